"""Word and character snippets of texts, drawn reproducibly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import let, rand_int, words


def word_snippets(text: Column, key: Column, n: int = 8, low: int = 3, high: int = 8, seed: int = 42) -> Column:
    """`n` spans of `low` to `high` words; shorter texts give all their words, wordless and NULL ones nothing."""
    none = F.array().cast("array<string>")

    def spans(ws: Column) -> Column:
        size = F.size(ws)

        def one(i: Column) -> Column:
            length = rand_int(seed, F.lit(low), F.greatest(F.lit(low), F.least(F.lit(high), size)), key, F.lit("wl"), i)
            start = F.when(size <= length, 0).otherwise(rand_int(seed, F.lit(0), F.greatest(size - length, F.lit(0)), key, F.lit("ws"), i))
            return F.array_join(F.slice(ws, start + 1, length), " ")

        return F.when(size > 0, F.transform(F.sequence(F.lit(1), F.lit(n)), one)).otherwise(none)

    return none if n <= 0 else let(words(text), spans)


def char_snippets(text: Column, key: Column, n: int = 4, low: int = 20, high: int = 60, seed: int = 42) -> Column:
    """`n` spans of `low` to `high` code points; a shorter text gives itself, an empty or NULL one nothing."""
    size = F.length(text)

    def one(i: Column) -> Column:
        length = rand_int(seed, F.lit(low), F.greatest(F.lit(low), F.least(F.lit(high), size)), key, F.lit("cl"), i)
        start = F.when(size <= length, 0).otherwise(rand_int(seed, F.lit(0), F.greatest(size - length, F.lit(0)), key, F.lit("cs"), i))
        return F.substr(text, start + 1, length)

    none = F.array().cast("array<string>")
    return none if n <= 0 else F.when(size > 0, F.transform(F.sequence(F.lit(1), F.lit(n)), one)).otherwise(none)


#: The same draw over region texts.
region_snippets = char_snippets


def augment(df: DataFrame, text: str = "text", row_id: str = "row_id", n_words: int = 8, n_chars: int = 4, word_range: tuple[int, int] = (3, 8), char_range: tuple[int, int] = (20, 60), seed: int = 42, splits: list[str] | None = None) -> DataFrame:
    """Every row, and one per snippet; `snippet` numbers them from 0, the row itself. `splits` restricts snippets to
    rows of these values of the column `split`."""
    key = F.col(row_id).cast("string")
    extra = F.concat(word_snippets(F.col(text), key, n_words, *word_range, seed=seed), char_snippets(F.col(text), key, n_chars, *char_range, seed=seed))
    if splits is not None:
        extra = F.when(F.col("split").isin(*splits), extra).otherwise(F.array().cast("array<string>"))
    columns = [c for c in df.columns if c != text]
    return df.select(*columns, F.posexplode(F.concat(F.array(F.col(text)), extra)).alias("snippet", text))
