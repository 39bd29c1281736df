"""Named compositions of the steps, each lazily planned as one Spark job per sink."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.scripts import dominant_script, purity_filter
from ..operators import balance, chunks, dedup, filters, snippets, split
from ..runtime import cut
from ..sources.writers import write_partitioned


@dataclass
class Options:
    """Parameters of the steps."""

    lowercase: bool = True
    strip_numbers: bool = True
    digits: bool = False
    wiki: bool = True
    form: str = "NFC"
    purity: str | None = "likely"
    bands: int = dedup.BANDS
    distance: int = dedup.DISTANCE
    max_words: int = 8
    max_chars: int = 40
    min_count: int = 1
    train: float = 0.8
    valid: float = 0.1
    min_per_class: int = 3
    seed: int = 42
    balance: str = "max"
    balance_target: int = 0
    snippet_splits: list[str] | None = field(default=None)


def route(df: DataFrame, o: Options) -> DataFrame:
    return df.withColumn("script", dominant_script(df.sparkSession, F.col("text")))


def clean(df: DataFrame, o: Options) -> DataFrame:
    return df.withColumn("text", T.clean(F.col("text"), lowercase=o.lowercase, strip_numbers=o.strip_numbers, digits=o.digits, wiki=o.wiki, form=o.form))


def pure(df: DataFrame, o: Options) -> DataFrame:
    """Words in scripts the language isn't written in are left out; `purity=None` keeps them. A label counts by its first
    part; texts whose label names no language with a known script stay whole in mode `likely`."""
    if not o.purity:
        return df
    tag = F.regexp_extract(F.lower(F.trim("lang")), "^([^-_]*)", 1)
    # the locale data would take "und" for English
    tagged = df.withColumn("_tag", F.nullif(tag, F.lit("und")))
    return purity_filter(tagged, "text", "_tag", o.purity, keep_unknown=o.purity == "likely").drop("_tag")


def filter_empty(df: DataFrame, o: Options) -> DataFrame:
    return filters.filter_empty(df)


def exact(df: DataFrame, o: Options) -> DataFrame:
    return dedup.exact_dedup(df, keys=["script"])


def near(df: DataFrame, o: Options) -> DataFrame:
    return dedup.near_dedup(df, keys=["script"], bands=o.bands, distance=o.distance)


def short(df: DataFrame, o: Options) -> DataFrame:
    return filters.filter_short(df, max_words=o.max_words, max_chars=o.max_chars)


def low_count(df: DataFrame, o: Options) -> DataFrame:
    return filters.filter_low_count_labels(df, min_count=o.min_count)


def split_long(df: DataFrame, o: Options) -> DataFrame:
    out = chunks.split_long_entries(df, keys=["script"])
    # pieces need ids of their own, which a hash would not make sure
    return out.withColumn("row_id", F.concat_ws("-", "row_id", "piece")).drop("piece")


def splits(df: DataFrame, o: Options) -> DataFrame:
    return split.stratified_split(df, keys=["script"], train=o.train, valid=o.valid, seed=o.seed, min_rows=o.min_per_class)


def balanced(df: DataFrame, o: Options) -> DataFrame:
    return balance.balance(df, keys=["script", "split"], mode=o.balance, target=o.balance_target, seed=o.seed)


def augmented(df: DataFrame, o: Options) -> DataFrame:
    keyed = df.withColumn("_key", F.concat_ws("|", "row_id", "copy"))
    return snippets.augment(keyed, row_id="_key", seed=o.seed, splits=o.snippet_splits).drop("_key")


def lines(df: DataFrame, o: Options) -> DataFrame:
    return df.select("split", "script", T.label_line(F.col("lang"), F.col("text"), F.col("region_code")).alias("value"))


def keep(df: DataFrame, o: Options) -> DataFrame:
    """Materialised once: the steps after it read it several times, those before it are costly."""
    return cut(df)


#: Steps in order; each maps a DataFrame and options to a DataFrame.
PIPELINES: dict[str, list[Callable[[DataFrame, Options], DataFrame]]] = {
    "full": [route, clean, pure, filter_empty, keep, exact, near, short, keep, low_count, split_long, keep, splits, balanced, augmented, lines],
    "wired": [route, splits, lines],
}


def run(name: str, df: DataFrame, options: Options | None = None, until: str | None = None, counters: dict[str, Observation] | None = None) -> DataFrame:
    """The named pipeline over `row_id, text, lang, region_code`, up to the step named `until`.

    `counters` receives an observation per step, `rows` being what the step gave; it is known once an action has run and
    costs no pass of its own. A step that feeds several others counts its rows at its first use."""
    o = options or Options()
    for k, step in enumerate(PIPELINES[name]):
        df = step(df, o)
        if counters is not None and step is not keep:
            seen = counters[step.__name__] = Observation(f"{k}-{step.__name__}")
            df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if step.__name__ == until:
            break
    return df


def write_routed(df: DataFrame, path: str, options: Options | None = None, **write) -> None:
    """Rows routed by script and written as Parquet, one folder a script."""
    write_partitioned(route(df, options or Options()), path, ["script"], **write)
