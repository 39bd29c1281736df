"""Cutting long entries at blanks."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small
from .dedup import chunk_numbers


def split_text(text: str | None, limit: int) -> list[str | None]:
    """Pieces of at most `limit` code points: up to the last blank U+0020 before the limit, or at the limit.

    Both sides of a cut are stripped. NULL and '' are their own single piece; a remainder without characters is left
    out, but a text of blanks gives one empty piece."""
    if not text or not limit:
        return [text]
    out, at, end = [], 0, len(text)
    while end - at > limit:
        cut = text.rfind(" ", at, at + limit)
        if cut < 0:
            cut = at + limit
        out.append(text[at:cut].strip())
        at = cut
        # the remainder is stripped on both sides before it is measured again
        while at < end and text[at].isspace():
            at += 1
        while end > at and text[end - 1].isspace():
            end -= 1
    if end > at:
        out.append(text[at:end])
    return out


def _pieces(text: Column, limit: Column) -> Column:
    @F.pandas_udf("array<string>")
    def run(texts: pd.Series, limits: pd.Series) -> pd.Series:
        return pd.Series([split_text(t, int(n)) for t, n in zip(texts, limits)], dtype=object)

    return run(text, limit)


def mean_length(df: DataFrame, text: str = "text", keys: list[str] = (), default: int = 100) -> DataFrame:
    """`limit` per group: the truncated mean length of its texts, NULL left out; `default` where that is 0."""
    mean = F.floor(F.avg(F.length(text))).cast("int")
    return df.groupBy(*keys).agg(F.when(F.coalesce(mean, F.lit(0)) > 0, mean).otherwise(default).alias("limit"))


def split_long_entries(df: DataFrame, text: str = "text", row_id: str = "row_id", keys: list[str] = (), limit: int | None = None, batch_rows: int | None = None) -> DataFrame:
    """One row per piece, numbered by `piece` from 0; all columns stay.

    The limit is given or the mean length of the group in `keys`; with `batch_rows` that of each run of so many
    consecutive ids."""
    if limit is not None:
        sized = df.withColumn("_limit", F.lit(limit))
    else:
        on = [*keys]
        if batch_rows:
            df = chunk_numbers(df, row_id, batch_rows).withColumnRenamed("chunk", "_chunk")
            on.append("_chunk")
        df = df.withColumn("_one", F.lit(1))
        on.append("_one")
        means = mean_length(df, text, on).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on)], F.col("limit").alias("_limit"))
        means = broadcast_if_small(means)
        match = None
        for i, k in enumerate(on):
            c = df[k].eqNullSafe(means[f"_k{i}"])
            match = c if match is None else match & c
        sized = df.join(means, match).drop(*[f"_k{i}" for i in range(len(on))], "_one", "_chunk")
    columns = [c for c in sized.columns if c not in (text, "_limit")]
    return sized.select(*columns, F.posexplode(_pieces(F.col(text), F.col("_limit"))).alias("piece", text))
