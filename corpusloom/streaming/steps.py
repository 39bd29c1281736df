"""Steps that need no state run on streams as they are; duplicates are dropped within a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import filters


def prepare(stream: DataFrame, text: str = "text", label: str = "lang", region: str = "region_code") -> DataFrame:
    """Lower case without numbers, empty and short records out, one labelled line each."""
    out = stream.withColumn(text, T.clean(F.col(text), lowercase=True, strip_numbers=True))
    out = filters.filter_short(filters.filter_empty(out, text, label), text)
    return out.withColumn("value", T.label_line(F.col(label), F.col(text), F.col(region)))


def drop_repeats(stream: DataFrame, at: str = "ingested_at", text: str = "text", delay: str = "30 days") -> DataFrame:
    """One row per text among those at most `delay` late; state is bounded by the watermark."""
    return stream.withWatermark(at, delay).withColumn("_h", F.md5(F.coalesce(text, F.lit("")))).dropDuplicatesWithinWatermark(["_h"]).drop("_h")


def counts_by_window(stream: DataFrame, at: str = "ingested_at", label: str = "lang", size: str = "1 day", delay: str = "30 days") -> DataFrame:
    """`window, label, n` of tumbling windows, late rows up to `delay` included."""
    return stream.withWatermark(at, delay).groupBy(F.window(at, size), label).agg(F.count("*").alias("n"))
