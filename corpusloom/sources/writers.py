"""Sinks of corpus artefacts. Partition columns make the directories; a salt keeps a heavy partition from one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import label_line

#: Codecs of parquet files; `none` writes them uncompressed.
CODECS = ("snappy", "zstd", "gzip", "brotli", "lz4", "none")


def write_partitioned(df: DataFrame, path: str, by: list[str], compression: str = "snappy", files_per_partition: int | None = None, mode: str = "overwrite") -> None:
    """Parquet by `by`, such as script or (split, script).

    Without `files_per_partition` tasks write what they hold, which needs no shuffle; with it rows are spread over so
    many files a partition by hash, whatever a partition's size."""
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {CODECS}")
    if files_per_partition:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_partition))
        df = df.withColumn("_salt", salt).repartition(*[F.col(c) for c in by], F.col("_salt")).drop("_salt")
    df.write.mode(mode).option("compression", "uncompressed" if compression == "none" else compression).partitionBy(*by).parquet(path)


def write_label_lines(df: DataFrame, path: str, label: str = "lang", text: str = "text", region: str | None = "region_code", by: list[str] = ("split", "script"), mode: str = "overwrite") -> None:
    """Text files of labelled lines; an absent region column prints as ''."""
    line = label_line(F.col(label), F.col(text), F.col(region) if region and region in df.columns else F.lit(""))
    by = [c for c in by if c in df.columns]
    out = df.select(line.alias("value"), *by).write.mode(mode)
    (out.partitionBy(*by) if by else out).text(path)


def prediction_rows(df: DataFrame) -> DataFrame:
    """Columns as they are written: NULL gold or prediction as '', probability with six decimals."""
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return df.select(blank("gold").alias("gold"), blank("pred").alias("pred"), F.format_string("%.6f", F.coalesce(F.col("prob"), F.lit(0.0))).alias("prob"), F.regexp_replace(blank("text"), r"[\t\r\n]+", " ").alias("text"))


def write_predictions(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated, with a header, without quoting."""
    prediction_rows(df).write.mode(mode).option("sep", "\t").option("header", "true").option("quote", "").option("escape", "").option("emptyValue", "").option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(path)


def write_arguments(spark, arguments: dict, path: str, mode: str = "overwrite") -> None:
    """One JSON object of parameters."""
    import json

    spark.createDataFrame([(json.dumps(arguments, sort_keys=True),)], "value string").coalesce(1).write.mode(mode).text(path)
