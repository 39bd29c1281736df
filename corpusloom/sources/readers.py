"""Readers of corpus artefacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip
from ..operators.filters import subset_of_path


def read_shards(spark: SparkSession, path: str, columns: list[str] | None = None, recursive: bool = False, schema: T.StructType | None = None) -> DataFrame:
    """Parquet files (`*.parquet`, `*.pq`) of a directory, or one file; nested ones with `recursive`. Missing paths raise."""
    reader = spark.read.option("recursiveFileLookup", "true" if recursive else "false")
    if not path.endswith((".parquet", ".pq")):
        reader = reader.option("pathGlobFilter", "*.{parquet,pq}")
    df = (reader.schema(schema) if schema is not None else reader).parquet(path)
    return df.select(*columns) if columns else df


def canonical(df: DataFrame, row_id: str, text: str = "text", lang: str | None = "lang", region: str | None = None) -> DataFrame:
    """`row_id, text, lang, region_code` of any table; absent columns are ''. Other columns stay where names don't clash."""
    pick = lambda c: F.col(c).cast("string") if c else F.lit("")
    used = {row_id, text, lang, region, "row_id", "text", "lang", "region_code"}
    return df.select(F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("text"), pick(lang).alias("lang"), pick(region).alias("region_code"), *[c for c in df.columns if c not in used])


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """`value, file_path, subset` of the text lines below a path; blank lines are left out."""
    lines = spark.read.option("recursiveFileLookup", "true").text(path)
    at = F.col("_metadata.file_path")
    return lines.select("value", at.alias("file_path"), subset_of_path(at).alias("subset")).where(strip(F.col("value")) != "")


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """`gold, pred, prob, text` of tab-separated predictions with a header and no quoting."""
    return spark.read.schema("gold string, pred string, prob double, text string").option("sep", "\t").option("header", "true").option("quote", "").option("escape", "").csv(path)
