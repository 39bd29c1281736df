"""Metrics of label predictions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(df: DataFrame, gold: str = "gold", pred: str = "pred") -> DataFrame:
    """One row `n, correct, accuracy, precision_at_1, recall_at_1`; NULL never matches; ratios of no rows are 0.

    With one label and one prediction a row, precision and recall at one are the accuracy."""
    counted = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.coalesce((F.col(gold) == F.col(pred)).cast("long"), F.lit(0))), F.lit(0)).alias("correct"))
    ratio = F.round(F.coalesce(F.col("correct") / F.nullif(F.col("n"), F.lit(0)), F.lit(0.0)), 6)
    return counted.select("n", "correct", *[ratio.alias(c) for c in ("accuracy", "precision_at_1", "recall_at_1")])


def per_label(df: DataFrame, gold: str = "gold", pred: str = "pred", top: int | None = None) -> DataFrame:
    """`label, n, precision, recall` of every label that is gold or predicted, most frequent gold labels first."""
    pairs = df.groupBy(F.col(gold).alias("g"), F.col(pred).alias("p")).agg(F.count("*").alias("c"))
    by_gold = pairs.where("g is not null").groupBy(F.col("g").alias("label")).agg(F.sum("c").alias("n"), F.sum(F.when(F.col("g") == F.col("p"), F.col("c")).otherwise(0)).alias("hit"))
    by_pred = pairs.where("p is not null").groupBy(F.col("p").alias("label")).agg(F.sum("c").alias("n_pred"))
    both = by_gold.join(by_pred, "label", "full")
    ratio = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 6)
    out = both.select("label", F.coalesce("n", F.lit(0)).alias("n"), ratio(F.col("hit"), F.col("n_pred")).alias("precision"), ratio(F.col("hit"), F.col("n")).alias("recall"))
    return out if top is None else out.orderBy(F.desc("n"), "label").limit(top)


def latest(df: DataFrame, key: str = "rec_id", at: str = "evaluated_at") -> DataFrame:
    """The last run's row of each record, rows delivered twice once; ties by prediction, then probability."""
    rest = [c for c in df.columns if c not in (key, at)]
    best = df.groupBy(key).agg(F.max(F.struct(at, *rest)).alias("r"))
    return best.select(key, *[F.col(f"r.{c}").alias(c) for c in (at, *rest)]).select(*df.columns)
