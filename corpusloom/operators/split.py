"""Stratified splits: exact sizes per label, membership by seeded hash."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import broadcast_if_small, cut
from .filters import with_group


def split_sizes(n: Column, train: float = 0.8, valid: float = 0.1) -> tuple[Column, Column]:
    """Rows of train and valid of a label with `n` rows; test gets the rest.

    Shares are truncated; from three rows on train and valid get one at least, and if nothing is left for test the
    larger of them, train among equals, gives one up."""
    many = n >= 3
    tr0 = F.floor(n * F.lit(float(train))).cast("long")
    va0 = F.floor(n * F.lit(float(valid))).cast("long")
    tr1 = F.when(many & (tr0 == 0), 1).otherwise(tr0)
    va1 = F.when(many & (va0 == 0), 1).otherwise(va0)
    lacks = many & (n - tr1 - va1 <= 0)
    from_train = (tr1 >= va1) & (tr1 > 1)
    from_valid = ~from_train & (va1 > 1)
    tr2 = F.when(lacks & from_train, tr1 - 1).when(lacks & ~from_valid, F.greatest(F.lit(1), tr1 - 1)).otherwise(tr1)
    va2 = F.when(lacks & from_valid, va1 - 1).otherwise(va1)
    return F.greatest(tr2, F.lit(0)), F.greatest(va2, F.lit(0))


def stratified_split(df: DataFrame, label: str = "lang", row_id: str = "row_id", keys: list[str] = (), train: float = 0.8, valid: float = 0.1, seed: int = 42, min_rows: int = 3, intersect: bool = True) -> DataFrame:
    """The rows with a column `split`. Labels of fewer than `min_rows` rows go, then labels that some split lacks.

    Only (label, hash, id) is ranked, in range partitions whose bounds are sampled quantiles, so a label with most of
    the rows is ranked by many tasks. What comes back is one pair of bounds per label; rows find their split by
    comparing their own hash with these, without being moved. NULL labels are no class and go."""
    if train <= 0 or valid < 0 or train + valid >= 1:
        raise ValueError("shares must be positive and leave room for test")
    group = [*keys, label]
    h = F.md5(F.concat_ws("#", F.lit(str(seed)), F.col(row_id)))
    narrow = df.where(F.col(label).isNotNull()).select(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], h.alias("_h"), F.col(row_id).alias("_id"))
    names = [f"_g{i}" for i in range(len(group))]
    tr, va = split_sizes(F.col("_total"), train, valid)
    spots = ranked(narrow, names, [F.col("_h"), F.col("_id")], "_rank", "_total").withColumns({"_tr": tr, "_va": va}).where((F.col("_rank") == 1) | (F.col("_rank") == F.col("_tr")) | (F.col("_rank") == F.col("_tr") + F.col("_va")))
    at = F.struct("_h", "_id")
    bounds = spots.groupBy(*names).agg(
        F.first("_total").alias("_total"), F.first("_tr").alias("_tr"), F.first("_va").alias("_va"),
        F.max(F.when(F.col("_rank") == F.col("_tr"), at)).alias("_to_train"), F.max(F.when(F.col("_rank") == F.col("_tr") + F.col("_va"), at)).alias("_to_valid"),
    )
    if min_rows > 0:
        bounds = bounds.where(F.col("_total") >= min_rows)
    if intersect:
        # a label is common if all its sizes are positive; where a whole split is empty, none is asked to be
        sizes = [F.col("_tr"), F.col("_va"), F.col("_total") - F.col("_tr") - F.col("_va")]
        full = F.least(*[F.max(s) for s in sizes]) > 0
        bounds = with_group(bounds, names[:-1], full.alias("_full")).where((F.least(*sizes) > 0) | ~F.col("_full")).drop("_full")
    bounds = broadcast_if_small(bounds)
    on = None
    for g, n in zip(group, names):
        c = df[g].eqNullSafe(bounds[n])
        on = c if on is None else on & c
    own = F.struct(h.alias("_h"), F.col(row_id).alias("_id"))
    split = F.when(own <= F.col("_to_train"), "train").when(own <= F.col("_to_valid"), "valid").otherwise("test")
    return df.join(bounds, on).withColumn("split", split).select(*[df[c] for c in df.columns], "split")


def ranked(df: DataFrame, group: list[str], order: list[Column], rank: str, total: str | None = None) -> DataFrame:
    """`rank` from 1 within each group in the given order, and the group's size, without one task per group.

    Rows are range-partitioned on group and order; a window ranks them within (partition, group), and the sizes of
    these pieces, one row each, give every piece its offset."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = [f"_o{i}" for i in range(len(order))]
    with_order = df.select("*", *[c.alias(o) for o, c in zip(names, order)])
    ranged = cut(with_order.repartitionByRange(n, *group, *names).withColumn("_part", F.spark_partition_id()))
    pieces = ranged.groupBy("_part", *group).agg(F.count("*").alias("_n"))
    by_group = W.partitionBy(*group)
    pieces = pieces.select("*", F.coalesce(F.sum("_n").over(by_group.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_before"), F.sum("_n").over(by_group).alias("_all"))
    keys = [F.col(g).alias(f"_q{i}") for i, g in enumerate(group)]
    pieces = pieces.select(F.col("_part").alias("_p"), *keys, "_before", "_all")
    local = ranged.withColumn("_local", F.row_number().over(W.partitionBy("_part", *group).orderBy(*names)))
    on = local["_part"] == pieces["_p"]
    for i, g in enumerate(group):
        on = on & local[g].eqNullSafe(pieces[f"_q{i}"])
    out = local.join(pieces, on).withColumn(rank, F.col("_before") + F.col("_local"))
    if total:
        out = out.withColumn(total, F.col("_all"))
    return out.drop("_part", "_local", "_p", "_before", "_all", *names, *[f"_q{i}" for i in range(len(group))])


def split_stats(df: DataFrame, keys: list[str] = (), label: str = "lang") -> DataFrame:
    """`keys, split, n_rows, n_labels`."""
    return df.groupBy(*keys, "split").agg(F.count("*").alias("n_rows"), F.count_distinct(label).alias("n_labels"))


def label_summary(df: DataFrame, label: str = "lang") -> DataFrame:
    """One row: distinct labels in train, valid and test, in any, and in all three."""
    flags = df.groupBy(label).agg(*[F.max((F.col("split") == s).cast("int")).alias(s) for s in ("train", "valid", "test")]).where(F.col(label).isNotNull())
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return flags.agg(*[total(s).alias(f"labels_{s}") for s in ("train", "valid", "test")], total(F.greatest("train", "valid", "test")).alias("labels_any"), total(F.least("train", "valid", "test")).alias("labels_all"))
