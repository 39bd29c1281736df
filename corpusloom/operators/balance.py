"""Oversampling of label groups to exact sizes."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import draw
from ..runtime import broadcast_if_small, partitions_for
from .split import ranked

MODES = ("max", "median_x2", "none")
#: Copies of a row that one task makes at most, on average; draws of a group that are numbered together.
COPIES_PER_TASK, _BLOCK = 1_000, 10_000


def balance(df: DataFrame, label: str = "lang", region: str | None = None, row_id: str = "row_id", keys: list[str] = (), mode: str = "max", target: int = 0, seed: int = 42) -> DataFrame:
    """All rows, and copies of seeded random ones so that each group reaches its target; `copy` is 0 for originals.

    `max` aims at the largest group, `median_x2` at twice the median (truncated), `none` at the group itself; `target`
    raises any aim. Groups are (label, region) within `keys`. With `none` and no target nothing changes; else rows
    with a NULL group key go. Missing rows are drawn as (group, rank) pairs spread over all tasks and joined with the
    ranked originals, so no group is gathered."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    if mode == "none" and target <= 0:
        return df.withColumn("copy", F.lit(0).cast("long"))
    group = [*keys, label, *([region] if region else [])]
    rows = df.dropna(subset=[label, *([region] if region else [])])
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_n"))
    if mode == "none":
        aims = sizes.withColumn("_aim", F.col("_n"))
    else:
        on = [*keys, "_one"]
        sizes = sizes.withColumn("_one", F.lit(1))
        whole = sizes.groupBy(*on).agg(F.max("_n").alias("_max"), F.median("_n").cast("long").alias("_median"))
        aims = sizes.join(broadcast_if_small(whole), on)
        aims = aims.withColumn("_aim", F.col("_max") if mode == "max" else F.greatest(2 * F.col("_median"), F.col("_n")))
    aims = aims.withColumn("_need", F.greatest(F.col("_aim"), F.lit(target)) - F.col("_n")).where("_need > 0")
    # a row drawn so often that its copies are too many for one task is looked up under several salts
    aims = aims.withColumn("_salts", F.greatest(F.lit(1), F.ceil(F.col("_need") / F.col("_n") / COPIES_PER_TASK)).cast("int"))
    aims = broadcast_if_small(aims.select(*[F.col(g).alias(f"_a{i}") for i, g in enumerate(group)], "_n", "_need", "_salts"))
    # needs are exploded in two steps, so a group that lacks millions of rows isn't one task's work
    names = [f"_a{i}" for i in range(len(group))]
    blocks = aims.select(*names, "_n", "_need", "_salts", F.explode(F.sequence(F.lit(0).cast("long"), ((F.col("_need") - 1) / _BLOCK).cast("long"))).alias("_b"))
    # a number of partitions keeps these few rows, from which millions are drawn, from being merged into one task
    parts = partitions_for(df.sparkSession)
    blocks = blocks.repartition(parts, "_b", *names)
    draws = blocks.select(*names, "_n", "_salts", F.explode(F.sequence(F.col("_b") * _BLOCK + 1, F.least(F.col("_need"), (F.col("_b") + 1) * _BLOCK))).alias("copy"))
    pick = draw(seed, *[F.col(a).cast("string") for a in names], F.col("copy").cast("string")) % F.col("_n") + 1
    draws = draws.select(*[F.col(a).alias(f"_d{i}") for i, a in enumerate(names)], "copy", pick.alias("_pick"), (F.col("copy") % F.col("_salts")).cast("int").alias("_salt"))

    def same(left: DataFrame, mine: list[str], right: DataFrame, theirs: list[str]):
        return functools.reduce(lambda x, y: x & y, [left[m].eqNullSafe(right[t]) for m, t in zip(mine, theirs)])

    def salted(df: DataFrame, columns: list[str]) -> DataFrame:
        """The rows of groups that lack some, once for every salt."""
        return df.join(aims, same(df, columns, aims, names)).select(*[df[c] for c in df.columns], F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)).alias("_at"))

    # a row's salts part before each join, however it is done, so that its copies don't stay together
    # ids alone are ranked and drawn; the rows are joined once, on their id
    keys = [f"_g{i}" for i in range(len(group))]
    numbered = salted(ranked(rows.select(*[F.col(g).alias(k) for g, k in zip(group, keys)], F.col(row_id).alias("_id")), keys, [F.col("_id")], "_rank"), keys).repartition(parts, *keys, "_rank", "_at")
    on = (numbered["_rank"] == draws["_pick"]) & (numbered["_at"] == draws["_salt"]) & same(numbered, keys, draws, [f"_d{i}" for i in range(len(group))])
    # Spark takes exploded rows for as few as what they come from, and would broadcast all draws through the driver
    drawn = numbered.join(draws.hint("merge"), on).select("_id", "copy", "_salt")
    source = salted(rows, group).repartition(parts, row_id, "_at")
    extra = source.join(drawn, (source[row_id] == drawn["_id"]) & (source["_at"] == drawn["_salt"])).select(*rows.columns, "copy")
    return rows.withColumn("copy", F.lit(0).cast("long")).unionByName(extra)


def group_sizes(df: DataFrame, label: str = "lang", region: str | None = None, keys: list[str] = ()) -> DataFrame:
    return df.groupBy(*keys, label, *([region] if region else [])).agg(F.count("*").alias("n"))


