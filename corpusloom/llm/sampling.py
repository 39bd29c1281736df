"""A sample of given size whose categories follow target shares, by the cube method.

Integer targets fix one inclusion probability per category. The flight phase moves pairs of undecided records of a
category (the null space of the category indicators) until at most one per category is undecided in each
partition; those few merge upward in wider and wider groups; landing decides the last one of each category, whose
probability is by then 0 or 1 up to rounding, because the targets are whole numbers.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import reads_as  # noqa: F401  (part of this operator's interface)
from ..runtime import blocks_of, by_id, cut, small
from .words import mix

FRACTION = 5
#: Partitions whose undecided records meet on the next level.
_FAN_IN = 64
#: Records of one flight.
_BLOCK = 1 << 16


def allocate(counts: dict[str, int], targets: list[tuple[str, float, int]], total: int) -> list[dict]:
    """Whole-number sample sizes. Each category wants max(minimum, floor(share x total)); what it lacks, and what
    rounding leaves, goes to categories that still have records, in proportion to their shares; what minimums take
    beyond `total` comes from the categories furthest above their minimum."""
    rows = [{"category": c, "available": counts.get(c, 0), "share": s, "minimum": m, "wanted": max(m, int(s * total))} for c, s, m in sorted(targets)]
    for r in rows:
        r["size"] = min(r["available"], r["wanted"])
    rest = total - sum(r["size"] for r in rows)
    while rest > 0 and (open_ := [r for r in rows if r["available"] > r["size"] and r["share"] > 0]):
        whole = sum(r["share"] for r in open_)
        gains = [(r, min(r["available"] - r["size"], int(rest * r["share"] / whole))) for r in open_]
        if not any(g for _, g in gains):
            gains = [(r, 1) for r in sorted(open_, key=lambda r: (-r["share"], r["category"]))[:rest]]
        for r, g in gains:
            r["size"] += g
            rest -= g
    over = sorted((r for r in rows if r["size"] > r["minimum"]), key=lambda r: r["category"])
    room = sum(r["size"] - r["minimum"] for r in over)
    if rest < 0 and room:
        take = min(-rest, room)
        cut, done = {r["category"]: take * (r["size"] - r["minimum"]) // room for r in over}, 0
        done = sum(cut.values())
        for r in over:
            extra = min(take - done, r["size"] - r["minimum"] - cut[r["category"]])
            r["size"] -= cut[r["category"]] + extra
            done += extra
    for r in rows:
        r["short"] = r["available"] < r["wanted"]
    return rows


def fly(category: np.ndarray, p: np.ndarray, key: np.ndarray, seed: int = 0) -> np.ndarray:
    """One flight: probabilities all but at most one per category 0 or 1, with the same sum in each category.

    Undecided records of a category are paired and moved along (1, -1), a null vector of the indicators, until one of
    the two is decided; the rest are paired again. All pairs of a round move at once."""
    p = p.astype(float)
    p[p < 1e-9], p[p > 1 - 1e-9] = 0.0, 1.0
    code = np.unique(category, return_inverse=True)[1] if len(category) else np.zeros(0, np.int64)
    turn = 0
    while True:
        at = np.nonzero((p > 0) & (p < 1))[0]
        at = at[np.argsort(code[at], kind="stable")]
        first = np.searchsorted(code[at], code[at])
        even = (np.arange(len(at)) - first) % 2 == 0
        i = np.nonzero(even[:-1] & (code[at][1:] == code[at][:-1]))[0]
        if not len(i):
            return p
        i, j = at[i], at[i + 1]
        # whichever step size reaches a face first, in either direction, with mean zero
        up, down = np.minimum(1 - p[i], p[j]), np.minimum(p[i], 1 - p[j])
        u = mix(mix(key[i] ^ np.uint64(seed * 2654435761 + turn)) ^ key[j]) / 2.0**64
        d = np.where(u * (up + down) < down, up, -down)
        p[i] += d
        p[j] -= d
        p[p < 1e-9], p[p > 1 - 1e-9] = 0.0, 1.0
        turn += 1


def _flight(seed: int, land: bool):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        waiting: list[pd.DataFrame] = []
        held = 0

        def flown(last: bool) -> list[pd.DataFrame]:
            f = pd.concat(waiting, ignore_index=True)
            key = f["h"].to_numpy(np.int64).view(np.uint64)
            f["p"] = p = fly(f["category"].to_numpy(), f["p"].to_numpy(), key, seed)
            undecided = (p > 0) & (p < 1)
            if not last:
                # what is undecided flies on with the next block, so a partition leaves one record per category
                return [f[p == 1], f[undecided]]
            drawn = mix(key ^ np.uint64(seed + 1)) / 2.0**64 < p
            return [f[p == 1], f[undecided & drawn].assign(p=1.0) if land else f[undecided]]

        for f in frames:
            # blocks of a fixed size, whatever the batches, so that these don't change the draw
            while len(f):
                part, f = f.iloc[: _BLOCK - held], f.iloc[_BLOCK - held :]
                waiting.append(part)
                held += len(part)
                if held == _BLOCK:
                    done, left = flown(False)
                    yield done
                    waiting, held = [left], 0
        if waiting:
            yield from flown(True)

    return run


def cube_sample(df: DataFrame, id_col: str, category: Column, sizes: dict[str, tuple[int, int]], seed: int = 7) -> DataFrame:
    """`id, category` of a sample with `sizes[c] = (wanted, available)` records of each category.

    Records are dealt out by their ids, so the sample depends on the records and the seed only."""
    spark = df.sparkSession
    schema = f"id {df.schema[id_col].dataType.simpleString()}, category string, h long, p double"
    rate = [(c, k / n) for c, (k, n) in sorted(sizes.items()) if n and k]
    if not rate:
        return df.select(F.col(id_col).alias("id"), F.lit(None).cast("string").alias("category")).where("false")
    rates = F.broadcast(spark.createDataFrame(rate, "category string, p double"))
    total = sum(n for c, (k, n) in sizes.items() if k)
    rows = df.select(F.col(id_col).alias("id"), category.alias("category")).join(rates, "category")
    rows = by_id(rows.select("id", "category", F.xxhash64(F.lit(seed), "id").alias("h"), "p"), "id", total)
    parts = blocks_of(total)
    state, step = rows.mapInPandas(_flight(seed, parts == 1), schema), 0
    chosen = []
    while parts > 1:
        # decided records stay where they are; at most one per category and partition goes up a level
        state = cut(state.withColumn("meet", F.floor(F.spark_partition_id() / _FAN_IN)))
        chosen.append(state.where("p = 1").drop("meet"))
        parts, step = -(-parts // _FAN_IN), step + 1
        met = state.where("p < 1").repartition(parts, "meet").sortWithinPartitions("meet", "h", "id").drop("meet")
        state = met.mapInPandas(_flight(seed + step, parts == 1), schema)
    out = state
    for c in chosen:
        out = out.unionByName(c)
    return out.where("p = 1").select("id", "category")


def plan(df: DataFrame, category: Column, targets: DataFrame, fraction: int = FRACTION) -> list[dict]:
    """The allocation for a sample of one `fraction`-th (rounded down) of the rows with a category."""
    counted = df.groupBy(category.alias("category")).agg(F.count("*").alias("n")).where("category is not null")
    counts = {r["category"]: r["n"] for r in small(counted)}
    wanted = [(r[0], r[1] or 0.0, r[2] or 0) for r in small(targets) if r[0] is not None]
    return allocate(counts, wanted, sum(counts.values()) // fraction)


def balanced_sample(df: DataFrame, id_col: str, category: Column, targets: DataFrame, fraction: int = FRACTION, seed: int = 7) -> DataFrame:
    """`id, category` of the sample; `targets(category, share, minimum)`. Rows without a category aren't drawn."""
    sizes = {r["category"]: (r["size"], r["available"]) for r in plan(df, category, targets, fraction)}
    return cube_sample(df, id_col, category, sizes, seed)


def balance_report(df: DataFrame, id_col: str, category: Column, targets: DataFrame, fraction: int = FRACTION, seed: int = 7) -> DataFrame:
    """Per target category `category, available, wanted, sampled, share, actual_share, residual, short`, counted on
    the sample itself; `short` where the category's records don't suffice for what it wants, `residual` is what the
    sample has more than was allocated."""
    spark = df.sparkSession
    rows = plan(df, category, targets, fraction)
    sizes = {r["category"]: (r["size"], r["available"]) for r in rows}
    schema = "category string, available long, wanted long, share double, size long, short boolean"
    goals = spark.createDataFrame([(r["category"], r["available"], r["wanted"], float(r["share"]), r["size"], r["short"]) for r in rows], schema)
    drawn = cube_sample(df, id_col, category, sizes, seed).groupBy("category").agg(F.count("*").alias("n"))
    total = max(1, sum(r["size"] for r in rows))
    sampled = F.coalesce("n", F.lit(0))
    return goals.join(drawn, "category", "left").select(
        "category", "available", "wanted", sampled.alias("sampled"), "share", (sampled / F.lit(total)).alias("actual_share"), (sampled - F.col("size")).alias("residual"), "short"
    )
