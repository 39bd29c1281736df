"""Per-key results although a few keys hold most rows.

Rows are range-partitioned on (key, value digest, row digest): the bounds are sampled quantiles of the composite key,
so a heavy key, and even one heavy value of it, is spread over as many partitions as it needs. Each partition forms
partial states of its keys; states of neighbouring partitions are stitched, counting a value that straddles a
boundary once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..runtime import cut, partitions_for

_STATE = "part int, key string, source string, n long, n_len long, sum_len long, d long, f1 long, f2 long, l1 long, l2 long"


def _states(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Partial states of a partition sorted by key and digest: one row per key (source NULL and `d` set), and one
    per key and source. Only adjacent rows are compared, so memory holds one batch and the states."""
    state: dict = {}
    sources: dict = {}
    last = None
    part = 0
    for f in frames:
        part = int(f["part"].iat[0])
        keys = f["key"].to_numpy(object)
        null = f["h1"].isna().to_numpy()
        h1, h2 = (f[c].fillna(0).to_numpy(np.int64) for c in ("h1", "h2"))
        codes, names = pd.factorize(f["key"], use_na_sentinel=False)
        fresh = np.ones(len(f), bool)
        fresh[1:] = (codes[1:] != codes[:-1]) | (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1]) | null[:-1]
        now = (None if pd.isna(keys[0]) else keys[0], int(h1[0]), int(h2[0]), bool(null[0]))
        if last == now:
            fresh[0] = False
        last = (None if pd.isna(keys[-1]) else keys[-1], int(h1[-1]), int(h2[-1]), bool(null[-1]))
        fresh &= ~null
        length = f["len"].fillna(0).to_numpy(np.int64)
        for c, name in enumerate(names):
            name = None if pd.isna(name) else name
            at = np.nonzero(codes == c)[0]
            full = at[~null[at]]
            s = state.setdefault(name, [0, 0, 0, 0, None, None, None, None])
            s[0] += len(at)
            s[1] += len(full)
            s[2] += int(length[full].sum())
            s[3] += int(fresh[at].sum())
            if len(full):
                if s[4] is None:
                    s[4], s[5] = int(h1[full[0]]), int(h2[full[0]])
                s[6], s[7] = int(h1[full[-1]]), int(h2[full[-1]])
        for (name, source), n in f.groupby([f["key"], f["source"]], dropna=False).size().items():
            if not pd.isna(source):
                k = (None if pd.isna(name) else name, source)
                sources[k] = sources.get(k, 0) + int(n)
    rows = [(part, k, None, *s) for k, s in state.items()] + [(part, k, s, n, *[None] * 7) for (k, s), n in sources.items()]
    if rows:
        out = pd.DataFrame(rows, columns=[c.split()[0] for c in _STATE.split(", ")])
        yield out.astype({c: "Int64" for c in out.columns[3:]})


def per_key_profile(df: DataFrame, key: Column, text: Column, source: Column, unique: Column, top: int = 3, partitions: int | None = None) -> DataFrame:
    """`key, n_rows, n_texts, mean_len, top_sources` of every key.

    `n_texts` counts distinct non-NULL texts (by 128-bit digest), `mean_len` is the mean length in code points of
    non-NULL texts to six decimals (NULL if none), `top_sources` are up to `top` sources as `name:rows` joined by
    blanks, most rows first, ties by name, NULL sources left out. A NULL key is a group of its own. `unique` should
    tell rows apart; where it doesn't, only balance suffers.
    """
    rows = df.select(
        key.cast("string").alias("key"), F.when(text.isNotNull(), F.xxhash64(text)).alias("h1"), F.when(text.isNotNull(), F.xxhash64(text, F.lit("second"))).alias("h2"),
        F.length(text).cast("long").alias("len"), source.alias("source"), F.xxhash64(unique).alias("r"),
    )
    if partitions is None:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(partitions, "key", "h1", "h2", "r").sortWithinPartitions("key", "h1", "h2")
    states = cut(ranged.withColumn("part", F.spark_partition_id()).drop("r").mapInPandas(_states, _STATE))
    order = W.partitionBy("key").orderBy("part")
    straddles = (F.col("f1") == F.lag("l1").over(order)) & (F.col("f2") == F.lag("l2").over(order))
    total = (
        states.where("d is not null")
        .select("*", F.coalesce(straddles, F.lit(False)).cast("long").alias("again"))
        .groupBy("key")
        .agg(F.sum("n").alias("n_rows"), F.sum(F.col("d") - F.col("again")).alias("n_texts"), F.round(F.sum("sum_len") / F.nullif(F.sum("n_len"), F.lit(0)), 6).alias("mean_len"))
    )
    by_source = states.where("d is null").groupBy("key", "source").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(W.partitionBy("key").orderBy(F.desc("n"), "source"))
    best = by_source.withColumn("rank", rank).where(F.col("rank") <= top).groupBy("key").agg(F.sort_array(F.collect_list(F.struct("rank", F.concat_ws(":", "source", "n").alias("s")))).alias("t"))
    best = best.select(F.col("key").alias("k"), F.concat_ws(" ", "t.s").alias("top_sources"))
    return total.join(best, total["key"].eqNullSafe(best["k"]), "left").select("key", "n_rows", "n_texts", "mean_len", "top_sources")


def heavy_keys(profile: DataFrame, share: float) -> DataFrame:
    """Keys of a profile, NULL aside, that hold at least `share` of the rows with a key."""
    known = profile.where("key is not null").select("key", "n_rows")
    total = known.agg(F.sum("n_rows")).first()[0] or 0
    return known.where(F.col("n_rows") >= F.lit(share) * F.lit(total)).select("key", "n_rows")


def _leads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`part, <keys>, id` in order of keys and id, and the first id of each run of equal keys within the partition."""
    last, lead = None, None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [c.to_numpy(zero_copy_only=False) for c in batch.columns[1:-1]]
        ids = batch.columns[-1].to_numpy(zero_copy_only=False)
        fresh = np.zeros(len(ids), bool)
        fresh[0] = last is None or any(k[0] != v for k, v in zip(keys, last))
        for k in keys:
            fresh[1:] |= k[1:] != k[:-1]
        if not fresh[0]:
            ids = np.concatenate([[lead], ids[1:]])
        first = np.maximum.accumulate(np.where(fresh, np.arange(len(ids)), 0))
        leads = ids[first]
        last, lead = [k[-1] for k in keys], leads[-1]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leads)], names=[*batch.schema.names, "lead"])


def run_leads(df: DataFrame, keys: list[str], id_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, spanning) of `df(<keys>, id)`, all whole numbers without NULL: `rows(<keys>, id, lead)` with the least id
    that has the same keys, and `spanning(lead)`, the leads of keys whose rows fill more than one partition.

    Rows are range-partitioned on keys and id, so equal keys, however many, lie in as many partitions as they need;
    only the first and last key of each partition are looked at together. `spanning` has at most one row a partition."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = ", ".join(["part int", *[f"`{k}` long" for k in keys], "id long", "lead long"])
    ordered = df.select(*keys, F.col(id_col).alias("id")).repartitionByRange(n, *keys, "id").sortWithinPartitions(*keys, "id")
    rows = cut(ordered.select(F.spark_partition_id().alias("part"), *keys, "id").mapInArrow(_leads, schema))
    ends = rows.groupBy("part").agg(F.min(F.struct(*keys, "lead")).alias("first"), F.max(F.struct(*keys, "lead")).alias("last")).orderBy("part").collect()
    before, found = None, {}
    for r in ends:
        first, last = tuple(r["first"]), tuple(r["last"])
        if before is not None and first[:-1] == before[:-1]:
            found[first[:-1]] = before[-1]
            if last[:-1] == first[:-1]:
                last = before
        before = last
    names = [f"_s{i}" for i in range(len(keys))]
    spans = spark.createDataFrame([(*k, v) for k, v in found.items()], ", ".join([*[f"{s} long" for s in names], "_lead long"]))
    on = None
    for k, s in zip(keys, names):
        on = (rows[k] == spans[s]) if on is None else on & (rows[k] == spans[s])
    out = rows.join(F.broadcast(spans), on, "left").select(*keys, "id", F.coalesce("_lead", "lead").alias("lead"))
    return out, spans.select(F.col("_lead").alias("lead"))


def expand(df: DataFrame, key: str, rows: DataFrame, lead: str, columns: dict[str, str], spanning: DataFrame, salts: int = 64) -> DataFrame:
    """`df` joined with `rows` on `key` = `lead`, with the columns of `rows` under new names. Keys in `spanning`, a small
    table of those that fill whole partitions, are spread over `salts` tasks."""
    hot = F.broadcast(spanning.select(F.col("lead").alias("_hot")))
    salt = F.when(F.col("_hot").isNotNull(), F.pmod(F.xxhash64(*[F.col(c) for c in columns]), F.lit(salts))).otherwise(0).cast("int")
    right = rows.join(hot, F.col(lead) == F.col("_hot"), "left").select(F.col(lead).alias("_key"), salt.alias("_salt"), *[F.col(c).alias(f"_c{i}") for i, c in enumerate(columns)])
    every = F.when(F.col("_hot").isNotNull(), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    left = df.join(hot, F.col(key) == F.col("_hot"), "left").select(*[df[c] for c in df.columns], F.explode(every).alias("_at"))
    # the salts of one key come from one row; they part before the join, however it is done
    left = left.repartition(partitions_for(df.sparkSession), key, "_at")
    out = left.join(right, (F.col(key) == F.col("_key")) & (F.col("_at") == F.col("_salt")))
    return out.select(*df.columns, *[F.col(f"_c{i}").alias(new) for i, new in enumerate(columns.values())])
