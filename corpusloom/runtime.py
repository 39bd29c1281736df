"""Session-level helpers: reading tables, cutting lineage, checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Largest number of rows that `small()` will let a query broadcast or collect.
SMALL_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """A scan of fewer splits than half the cores, such as one small file, dealt out to all cores; any other as it is.

    So little input moves cheaply, and only the columns and rows that pass the filters do."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if 2 * df.rdd.getNumPartitions() < cores else df


def partitions_for(spark: SparkSession, rows: int = 0, most: int = 1) -> int:
    """Partitions of a shuffle of so many rows, so that none has many more than `most`; the session's number at least.

    Named as a number, they aren't merged again because what is shuffled looks small."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // most))


#: Rows of a partition that `by_id` aims at.
BLOCK_ROWS = 1 << 18


def blocks_of(rows: int) -> int:
    return -(-max(rows, 1) // BLOCK_ROWS)


def by_id(df: DataFrame, id_col: str, rows: int, *first: str) -> DataFrame:
    """The rows dealt out by the hash of their id, in order of the columns `first`, that hash and the id.

    How many partitions there are depends on `rows`, the number of rows, alone, so what is drawn along them is the same on
    every cluster and for every layout of the input."""
    return df.repartition(blocks_of(rows), F.col(id_col)).sortWithinPartitions(*first, F.xxhash64(id_col), id_col)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's shared checkpoint folder; a private one only on a local master without one (tests)."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="corpusloom-"))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise `df` once in the checkpoint folder, so later reads don't recompute it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(df: DataFrame, limit: int = SMALL_ROWS) -> list:
    """Collect a table of fixed size; refuse one that turns out larger than `limit` rows."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"expected at most {limit} rows")
    return rows


def broadcast_if_small(df: DataFrame, limit: int = SMALL_ROWS) -> DataFrame:
    """A table computed once: as a broadcast of its rows if there are at most `limit` of them, else cut and left to a
    shuffled join."""
    rows = df.limit(limit + 1).collect()
    if len(rows) <= limit:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return cut(df)
