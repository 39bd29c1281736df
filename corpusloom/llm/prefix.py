"""Exact similarity joins by prefix filters on rarest-first tokens.

Tokens are ordered from rare to common. Two bags of similarity t or more share a token among the first
n - ceil(t n) + 1 of each, so only prefixes meet; length and position filters, and parity bits whose Hamming distance
bounds the bags' difference from below, drop pairs that can't reach t. The filters lose nothing: any total order of
the tokens is right, and rarity, counted over all records in a sketch of fixed size, only makes it fast.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import expand
from ..runtime import broadcast_if_small
from .words import Hasher, as_int32, bag_keys, bags, parity_bits

#: Counters of the rarity sketch: the most rows that reach the driver, whatever the input.
SKETCH = 1 << 18
#: Entries of a token from which on it is spread.
HOT = 50_000


def similarity(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of tokens."""
    common = F.size(F.array_intersect(a, b))
    return common / (F.size(a) + F.size(b) - common)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher, total = Hasher(), np.zeros(SKETCH, np.int64)
    for batch in batches:
        tokens, _ = bags(batch.column(0).to_pylist(), hasher)
        total += np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    at = np.nonzero(total)[0]
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["bucket", "n"])


def rarity(df: DataFrame, text_col: str) -> np.ndarray:
    """How often the tokens of each of the SKETCH buckets occur in all records."""
    counted = df.select(text_col).where(F.col(text_col).isNotNull()).mapInArrow(_count, "bucket long, n long")
    found = counted.groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(SKETCH, np.int64)
    out[found.bucket.to_numpy()] = found.n.to_numpy()
    return out


def _order(counts, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rare = Hasher(), counts.value
        for batch in batches:
            tokens, sizes = bags(batch.column(batch.num_columns - 1).to_pylist(), hasher)
            keep = sizes >= max(1, min_words)
            tokens, sizes = tokens[np.repeat(keep, sizes)], sizes[keep]
            k1, k2 = bag_keys(tokens, sizes)
            parity = parity_bits(tokens, sizes)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            tokens = tokens[np.lexsort((tokens, rare[(tokens % np.uint64(SKETCH)).astype(np.int64)], doc))]
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            kept = pa.array(keep)
            yield pa.RecordBatch.from_arrays(
                [*(c.filter(kept) for c in batch.columns[:-1]), pa.array(k1), pa.array(k2), pa.array(parity[:, 0].copy()), pa.array(parity[:, 1].copy()), pa.ListArray.from_arrays(offsets, pa.array(as_int32(tokens)))],
                names=[*batch.schema.names[:-1], "k1", "k2", "p1", "p2", "tokens"],
            )

    return run


def ordered(records: DataFrame, min_words: int) -> DataFrame:
    """The columns of `records` but for its last, `text`, with the bag's keys, parities and rarest-first tokens, of every
    record of `min_words` words or more."""
    counts = records.sparkSession.sparkContext.broadcast(rarity(records, "text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields[:-1])
    return records.mapInArrow(_order(counts, min_words), f"{fields}, k1 long, k2 long, p1 long, p2 long, tokens array<int>")


def entries(classes: DataFrame, threshold: float) -> DataFrame:
    """One row per token of each prefix: the columns of `classes` without `tokens`, `n`, `at` and `token`."""
    n = F.size("tokens")
    prefix = n - F.ceil(F.lit(threshold) * n - 1e-9).cast("int") + 1
    return classes.select(*[c for c in classes.columns if c != "tokens"], n.alias("n"), F.posexplode(F.slice("tokens", 1, prefix)).alias("at", "token"))


def meet(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """`rep_l, rep_r`, possibly repeated, of entries that share a token and may reach the threshold.

    A token in more than HOT entries of the left side is spread over several tasks."""
    columns = ("rep", "n", "at", "p1", "p2")
    l = left.select("token", *[F.col(c).alias(f"{c}_l") for c in columns])
    # at most one in HOT of the entries' tokens
    hot = left.groupBy("token").agg(F.count("*").alias("c")).where(F.col("c") > HOT).select(F.col("token").alias("lead"))
    hot = broadcast_if_small(hot)
    # holds for the first common token of every true pair: none is common before it, so the rest must do
    needed = F.lit(threshold / (1 + threshold)) * (F.col("n_l") + F.col("n_r")) - 1e-9
    apart = F.bit_count(F.col("p1_l").bitwiseXOR(F.col("p1_r"))) + F.bit_count(F.col("p2_l").bitwiseXOR(F.col("p2_r")))
    possible = (
        (apart <= F.col("n_l") + F.col("n_r") - 2 * needed)
        & (F.least("n_l", "n_r") >= threshold * F.greatest("n_l", "n_r") - 1e-9)
        & (F.least(F.col("n_l") - F.col("at_l"), F.col("n_r") - F.col("at_r")) >= needed)
    )
    return expand(l, "token", right.select("token", *columns), "token", {c: f"{c}_r" for c in columns}, hot).where(possible).select("rep_l", "rep_r")
