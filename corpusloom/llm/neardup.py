"""Near-duplicate groups by fingerprint blocks (pigeonhole), verified by Hamming distance, then exactly.

A bag of words has a fingerprint of BLOCKS x ROWS min-hash symbols. Two records whose fingerprints differ in fewer
than BLOCKS symbols agree on a whole block at least (pigeonhole), and two that differ in more still do with
probability 1 - (1 - J^ROWS)^BLOCKS at similarity J: all but 2 in 100,000 at 0.7. Records are joined on equal blocks.

The join itself checks Hamming distances. Bags of fewer than LONG words carry parity bits: a word that two bags don't
share changes one bit at most, so the distance bounds the difference of the bags from below and the check loses
nothing. Longer bags carry a longer fingerprint, one bit a symbol, and its distance may exceed the mean at the threshold
by five standard deviations. The few pairs left are checked on the words themselves.

`exact=True` takes the candidates from an exact prefix filter instead: it loses no pair at any similarity, at the price
of many more meetings in corpora of few different words.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.graph import connected_components
from ..operators.skew import expand, run_leads
from ..runtime import cut, partitions_for
from . import prefix
from .prefix import similarity
from .words import Hasher, as_int32, bag_keys, bags, mix, parity_bits

#: Blocks of a fingerprint and min-hash symbols in a block.
BLOCKS, ROWS = 40, 4
#: Shortest record in words, least similarity of a pair.
MIN_WORDS, THRESHOLD = 20, 0.7
#: Words from which on a bag has 128 and 256 parity bits rather than 64, so that chance hardly stays below the limit;
#: from LONG words on it has the fingerprint's BITS instead.
WIDER, LONG, BITS = (48, 96), 256, 768
#: Most bits, as a power of two, of the bitmap of candidates that is broadcast.
BITMAP_LOG = 28
#: Bits of a bag's key by which it is known in the block join; bags that share them are told apart afterwards.
NODE_BITS = 40
#: Bags whose blocks a task remembers having sent already.
_SEEN = 1 << 20
#: Rows of a partition of the block join.
_BLOCK_ROWS = 1 << 20
_U = np.uint64
_WORDS = BITS // 64


def _bit_limit(threshold: float) -> int:
    """Differing bits allowed: the mean at the threshold and five standard deviations."""
    p = (1 - threshold) / 2
    return int(BITS * p + 5 * (BITS * p * (1 - p)) ** 0.5)


def _seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * _U(0x2545F4914F6CDD1D)) | _U(1)


def fingerprints(tokens: np.ndarray, sizes: np.ndarray, long: float = LONG) -> tuple[np.ndarray, np.ndarray]:
    """(blocks, bits) of bags none of which is empty: (n, BLOCKS) hashes of 32 bits of the symbols of each block, and the
    lowest bits of BITS symbols, the blocks' first, in words of 64 for each bag of `long` tokens or more."""
    n, many = len(sizes), sizes >= long
    blocks = np.zeros((n, BLOCKS), _U)
    bits = np.zeros((int(many.sum()), _WORDS), _U)
    starts = np.cumsum(sizes) - sizes
    # beyond the blocks only bits are wanted, for which half the width will do
    wide = (mix(tokens[np.repeat(many, sizes)]) >> _U(32)).astype(np.uint32)
    wide_starts = np.cumsum(sizes[many]) - sizes[many]
    for k, seed in enumerate(_seeds(max(BITS, BLOCKS * ROWS))):
        b = k // ROWS
        if b < BLOCKS:
            symbol = mix(np.minimum.reduceat((tokens * seed) >> _U(24), starts))
            blocks[:, b] = mix(blocks[:, b] ^ symbol ^ _U(b + 1))
            symbol = symbol[many]
        elif len(bits):
            symbol = mix(np.minimum.reduceat(wide * np.uint32(int(seed) >> 32 | 1), wide_starts).astype(_U))
        else:
            break
        if k < BITS:
            bits[:, k // 64] |= (symbol & _U(1)) << _U(k % 64)
    return blocks >> _U(32), bits.view(np.int64)


def nested_parity(tokens: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """(n, 4) words: the first is the parity of 64 bits, with the second of 128, with all of 256 bits. A wider one folds
    into a narrower one, so bags of different size compare; words that a bag is too short for are 0."""
    w = parity_bits(tokens, sizes, 4)
    out = np.stack([w[:, 0] ^ w[:, 1] ^ w[:, 2] ^ w[:, 3], w[:, 1] ^ w[:, 3], w[:, 2], w[:, 3]], 1)
    out[sizes < WIDER[0], 1] = 0
    out[sizes < WIDER[1], 2:] = 0
    return out


def _apart(n: Column) -> Column:
    """Differing parity bits of the columns p0_a..p3_a and p0_b..p3_b, `n` being the size of the shorter bag."""
    x0, x1, x2, x3 = (F.col(f"p{k}_a").bitwiseXOR(F.col(f"p{k}_b")) for k in range(4))
    two = x0.bitwiseXOR(x1)
    wide = F.bit_count(two.bitwiseXOR(x2)) + F.bit_count(x1.bitwiseXOR(x3)) + F.bit_count(x2) + F.bit_count(x3)
    return F.when(n < WIDER[0], F.bit_count(x0)).when(n < WIDER[1], F.bit_count(two) + F.bit_count(x1)).otherwise(wide)


def _different() -> Column:
    """Differing bits of the arrays m_a and m_b."""
    return functools.reduce(lambda a, b: a + b, [F.bit_count(F.col("m_a")[k].bitwiseXOR(F.col("m_b")[k])) for k in range(_WORDS)])


_SIGNED = T.StructType(
    [T.StructField(c, T.LongType()) for c in ("id", "k1", "k2")]
    + [T.StructField("n", T.IntegerType())]
    + [T.StructField(f"p{k}", T.LongType()) for k in range(4)]
    + [T.StructField("m", T.ArrayType(T.LongType(), False)), T.StructField("blocks", T.ArrayType(T.IntegerType(), False))]
)


def _sign(min_words: int, long: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(), set()
        for batch in batches:
            tokens, sizes = bags(batch.column(1).to_pylist(), hasher)
            keep = sizes >= max(1, min_words)
            tokens, ids, sizes = tokens[np.repeat(keep, sizes)], batch.column(0).filter(pa.array(keep)), sizes[keep]
            if not len(ids):
                continue
            k1, k2 = bag_keys(tokens, sizes)
            if len(seen) > _SEEN:
                seen.clear()
            fresh = np.zeros(len(ids), bool)
            for i, key in enumerate(zip(k1.tolist(), k2.tolist())):
                if key not in seen:
                    seen.add(key)
                    fresh[i] = True
            # a bag that this task has signed already is only counted
            tokens, first = tokens[np.repeat(fresh, sizes)], sizes[fresh]
            parity = np.zeros((len(ids), 4), np.int64)
            m, blocks = np.zeros((0, _WORDS), np.int64), np.zeros((0, BLOCKS), _U)
            if len(first):
                blocks, m = fingerprints(tokens, first, long)
                parity[fresh] = nested_parity(tokens, first)
                parity[sizes >= LONG] = 0
            lists = lambda a, size: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.array(a.ravel()))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(k1), pa.array(k2), pa.array(sizes.astype(np.int32)), *(pa.array(parity[:, k].copy()) for k in range(4))]
                + [lists(m, np.where(fresh & (sizes >= long), _WORDS, 0)), lists(blocks.astype(np.uint32).view(np.int32), np.where(fresh, BLOCKS, 0))],
                names=_SIGNED.names,
            )

    return run


def _texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id is not null and text is not null")


def signatures(df: DataFrame, id_col: str, text_col: str, min_words: int = MIN_WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """`id, k1, k2, n` of every record of `min_words` words or more, and its parities, bits and blocks where a task meets
    its bag for the first time; NULL ids are left out."""
    return _texts(df, id_col, text_col).mapInArrow(_sign(min_words, threshold * LONG), _SIGNED)


def _node() -> Column:
    return F.col("k1").bitwiseAND(F.lit((1 << NODE_BITS) - 1))


def _by_blocks(signed: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Candidates `rep_a, rep_b` that share a block and whose Hamming distance allows the threshold.

    Records meet under the key of their bag, so copies never do: a task sends the blocks of a bag once, and what
    several tasks send alike is one row before the join. The number of a block is part of its key."""
    payload = ("n", "p0", "p1", "p2", "p3", "m")
    sent = signed.select(_node().alias("node"), *payload, F.posexplode("blocks").alias("number", "value"))
    key = F.expr("shiftleft(cast(number as bigint), 32) | (cast(value as bigint) & 4294967295)")
    parts = partitions_for(signed.sparkSession, signed.count() * BLOCKS, _BLOCK_ROWS)
    keyed = sent.select(key.alias("block"), "node", *payload).repartition(parts, "block").distinct()
    a, b = (keyed.select("block", *[F.col(c).alias(f"{c}_{s}") for c in ("node", *payload)]) for s in "ab")
    shorter, longer = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    most = (F.col("n_a") + F.col("n_b")) * F.lit((1 - threshold) / (1 + threshold)) + 1e-9
    near = F.when(longer < LONG, _apart(shorter) <= most).otherwise(_different() <= _bit_limit(threshold))
    pairs = a.join(b, "block").where((F.col("node_a") < F.col("node_b")) & (shorter >= threshold * longer - 1e-9) & near).select("node_a", "node_b").distinct()
    for s in "ab":
        pairs = pairs.join(classes.select(F.col("node").alias(f"node_{s}"), F.col("rep").alias(f"rep_{s}")), f"node_{s}")
    return pairs.select(F.least("rep_a", "rep_b").alias("rep_a"), F.greatest("rep_a", "rep_b").alias("rep_b"))


def _by_prefixes(df: DataFrame, id_col: str, text_col: str, threshold: float, min_words: int) -> DataFrame:
    """Candidates `rep_a, rep_b`: all that share a token of their prefixes."""
    ordered = prefix.ordered(_texts(df, id_col, text_col), min_words)
    classes = ordered.groupBy("k1", "k2").agg(F.min(F.struct("id", "p1", "p2", "tokens")).alias("r")).select(F.col("r.id").alias("rep"), "r.p1", "r.p2", "r.tokens")
    entries = prefix.entries(cut(classes), threshold)
    return prefix.meet(entries, entries, threshold).where("rep_l < rep_r").distinct().select(F.col("rep_l").alias("rep_a"), F.col("rep_r").alias("rep_b"))


def _bitmap(ids: DataFrame, column: str) -> np.ndarray:
    """Bits set at the hashes of the ids: 16 bits an id, between 2^20 and 2^BITMAP_LOG in all.

    Words of 64 bits are put together by aggregation, so what reaches the driver has a fixed bound. A full bitmap
    lets more records through, never fewer."""
    n = ids.count()
    log = min(BITMAP_LOG, max(20, int(n * 16).bit_length()))
    h = F.shiftrightunsigned(F.xxhash64(column), 64 - log)
    words = ids.select(h.alias("h")).select(F.shiftrightunsigned("h", 6).alias("w"), F.expr("shiftleft(1L, cast(h & 63 as int))").alias("m"))
    found = words.groupBy("w").agg(F.bit_or("m").alias("m")).toPandas()
    out = np.zeros(1 << (log - 6), np.int64)
    out[found.w.to_numpy()] = found.m.to_numpy()
    return out.view(np.uint64)


def _tokens(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = Hasher(), wanted.value
        shift = _U(64 - (len(bits) * 64).bit_length() + 1)
        for batch in batches:
            h = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64) >> shift
            keep = pa.array((bits[(h >> _U(6)).astype(np.int64)] >> (h & _U(63))) & _U(1) > 0)
            tokens, sizes = bags(batch.column(1).filter(keep).to_pylist(), hasher)
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), pa.ListArray.from_arrays(offsets, pa.array(as_int32(tokens)))], names=["id", "tokens"])

    return run


def representative_links(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, exact: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, spanning, links): `members(rep, id)` has one row per record, `rep` being the least id with the same bag,
    `spanning` the classes that fill whole partitions; `links(rep_a, rep_b)` are the pairs of representatives,
    `rep_a < rep_b`, at least `threshold` alike.
    """
    signed = cut(signatures(df, id_col, text_col, min_words, threshold))
    members, spanning = run_leads(signed, ["k1", "k2"], "id")
    classes = members.where("id = lead").select(_node().alias("node"), F.col("lead").alias("rep"))
    candidates = cut(_by_prefixes(df, id_col, text_col, threshold, min_words) if exact else _by_blocks(signed, classes, threshold))
    # a bitmap of the candidates' ids goes to the texts, so that other texts are neither hashed again nor moved
    wanted = df.sparkSession.sparkContext.broadcast(_bitmap(candidates.select(F.explode(F.array("rep_a", "rep_b")).alias("id")).distinct(), "id"))
    # read by both joins, so hashed once
    tokens = cut(_texts(df, id_col, text_col).select("id", "text", F.xxhash64("id").alias("h")).mapInArrow(_tokens(wanted), "id long, tokens array<int>"))
    links = (
        candidates.join(tokens.select(F.col("id").alias("rep_a"), F.col("tokens").alias("ta")), "rep_a")
        .join(tokens.select(F.col("id").alias("rep_b"), F.col("tokens").alias("tb")), "rep_b")
        .where(similarity(F.col("ta"), F.col("tb")) >= threshold)
        .select("rep_a", "rep_b")
    )
    return members.select(F.col("lead").alias("rep"), "id"), spanning, links


def pairs(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, exact: bool = False) -> DataFrame:
    """All pairs `id_a < id_b`, copies included. NULL, empty and short texts are in no pair."""
    members, spanning, links = representative_links(df, id_col, text_col, threshold, min_words, exact)
    across = expand(expand(links, "rep_a", members, "rep", {"id": "id_a"}, spanning), "rep_b", members, "rep", {"id": "id_b"}, spanning)
    across = across.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
    within = expand(members.select("rep", F.col("id").alias("id_a")), "rep", members, "rep", {"id": "id_b"}, spanning).where("id_a < id_b").select("id_a", "id_b")
    return across.unionByName(within)


def groups(df: DataFrame, id_col: str, text_col: str, threshold: float = THRESHOLD, min_words: int = MIN_WORDS, exact: bool = False) -> DataFrame:
    """`id, group_id, copies, links` for every record of `min_words` or more: `group_id` is the least id reachable
    over links, `copies` the records with the very same bag, `links` the other bags it is linked to."""
    members, spanning, links = representative_links(df, id_col, text_col, threshold, min_words, exact)
    links = cut(links)
    component = connected_components(links, "rep_a", "rep_b")
    degree = links.select(F.explode(F.array("rep_a", "rep_b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("links"))
    copies = members.groupBy("rep").agg(F.count("*").alias("copies"))
    per_rep = copies.join(degree, "rep", "left").join(component.select(F.col("node").alias("rep"), "component"), "rep", "left")
    per_rep = per_rep.select("rep", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "rep").alias("group_id"))
    return expand(per_rep, "rep", members, "rep", {"id": "id"}, spanning).select("id", "group_id", "copies", "links")
