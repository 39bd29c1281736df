"""Exact and near duplicates.

Near duplicates follow a greedy rule: in order of ids a record is kept unless an earlier *kept* record of its group
has a signature within the given Hamming distance. Signatures meet through equal bands, which loses no pair as
long as the distance is less than the number of bands, and the greedy rule is settled in rounds over the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

BANDS, DISTANCE, NGRAM = 8, 3, 3


def exact_dedup(df: DataFrame, text: str = "text", row_id: str = "row_id", keys: list[str] = ()) -> DataFrame:
    """The row of least id for every text, NULL counting as one text, within `keys`.

    Aggregates ids map-side instead of ordering rows in a window, so a text held by a third of all rows is no hot
    task; the winners join back on their id."""
    first = df.groupBy(*keys, F.xxhash64(text).alias("_h1"), F.md5(text).alias("_h2")).agg(F.min(row_id).alias("_first"))
    return df.join(first.select(F.col("_first")), F.col(row_id) == F.col("_first"), "left_semi")


class _Signer:
    """Signatures of texts; the +1/-1 rows of n-grams are remembered up to a bounded number."""

    LIMIT = 500_000

    def __init__(self, ngram: int):
        self.ngram = ngram
        self.weights = np.uint64(1) << np.arange(64, dtype=np.uint64)
        self.reset()

    def reset(self) -> None:
        self.known: dict[int | str, int] = {}
        self.rows = np.zeros((1 << 12, 64), np.int8)

    def _row(self, key: int | str, gram: str) -> int:
        k = len(self.known)
        if k == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        bits = np.unpackbits(np.frombuffer(hashlib.md5(gram.encode("utf-8", "surrogatepass")).digest()[:8], np.uint8))[::-1]
        self.rows[k] = bits.astype(np.int8) * 2 - 1
        self.known[key] = k
        return k

    def sign(self, text: str | None) -> np.uint64:
        if not text:
            return np.uint64(0)
        n = self.ngram
        if len(self.known) > self.LIMIT:
            self.reset()
        known = self.known
        if n <= 3 and len(text) >= n:
            # up to three code points fit one number
            cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
            packed = cps[: len(cps) - n + 1].copy()
            for k in range(1, n):
                packed = (packed << np.uint64(21)) | cps[k : len(cps) - n + 1 + k]
            keys, counts = np.unique(packed, return_counts=True)
            index = [known[k] if k in known else self._row(k, "".join(chr((k >> (21 * (n - 1 - i))) & 0x1FFFFF) for i in range(n))) for k in keys.tolist()]
        else:
            grams: dict[str, int] = {}
            for k in range(max(1, len(text) - n + 1)):
                g = text[k : k + n]
                grams[g] = grams.get(g, 0) + 1
            counts = np.array(list(grams.values()))
            index = [known[g] if g in known else self._row(g, g) for g in grams]
        return self.weights[counts.astype(np.float32) @ self.rows[index].astype(np.float32) > 0].sum(dtype=np.uint64)


def _simhash(ngram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = _Signer(ngram)
        for batch in batches:
            out = np.array([signer.sign(t) for t in batch.column(batch.num_columns - 1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(out.view(np.int64))], names=[*batch.schema.names[:-1], "sig"])

    return run


def simhash(df: DataFrame, keep: list[str], text: str = "text", ngram: int = NGRAM) -> DataFrame:
    """`keep` columns and `sig`: 64 bits, each set if the n-grams' hashes, with repeats, have it more often than not.

    The hash of an n-gram is the first eight bytes of its MD5. NULL and empty texts have signature 0."""
    rows = df.select(*keep, F.col(text).alias("_text"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_simhash(ngram), f"{fields}, sig long")


def band_keys(sig: Column, bands: int = BANDS) -> Column:
    """Array of `struct(band, v)`, low bits first; the last band takes the bits that are left over."""
    width = 64 // bands
    out = []
    for b in range(bands):
        size = width if b < bands - 1 else 64 - width * (bands - 1)
        v = F.shiftrightunsigned(sig, b * width)
        out.append(F.struct(F.lit(b).alias("band"), (v if size == 64 else v.bitwiseAND(F.lit((1 << size) - 1))).alias("v")))
    return F.array(*out)


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def _key_sets(distance: int, most: int = 40) -> tuple[int, list[tuple[int, ...]]]:
    """Number of blocks of a signature, and the sets of blocks used as keys: of distance + r blocks r agree in every
    pair, for the largest r up to 3 that needs at most `most` keys."""
    for r in (3, 2, 1):
        sets = list(combinations(range(distance + r), r))
        if len(sets) <= most or r == 1:
            return distance + r, sets


def signature_pairs(signed: DataFrame, row_id: str = "row_id", group: str = "grp", bands: int = BANDS, distance: int = DISTANCE) -> DataFrame:
    """`x, y` with x < y of the same group and at most `distance` apart; one row per distinct signature is expected.

    A pair that differs in `distance` bits agrees on whole bands if those outnumber the distance, which is required;
    the pairs are the same for any number of bands. The join itself uses keys of several wider blocks together (32
    bits at distance 3), because a single narrow band is shared by too many records of a large corpus."""
    if not 0 <= distance < bands:
        raise ValueError("bands must outnumber the distance")
    blocks, sets = _key_sets(distance)
    edges = [64 * k // blocks for k in range(blocks + 1)]
    part = [F.shiftrightunsigned("sig", a).bitwiseAND(F.lit((1 << (b - a)) - 1)) if b - a < 64 else F.col("sig") for a, b in zip(edges, edges[1:])]
    rows = signed.select(F.col(row_id).alias("id"), F.xxhash64(group).alias("g"), "sig")
    keys = F.array(*[F.xxhash64("g", F.lit(k), *[part[i] for i in s]) for k, s in enumerate(sets)])
    keyed = rows.select("id", "g", "sig", F.explode(keys).alias("key"))
    other = keyed.select(F.col("id").alias("id2"), F.col("g").alias("g2"), F.col("sig").alias("sig2"), "key")
    return (
        keyed.join(other, "key")
        .where((F.col("id") < F.col("id2")) & (F.col("g") == F.col("g2")) & (hamming(F.col("sig"), F.col("sig2")) <= distance))
        .select(F.col("id").alias("x"), F.col("id2").alias("y"))
        .distinct()
    )


#: Links that are few enough for one task.
FEW_LINKS = 100_000


def _settle(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The records that the greedy rule drops, for all links at once."""
    links = pd.concat([*frames, pd.DataFrame({"x": pd.Series(dtype="int64"), "y": pd.Series(dtype="int64")})], ignore_index=True).sort_values("y")
    dropped: set = set()
    for x, y in zip(links["x"].tolist(), links["y"].tolist()):
        if x not in dropped:
            dropped.add(y)
    yield pd.DataFrame({"id": sorted(dropped)}, dtype="int64")


def greedy_keep(ids: DataFrame, links: DataFrame, few: int = FEW_LINKS) -> DataFrame:
    """Of `ids(id)` those kept by the greedy rule over `links(x, y)`, x < y.

    What is never second in a link is kept, and drops all it is linked to; links of dropped records mean nothing any
    more and go. Each round starts from what is left, so it shrinks; the last `few` links are settled by one task, however
    long their chains are. The least undecided record settles in every round, and there is no limit on rounds."""
    links, dropped = cut(links.select(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"))), None
    while True:
        few_left = links.limit(few + 1).count() <= few
        if few_left:
            gone = links.coalesce(1).mapInPandas(_settle, "id long")
        else:
            kept = links.select(F.col("x").alias("k")).distinct().join(links.select(F.col("y").alias("k")).distinct(), "k", "left_anti")
            gone = cut(links.join(kept, links["x"] == kept["k"], "left_semi").select(F.col("y").alias("id")).distinct())
        dropped = gone if dropped is None else dropped.unionByName(gone)
        if few_left:
            return ids.join(dropped, "id", "left_anti")
        rest = links.join(gone, links["y"] == gone["id"], "left_anti")
        links = cut(rest.join(gone, rest["x"] == gone["id"], "left_anti"))


def near_dedup(df: DataFrame, text: str = "text", lang: str = "lang", row_id: str = "row_id", keys: list[str] = (), bands: int = BANDS, distance: int = DISTANCE, ngram: int = NGRAM, chunk_rows: int | None = None) -> DataFrame:
    """Rows kept by the greedy rule within `keys` and language, NULL language counting as ''.

    Equal signatures collapse to the least id first, which changes nothing under the rule. `chunk_rows` compares only
    within runs of so many consecutive ids of the whole input, as a batch-wise run would."""
    group = F.concat_ws("\x01", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys], F.coalesce(F.col(lang), F.lit("")))
    rows = df.select(F.col(row_id).alias("id"), group.alias("grp"), F.col(text).alias("_t"))
    if chunk_rows:
        rows = chunk_numbers(rows, "id", chunk_rows).select("id", F.concat_ws("\x02", "chunk", "grp").alias("grp"), "_t")
    signed = cut(simhash(rows, ["id", "grp"], "_t", ngram))
    return df.join(keep_signatures(signed, bands, distance).select(F.col("id").alias("_kept")), F.col(row_id) == F.col("_kept"), "left_semi")


def keep_signatures(signed: DataFrame, bands: int = BANDS, distance: int = DISTANCE) -> DataFrame:
    """`id` kept of `signed(id, grp, sig)` by the greedy rule."""
    firsts = cut(signed.groupBy("grp", "sig").agg(F.min("id").alias("id")))
    return greedy_keep(firsts.select("id"), signature_pairs(firsts, "id", "grp", bands, distance))


def chunk_numbers(df: DataFrame, order: str, size: int) -> DataFrame:
    """`chunk`: the number of the run of `size` rows that a row falls into, in the given order.

    Ranks come from range partitions and their sizes, so no task sees the whole order."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut(df.repartitionByRange(n, order).sortWithinPartitions(order).withColumn("_part", F.spark_partition_id()).withColumn("_at", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))))
    sizes = sorted((r["_part"], r["n"]) for r in ranged.groupBy("_part").agg(F.count("*").alias("n")).collect())
    offsets, total = [], 0
    for part, k in sizes:
        offsets.append((part, total))
        total += k
    before = F.broadcast(spark.createDataFrame(offsets or [(0, 0)], "_part int, _before long"))
    return ranged.join(before, "_part").withColumn("chunk", F.floor((F.col("_before") + F.col("_at")) / size)).drop("_part", "_at", "_before")
