"""Mixing sources to target shares of the total size, by entropy balancing.

The rates r of the documents stay as near as they can to one copy each: they minimise sum r log r - r subject to: the
sizes of each source sum to its target. The solution tilts exponentially, r = exp(lambda_s * size), capped at the
source's allowed repeats. Newton iterations
on the convex dual find lambda_s; each is one aggregation over a histogram of (source, size), whose size doesn't
depend on the number of documents with a given size. Rates become whole copies by systematic rounding.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import by_id, cut, small

#: Newton stops when every reachable target is met to this relative error.
TOLERANCE, MAX_ROUNDS = 1e-4, 60


def plain_source(source: Column) -> Column:
    """Trimmed lower case; blank counts as NULL."""
    return F.nullif(F.lower(F.trim(source)), F.lit(""))


def word_sizes(text: Column) -> Column:
    """Runs of non-blank characters; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]+")), F.lit(0)).cast("long")


def token_sizes(spark: SparkSession, path: str, pattern: str):
    """A function of a text column: tokens of the byte-pair vocabulary in the file `path` (tiktoken ranks).

    The file, of fixed size, is read once by the driver; executors get its ranks by broadcast."""
    with open(path, "rb") as f:
        ranks = spark.sparkContext.broadcast({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)})

    @F.pandas_udf("long")
    def count(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import tiktoken

        coder = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks.value, special_tokens={})
        for s in texts:
            yield pd.Series([0 if t is None else len(coder.encode_ordinary(t)) for t in s], dtype="int64")

    return count


def _solve(histogram: DataFrame, targets: dict[str, tuple[float, int]], capacity: dict[str, int], mean: dict[str, float]) -> dict[str, dict]:
    """lambda of each source; `targets[s] = (target size, repeats)`."""
    spark = histogram.sparkSession
    state = {}
    for s, (goal, cap) in targets.items():
        size = capacity.get(s, 0)
        kind = "empty" if not size or goal <= 0 else "short" if size * cap <= goal else "open"
        # size 1 is the mean document, so the tilt is of order one; one copy of each starts the search
        state[s] = {"kind": kind, "tilt": 0.0, "cap": cap, "goal": goal, "lo": -np.inf, "hi": np.inf}
    for _ in range(MAX_ROUNDS):
        left = {s: v for s, v in state.items() if v["kind"] == "open"}
        if not left:
            break
        at = spark.createDataFrame([(s, float(v["tilt"]), float(v["cap"]), float(mean[s])) for s, v in left.items()], "source string, tilt double, cap double, mean double")
        x = F.col("size") / F.col("mean")
        raw = F.exp(F.col("tilt") * x)
        got = (
            histogram.join(F.broadcast(at), "source")
            .select("source", "n", "size", x.alias("x"), F.least(raw, F.col("cap")).alias("r"), (raw <= F.col("cap")).alias("inner"))
            .groupBy("source")
            .agg(F.sum(F.col("n") * F.col("r") * F.col("size")).alias("total"), F.sum(F.when(F.col("inner"), F.col("n") * F.col("r") * F.col("size") * F.col("x")).otherwise(0.0)).alias("slope"))
            .collect()
        )
        for g in got:
            v = state[g["source"]]
            gap = g["total"] - v["goal"]
            if abs(gap) <= TOLERANCE * v["goal"]:
                v["kind"] = "met"
                continue
            v["lo" if gap < 0 else "hi"] = v["tilt"]
            # Newton on the logarithm of the total, which is closer to a line than the total
            step = v["tilt"] - np.log(g["total"] / v["goal"]) * g["total"] / g["slope"] if g["slope"] > 0 else np.nan
            if v["lo"] < step < v["hi"]:
                v["tilt"] = float(step)
            elif np.isfinite(v["lo"]) and np.isfinite(v["hi"]):
                v["tilt"] = (v["lo"] + v["hi"]) / 2
            else:
                v["tilt"] += -np.sign(gap) * max(1.0, abs(v["tilt"]))
    if open_ := sorted(s for s, v in state.items() if v["kind"] == "open"):
        raise ArithmeticError(f"no rates found in {MAX_ROUNDS} rounds for {open_}")
    return state


def _systematic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole copies from rates: along each source of a partition, by size, the running sum of rates is rounded, from
    a start that depends on the source and partition, so a partition is off by less than one document per source."""
    import xxhash

    carry: dict[str, float] = {}
    for batch in batches:
        f = batch.to_pandas()
        for s, rows in f.groupby("source").indices.items():
            rate = f["rate"].to_numpy()[rows]
            if s not in carry:
                carry[s] = xxhash.xxh3_64_intdigest(f"{s}|{f['id'].iat[rows[0]]}") / 2.0**64
            total = carry[s] + np.cumsum(rate)
            f.loc[f.index[rows], "copies"] = np.floor(total + 1e-9) - np.floor(np.concatenate([[carry[s]], total[:-1]]) + 1e-9)
            carry[s] = float(total[-1] % 1.0) if len(total) else carry[s]
        copies = f["copies"].fillna(0).astype("int64") if "copies" in f else pd.Series([], dtype="int64")
        keep = copies > 0
        yield pa.RecordBatch.from_arrays([pa.array(f["id"][keep]).cast(batch.column(0).type), pa.array(f["source"][keep], pa.string()), pa.array(f["size"][keep], pa.int64()), pa.array(copies[keep], pa.int64())], names=["id", "source", "size", "copies"])


class Mixture:
    """A solved mixture: `documents()` with their copies, `report()` with the actual shares."""

    def __init__(self, df: DataFrame, id_col: str, source_col: str, size: Column, targets: DataFrame, total: float | None = None):
        """`targets(source, target_share, max_repeats)`, sources trimmed lower case; `total` is the wanted size,
        by default that of all documents with a source. Documents without a source aren't used."""
        self.spark = df.sparkSession
        sized = df.select(F.col(id_col).alias("id"), plain_source(F.col(source_col)).alias("source"), size.alias("size")).where("source is not null")
        self.sized = cut(sized)
        self.histogram = cut(self.sized.groupBy("source", "size").agg(F.count("*").alias("n")))
        self.targets = {r[0]: (float(r[1] or 0.0), int(r[2] or 0)) for r in small(targets) if r[0] is not None}
        wanted = self.spark.createDataFrame([(s,) for s in self.targets], "source string")
        whole = self.histogram.agg(F.sum("n"), F.sum(F.col("n") * F.col("size"))).first()
        self.count, self.size = int(whole[0] or 0), int(whole[1] or 0)
        self.total = float(self.size if total is None else total)
        # only sources with a target come to the driver, which the table of targets bounds
        have = self.histogram.join(F.broadcast(wanted), "source").groupBy("source").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("size")).collect()
        self.have = {r["source"]: r for r in have}
        goals = {s: (share * self.total, cap) for s, (share, cap) in self.targets.items()}
        self.state = _solve(self.histogram, goals, {s: r["size"] for s, r in self.have.items()}, {s: self._mean(s) for s in self.have})

    def _mean(self, source: str) -> float:
        return max(1.0, self.have[source]["size"] / self.have[source]["n"])

    def documents(self) -> DataFrame:
        """`id, source, size, copies` of the documents used, `copies` at most the source's repeats.

        Documents are dealt out by their ids, so the copies don't depend on the cluster or the layout of the input."""
        rows = [(s, float(v["tilt"]), float(v["cap"]), self._mean(s), v["kind"] == "short") for s, v in self.state.items() if s in self.have and v["kind"] != "empty"]
        at = self.spark.createDataFrame(rows, "source string, tilt double, cap double, mean double, short boolean")
        rate = F.when(F.col("short"), F.col("cap")).otherwise(F.least(F.exp(F.col("tilt") * F.col("size") / F.col("mean")), F.col("cap")))
        rated = self.sized.join(F.broadcast(at), "source").select("id", "source", "size", rate.alias("rate"))
        rated = by_id(rated, "id", self.count, "source", "size")
        return rated.mapInArrow(_systematic, f"id {self.sized.schema['id'].dataType.simpleString()}, source string, size long, copies long")

    def report(self) -> DataFrame:
        """`source, documents, available, target_share, max_repeats, actual_size, actual_share, most_copies, short`;
        `short` where even all repeats stay below the target."""
        used = self.documents().groupBy("source").agg(F.sum(F.col("size") * F.col("copies")).alias("actual_size"), F.max("copies").alias("most_copies"))
        rows = [(s, int(self.have[s]["n"]) if s in self.have else 0, int(self.have[s]["size"]) if s in self.have else 0, share, cap) for s, (share, cap) in self.targets.items()]
        goals = self.spark.createDataFrame(rows, "source string, documents long, available long, target_share double, max_repeats long")
        out = goals.join(used, "source", "left").withColumn("actual_size", F.coalesce("actual_size", F.lit(0)))
        return out.select(
            "source", "documents", "available", "target_share", "max_repeats", "actual_size", (F.col("actual_size") / F.lit(max(1.0, self.total))).alias("actual_share"), F.coalesce("most_copies", F.lit(0)).alias("most_copies"),
            (F.col("available") * F.col("max_repeats") < F.col("target_share") * F.lit(self.total)).alias("short"),
        )
