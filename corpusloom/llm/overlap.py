"""Exact and near-exact overlaps between splits: a bipartite prefix-filter join on the rarest words.

Evaluation prefixes are indexed and training prefixes probe the index (`prefix`); what passes the filters is verified
on the whole bags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import expand, run_leads
from ..runtime import cut
from . import prefix
from .prefix import similarity

MIN_WORDS, THRESHOLD = 20, 0.7


def plain_split(split: Column, path: Column | None = None) -> Column:
    """train, valid or test from any spelling; the path's segment where the spelling says nothing; else NULL."""

    def read(c: Column) -> Column:
        return (
            F.when(c.isin("train", "training"), "train")
            .when(c.isin("valid", "val", "validation"), "valid")
            .when(c.isin("test", "eval"), "test")
        )

    own = read(F.lower(F.trim(split)))
    if path is None:
        return own
    return F.coalesce(own, read(F.lower(F.regexp_extract(path, r"(?i)(?:^|/)(train|valid|test)(?:/|_|$)", 1))))


def cross_links(records: DataFrame, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(members, spanning, links) of `records(id, train, text)`: `members(id, train, rep)`, the classes that fill whole
    partitions, and linked bags `links(eval_rep, train_rep)`.

    Records with the same bag of words and the same side are one class, whose `rep` is their least id.
    """
    records = records.where("id is not null and train is not null and text is not null").select("id", "train", "text")
    ordered = cut(prefix.ordered(records, min_words))
    classes = cut(ordered.groupBy("train", "k1", "k2").agg(F.min(F.struct("id", "p1", "p2", "tokens")).alias("r")).select("train", "k1", "k2", F.col("r.id").alias("rep"), "r.p1", "r.p2", "r.tokens"))
    members, spanning = run_leads(ordered.select(F.col("train").cast("long").alias("side"), "k1", "k2", "id"), ["side", "k1", "k2"], "id")
    members = members.select("id", (F.col("side") == 1).alias("train"), F.col("lead").alias("rep"))
    entries = prefix.entries(classes.select("train", "rep", "p1", "p2", "tokens"), threshold)
    candidates = prefix.meet(entries.where("not train"), entries.where("train"), threshold).select(F.col("rep_l").alias("eval_rep"), F.col("rep_r").alias("train_rep")).distinct()
    side = lambda train, name: classes.where("train" if train else "not train").select(F.col("rep").alias(f"{name}_rep"), F.col("tokens").alias(name))
    links = (
        candidates.join(side(False, "eval"), "eval_rep")
        .join(side(True, "train"), "train_rep")
        .where(similarity(F.col("eval"), F.col("train")) >= threshold)
        .select("eval_rep", "train_rep", similarity(F.col("eval"), F.col("train")).alias("similarity"))
    )
    return members, spanning, links


def prepare(df: DataFrame, id_col: str, text_col: str, split_col: str, path_col: str | None = None) -> DataFrame:
    split = plain_split(F.col(split_col), F.col(path_col) if path_col else None)
    return df.select(F.col(id_col).cast("long").alias("id"), (split == "train").alias("train"), F.col(text_col).alias("text"))


def pairs(df: DataFrame, id_col: str, text_col: str, split_col: str, path_col: str | None = None, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """`eval_id, train_id, similarity` of all overlapping pairs. Records whose split or text is NULL are in none."""
    members, spanning, links = cross_links(prepare(df, id_col, text_col, split_col, path_col), threshold, min_words)
    e, t = members.where("not train"), members.where("train")
    both = expand(expand(links, "eval_rep", e, "rep", {"id": "eval_id"}, spanning), "train_rep", t, "rep", {"id": "train_id"}, spanning)
    return both.select("eval_id", "train_id", "similarity")


def report(df: DataFrame, id_col: str, text_col: str, split_col: str, source_col: str, path_col: str | None = None, threshold: float = THRESHOLD, min_words: int = MIN_WORDS) -> DataFrame:
    """`split, source, records, overlapping, pairs` of the evaluation splits; works on classes, so copies stay unexpanded."""
    members, spanning, links = cross_links(prepare(df, id_col, text_col, split_col, path_col), threshold, min_words)
    copies = members.where("train").groupBy(F.col("rep").alias("train_rep")).agg(F.count("*").alias("n"))
    partners = links.join(copies, "train_rep").groupBy(F.col("eval_rep").alias("rep")).agg(F.sum("n").alias("n"))
    hits = expand(partners, "rep", members.where("not train"), "rep", {"id": "id"}, spanning).select("id", "n")
    split = plain_split(F.col(split_col), F.col(path_col) if path_col else None)
    base = df.select(F.col(id_col).cast("long").alias("id"), split.alias("split"), F.col(source_col).alias("source")).where("split <> 'train'")
    return (
        base.join(hits, "id", "left")
        .groupBy("split", "source")
        .agg(F.count("*").alias("records"), F.count("n").alias("overlapping"), F.coalesce(F.sum("n"), F.lit(0)).alias("pairs"))
    )
