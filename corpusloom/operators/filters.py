"""Row filters on texts and labels. Every column passes through."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..runtime import broadcast_if_small


def filter_empty(df: DataFrame, text: str = "text", label: str = "lang") -> DataFrame:
    """Rows whose text and label aren't ''. NULL and blank ones stay."""
    return df.where(~F.col(text).eqNullSafe("") & ~F.col(label).eqNullSafe(""))


def filter_short(df: DataFrame, text: str = "text", max_words: int = 8, max_chars: int = 40) -> DataFrame:
    """Rows with more than `max_words` words and `max_chars` code points; NULL texts go."""
    return df.where(~T.is_short(F.col(text), max_words, max_chars))


def label_counts(df: DataFrame, label: str = "lang") -> DataFrame:
    """`label, n` of every label but NULL."""
    return df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))


def frequent_labels(df: DataFrame, label: str = "lang", min_count: int = 100) -> DataFrame:
    return label_counts(df, label).where(F.col("n") >= min_count).select(label)


def filter_low_count_labels(df: DataFrame, label: str = "lang", min_count: int = 100) -> DataFrame:
    """Rows whose label occurs at least `min_count` times; NULL labels go."""
    return df.join(broadcast_if_small(frequent_labels(df, label, min_count)), label, "left_semi")


def _semi(df: DataFrame, keys: list[str], kept: DataFrame) -> DataFrame:
    """Rows whose keys, NULL included, are in `kept(_k0, _k1, ...)`."""
    kept = broadcast_if_small(kept)
    on = None
    for i, k in enumerate(keys):
        c = df[k].eqNullSafe(kept[f"_k{i}"])
        on = c if on is None else on & c
    return df.join(kept, on, "left_semi")


def with_group(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """The rows with aggregates of their group in `keys`, NULL being a value, or of all rows without keys; joined, so that
    no task needs to see a whole group."""
    names = [f"_w{i}" for i in range(len(keys) + 1)]
    columns = [*[F.col(k) for k in keys], F.lit(1)]
    keyed = df.select("*", *[c.alias(n) for c, n in zip(columns, names)])
    whole = broadcast_if_small(keyed.groupBy(*names).agg(*aggregates))
    on = functools.reduce(lambda a, b: a & b, [keyed[n].eqNullSafe(whole[n]) for n in names])
    return keyed.join(whole, on).select(*[keyed[c] for c in df.columns], *[whole[c] for c in whole.columns[len(names) :]])


def min_per_class(df: DataFrame, keys: list[str], minimum: int = 3) -> DataFrame:
    """Rows whose group has at least `minimum` rows; all rows if `minimum` is 0 or less.

    Counted by aggregation and joined back, so a heavy group is never gathered in one task."""
    if minimum <= 0:
        return df
    kept = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= minimum).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    return _semi(df, keys, kept)


def common_labels(df: DataFrame, keys: list[str], label: str = "lang", split: str = "split") -> DataFrame:
    """Rows whose label occurs in all of train, valid and test; unchanged where one of the three is empty.

    `keys` separate datasets, such as scripts, that are judged one by one."""
    seen = [F.max((F.col(split) == s).cast("int")).alias(s) for s in ("train", "valid", "test")]
    per_label = df.groupBy(*keys, label).agg(*seen)
    full = F.least(*[F.max(s) for s in ("train", "valid", "test")])
    kept = with_group(per_label, keys, full.alias("_full")).where((F.least("train", "valid", "test") == 1) | (F.col("_full") == 0))
    names = [*keys, label]
    return _semi(df, names, kept.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(names)]))


def subset_of_path(path):
    """train, valid or test by a segment of the path, tried in this order; train without one."""
    def has(names: str):
        return F.regexp_like(path, F.lit(rf"(?i)(?:^|[/\\])(?:{names})(?:[/\\]|$)"))

    return F.when(path.isNull(), None).when(has("train"), "train").when(has("valid|validation|val"), "valid").when(has("test|eval"), "test").otherwise("train")


def subset_of_stem(stem):
    """train or valid if the name holds that word, else test."""
    return F.when(stem.isNull(), None).when(F.contains(stem, F.lit("train")), "train").when(F.contains(stem, F.lit("valid")), "valid").otherwise("test")


def discover_scripts(df: DataFrame, script: str = "script") -> DataFrame:
    """Distinct four-letter script codes, in order."""
    return df.where(F.regexp_like(F.col(script), F.lit("^[A-Za-z]{4}$"))).select(script).distinct().orderBy(script)
