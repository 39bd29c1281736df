"""Statistics of labelled training lines, and the training plan they lead to."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def vocabulary_stats(df: DataFrame, line: str = "value", keys: list[str] = ()) -> DataFrame:
    """`vocab, tokens` per group: distinct and all runs of word characters, labels and regions included.

    Tokens are pre-aggregated by value, so a frequent token is one partial row per task."""
    tokens = df.select(*keys, F.explode(T.vocabulary_tokens(F.col(line))).alias("token")).groupBy(*keys, "token").agg(F.count("*").alias("n"))
    return tokens.groupBy(*keys).agg(F.count("*").alias("vocab"), F.sum("n").alias("tokens"))


def scan(df: DataFrame, line: str = "value", keys: list[str] = ()) -> DataFrame:
    """`n_lines, mean_length, n_classes` per group, over non-blank lines stripped of outer blanks."""
    s = T.strip(F.col(line))
    rows = df.select(*keys, s.alias("s")).where("s <> ''").select(*keys, F.length("s").alias("len"), T.parse_label_line(F.col("s"))["gold"].alias("gold"))
    by_label = rows.groupBy(*keys, "gold").agg(F.count("*").alias("n"), F.sum("len").alias("len"))
    return by_label.groupBy(*keys).agg(F.sum("n").alias("n_lines"), F.round(F.sum("len") / F.sum("n"), 6).alias("mean_length"), F.count("gold").alias("n_classes"))


def top_labels(df: DataFrame, line: str = "value", k: int = 15) -> DataFrame:
    """`label, n` of the `k` most frequent first labels, ties by label."""
    gold = T.parse_label_line(F.col(line))["gold"]
    return df.select(gold.alias("label")).where("label is not null").groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label").limit(k)


def count_labels(df: DataFrame, line: str = "value", keys: list[str] = ()) -> DataFrame:
    """`n_labels`: distinct labels anywhere in the lines."""
    found = df.select(*keys, F.explode(T.label_tokens(F.col(line))).alias("label")).distinct()
    return found.groupBy(*keys).agg(F.count("*").alias("n_labels"))


def check_prefix(df: DataFrame, line: str = "value", prefix: str = T.LABEL) -> None:
    """Raise unless a first non-blank line starts with the prefix."""
    first = df.select(T.strip(F.col(line)).alias("s")).where("s <> ''").first()
    if first is None or not first["s"].startswith(prefix):
        raise ValueError(f"labels must start with {prefix!r}")


def prefix_counts(df: DataFrame, line: str = "value", prefix: str = T.LABEL) -> DataFrame:
    """`n_lines, n_labelled`: non-blank lines, and those of them that start with the prefix."""
    s = df.select(T.strip(F.col(line)).alias("s")).where("s <> ''")
    return s.agg(F.count("*").alias("n_lines"), F.count_if(F.startswith("s", F.lit(prefix))).alias("n_labelled"))


def training_plan(df: DataFrame, line: str = "value", script: str = "script", forced_dsub: int | None = None, cutoff: int | None = None) -> DataFrame:
    """Per script: vocabulary, profile and quantiser settings. Only four-letter script codes are planned for."""
    stats = vocabulary_stats(df.where(F.regexp_like(F.col(script), F.lit("^[A-Za-z]{4}$"))), line, [script])
    plan = stats.withColumn("p", T.training_profile(F.col("vocab")))
    return plan.select(
        script, "vocab", "tokens", F.col("p.name").alias("profile"), "p.dim", "p.bucket", "p.minn", "p.maxn", "p.word_ngrams",
        T.pick_dsub(F.col("p.dim"), forced_dsub).alias("dsub"), T.safe_cutoff(F.lit(cutoff).cast("long"), F.col("vocab")).alias("cutoff"),
    )


def vocabulary_padding(df: DataFrame, line: str = "value", minimum: int = 256, per_line: int = 32) -> DataFrame:
    """The lines, and unlabelled ones of `per_line` dummy tokens, one for each word the vocabulary lacks of `minimum`."""
    spark = df.sparkSession
    have = vocabulary_stats(df, line).select("vocab").first()
    need = max(0, minimum - (have["vocab"] if have and have["vocab"] else 0))
    pads = spark.range(need).select(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(per_line - 1)), lambda j: F.concat(F.lit("__pad_tok_"), F.col("id"), F.lit("_"), j, F.lit("__"))), " ").alias(line))
    return df.select(line).unionByName(pads)
