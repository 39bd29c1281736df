"""Registered queries of the operators for training data, and the SQL that says the same where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import table
from . import chunking, langid, leakage, markup, mixing, neardup, overlap, quality, sampling


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunking.oversized(table(spark, sf_dir, "shards"), "row_id", "text")
    return found.select(F.col("id").alias("row_id"), "cut")


def p1_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = chunking.pieces(table(spark, sf_dir, "shards"), "row_id", "text", only_long=False)
    return p.withColumnRenamed("id", "row_id")


def p1_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts put together again from their pieces, and whether every piece keeps to the limit and overlap."""
    p = chunking.pieces(table(spark, sf_dir, "shards"), "row_id", "text", only_long=False)
    body = F.struct("piece", F.substr("text", F.col("body_start") - F.col("start") + 1).alias("t"))
    fits = F.bool_and((F.length("text") <= chunking.LIMIT) & (F.col("body_start") - F.col("start") <= chunking.OVERLAP))
    whole = p.groupBy(F.col("id").alias("row_id")).agg(F.sort_array(F.collect_list(body)).alias("b"), fits.alias("fits"))
    return whole.select("row_id", F.array_join("b.t", "").alias("text"), "fits")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = markup.cleaned(table(spark, sf_dir, "shards"), "row_id", "text")
    return c.select(F.col("id").alias("row_id"), F.explode("kinds").alias("markup"))


def p2_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = markup.cleaned(table(spark, sf_dir, "shards"), "row_id", "text")
    return c.select(F.col("id").alias("row_id"), "clean_text", F.array_join("kinds", ",").alias("kinds"))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.mislabelled(_model(spark, sf_dir), *_labelled(spark, sf_dir)).select(F.col("id").alias("row_id"), "found_lang")


def _model(spark: SparkSession, sf_dir: str) -> langid.Model:
    return langid.train(table(spark, sf_dir, "lang_samples"))


def _labelled(spark: SparkSession, sf_dir: str):
    label = sampling.reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
    return table(spark, sf_dir, "shards"), "row_id", "text", label


def p3_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.found(_model(spark, sf_dir), *_labelled(spark, sf_dir)).withColumnRenamed("id", "row_id")


def p3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.segments(_model(spark, sf_dir), table(spark, sf_dir, "shards"), "row_id", "text").withColumnRenamed("id", "row_id")


def _sampling(spark: SparkSession, sf_dir: str):
    label = sampling.reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
    targets = table(spark, sf_dir, "label_targets").select("lang", "target_share", "min_rows")
    return table(spark, sf_dir, "shards").select("row_id", "lang"), "row_id", label, targets


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balance_report(*_sampling(spark, sf_dir)).where("short").select(F.col("category").alias("lang"))


def p4_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balance_report(*_sampling(spark, sf_dir)).withColumnRenamed("category", "lang")


def p4_wants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the report doesn't depend on draws, and whether the sample has exactly what was allocated."""
    r = p4_report(spark, sf_dir)
    return r.select("lang", "available", "wanted", "share", "short", (F.col("residual") == 0).alias("met"))


def p4_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.balanced_sample(*_sampling(spark, sf_dir)).select(F.col("id").alias("row_id"), F.col("category").alias("lang"))


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = overlap.pairs(table(spark, sf_dir, "split_shards"), "rec_id", "text", "split", "file_path")
    return p.select(F.least("eval_id", "train_id").alias("rec_id_a"), F.greatest("eval_id", "train_id").alias("rec_id_b"))


def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlap.report(table(spark, sf_dir, "split_shards"), "rec_id", "text", "split", "source", "file_path")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = neardup.pairs(table(spark, sf_dir, "shards"), "row_id", "text")
    return p.select(F.col("id_a").alias("row_id_a"), F.col("id_b").alias("row_id_b"))


def p6_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.groups(table(spark, sf_dir, "shards"), "row_id", "text").withColumnRenamed("id", "row_id")


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items")
    return leakage.leaks(docs, "doc_id", "text", items, "item_id", "text", table(spark, sf_dir, "common_words"))


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).where("kind <> 're-parameterised'").select(F.col("id").alias("doc_id"), "item_id")


def p8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _leaks(spark, sf_dir).withColumnRenamed("id", "doc_id")


def _mixture(spark: SparkSession, sf_dir: str, size) -> mixing.Mixture:
    docs = table(spark, sf_dir, "documents")
    return mixing.Mixture(docs, "doc_id", "source", size(F.col("text")), table(spark, sf_dir, "source_targets").select("source", "target_share", "max_repeats"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _mixture(spark, sf_dir, mixing.word_sizes).report().where("short").select("source")


def _tokens(spark: SparkSession, tokenizer: str | None = None):
    import public_tokenizers

    return mixing.token_sizes(spark, tokenizer or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def p9_report(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return _mixture(spark, sf_dir, _tokens(spark, tokenizer)).report()


def p9_supply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the report in words doesn't depend on draws, and whether the actual share of each source that isn't short
    is its target but for rounding."""
    r = _mixture(spark, sf_dir, mixing.word_sizes).report()
    near = F.abs(F.col("actual_share") - F.col("target_share")) <= 0.01
    return r.select("source", "documents", "available", "target_share", "max_repeats", "short", F.when(~F.col("short"), near).alias("met"))


def p9_mixture(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    return _mixture(spark, sf_dir, _tokens(spark, tokenizer)).documents().withColumnRenamed("id", "doc_id")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p10_profiles(spark, sf_dir).where("kind <> 'prose'").select("doc_id", "kind")


def p10_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = quality.profiles(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "lang_samples"), table(spark, sf_dir, "common_words"))
    return p.withColumnRenamed("id", "doc_id")


def p10_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = sampling.reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
    s = quality.basic_stats(table(spark, sf_dir, "documents"), "doc_id", "text", label, table(spark, sf_dir, "common_words"))
    return s.withColumnRenamed("id", "doc_id")


def queries() -> dict:
    named = (p1_found, p1_pieces, p1_rejoined, p2_found, p2_clean, p3_found, p3_languages, p3_segments, p4_found, p4_report, p4_wants, p4_sample, p5_found, p5_report, p6_found, p6_groups, p8_found, p8_leaks, p9_found, p9_report, p9_supply, p9_mixture, p10_found, p10_profiles, p10_stats)
    return {q.__name__: q for q in named}


# ---- SQL ----

_READS = """
forms AS (SELECT lang, lang AS form FROM languages UNION SELECT lang, code2 FROM languages WHERE code2 IS NOT NULL UNION SELECT lang, lower(lang_name) FROM languages)"""
_READ = "coalesce((SELECT f.lang FROM forms f WHERE f.form = lower(trim({0}))), (SELECT f.lang FROM forms f WHERE f.form = regexp_extract(lower(trim({0})), '^([^-_]*)', 1)))"
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
_SOLID = r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"


def _bags(name: str, key: str, extra: str) -> str:
    """Token sets (word, k-th occurrence) of records of 20 words or more."""
    return f"""
raw AS (SELECT {key} AS id{extra}, unnest(regexp_split_to_array(lower(nfc_normalize(text)), '{_BLANK}+')) AS w FROM {name} WHERE text IS NOT NULL),
plain AS (SELECT * EXCLUDE (w), regexp_replace(w, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}\\p{{M}}]+$', '', 'g') AS w FROM raw),
tok AS (SELECT *, row_number() OVER (PARTITION BY id, w) AS k FROM plain WHERE w <> ''),
sizes AS (SELECT id, count(*) AS n FROM tok GROUP BY id HAVING count(*) >= 20),
bag AS (SELECT tok.*, n FROM tok JOIN sizes USING (id))"""


_SPLIT = "CASE WHEN lower(trim(split)) IN ('train', 'training') THEN 'train' WHEN lower(trim(split)) IN ('valid', 'val', 'validation') THEN 'valid' ELSE 'test' END"


def oracle_sql() -> dict[str, str]:
    alike = "HAVING count(*) >= 0.7 * (any_value(a.n) + any_value(b.n) - count(*)) - 1e-9"
    return {
        "p1_found": r"""
SELECT row_id, CASE WHEN list_max(list_transform(regexp_split_to_array(text, '[\s\x{1c}-\x{1f}\x{85}\p{Z}.!?…。！？।؟።]'), lambda x: length(x))) > 1500 THEN 'hard' ELSE 'soft' END AS cut
FROM shards WHERE length(text) > 1500""",
        "p1_rejoined": "SELECT row_id, text, true AS fits FROM shards WHERE text IS NOT NULL",
        "p4_found": f"""
WITH {_READS}, labelled AS (SELECT {_READ.format('s.lang')} AS lang FROM shards s), counts AS (SELECT lang, count(*) AS n FROM labelled WHERE lang IS NOT NULL GROUP BY lang),
total AS (SELECT sum(n) // 5 AS n FROM counts)
SELECT t.lang FROM label_targets t LEFT JOIN counts c USING (lang), total WHERE coalesce(c.n, 0) < greatest(t.min_rows, floor(t.target_share * total.n))""",
        "p4_wants": f"""
WITH {_READS}, labelled AS (SELECT {_READ.format('s.lang')} AS lang FROM shards s), counts AS (SELECT lang, count(*) AS n FROM labelled WHERE lang IS NOT NULL GROUP BY lang),
total AS (SELECT sum(n) // 5 AS n FROM counts)
SELECT t.lang, coalesce(c.n, 0) AS available, greatest(t.min_rows, floor(t.target_share * total.n))::BIGINT AS wanted, t.target_share AS share, coalesce(c.n, 0) < greatest(t.min_rows, floor(t.target_share * total.n)) AS short, true AS met
FROM label_targets t LEFT JOIN counts c USING (lang), total""",
        "p5_found": f"""
WITH {_bags('split_shards', 'rec_id', ", lower(trim(split)) IN ('train', 'training') AS train")}
SELECT least(a.id, b.id) AS rec_id_a, greatest(a.id, b.id) AS rec_id_b FROM bag a JOIN bag b USING (w, k)
WHERE NOT a.train AND b.train AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) GROUP BY a.id, b.id {alike}""",
        "p5_report": f"""
WITH {_bags('split_shards', 'rec_id', f", {_SPLIT} AS split")},
pairs AS (SELECT a.id FROM bag a JOIN bag b USING (w, k) WHERE a.split <> 'train' AND b.split = 'train' AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) GROUP BY a.id, b.id {alike}),
hits AS (SELECT id, count(*) AS n FROM pairs GROUP BY id)
SELECT {_SPLIT} AS split, source, count(*) AS records, count(n) AS overlapping, coalesce(sum(n), 0)::BIGINT AS pairs FROM split_shards s LEFT JOIN hits h ON h.id = s.rec_id WHERE {_SPLIT} <> 'train' GROUP BY 1, 2""",
        "p6_groups": f"""
WITH RECURSIVE {_bags('shards', 'row_id', '')},
whole AS (SELECT id, list(w || ' ' || k ORDER BY w, k) AS words FROM bag GROUP BY id),
member AS (SELECT id, min(id) OVER (PARTITION BY words) AS rep, count(*) OVER (PARTITION BY words) AS copies FROM whole),
link AS (SELECT a.id AS a, b.id AS b FROM bag a JOIN bag b USING (w, k) WHERE a.id <> b.id AND a.id IN (SELECT rep FROM member) AND b.id IN (SELECT rep FROM member) AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) GROUP BY a.id, b.id {alike}),
reach AS (SELECT a AS rep, b AS other FROM link UNION SELECT r.rep, l.b FROM reach r JOIN link l ON l.a = r.other),
least_ AS (SELECT rep, min(other) AS other FROM reach GROUP BY rep), degree AS (SELECT a AS rep, count(*) AS links FROM link GROUP BY a)
SELECT m.id AS row_id, least(m.rep, coalesce(l.other, m.rep)) AS group_id, copies, coalesce(links, 0) AS links FROM member m LEFT JOIN least_ l USING (rep) LEFT JOIN degree USING (rep)""",
        "p6_found": f"""
WITH {_bags('shards', 'row_id', '')}
SELECT a.id AS row_id_a, b.id AS row_id_b FROM bag a JOIN bag b USING (w, k)
WHERE a.id < b.id AND least(a.n, b.n) >= 0.7 * greatest(a.n, b.n) GROUP BY a.id, b.id {alike}""",
        "p9_found": f"""
WITH sized AS (SELECT nullif(lower(trim(source)), '') AS source, len(regexp_extract_all(coalesce(text, ''), '{_SOLID}+')) AS n FROM documents),
have AS (SELECT source, sum(n) AS n FROM sized WHERE source IS NOT NULL GROUP BY source), total AS (SELECT sum(n) AS n FROM have)
SELECT t.source FROM source_targets t LEFT JOIN have h USING (source), total WHERE coalesce(h.n, 0) * t.max_repeats < t.target_share * total.n""",
        "p9_supply": f"""
WITH sized AS (SELECT nullif(lower(trim(source)), '') AS source, len(regexp_extract_all(coalesce(text, ''), '{_SOLID}+')) AS n FROM documents),
have AS (SELECT source, count(*) AS docs, sum(n) AS n FROM sized WHERE source IS NOT NULL GROUP BY source), total AS (SELECT sum(n) AS n FROM have)
SELECT t.source, coalesce(h.docs, 0) AS documents, coalesce(h.n, 0)::BIGINT AS available, t.target_share, t.max_repeats, coalesce(h.n, 0) * t.max_repeats < t.target_share * total.n AS short,
  CASE WHEN coalesce(h.n, 0) * t.max_repeats >= t.target_share * total.n THEN true END AS met FROM source_targets t LEFT JOIN have h USING (source), total""",
        "p10_stats": f"""
WITH {_READS}, base AS (
  SELECT doc_id, text, {_READ.format('d.lang')} AS lang, list_filter(regexp_split_to_array(text, '{_BLANK}+'), lambda w: w <> '') AS tokens,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_SOLID}')) AS lines, len(regexp_extract_all(text, '{_SOLID}')) AS solid,
    len(regexp_extract_all(text, '[^\\p{{L}}\\p{{M}}\\p{{N}}\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]')) AS symbols FROM documents d),
common AS (SELECT lang, list(DISTINCT lower(word)) AS common FROM common_words GROUP BY lang)
SELECT doc_id, coalesce(len(tokens), 0) AS word_count,
  CASE WHEN text IS NOT NULL THEN round(coalesce(solid / nullif(len(tokens), 0), 0.0), 6) END AS mean_word_length,
  CASE WHEN text IS NOT NULL THEN round(coalesce(symbols / nullif(solid, 0), 0.0), 6) END AS symbol_ratio,
  CASE WHEN text IS NOT NULL THEN round(coalesce(len(list_filter(lines, lambda x: regexp_matches(x, '[.!?…。！？।؟።]{_BLANK}*$'))) / nullif(len(lines), 0), 0.0), 6) END AS line_end_share,
  CASE WHEN text IS NOT NULL THEN round(coalesce(coalesce(len(list_filter(tokens, lambda w: list_contains(common, regexp_replace(lower(w), '^[^\\p{{L}}\\p{{M}}\\p{{N}}]+|[^\\p{{L}}\\p{{M}}\\p{{N}}]+$', '', 'g')))), 0) / nullif(len(tokens), 0), 0.0), 6) END AS common_share
FROM base LEFT JOIN common USING (lang)""",
    }
