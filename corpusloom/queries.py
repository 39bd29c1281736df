"""Registered queries of the core operators over whole tables, and the SQL that says the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scripts as S
from .functions import text as T
from .functions.labels import reads_as
from .operators import balance, chunks, dedup, evaluation, filters, lines, skew, snippets, split
from .plans import pipeline
from .runtime import scratch, table
from .sources import readers, writers

#: A language is heavy from this share of the rows with a readable label on.
HEAVY = 1 / 20


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "shards").select("row_id", "text", "lang", "region_code")


def _by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
    return skew.per_key_profile(table(spark, sf_dir, "shards"), label, F.col("text"), F.col("source"), F.col("row_id"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew.heavy_keys(_by_language(spark, sf_dir), HEAVY).select(F.col("key").alias("lang"))


def p7_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _by_language(spark, sf_dir).withColumnRenamed("key", "lang")


def _text_query(column, name: str):
    """A query `row_id, <name>` of one function of the text."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shards(spark, sf_dir).select("row_id", column(F.col("text")).alias(name))

    return query


def _rows(transform, *columns: str):
    """A query of some columns of the transformed shards."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return transform(shards(spark, sf_dir)).select(*(columns or ("row_id",)))

    return query


def dominant_script(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark, sf_dir).select("row_id", S.dominant_script(spark, F.col("text"), extensions=False).alias("script"))


def script_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = S.script_histogram(spark, shards(spark, sf_dir), "row_id", F.col("text"), extensions=False)
    return h.groupBy("script").agg(F.count("*").alias("texts"), F.sum("n").alias("n"))


def script_purity_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.purity_filter(shards(spark, sf_dir), "text", "lang").select("row_id", "text")


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.simhash(shards(spark, sf_dir), ["row_id", "lang"])


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed(spark, sf_dir).select("row_id", "sig")


def shingle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark, sf_dir).select("row_id", F.size(T.shingles(F.col("text"))).alias("n"))


def lsh_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _signed(spark, sf_dir).select("row_id", F.explode(dedup.band_keys(F.col("sig"))).alias("b")).select("row_id", "b.band", "b.v")


def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of distinct signatures of a language; a signature's first row stands for its copies."""
    from .runtime import cut

    signed = _signed(spark, sf_dir).select("sig", F.coalesce("lang", F.lit("")).alias("grp"), "row_id")
    firsts = cut(signed.groupBy("grp", "sig").agg(F.min("row_id").alias("row_id")))
    return dedup.signature_pairs(firsts)


def near_dup_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row with the same language and signature, for every row: the membership beside `near_dup_pairs`."""
    signed = _signed(spark, sf_dir).select("row_id", F.coalesce("lang", F.lit("")).alias("grp"), "sig")
    keys = signed.select(F.xxhash64("grp").alias("g"), "sig", "row_id")
    return skew.run_leads(keys, ["g", "sig"], "row_id")[0].select(F.col("id").alias("row_id"), F.col("lead").alias("first_id"))


def near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_dedup(shards(spark, sf_dir)).select("row_id")


def near_dedup_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.near_dedup(shards(spark, sf_dir), chunk_rows=1000).select("row_id")


def chunk_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.chunk_numbers(shards(spark, sf_dir).select("row_id"), "row_id", 300).select("row_id", "chunk")


def io_routed_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards routed by script, written and read again."""
    path = scratch(spark, "routed")
    rows = shards(spark, sf_dir).withColumn("script", S.dominant_script(spark, F.col("text"), extensions=False))
    writers.write_partitioned(rows, path, ["script"], compression="zstd", files_per_partition=4)
    return readers.read_shards(spark, path, ["row_id", "lang", "script"])


def io_label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled lines written as text below a folder per split, and read again with the split of their path."""
    path = scratch(spark, "lines")
    rows = table(spark, sf_dir, "split_shards").withColumn("split", filters_split(F.col("split")))
    for name in ("train", "valid", "test"):
        writers.write_label_lines(rows.where(F.col("split") == name), f"{path}/{name}", by=["script"])
    return readers.read_lines(spark, path).select("value", "subset")


def io_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions written tab-separated and read again; what is empty comes back as NULL."""
    path = scratch(spark, "predictions")
    writers.write_predictions(_predictions(spark, sf_dir), path)
    return readers.read_predictions(spark, path)


def label_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.label_counts(shards(spark, sf_dir))


def split_long_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.split_long_entries(shards(spark, sf_dir)).select("row_id", "piece", "text")


def split_long_batched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.split_long_entries(shards(spark, sf_dir), batch_rows=500).select("row_id", "piece", "text")


def _split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.stratified_split(shards(spark, sf_dir).select("row_id", "lang"))


def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _split(spark, sf_dir).select("row_id", "lang", "split")


def split_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return split.split_stats(_split(spark, sf_dir))


def split_label_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "split_shards").select("lang", filters_split(F.col("split")).alias("split"))
    return split.label_summary(rows)


def filters_split(c):
    """Plain names of splits written otherwise."""
    c = F.lower(F.trim(c))
    return F.when(c.isin("train", "training"), "train").when(c.isin("valid", "val", "validation"), "valid").otherwise("test")


def common_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "split_shards").select("rec_id", "lang", "script", filters_split(F.col("split")).alias("split"))
    return filters.common_labels(rows, ["script"]).select("rec_id")


def _balanced(mode: str, target: int = 0, region: str | None = None):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        label = reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
        rows = shards(spark, sf_dir).select("row_id", label.alias("lang"), "region_code")
        return balance.balance(rows, region=region, mode=mode, target=target).select("row_id", "lang", "copy")

    return query


def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balance.group_sizes(shards(spark, sf_dir), region="region_code")


def _snippets(column):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = shards(spark, sf_dir).select("row_id", F.posexplode(column(F.col("text"), F.col("row_id").cast("string"))).alias("i", "snippet"))
        return rows.select("row_id", "i", "snippet")

    return query


def augment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snippets.augment(shards(spark, sf_dir)).select("row_id", "snippet", "text")


def fasttext_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(spark, sf_dir).select("row_id", T.label_line(F.col("lang"), F.col("text"), F.col("region_code")).alias("value"))


def _training_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "training_lines").select("line_id", "rec_id", "file_path", F.col("line_text").alias("value"))


def parse_fasttext_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = _training_lines(spark, sf_dir).select("line_id", T.parse_label_line(F.col("value")).alias("p"))
    return parsed.select("line_id", "p.gold", "p.text")


def line_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _training_lines(spark, sf_dir).select("line_id", filters.subset_of_path(F.col("file_path")).alias("subset"), filters.subset_of_stem(F.col("file_path")).alias("stem_subset"))


def label_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.scan(_training_lines(spark, sf_dir))


def label_scan_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.top_labels(_training_lines(spark, sf_dir))


def line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.count_labels(_training_lines(spark, sf_dir))


def vocab_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.vocabulary_stats(_training_lines(spark, sf_dir))


def _scripted_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "split_shards")
    return rows.select("script", T.label_line(F.col("lang"), F.col("text"), F.col("region_code")).alias("value"))


def training_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.training_plan(_scripted_lines(spark, sf_dir), cutoff=500)


def discover_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.discover_scripts(table(spark, sf_dir, "split_shards"))


def vocab_padding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.vocabulary_padding(_training_lines(spark, sf_dir), minimum=100_000).groupBy("value").agg(F.count("*").alias("n"))


def langid_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.accuracy(_predictions(spark, sf_dir))


def langid_per_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.per_label(_predictions(spark, sf_dir))


def langid_per_label_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.per_label(_predictions(spark, sf_dir), top=20)


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.latest(table(spark, sf_dir, "predictions"))


def latest_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predictions(spark, sf_dir).select("rec_id", F.unix_micros("evaluated_at").alias("evaluated_us"), "gold", "pred", "prob")


def prediction_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writers.prediction_rows(_predictions(spark, sf_dir))


def classifier_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A classifier fitted on trusted texts, judged on the corpus rows whose label reads as a language."""
    from .operators import model

    trusted = table(spark, sf_dir, "lang_samples").select(F.col("lang").alias("gold"), F.lower("text").alias("text"))
    label = reads_as(F.col("lang"), table(spark, sf_dir, "languages"))
    rows = shards(spark, sf_dir).select(label.alias("gold"), F.lower("text").alias("text")).where("gold is not null and text is not null")
    return model.evaluate(model.train(trusted), rows)


def quantise_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .operators import model

    vectors = table(spark, sf_dir, "embeddings")
    dim = vectors.select(F.max(F.size("embedding"))).first()[0] or 0
    dsub = spark.range(1).select(T.pick_dsub(F.lit(dim))).first()[0]
    coded, _ = model.quantise(vectors, "embedding", dim, dsub=dsub, codes=256)
    return coded.select("vec_id", "codes")


def pipeline_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = pipeline.Options(balance="median_x2")
    return pipeline.run("full", shards(spark, sf_dir), o)


def pipeline_wired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline.run("wired", shards(spark, sf_dir))


QUERIES = {
    "p7_found": p7_found,
    "p7_profile": p7_profile,
    "filter_empty": _rows(filters.filter_empty),
    "filter_short": _rows(filters.filter_short),
    "lowercase_strip_numbers": _text_query(lambda c: T.clean(c, lowercase=True, strip_numbers=True), "text"),
    "fold_digits": _text_query(T.fold_digits, "text"),
    "clean_text_full": _text_query(lambda c: T.clean(c, lowercase=True, strip_numbers=True, digits=True, wiki=True, form="NFC"), "text"),
    "clean_text_nfkc": _text_query(lambda c: T.clean(c, lowercase=True, form="NFKC", fold_case=True), "text"),
    "clean_social_text": _text_query(lambda c: T.clean_social(c, strip_hashtags=True, lowercase=False, form="NFC"), "text"),
    "clean_social_text_nfkc": _text_query(T.clean_social, "text"),
    "drop_wiki_lines": _text_query(T.drop_wiki_lines, "text"),
    "normalize_nfc": _text_query(lambda c: T.normalize(c, "NFC"), "text"),
    "word_count": _text_query(T.word_count, "n"),
    "char_count": _text_query(T.char_count, "n"),
    "is_short": _text_query(T.is_short, "short"),
    "block_script": _text_query(T.block_script, "script"),
    "digit_ratio_bucket": _text_query(lambda c: T.digit_bucket(T.digit_ratio(c)), "bucket"),
    "digit_ratio": _text_query(lambda c: F.round(T.digit_ratio(c), 9), "ratio"),
    "length_bucket": _text_query(T.len_bucket, "bucket"),
    "meta_tokens": _text_query(T.meta_tokens, "tokens"),
    "has_diacritics": _text_query(T.has_diacritics, "diacritics"),
    "dominant_script": dominant_script,
    "script_histogram": script_histogram,
    "script_purity_filter": script_purity_filter,
    "label_counts": label_counts,
    "filter_low_count_labels": _rows(lambda df: filters.filter_low_count_labels(df, min_count=100)),
    "min_per_class": _rows(lambda df: filters.min_per_class(df, ["lang"])),
    "exact_dedup": _rows(dedup.exact_dedup),
    "shingle_counts": shingle_counts,
    "simhash": simhash,
    "lsh_bands": lsh_bands,
    "near_dup_pairs": near_dup_pairs,
    "near_dup_members": near_dup_members,
    "near_dedup": near_dedup,
    "near_dedup_chunked": near_dedup_chunked,
    "chunk_numbers": chunk_numbers,
    "io_routed_shards": io_routed_shards,
    "io_label_lines": io_label_lines,
    "io_predictions": io_predictions,
    "human_sizes": lambda spark, sf_dir: shards(spark, sf_dir).select("row_id", T.human_bytes(F.pow(F.lit(2.0), F.col("row_id") % 47) * 1.3).alias("size")),
    "split_long_entries": split_long_entries,
    "split_long_batched": split_long_batched,
    "stratified_split": stratified_split,
    "split_stats": split_stats,
    "split_label_summary": split_label_summary,
    "common_labels": common_labels,
    "group_sizes": group_sizes,
    "balance_max": _balanced("max"),
    "balance_median_x2": _balanced("median_x2"),
    "balance_target": _balanced("none", 200, "region_code"),
    "word_snippets": _snippets(snippets.word_snippets),
    "char_snippets": _snippets(snippets.char_snippets),
    "augment": augment,
    "fasttext_lines": fasttext_lines,
    "parse_fasttext_lines": parse_fasttext_lines,
    "line_subset": line_subset,
    "label_scan": label_scan,
    "label_scan_topk": label_scan_topk,
    "label_prefixes": lambda spark, sf_dir: lines.prefix_counts(_training_lines(spark, sf_dir)),
    "line_labels": line_labels,
    "vocab_stats": vocab_stats,
    "training_profile": training_profile,
    "discover_scripts": discover_scripts,
    "vocab_padding": vocab_padding,
    "latest_predictions": latest_predictions,
    "langid_accuracy": langid_accuracy,
    "langid_per_label": langid_per_label,
    "langid_per_label_top": langid_per_label_top,
    "prediction_rows": prediction_rows,
    "classifier_accuracy": classifier_accuracy,
    "quantise_vectors": quantise_vectors,
    "pipeline_full": pipeline_full,
    "pipeline_wired": pipeline_wired,
}


def queries() -> dict:
    return dict(QUERIES)


# ---- SQL ----

_B, _S = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]", r"[^\s\x{1c}-\x{1f}\x{85}\p{Z}]"
_FORMS = "forms AS (SELECT lang, lang AS form FROM languages UNION SELECT lang, code2 FROM languages WHERE code2 IS NOT NULL UNION SELECT lang, lower(lang_name) FROM languages)"
_READ = "coalesce((SELECT f.lang FROM forms f WHERE f.form = lower(trim(s.lang))), (SELECT f.lang FROM forms f WHERE f.form = regexp_extract(lower(trim(s.lang)), '^([^-_]*)', 1)))"
_READS = f"{_FORMS}, labelled AS (SELECT row_id, {_READ} AS lang, region_code, text, source FROM shards s)"
# lower case with the dot above of a dotted capital I kept and a final sigma, as Unicode has them
def _lower(x: str) -> str:
    return rf"lower(regexp_replace(replace({x}, 'İ', 'i' || chr(775)), '(\p{{L}}\p{{M}}*)Σ([^\p{{L}}\p{{M}}]|$)', '\1ς\2', 'g'))"


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^{_B}+|{_B}+$', '', 'g')"


def _wiki(x: str) -> str:
    return _strip(f"array_to_string(list_filter(regexp_split_to_array({x}, '{T.LINE_END}'), lambda x: NOT regexp_matches(x, '{T.WIKI_LINE}')), chr(10))")


def _fold(x: str) -> str:
    return f"translate({x}, '{T.digit_table()[0]}', '{T.digit_table()[1]}')"


def _draw(*keys: str) -> str:
    joined = " || '|' || ".join(["'42'", *keys])
    return f"(('0x' || substr(md5({joined}), 1, 8))::BIGINT)"


def _snippet_sql(word: bool, with_text: bool = False) -> str:
    if word:
        unit, n, low, high, a, b = "len(ws)", 8, 3, 8, "wl", "ws"
        cut = "array_to_string(ws[start + 1:start + length], ' ')"
    else:
        unit, n, low, high, a, b = "length(text)", 4, 20, 60, "cl", "cs"
        cut = "substr(text, start + 1, length)"
    source = f"SELECT row_id, text, list_filter(regexp_split_to_array(text, '{_B}+'), lambda w: w <> '') AS ws FROM shards WHERE text IS NOT NULL"
    return f"""
SELECT row_id, i - 1 AS i, {cut} AS snippet FROM (
  SELECT *, CASE WHEN {unit} <= length THEN 0 ELSE {_draw('row_id', f"'{b}'", 'i')} % ({unit} - length + 1) END AS start FROM (
    SELECT *, {low} + {_draw('row_id', f"'{a}'", 'i')} % (greatest({low}, least({high}, {unit})) - {low} + 1) AS length
    FROM ({source}), range(1, {n + 1}) t(i) WHERE {unit} > 0))"""


def _balance_sql(aim: str, group: str = "lang") -> str:
    keys = group.split(", ")
    same = " AND ".join(f"r.{k} = x.{k}" for k in keys)
    known = " AND ".join(f"{k} IS NOT NULL" for k in keys)
    return f"""
WITH {_READS}, rows_ AS (SELECT row_id, lang, region_code FROM labelled WHERE {known}),
sizes AS (SELECT {group}, count(*) AS n FROM rows_ GROUP BY {group}),
aims AS (SELECT *, (SELECT max(n) FROM sizes) AS most, (SELECT trunc(median(n))::BIGINT FROM sizes) AS med FROM sizes),
needs AS (SELECT *, {aim} - n AS need FROM aims),
draws AS (SELECT {group}, c AS copy, {_draw(*keys, 'c')} % n + 1 AS pick FROM needs, LATERAL (SELECT unnest(range(1, greatest(need, 0) + 1)) AS c)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY row_id) AS rank FROM rows_)
SELECT row_id, lang, 0 AS copy FROM rows_ UNION ALL SELECT r.row_id, r.lang, x.copy FROM draws x JOIN ranked r ON {same} AND r.rank = x.pick"""


_SIZES = """
sized AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS n, row_number() OVER (PARTITION BY {keys} ORDER BY md5('42#' || row_id), row_id) AS r FROM {source} WHERE lang IS NOT NULL),
a AS (SELECT *, trunc(n * 0.8::double)::BIGINT AS tr, trunc(n * 0.1::double)::BIGINT AS va FROM sized WHERE n >= 3),
b AS (SELECT * REPLACE (greatest(tr, 1) AS tr, greatest(va, 1) AS va) FROM a),
c AS (SELECT * REPLACE (CASE WHEN n - tr - va > 0 THEN tr WHEN tr >= va AND tr > 1 THEN tr - 1 WHEN va > 1 THEN tr ELSE greatest(1, tr - 1) END AS tr,
                        CASE WHEN n - tr - va <= 0 AND NOT (tr >= va AND tr > 1) AND va > 1 THEN va - 1 ELSE va END AS va) FROM b),
d AS (SELECT *, CASE WHEN r <= tr THEN 'train' WHEN r <= tr + va THEN 'valid' ELSE 'test' END AS split FROM c),
splits AS (SELECT * FROM d WHERE lang IN (SELECT lang FROM d GROUP BY lang HAVING count(DISTINCT split) = 3))"""
_SPLIT = _SIZES.format(keys="lang", source="shards")

_SHINGLES = "CASE WHEN text = '' THEN [] ELSE list_transform(range(1, greatest(length(text) - 2, 1) + 1), lambda i: substr(text, i, 3)) END"
_SIG = f"""
grams AS (SELECT row_id, g, count(*) AS c FROM (SELECT row_id, unnest({_SHINGLES}) AS g FROM shards WHERE text IS NOT NULL) GROUP BY row_id, g),
hashed AS (SELECT row_id, c, ('0x' || substr(m, 1, 8))::BIGINT AS hi, ('0x' || substr(m, 9, 8))::BIGINT AS lo FROM (SELECT row_id, c, md5(g) AS m FROM grams)),
halves AS (SELECT row_id, {' + '.join(f"(CASE WHEN sum(CASE WHEN (hi >> {k}) & 1 = 1 THEN c ELSE -c END) > 0 THEN {1 << k} ELSE 0 END)::BIGINT" for k in range(32))} AS hi,
  {' + '.join(f"(CASE WHEN sum(CASE WHEN (lo >> {k}) & 1 = 1 THEN c ELSE -c END) > 0 THEN {1 << k} ELSE 0 END)::BIGINT" for k in range(32))} AS lo FROM hashed GROUP BY row_id),
signed AS (SELECT s.row_id, coalesce(s.lang, '') AS grp, coalesce(CASE WHEN hi >= 2147483648 THEN hi - 4294967296 ELSE hi END * 4294967296 + lo, 0)::BIGINT AS sig FROM shards s LEFT JOIN halves USING (row_id))"""
_PAIRS = f"""{_SIG}, firsts AS (SELECT grp, sig, min(row_id) AS row_id FROM signed GROUP BY grp, sig),
links AS (SELECT a.row_id AS x, b.row_id AS y FROM firsts a JOIN firsts b ON a.grp = b.grp AND a.row_id < b.row_id AND bit_count(xor(a.sig, b.sig)) <= 3)"""

_GOLD = "list_filter(tokens, lambda t: starts_with(t, '__label__'))[1]"
_TOKENS = f"list_filter(regexp_split_to_array(line_text, '{_B}+'), lambda w: w <> '')"
_LATEST = "latest AS (SELECT rec_id, r.* FROM (SELECT rec_id, max(struct_pack(evaluated_at, script, gold, pred, prob, text)) AS r FROM predictions GROUP BY rec_id))"


def _digit_regex() -> str:
    return T._digit_class()


def _block_sql() -> str:
    bare = f"regexp_replace(text, '{_digit_regex()[:-1]}\\p{{P}}\\p{{S}}\\p{{C}}\\s\\x{{1c}}-\\x{{1f}}\\x{{85}}\\p{{Z}}]', '', 'g')"
    counts = ", ".join(f"struct_pack(n := len(regexp_extract_all(bare, '{T.block_class(k)}')), k := {-i}, name := '{k}')" for i, k in enumerate(T.BLOCKS))
    return f"SELECT row_id, text, CASE WHEN text IS NULL THEN NULL WHEN best.n = 0 THEN 'Other' ELSE best.name END AS script FROM (SELECT row_id, text, list_max([{counts}]) AS best FROM (SELECT row_id, text, {bare} AS bare FROM shards))"


_RATIO = f"len(regexp_extract_all(text, '{T._digit_class()}')) / greatest(length(text), 1)"
_WORDS = f"len(regexp_extract_all(text, '{_S}+'))"
_LEN = f"CASE WHEN text IS NULL THEN NULL WHEN {_WORDS} <= 8 OR length(text) <= 40 THEN 'SHORT' WHEN {_WORDS} >= 20 AND length(text) >= 120 THEN 'LONG' ELSE 'MEDIUM' END"
_DIGIT = f"CASE WHEN text IS NULL THEN NULL WHEN {_RATIO} <= 0 THEN 'NONE' WHEN {_RATIO} < 0.05 THEN 'LOW' WHEN {_RATIO} < 0.2 THEN 'MED' ELSE 'HIGH' END"
_LINE = "'__label__' || coalesce(lang, '') || ' ' || regexp_replace(coalesce(text, ''), '[\\r\\n]+', ' ', 'g') || ' ' || coalesce(region_code, '')"
_CASE_SPLIT = "CASE WHEN lower(trim(split)) IN ('train', 'training') THEN 'train' WHEN lower(trim(split)) IN ('valid', 'val', 'validation') THEN 'valid' ELSE 'test' END"
#: ISO code and the name that regular expressions use, for the scripts that occur in the tables.
_SCRIPTS = {"Arab": "Arabic", "Armn": "Armenian", "Cher": "Cherokee", "Cyrl": "Cyrillic", "Deva": "Devanagari", "Ethi": "Ethiopic", "Geor": "Georgian", "Grek": "Greek", "Hang": "Hangul", "Hani": "Han", "Hebr": "Hebrew", "Hira": "Hiragana", "Kana": "Katakana", "Latn": "Latin", "Tfng": "Tifinagh"}


def _greedy_sql(pairs: str) -> str:
    return f"""
WITH RECURSIVE {pairs}, nodes AS (SELECT DISTINCT unnest([x, y]) AS id FROM links),
seq AS (SELECT id, row_number() OVER (ORDER BY id) AS k FROM nodes),
before AS (SELECT y AS id, list(x) AS xs FROM links GROUP BY y),
walk AS (SELECT 0::BIGINT AS k, []::BIGINT[] AS kept UNION ALL
  SELECT s.k, CASE WHEN b.xs IS NOT NULL AND list_has_any(b.xs, w.kept) THEN w.kept ELSE list_append(w.kept, s.id) END FROM walk w JOIN seq s ON s.k = w.k + 1 LEFT JOIN before b ON b.id = s.id),
kept AS (SELECT unnest(kept) AS id FROM walk WHERE k = (SELECT max(k) FROM seq))
SELECT row_id FROM firsts WHERE row_id NOT IN (SELECT id FROM nodes) OR row_id IN (SELECT id FROM kept)"""


def _long_sql(batch: int) -> str:
    return f"""
WITH RECURSIVE s AS (SELECT row_id, text, (row_number() OVER (ORDER BY row_id) - 1) // {batch} AS b FROM shards),
m AS (SELECT b, CASE WHEN trunc(avg(length(text))) > 0 THEN trunc(avg(length(text)))::INT ELSE 100 END AS n FROM s GROUP BY b),
walk AS (SELECT row_id, b, -1 AS piece, NULL::VARCHAR AS chunk, text AS rest, false AS done FROM s UNION ALL
  SELECT row_id, b, piece + 1, CASE WHEN long THEN {_strip('substr(rest, 1, cut)')} ELSE rest END, CASE WHEN long THEN {_strip('substr(rest, cut + 1)')} END, NOT long OR {_strip('substr(rest, cut + 1)')} = ''
  FROM (SELECT row_id, b, piece, rest, length(rest) > m.n AS long, CASE WHEN regexp_matches(substr(rest, 1, m.n), ' ') THEN length(regexp_extract(substr(rest, 1, m.n), '(?s)^(.*) ', 1)) ELSE m.n END AS cut FROM walk JOIN m USING (b) WHERE NOT done))
SELECT row_id, piece, chunk AS text FROM walk WHERE piece >= 0"""


def oracle_sql() -> dict[str, str]:
    no_numbers = "nfc_normalize(regexp_replace(" + _lower("text") + r", '\p{Nd}+', '', 'g'))"
    social = "nfc_normalize(coalesce(text, ''))"
    for pattern in (T.URL, T.EMAIL, T.MENTION, T.HASHTAG):
        social = f"regexp_replace({social}, '{pattern}', ' ', 'g')"
    social = rf"regexp_replace(regexp_replace({social}, '\p{{Nd}}', '0', 'g'), '{_B}+', ' ', 'g')"
    counts = ", ".join(f"struct_pack(n := len(regexp_extract_all(coalesce(text, ''), '\\p{{{v}}}')), at := -length(regexp_extract(coalesce(text, ''), '^([^\\p{{{v}}}]*)', 1)), name := '{k}')" for k, v in _SCRIPTS.items())
    return {
        "p7_found": f"WITH {_READS} SELECT lang FROM labelled WHERE lang IS NOT NULL GROUP BY lang HAVING count(*) >= (1.0::double / 20) * (SELECT count(*) FROM labelled WHERE lang IS NOT NULL)",
        "p7_profile": f"""
WITH {_READS}, ranked AS (SELECT lang, source, count(*) AS n, row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, source) AS r FROM labelled WHERE source IS NOT NULL GROUP BY lang, source),
best AS (SELECT lang, string_agg(source || ':' || n, ' ' ORDER BY r) AS top_sources FROM ranked WHERE r <= 3 GROUP BY lang),
total AS (SELECT lang, count(*) AS n_rows, count(DISTINCT text) AS n_texts, round(avg(length(text)), 6) AS mean_len FROM labelled GROUP BY lang)
SELECT t.lang, n_rows, n_texts, mean_len, top_sources FROM total t LEFT JOIN best b ON t.lang IS NOT DISTINCT FROM b.lang""",
        "filter_empty": "SELECT row_id FROM shards WHERE text IS DISTINCT FROM '' AND lang IS DISTINCT FROM ''",
        "filter_short": f"SELECT row_id FROM shards WHERE {_WORDS} > 8 AND length(text) > 40",
        "lowercase_strip_numbers": f"SELECT row_id, regexp_replace({_lower('text')}, '\\p{{Nd}}+', '', 'g') AS text FROM shards",
        "fold_digits": f"SELECT row_id, {_fold('text')} AS text FROM shards",
        "clean_text_full": f"SELECT row_id, {_wiki(_fold(no_numbers))} AS text FROM shards",
        "clean_social_text": f"""
SELECT row_id, {_strip(social)} AS text FROM shards""",
        "drop_wiki_lines": f"SELECT row_id, {_wiki('text')} AS text FROM shards",
        "normalize_nfc": "SELECT row_id, nfc_normalize(text) AS text FROM shards",
        "word_count": f"SELECT row_id, {_WORDS} AS n FROM shards",
        "char_count": "SELECT row_id, length(text) AS n FROM shards",
        "is_short": f"SELECT row_id, coalesce({_WORDS} <= 8 OR length(text) <= 40, true) AS short FROM shards",
        "block_script": f"SELECT row_id, script FROM ({_block_sql()})",
        "digit_ratio_bucket": f"SELECT row_id, {_DIGIT} AS bucket FROM shards",
        "digit_ratio": f"SELECT row_id, round({_RATIO}, 9) AS ratio FROM shards",
        "length_bucket": f"SELECT row_id, {_LEN} AS bucket FROM shards",
        "meta_tokens": f"SELECT row_id, CASE WHEN text IS NOT NULL THEN ' __feat_SCRIPT=' || script || ' __feat_LEN=' || {_LEN} || ' __feat_DIGITRATIO=' || {_DIGIT} END AS tokens FROM ({_block_sql()})",
        "has_diacritics": r"SELECT row_id, strip_accents(text) <> text OR regexp_matches(text, '\p{Mn}') AS diacritics FROM shards",
        "dominant_script": f"SELECT row_id, CASE WHEN best.n = 0 THEN 'Unknown' ELSE best.name END AS script FROM (SELECT row_id, list_max([{counts}]) AS best FROM shards)",
        "script_histogram": "SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{k}' AS script, count(*) FILTER (n > 0) AS texts, sum(n) AS n FROM (SELECT len(regexp_extract_all(coalesce(text, ''), '\\p{{{v}}}')) AS n FROM shards)" for k, v in _SCRIPTS.items()) + ") WHERE texts > 0",
        "label_counts": "SELECT lang, count(*) AS n FROM shards WHERE lang IS NOT NULL GROUP BY lang",
        "filter_low_count_labels": "SELECT row_id FROM shards WHERE lang IN (SELECT lang FROM shards GROUP BY lang HAVING count(*) >= 100)",
        "min_per_class": "SELECT row_id FROM (SELECT row_id, count(*) OVER (PARTITION BY lang) AS n FROM shards) WHERE n >= 3",
        "exact_dedup": "SELECT row_id FROM (SELECT row_id, row_number() OVER (PARTITION BY text ORDER BY row_id) AS r FROM shards) WHERE r = 1",
        "shingle_counts": f"SELECT row_id, len({_SHINGLES}) AS n FROM shards",
        "simhash": f"WITH {_SIG} SELECT row_id, sig FROM signed",
        "lsh_bands": f"WITH {_SIG} SELECT row_id, b AS band, (CASE WHEN b < 4 THEN ((sig & 4294967295) >> (8 * b)) ELSE (((sig >> 32) & 4294967295) >> (8 * (b - 4))) END & 255)::BIGINT AS v FROM signed, range(8) t(b)",
        "near_dup_pairs": f"WITH {_PAIRS} SELECT x, y FROM links",
        "near_dup_members": f"WITH {_SIG} SELECT row_id, min(row_id) OVER (PARTITION BY grp, sig) AS first_id FROM signed",
        "label_prefixes": f"SELECT count(*) AS n_lines, count(*) FILTER (starts_with(s, '__label__')) AS n_labelled FROM (SELECT {_strip('line_text')} AS s FROM training_lines) WHERE s <> ''",
        "near_dedup": _greedy_sql(_PAIRS),
        "near_dedup_chunked": _greedy_sql(_PAIRS.replace("coalesce(s.lang, '') AS grp", "(s.k - 1) // 1000 || '#' || coalesce(s.lang, '') AS grp").replace("FROM shards s LEFT JOIN", "FROM (SELECT *, row_number() OVER (ORDER BY row_id) AS k FROM shards) s LEFT JOIN")),
        "chunk_numbers": "SELECT row_id, (row_number() OVER (ORDER BY row_id) - 1) // 300 AS chunk FROM shards",
        "io_routed_shards": f"SELECT row_id, lang, CASE WHEN best.n = 0 THEN 'Unknown' ELSE best.name END AS script FROM (SELECT row_id, lang, list_max([{counts}]) AS best FROM shards)",
        "io_label_lines": f"SELECT {_LINE} AS value, {_CASE_SPLIT} AS subset FROM split_shards",
        "io_predictions": f"WITH {_LATEST} SELECT nullif(gold, '') AS gold, nullif(pred, '') AS pred, printf('%.6f', coalesce(prob, 0.0))::DOUBLE AS prob, nullif(regexp_replace(coalesce(text, ''), '[\\t\\r\\n]+', ' ', 'g'), '') AS text FROM latest",
        "human_sizes": "SELECT row_id, CASE WHEN n < 1024.0 THEN printf('%.1f B', n) WHEN n < 1024.0 ** 2 THEN printf('%.1f KB', n / 1024.0) WHEN n < 1024.0 ** 3 THEN printf('%.1f MB', n / 1024.0 ** 2) WHEN n < 1024.0 ** 4 THEN printf('%.1f GB', n / 1024.0 ** 3) ELSE printf('%.1f TB', n / 1024.0 ** 4) END AS size FROM (SELECT row_id, (2.0 ** (row_id % 47)) * 1.3 AS n FROM shards)",
        "split_long_entries": _long_sql(10**15),
        "split_long_batched": _long_sql(500),
        "stratified_split": f"WITH {_SPLIT} SELECT row_id, lang, split FROM splits",
        "split_stats": f"WITH {_SPLIT} SELECT split, count(*) AS n_rows, count(DISTINCT lang) AS n_labels FROM splits GROUP BY split",
        "split_label_summary": f"""
WITH f AS (SELECT lang, max((s = 'train')::INT) AS a, max((s = 'valid')::INT) AS b, max((s = 'test')::INT) AS c FROM (SELECT lang, {_CASE_SPLIT} AS s FROM split_shards) WHERE lang IS NOT NULL GROUP BY lang)
SELECT sum(a) AS labels_train, sum(b) AS labels_valid, sum(c) AS labels_test, sum(greatest(a, b, c)) AS labels_any, sum(least(a, b, c)) AS labels_all FROM f""",
        "common_labels": f"""
WITH s AS (SELECT rec_id, lang, script, {_CASE_SPLIT} AS split FROM split_shards), n AS (SELECT script, lang, count(DISTINCT split) AS k FROM s GROUP BY script, lang), w AS (SELECT script, count(DISTINCT split) AS k FROM s GROUP BY script)
SELECT rec_id FROM s JOIN n ON s.lang IS NOT DISTINCT FROM n.lang AND s.script IS NOT DISTINCT FROM n.script JOIN w ON s.script IS NOT DISTINCT FROM w.script WHERE n.k = 3 OR w.k < 3""",
        "group_sizes": "SELECT lang, region_code, count(*) AS n FROM shards GROUP BY lang, region_code",
        "balance_max": _balance_sql("most"),
        "balance_median_x2": _balance_sql("greatest(2 * med, n)"),
        "balance_target": _balance_sql("greatest(n, 200)", "lang, region_code"),
        "word_snippets": _snippet_sql(True),
        "char_snippets": _snippet_sql(False),
        "augment": f"""
SELECT row_id, 0 AS snippet, text FROM shards UNION ALL SELECT row_id, i + 1, snippet FROM ({_snippet_sql(True)})
UNION ALL SELECT row_id, i + 1 + CASE WHEN row_id IN (SELECT row_id FROM shards WHERE regexp_matches(text, '{_S}')) THEN 8 ELSE 0 END, snippet FROM ({_snippet_sql(False)})""",
        "fasttext_lines": f"SELECT row_id, {_LINE} AS value FROM shards",
        "parse_fasttext_lines": f"""
SELECT line_id, {_GOLD} AS gold, array_to_string(CASE WHEN {_GOLD} IS NULL THEN tokens ELSE tokens[list_position(tokens, {_GOLD}) + 1:] END, ' ') AS text FROM (SELECT line_id, {_TOKENS} AS tokens FROM training_lines)""",
        "line_subset": r"""
SELECT line_id, CASE WHEN regexp_matches(file_path, '(?i)(?:^|[/\\])(?:train)(?:[/\\]|$)') THEN 'train' WHEN regexp_matches(file_path, '(?i)(?:^|[/\\])(?:valid|validation|val)(?:[/\\]|$)') THEN 'valid'
  WHEN regexp_matches(file_path, '(?i)(?:^|[/\\])(?:test|eval)(?:[/\\]|$)') THEN 'test' ELSE 'train' END AS subset,
  CASE WHEN contains(file_path, 'train') THEN 'train' WHEN contains(file_path, 'valid') THEN 'valid' ELSE 'test' END AS stem_subset FROM training_lines""",
        "label_scan": f"""
SELECT count(*) AS n_lines, round(avg(length(s)), 6) AS mean_length, count(DISTINCT {_GOLD}) AS n_classes FROM (SELECT {_strip('line_text')} AS s, {_TOKENS} AS tokens FROM training_lines) WHERE s <> ''""",
        "label_scan_topk": f"SELECT label, n FROM (SELECT {_GOLD} AS label, count(*) AS n FROM (SELECT {_TOKENS} AS tokens FROM training_lines) GROUP BY 1) WHERE label IS NOT NULL ORDER BY n DESC, label LIMIT 15",
        "line_labels": f"SELECT count(DISTINCT l) AS n_labels FROM (SELECT unnest(regexp_extract_all(line_text, '__label__{_S}+')) AS l FROM training_lines)",
        "vocab_stats": r"SELECT count(DISTINCT t) AS vocab, count(*) AS tokens FROM (SELECT unnest(regexp_extract_all(line_text, '[\p{L}\p{N}_]+')) AS t FROM training_lines)",
        "training_profile": f"""
WITH t AS (SELECT script, unnest(regexp_extract_all({_LINE}, '[\\p{{L}}\\p{{N}}_]+')) AS tok FROM split_shards WHERE regexp_matches(script, '^[A-Za-z]{{4}}$')),
v AS (SELECT script, count(DISTINCT tok) AS vocab, count(*) AS tokens FROM t GROUP BY script),
p AS (SELECT *, CASE WHEN vocab < 128 THEN 1 WHEN vocab < 256 THEN 2 WHEN vocab < 5000 THEN 3 WHEN vocab < 50000 THEN 4 ELSE 5 END AS k FROM v)
SELECT script, vocab, tokens, (['micro', 'tiny', 'small', 'med', 'large'])[k] AS profile, ([32, 64, 100, 200, 300])[k] AS dim, ([20000, 50000, 100000, 200000, 500000])[k] AS bucket, 2 AS minn, ([3, 4, 5, 5, 6])[k] AS maxn,
  CASE WHEN k < 3 THEN 1 ELSE 2 END AS word_ngrams, 4 AS dsub, least(500, vocab) AS cutoff FROM p""",
        "discover_scripts": "SELECT DISTINCT script FROM split_shards WHERE regexp_matches(script, '^[A-Za-z]{4}$')",
        "vocab_padding": r"""
WITH v AS (SELECT count(DISTINCT t) AS n FROM (SELECT unnest(regexp_extract_all(line_text, '[\p{L}\p{N}_]+')) AS t FROM training_lines)),
pads AS (SELECT array_to_string(list_transform(range(32), lambda j: '__pad_tok_' || i || '_' || j || '__'), ' ') AS value FROM v, LATERAL (SELECT unnest(range(greatest(100000 - n, 0))) AS i))
SELECT value, count(*) AS n FROM (SELECT line_text AS value FROM training_lines UNION ALL SELECT value FROM pads) GROUP BY value""",
        "langid_accuracy": f"WITH {_LATEST}, a AS (SELECT count(*) AS n, coalesce(sum((gold = pred)::INT), 0) AS correct FROM latest) SELECT n, correct, round(correct / n, 6) AS accuracy, round(correct / n, 6) AS precision_at_1, round(correct / n, 6) AS recall_at_1 FROM a",
        "langid_per_label": f"WITH {_LATEST}, {_PER_LABEL} SELECT * FROM per_label",
        "langid_per_label_top": f"WITH {_LATEST}, {_PER_LABEL} SELECT * FROM per_label ORDER BY n DESC, label LIMIT 20",
        "latest_predictions": f"WITH {_LATEST} SELECT rec_id, epoch_us(evaluated_at) AS evaluated_us, gold, pred, prob FROM latest",
        "prediction_rows": f"WITH {_LATEST} SELECT coalesce(gold, '') AS gold, coalesce(pred, '') AS pred, printf('%.6f', coalesce(prob, 0.0)) AS prob, regexp_replace(coalesce(text, ''), '[\\t\\r\\n]+', ' ', 'g') AS text FROM latest",
        "pipeline_wired": f"""
WITH s AS (SELECT row_id, lang, text, region_code, CASE WHEN best.n = 0 THEN 'Unknown' ELSE best.name END AS script FROM (SELECT *, list_max([{counts}]) AS best FROM shards)),
{_SIZES.format(keys='script, lang', source='s').replace('WHERE lang IN (SELECT lang FROM d GROUP BY lang HAVING count(DISTINCT split) = 3)', 'WHERE (script, lang) IN (SELECT (script, lang) FROM d GROUP BY script, lang HAVING count(DISTINCT split) = 3) OR script IN (SELECT script FROM d GROUP BY script HAVING count(DISTINCT split) < 3)')}
SELECT split, script, {_LINE} AS value FROM splits""",
    }


_PER_LABEL = """
g AS (SELECT gold AS label, count(*) AS n, sum((gold = pred AND pred IS NOT NULL)::INT) AS hit FROM latest WHERE gold IS NOT NULL GROUP BY gold),
p AS (SELECT pred AS label, count(*) AS m FROM latest WHERE pred IS NOT NULL GROUP BY pred),
per_label AS (SELECT coalesce(g.label, p.label) AS label, coalesce(n, 0) AS n, round(coalesce(hit / nullif(m, 0), 0.0), 6) AS precision, round(coalesce(hit / nullif(n, 0), 0.0), 6) AS recall FROM g FULL JOIN p ON g.label = p.label)"""
