import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusloom import runtime
from corpusloom.llm import mixing, sampling

LANGUAGES = [("eng", "en", "English"), ("deu", "de", "German"), ("qaa", None, "Xyz (local)")]


@pytest.mark.parametrize("label, lang", [("eng", "eng"), (" EN ", "eng"), ("english", "eng"), ("en_US", "eng"), ("de-CH", "deu"), ("xyz (local)", "qaa"), ("und", None), ("", None), ("-", None), (None, None), ("eng_Latn", "eng"), ("engl", None)])
def test_labels(spark, label, lang):
    table = spark.createDataFrame(LANGUAGES, "lang string, code2 string, lang_name string")
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(sampling.reads_as(F.col("l"), table)).first()[0] == lang


@pytest.mark.parametrize(
    "counts, targets, total",
    [({"a": 100, "b": 50, "c": 3}, [("a", 0.5, 1), ("b", 0.3, 1), ("c", 0.2, 5)], 40), ({"a": 100}, [("a", 0.1, 0), ("z", 0.9, 3)], 20), ({"a": 100, "b": 100}, [("a", 0.5, 30), ("b", 0.5, 30)], 20), ({}, [("a", 1.0, 1)], 0), ({"a": 5}, [("a", 1.0, 0)], 50)],
)
def test_allocation(counts, targets, total):
    rows = {r["category"]: r for r in sampling.allocate(counts, targets, total)}
    for c, share, minimum in targets:
        r = rows[c]
        assert 0 <= r["size"] <= counts.get(c, 0)
        assert r["size"] >= min(minimum, counts.get(c, 0))
        assert r["short"] == (counts.get(c, 0) < max(minimum, int(share * total)))
    floor = sum(min(m, counts.get(c, 0)) for c, _, m in targets)
    can = sum(counts.get(c, 0) for c, _, _ in targets)
    assert sum(r["size"] for r in rows.values()) == max(floor, min(total, can))


def test_flight_leaves_one_undecided_record_a_category():
    rng = np.random.default_rng(3)
    category = np.array(["abc"[k] for k in rng.integers(0, 3, 500)])
    p = np.array([{"a": 0.3, "b": 0.25, "c": 0.9}[c] for c in category])
    out = sampling.fly(category, p, rng.integers(0, 2**63, 500).astype(np.uint64))
    for c in "abc":
        own = out[category == c]
        assert ((own > 0) & (own < 1)).sum() <= 1
        assert abs(own.sum() - p[category == c].sum()) < 1e-6


def test_inclusion_rates_are_even():
    hits = np.zeros(20)
    rng = np.random.default_rng(1)
    for _ in range(4000):
        hits += sampling.fly(np.array(["a"] * 20), np.full(20, 0.4), rng.integers(0, 2**63, 20).astype(np.uint64))
    assert np.abs(hits / 4000 - 0.4).max() < 0.05


def test_sample_is_exact_over_partitions(spark):
    rows = [(i, "abcd"[(i % 10) // 3], None, 1.0) for i in range(3000)] + [(9000 + i, None, None, 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "row_id long, lang string, category string, p double").repartition(130)
    targets = spark.createDataFrame([("a", 0.1, 5), ("b", 0.6, 5), ("d", 0.3, 400), ("z", 0.0, 3)], "lang string, share double, least long")
    report = {r["category"]: r for r in sampling.balance_report(df, "row_id", F.col("lang"), targets).collect()}
    assert all(r["residual"] == 0 for r in report.values())
    assert sum(r["sampled"] for r in report.values()) == 600
    assert report["d"]["short"] and report["d"]["sampled"] == 300 and report["z"]["short"] and not report["a"]["short"]
    drawn = sampling.balanced_sample(df, "row_id", F.col("lang"), targets).collect()
    assert len({r["id"] for r in drawn}) == 600
    names = {i: l for i, l, *_ in rows}
    assert all(names[r["id"]] == r["category"] for r in drawn)


def test_draws_do_not_depend_on_the_layout(spark, monkeypatch):
    monkeypatch.setattr(runtime, "BLOCK_ROWS", 300)
    rows = [(i, "abcd"[(i % 10) // 3], "w " * (1 + i % 37)) for i in range(3000)]
    df = spark.createDataFrame(rows, "row_id long, lang string, text string")
    targets = spark.createDataFrame([("a", 0.1, 5), ("b", 0.6, 5), ("d", 0.3, 4)], "lang string, share double, least long")
    samples, mixtures = [], []
    for parts, batch in ((2, 10_000), (4, 10_000), (7, 64)):
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        laid = df.repartition(parts)
        samples.append({tuple(r) for r in sampling.balanced_sample(laid, "row_id", F.col("lang"), targets).collect()})
        mixtures.append({tuple(r) for r in mixing.Mixture(laid, "row_id", "lang", mixing.word_sizes(F.col("text")), targets).documents().collect()})
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert samples[0] == samples[1] == samples[2] and len(samples[0]) == 600
    assert mixtures[0] == mixtures[1] == mixtures[2]


def test_sample_of_nothing(spark):
    df = spark.createDataFrame([], "row_id long, lang string")
    targets = spark.createDataFrame([("a", 1.0, 5)], "lang string, share double, least long")
    assert sampling.balanced_sample(df, "row_id", F.col("lang"), targets).count() == 0
    assert sampling.balance_report(df, "row_id", F.col("lang"), targets).first()["short"]


def documents(spark):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(1500):
        source = ("Big", " big ", "small", "rare", None, " ")[int(rng.choice(6, p=[0.4, 0.3, 0.15, 0.05, 0.05, 0.05]))]
        rows.append((i, "w " * int(rng.integers(1, 60)), source, 5, 0.5))
    rows += [(5000, None, "big", 5, 0.5), (5001, "", "small", 5, 0.5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size int, rate double")


TARGETS = [("big", 0.5, 2), ("small", 0.4, 5), ("rare", 0.0999, 1), ("absent", 0.0001, 3)]


def test_mixture_follows_the_targets(spark):
    df, targets = documents(spark), spark.createDataFrame(TARGETS, "source string, share double, cap long")
    m = mixing.Mixture(df, "doc_id", "source", mixing.word_sizes(F.col("text")), targets)
    report = {r["source"]: r for r in m.report().collect()}
    for source, share, _ in TARGETS[:2]:
        assert abs(report[source]["actual_share"] - share) < 0.01 and not report[source]["short"]
    assert report["rare"]["short"] and report["rare"]["actual_size"] == report["rare"]["available"]
    assert report["absent"]["short"] and report["absent"]["actual_size"] == 0
    used = m.documents().collect()
    assert all(1 <= r["copies"] <= dict((s, c) for s, _, c in TARGETS)[r["source"]] for r in used)
    assert len({r["id"] for r in used}) == len(used)


def test_mixture_tilts_the_rates(spark):
    # "less" needs fewer than one copy of each, "more" more, and its longest documents reach the cap; one is an outlier
    rows = [(i, "w " * n, s) for s, k in (("less", 0), ("more", 10_000)) for i, n in enumerate([*range(1, 200), 20_000], k)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    targets = spark.createDataFrame([("less", 0.1, 2), ("more", 1.1, 3)], "source string, share double, cap long")
    m = mixing.Mixture(df, "doc_id", "source", mixing.word_sizes(F.col("text")), targets)
    assert m.state["less"]["kind"] == m.state["more"]["kind"] == "met"
    assert m.state["less"]["tilt"] < -0.1 and m.state["more"]["tilt"] > 0.1
    sizes = [*range(1, 200), 20_000]
    for source, share, cap in (("less", 0.1, 2), ("more", 1.1, 3)):
        rates = [min(cap, math.exp(m.state[source]["tilt"] * n / (sum(sizes) / 200))) for n in sizes]
        assert abs(sum(r * n for r, n in zip(rates, sizes)) / (share * m.total) - 1) <= mixing.TOLERANCE
    report = {r["source"]: r for r in m.report().collect()}
    assert all(not r["short"] for r in report.values())


def test_mixture_of_nothing(spark):
    targets = spark.createDataFrame(TARGETS, "source string, share double, cap long")
    m = mixing.Mixture(documents(spark).where("false"), "doc_id", "source", mixing.word_sizes(F.col("text")), targets)
    assert m.documents().count() == 0
    assert all(r["actual_size"] == 0 for r in m.report().collect())


def test_token_sizes(spark):
    tokenizers = pytest.importorskip("public_tokenizers")
    count = mixing.token_sizes(spark, tokenizers.path("byte_bpe_multi_50k.tiktoken"), tokenizers.PATTERN)
    df = spark.createDataFrame([("hello world",), (None,), ("",), ("<|endoftext|>",)], "t string")
    sizes = [r[0] for r in df.select(count(F.col("t"))).collect()]
    assert sizes[0] >= 2 and sizes[1:3] == [0, 0] and sizes[3] > 1
