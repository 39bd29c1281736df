import pytest
from pyspark.sql import functions as F

from corpusloom.operators import balance, chunks, dedup, evaluation, filters, graph, lines, skew, snippets, split

ROWS = "row_id long, text string, lang string"


def ids(df, c="row_id"):
    return sorted(r[c] for r in df.collect())


def test_filter_empty_keeps_null_and_blank(spark):
    df = spark.createDataFrame([(1, "", "a"), (2, None, "a"), (3, " ", "a"), (4, "x", ""), (5, "x", None)], ROWS)
    assert ids(filters.filter_empty(df)) == [2, 3, 5]


def test_filter_short(spark):
    nine = lambda n: " ".join(["abcd"] * 8 + ["x" * n])
    df = spark.createDataFrame([(1, " ".join(["a" * 50] * 8), "a"), (2, "a " * 8 + "b" * 24, "a"), (3, "a " * 8 + "b" * 25, "a"), (4, None, "a")], ROWS)
    assert ids(filters.filter_short(df)) == [3]
    assert len(nine(1)) == 41


def test_low_count_labels(spark):
    df = spark.createDataFrame([(i, "t", l) for i, l in enumerate(["a"] * 3 + ["b"] * 2 + [None] * 5)], ROWS)
    assert ids(filters.filter_low_count_labels(df, min_count=3)) == [0, 1, 2]


@pytest.mark.parametrize("path, subset", [("/x/08_split/val/a.parquet", "valid"), ("/x/eval/a.parquet", "test"), ("/x/a.parquet", "train"), ("/train/valid/a", "train")])
def test_subset_of_path(spark, path, subset):
    assert spark.createDataFrame([(path,)], "p string").select(filters.subset_of_path(F.col("p"))).first()[0] == subset


def test_exact_dedup_keeps_the_least_id(spark):
    df = spark.createDataFrame([(2, "a", "de"), (1, "a", "en"), (3, "b", "en"), (4, None, "en"), (5, None, "en")], ROWS)
    assert ids(dedup.exact_dedup(df)) == [1, 3, 4]


def test_band_keys(spark):
    df = spark.createDataFrame([(0x0102030405060708,)], "sig long").select(F.explode(dedup.band_keys(F.col("sig"))).alias("b"))
    assert [(r["b"]["band"], r["b"]["v"]) for r in df.collect()] == list(zip(range(8), range(8, 0, -1)))


def _greedy(rows, distance=3):
    kept = []
    for i, g, s in sorted(rows):
        if not any(g == h and bin((s ^ t) & (2**64 - 1)).count("1") <= distance for _, h, t in kept):
            kept.append((i, g, s))
    return [i for i, _, _ in kept]


def test_greedy_near_dedup_equals_the_sequential_rule(spark):
    import random

    rng = random.Random(4)
    base = [rng.getrandbits(63) for _ in range(6)]
    rows = []
    for i in range(160):
        s = rng.choice(base)
        for _ in range(rng.randrange(6)):
            s ^= 1 << rng.randrange(63)
        rows.append((i, rng.choice("ab"), s))
    df = spark.createDataFrame(rows, "id long, grp string, sig long")
    assert ids(dedup.keep_signatures(df), "id") == _greedy(rows)
    for bands, distance in ((4, 3), (8, 7), (5, 2)):
        assert ids(dedup.keep_signatures(df, bands, distance), "id") == _greedy(rows, distance)


def test_greedy_chain(spark):
    df = spark.createDataFrame([(1, "en", 0), (2, "en", 0b111), (3, "en", 0b111111)], "id long, grp string, sig long")
    assert ids(dedup.keep_signatures(df), "id") == [1, 3]


def test_bands_must_outnumber_distance(spark):
    with pytest.raises(ValueError):
        dedup.signature_pairs(spark.createDataFrame([], "row_id long, grp string, sig long"), bands=3, distance=3)


def test_near_dedup_is_by_language(spark):
    text = "ein ganz gewöhnlicher Satz über Dinge"
    df = spark.createDataFrame([(1, text, "en"), (2, text, "de"), (3, text, "en"), (4, None, None), (5, "", None)], ROWS)
    assert ids(dedup.near_dedup(df)) == [1, 2, 4]


def test_near_dedup_of_nothing(spark):
    assert dedup.near_dedup(spark.createDataFrame([], ROWS)).count() == 0


SIZES = {1: (0, 0, 1), 2: (1, 0, 1), 3: (1, 1, 1), 4: (2, 1, 1), 5: (3, 1, 1), 7: (5, 1, 1), 9: (7, 1, 1), 10: (8, 1, 1), 11: (8, 1, 2), 20: (16, 2, 2)}


def test_split_sizes(spark):
    df = spark.createDataFrame([(n,) for n in SIZES], "n long")
    tr, va = split.split_sizes(F.col("n"))
    assert {r[0]: (r[1], r[2], r[0] - r[1] - r[2]) for r in df.select("n", tr, va).collect()} == SIZES


def test_stratified_split_is_a_partition(spark):
    rows = [(i, "t", "abc"[i % 3] if i < 90 else "d") for i in range(92)] + [(100, "t", None)]
    df = spark.createDataFrame(rows, ROWS)
    out = split.stratified_split(df).collect()
    assert sorted(r["row_id"] for r in out) == list(range(90))
    for label in "abc":
        n = [r["split"] for r in out if r["lang"] == label]
        assert (n.count("train"), n.count("valid"), n.count("test")) == (24, 3, 3)
    assert sorted(map(tuple, out)) == sorted(map(tuple, split.stratified_split(df.repartition(3)).collect()))


def test_split_rejects_bad_shares(spark):
    with pytest.raises(ValueError):
        split.stratified_split(spark.createDataFrame([], ROWS), train=0.9, valid=0.1)


@pytest.mark.parametrize("sizes, mode, target, expected", [((5, 2, 1), "max", 0, (5, 5, 5)), ((5, 2, 1), "median_x2", 0, (5, 4, 4)), ((4, 1), "median_x2", 0, (4, 4)), ((5, 2), "none", 3, (5, 3)), ((5, 2), "none", 0, (5, 2))])
def test_balance(spark, sizes, mode, target, expected):
    rows = [(10 * k + i, "t", "abc"[k]) for k, n in enumerate(sizes) for i in range(n)]
    out = balance.balance(spark.createDataFrame(rows, ROWS), mode=mode, target=target)
    got = {r["lang"]: r["n"] for r in out.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    assert got == dict(zip("abc", expected))
    assert out.where("copy = 0").count() == len(rows)
    names = {i: l for i, _, l in rows}
    assert all(names[r["row_id"]] == r["lang"] for r in out.collect())


def test_balance_drops_null_keys_only_when_active(spark):
    df = spark.createDataFrame([(1, "t", None), (2, "t", "a")], ROWS)
    assert balance.balance(df, mode="none").count() == 2
    assert ids(balance.balance(df, mode="max")) == [2]


@pytest.mark.parametrize(
    "text, limit, pieces",
    [("the quick brown fox", 10, ["the quick", "brown fox"]), ("abcdefghij", 4, ["abcd", "efgh", "ij"]), ("ab cd ef", 5, ["ab", "cd ef"]), ("ab cd ef", 6, ["ab cd", "ef"]), ("", 5, [""]), (" abcdefghij", 5, ["", "abcde", "fghij"]), ("   ", 2, [""]), (None, 5, [None])],
)
def test_split_text(text, limit, pieces):
    assert chunks.split_text(text, limit) == pieces


def test_split_long_entries_uses_the_mean(spark):
    df = spark.createDataFrame([(1, "aa bb", "x"), (2, "a", "x"), (3, None, "x")], ROWS)
    got = [tuple(r) for r in chunks.split_long_entries(df).select("row_id", "piece", "text").orderBy("row_id", "piece").collect()]
    assert got == [(1, 0, "aa"), (1, 1, "bb"), (2, 0, "a"), (3, 0, None)]


@pytest.mark.parametrize("text, rows", [(" ".join(f"w{i}" for i in range(20)), 13), (" ", 5), ("", 1), (None, 1)])
def test_augment_row_counts(spark, text, rows):
    out = snippets.augment(spark.createDataFrame([(1, text, "a")], ROWS)).collect()
    assert len(out) == rows
    for r in out[1:]:
        assert r["text"] in text


def test_short_texts_give_all_their_words(spark):
    out = snippets.augment(spark.createDataFrame([(1, "a b", "x")], ROWS), n_chars=0).collect()
    assert [r["text"] for r in out[1:]] == ["a b"] * 8


def test_components(spark):
    pairs = [(1, 2), (2, 3), (10, 11), *[(k, k + 1) for k in range(100, 140)], (5, 5)]
    got = {r["node"]: r["component"] for r in graph.connected_components(spark.createDataFrame(pairs, "a long, b long"), "a", "b").collect()}
    assert got[3] == 1 and got[11] == 10 and {got[k] for k in range(100, 141)} == {100} and 5 not in got


def _profile(rows):
    out = {}
    for key in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == key]
        texts = [t for _, t, _ in own if t is not None]
        n = {}
        for _, _, s in own:
            if s is not None:
                n[s] = n.get(s, 0) + 1
        top = " ".join(f"{s}:{c}" for s, c in sorted(n.items(), key=lambda x: (-x[1], x[0]))[:3]) if n else None
        out[key] = (len(own), len(set(texts)), round(sum(map(len, texts)) / len(texts), 6) if texts else None, top)
    return out


@pytest.mark.parametrize("partitions", [1, 3, 16])
def test_per_key_profile_with_a_heavy_key_and_a_heavy_value(spark, partitions):
    rows = [("eng", "same text", "s1")] * 300 + [("eng", f"t{i % 50}", f"s{i % 7}") for i in range(200)] + [("deu", None, None), ("deu", "x", "s"), (None, "y", "s"), (None, None, None), ("fra", None, None)] + [("nld", "", "q")] * 2
    data = [(i, *r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "row_id long, lang string, text string, source string")
    got = skew.per_key_profile(df, F.col("lang"), F.col("text"), F.col("source"), F.col("row_id"), partitions=partitions).collect()
    assert {r["key"]: tuple(r)[1:] for r in got} == _profile(rows)


def test_per_key_profile_of_nothing_and_with_clashing_columns(spark):
    schema = "row_id long, lang string, text string, source string, part int, key string, h1 long"
    empty = spark.createDataFrame([], schema)
    args = (F.col("lang"), F.col("text"), F.col("source"), F.col("row_id"))
    assert skew.per_key_profile(empty, *args).count() == 0
    one = spark.createDataFrame([(1, "a", "t" * 100_000, "s", 3, "k", 9)], schema)
    assert tuple(skew.per_key_profile(one, *args).first()) == ("a", 1, 1, 100000.0, "s:1")
    assert [r["key"] for r in skew.heavy_keys(skew.per_key_profile(one, *args), 0.5).collect()] == ["a"]


def test_vocabulary(spark):
    df = spark.createDataFrame([("__label__deu hallo hallo AT",)], "value string")
    assert tuple(lines.vocabulary_stats(df).first()) == (3, 4)


def test_vocabulary_padding(spark):
    df = spark.createDataFrame([("__label__deu a b",)], "value string")
    out = lines.vocabulary_padding(df, minimum=6).collect()
    assert len(out) == 4 and out[1]["value"].split()[31].endswith("_31__")


def test_prefix_check(spark):
    lines.check_prefix(spark.createDataFrame([("  ",), ("__label__a b",)], "value string"))
    with pytest.raises(ValueError):
        lines.check_prefix(spark.createDataFrame([("a b",)], "value string"))


def test_metrics(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "b"), (None, "b"), ("c", None)], "gold string, pred string")
    assert tuple(evaluation.accuracy(df).first()) == (5, 2, 0.4, 0.4, 0.4)
    got = {r["label"]: tuple(r)[1:] for r in evaluation.per_label(df).collect()}
    assert got == {"a": (2, 1.0, 0.5), "b": (1, round(1 / 3, 6), 1.0), "c": (1, 0.0, 0.0)}
    assert tuple(evaluation.accuracy(df.where("false")).first()) == (0, 0, 0.0, 0.0, 0.0)




def test_leads_of_runs_that_fill_partitions(spark):
    rows = [(7, i) for i in range(400)] + [(k, 1000 + k) for k in range(5)] + [(9, 2000 + i) for i in range(3)]
    out, spanning = skew.run_leads(spark.createDataFrame(rows, "k long, id long"), ["k"], "id")
    first = {}
    for k, i in sorted(rows):
        first.setdefault(k, i)
    assert sorted((r["k"], r["id"], r["lead"]) for r in out.collect()) == sorted((k, i, first[k]) for k, i in rows)
    assert [r["lead"] for r in spanning.collect()] == [0]
    named = spark.createDataFrame([(0, "hot"), (2000, "cold"), (5, "none")], "lead long, name string")
    got = skew.expand(named, "lead", out, "lead", {"id": "member"}, spanning, salts=4)
    assert sorted((r["name"], r["member"]) for r in got.collect()) == sorted([("hot", i) for i in range(400)] + [("cold", 2000 + i) for i in range(3)])
    # the hot key's rows come out of several tasks
    parts = got.where("name = 'hot'").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 or spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_leads_of_nothing(spark):
    out, spanning = skew.run_leads(spark.createDataFrame([], "k long, id long"), ["k"], "id")
    assert out.count() == 0 and spanning.count() == 0


def test_a_long_chain_settles(spark):
    n = 1000
    ids = spark.range(1, n + 1).selectExpr("id")
    links = spark.range(1, n).selectExpr("id as x", "id + 1 as y")
    assert sorted(r["id"] for r in dedup.greedy_keep(ids, links).collect()) == list(range(1, n + 1, 2))


def test_rounds_and_one_task_agree(spark):
    import random

    rng = random.Random(5)
    pairs = sorted({tuple(sorted(rng.sample(range(60), 2))) for _ in range(90)})
    links = spark.createDataFrame(pairs, "x long, y long")
    dropped = set()
    for x, y in sorted(pairs, key=lambda p: p[1]):
        if x not in dropped:
            dropped.add(y)
    for few in (0, 10, 10_000):
        assert {r["id"] for r in dedup.greedy_keep(spark.range(60), links, few).collect()} == set(range(60)) - dropped


def test_copies_of_one_row_are_made_by_many_tasks(spark):
    rows = spark.createDataFrame([(1, "rare", "t")] + [(10 + i, "many", "t") for i in range(3)], "row_id long, lang string, text string")
    out = balance.balance(rows, mode="none", target=20_000)
    assert out.where("lang = 'rare'").select("copy").distinct().count() == 20_000
    salts = {r["s"] for r in out.where("lang = 'rare' and copy > 0").selectExpr("copy % 20 as s").distinct().collect()}
    assert salts == set(range(20))


def test_draws_of_balance_are_not_broadcast(spark):
    def nodes(plan):
        yield plan
        for i in range(plan.children().size()):
            yield from nodes(plan.children().apply(i))

    rows = spark.createDataFrame([(1, "rare", "t")] + [(10 + i, "many", "t") for i in range(3)], "row_id long, lang string, text string")
    out = balance.balance(rows, mode="none", target=200_000)
    joins = [p for p in nodes(out._jdf.queryExecution().sparkPlan()) if p.nodeName() == "BroadcastHashJoin"]
    built = [(p.left() if p.buildSide().toString() == "BuildLeft" else p.right()).output().mkString(" ") for p in joins]
    assert built and not any("copy#" in names for names in built)
    counts = out.groupBy("lang").agg(F.count("*").alias("n"), F.count_distinct("copy").alias("d")).collect()
    assert {r["lang"]: (r["n"], r["d"]) for r in counts} == {"rare": (200_000, 200_000), "many": (200_000, 199_998)}
