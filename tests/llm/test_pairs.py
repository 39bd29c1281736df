import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from corpusloom.llm import neardup, overlap
from corpusloom.llm.words import Hasher, bag_keys, bags, words

SCHEMA = "row_id long, text string, id string, text_a string, rep long, block long"


def test_words():
    assert words("«Straße,» can't (A) -- 3 … x_y को") == ["strasse", "can't", "a", "3", "x_y", "को"]
    assert words(None) == words("") == words(" \n") == []
    assert words("e\u0301te\u0301") == words("\u00e9t\u00e9")


def test_bags_are_multisets():
    tokens, sizes = bags(["a b a", "b a a", "a b", None, "a a b b"], Hasher())
    k1, k2 = bag_keys(tokens, sizes)
    keys = list(zip(k1.tolist(), k2.tolist()))
    assert keys[0] == keys[1] and len(set(keys)) == 4 and sizes.tolist() == [3, 3, 2, 0, 4]


def similarity(a, b):
    x, y = Counter(words(a)), Counter(words(b))
    common = sum((x & y).values())
    return common / (sum(x.values()) + sum(y.values()) - common)


def corpus(seed, groups=12, copies=9):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of", "a"] * 30
    rows = []
    for _ in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(18, 60))]
        for _ in range(copies):
            ws = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3))):
                k = rng.randrange(len(ws))
                kind = rng.randrange(3)
                if kind == 0:
                    ws[k] = rng.choice(vocabulary)
                elif kind == 1:
                    ws.insert(k, rng.choice(vocabulary))
                else:
                    ws.pop(k)
            if rng.random() < 0.3:
                rng.shuffle(ws)
            rows.append(" ".join(ws).upper() if rng.random() < 0.2 else " ".join(ws))
    rng.shuffle(rows)
    return rows


def frame(spark, texts):
    # columns named like the operator's own must not disturb it
    return spark.createDataFrame([(i * 3, t, "x", "y", 7, 9) for i, t in enumerate(texts)], SCHEMA)


def brute(texts, threshold=0.7):
    long = {i * 3: t for i, t in enumerate(texts) if t is not None and len(words(t)) >= 20}
    return {(a, b) for a in long for b in long if a < b and similarity(long[a], long[b]) >= threshold}


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicate_pairs_against_brute_force(spark, seed):
    texts = [*corpus(seed), None, "", " ", "too short", "x " * 30_000 + "y"]
    got = {tuple(r) for r in neardup.pairs(frame(spark, texts), "row_id", "text").collect()}
    truth = brute(texts)
    assert got <= truth and len(got) >= 0.97 * len(truth)


def test_pairs_at_the_threshold_are_found(spark):
    # 28 of 40 words in common: exactly 0.7; blocks and limits that favour closer pairs lose some of these
    texts = []
    for g in range(600):
        common = [f"g{g}c{i}" for i in range(28)]
        texts += [" ".join([*common, *(f"g{g}{s}{i}" for i in range(6))]) for s in "ab"]
    got = {tuple(r) for r in neardup.pairs(frame(spark, texts), "row_id", "text").collect()}
    assert got == {(6 * g, 6 * g + 3) for g in range(600)}


def test_heavy_group_of_copies(spark):
    base = " ".join(f"word{i}" for i in range(30))
    texts = [base] * 60 + [base + " more", " ".join(f"other{i}" for i in range(30))]
    df = frame(spark, texts)
    assert neardup.pairs(df, "row_id", "text").count() == 61 * 60 // 2
    rows = {r["id"]: r for r in neardup.groups(df, "row_id", "text").collect()}
    assert {rows[i * 3]["group_id"] for i in range(61)} == {0}
    assert (rows[0]["copies"], rows[0]["links"], rows[180]["copies"]) == (60, 1, 1)
    assert (rows[183]["group_id"], rows[183]["links"]) == (183, 0)


def test_near_duplicates_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert neardup.pairs(empty, "row_id", "text").count() == 0
    assert neardup.groups(empty, "row_id", "text").count() == 0


@pytest.mark.parametrize("written, plain", [("TRAIN", "train"), (" training ", "train"), ("val", "valid"), ("Validation", "valid"), ("eval", "test"), ("odd", "test"), (None, "test")])
def test_split_names(spark, written, plain):
    df = spark.createDataFrame([(written, "/a/test/x.parquet")], "s string, p string")
    assert df.select(overlap.plain_split(F.col("s"), F.col("p"))).first()[0] == plain


def test_overlaps_against_brute_force(spark):
    texts = [*corpus(5, groups=15), None, "", "short one"]
    rows = [(i, t, ("train", "TRAINING", "valid", "test", None)[i % 5], f"s{i % 3}", 1, True, "tokens") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "rec_id long, text string, split string, source string, id int, train boolean, tokens string")
    got = {(r["eval_id"], r["train_id"]) for r in overlap.pairs(df, "rec_id", "text", "split").collect()}
    side = {i: s for i, _, s, *_ in rows}
    long = {i: t for i, t, *_ in rows if t and len(words(t)) >= 20}
    evals, trains = [i for i in long if side[i] in ("valid", "test")], [i for i in long if side[i] in ("train", "TRAINING")]
    truth = {(e, t) for e in evals for t in trains if similarity(long[e], long[t]) >= 0.7}
    assert got == truth and truth
    report = overlap.report(df, "rec_id", "text", "split", "source").collect()
    assert sum(r["pairs"] for r in report) == len(truth) and sum(r["overlapping"] for r in report) == len({e for e, _ in truth})
    assert sum(r["records"] for r in report) == sum(s in ("valid", "test") for s in side.values())


def test_hot_words_are_spread(spark, monkeypatch):
    from corpusloom.llm import prefix

    monkeypatch.setattr(prefix, "HOT", 5)
    texts = corpus(6, groups=10)
    rows = [(i, t, ("train", "valid")[i % 2]) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "rec_id long, text string, split string")
    got = {(r["eval_id"], r["train_id"]) for r in overlap.pairs(df, "rec_id", "text", "split").collect()}
    long = [i for i, t, _ in rows if len(words(t)) >= 20]
    assert got == {(e, t) for e in long if e % 2 for t in long if not t % 2 and similarity(texts[e], texts[t]) >= 0.7}


def test_overlaps_of_nothing(spark):
    empty = spark.createDataFrame([], "rec_id long, text string, split string, source string")
    assert overlap.pairs(empty, "rec_id", "text", "split").count() == 0
    assert overlap.report(empty, "rec_id", "text", "split", "source").count() == 0


def test_the_exact_way_finds_all(spark):
    texts = [*corpus(3), None, "", "too short"]
    for g in range(60):
        common = [f"g{g}c{i}" for i in range(28)]
        texts += [" ".join([*common, *(f"g{g}{s}{i}" for i in range(6))]) for s in "ab"]
    got = {tuple(r) for r in neardup.pairs(frame(spark, texts), "row_id", "text", exact=True).collect()}
    assert got == brute(texts)


def test_parities_fold_and_bound_the_difference():
    rng = random.Random(4)
    for n in (30, 40, 52, 80, 100, 200):
        a = [f"w{rng.randrange(10**6)}" for _ in range(n)]
        b = [w if rng.random() > 0.15 else w + "x" for w in a] + ["y"] * rng.randrange(9)
        tokens, sizes = bags([" ".join(a), " ".join(b)], Hasher())
        x, y = neardup.nested_parity(tokens, sizes)
        d = [int(p) ^ int(q) for p, q in zip(x, y)]
        bits = lambda v: bin(v & (2**64 - 1)).count("1")
        apart = bits(d[0]) if sizes.min() < 48 else bits(d[0] ^ d[1]) + bits(d[1]) if sizes.min() < 96 else bits(d[0] ^ d[1] ^ d[2]) + bits(d[1] ^ d[3]) + bits(d[2]) + bits(d[3])
        difference = len(set(tokens[: sizes[0]].tolist()) ^ set(tokens[sizes[0] :].tolist()))
        assert 0 < apart <= difference and (difference - apart) % 2 == 0


def test_long_records_of_one_vocabulary(spark):
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(900)]
    texts = []
    for _ in range(30):
        base = [rng.choice(vocabulary) for _ in range(rng.randrange(240, 700))]
        texts.append(" ".join(base))
        texts.append(" ".join(w for w in base if rng.random() > 0.12))
        texts.append(" ".join(w if rng.random() > 0.15 else rng.choice(vocabulary) for w in base))
    got = {tuple(r) for r in neardup.pairs(frame(spark, texts), "row_id", "text").collect()}
    assert got == brute(texts) and len(got) >= 50
