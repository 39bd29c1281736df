import pytest
from pyspark.sql import functions as F

from corpusloom.functions import scripts as S
from corpusloom.functions import text as T


def value(spark, column, text):
    return spark.createDataFrame([(text,)], "text string").select(column(F.col("text")).alias("v")).first()["v"]


@pytest.mark.parametrize("text, expected", [("M² ٣b3", "m2 b"), (None, None), ("", "")])
def test_clean_removes_decimal_digits_before_folding_others(spark, text, expected):
    assert value(spark, lambda c: T.clean(c, lowercase=True, strip_numbers=True, digits=True), text) == expected


def test_drop_wiki_lines(spark):
    assert value(spark, T.drop_wiki_lines, "Category:X\nhi [[Category:Y]]\n[[Category:Z]] tail") == "hi [[Category:Y]]"


def test_normalisation_is_gated(spark):
    decomposed = "é"
    assert value(spark, lambda c: T.clean(c), decomposed) == decomposed
    assert value(spark, lambda c: T.clean(c, always_normalize=True), decomposed) == "é"
    assert value(spark, lambda c: T.clean(c, form="NFD"), "é") == decomposed


@pytest.mark.parametrize("text, expected", [("", []), ("ab", ["ab"]), ("abc", ["abc"]), ("abcd", ["abc", "bcd"])])
def test_shingles(spark, text, expected):
    assert value(spark, T.shingles, text) == expected


@pytest.mark.parametrize(
    "text, bucket", [(" ".join(["wort"] * 8) + "x" * 200, "SHORT"), (" ".join(["abcde"] * 20) + "x", "LONG"), (" ".join(["abcde"] * 20), "MEDIUM")]
)
def test_length_bucket(spark, text, bucket):
    assert value(spark, T.len_bucket, text) == bucket


def test_digit_bucket(spark):
    rows = spark.createDataFrame([(0.0,), (0.049,), (0.05,), (0.2,)], "r double").select(T.digit_bucket(F.col("r")).alias("b")).collect()
    assert [r["b"] for r in rows] == ["NONE", "LOW", "MED", "HIGH"]


def test_digits_of_any_kind_count(spark):
    assert value(spark, T.digit_ratio, "a1²٣") == 0.75
    assert value(spark, T.digit_ratio, "") == 0.0


@pytest.mark.parametrize("text, expected", [("abДа", "Cyrillic"), ("12 !", "Other"), (None, None)])
def test_block_script(spark, text, expected):
    assert value(spark, T.block_script, text) == expected


def test_meta_tokens(spark):
    assert value(spark, T.meta_tokens, "abc 1") == " __feat_SCRIPT=Latin __feat_LEN=SHORT __feat_DIGITRATIO=HIGH"


def test_social_text(spark):
    text = "See https://x.y/z or me@site.org @you #tag\r\nnow 12"
    assert value(spark, lambda c: T.clean_social(c, strip_hashtags=True), text) == "see or now 00"
    assert value(spark, T.clean_social, None) == ""


def test_blanks_are_unicode(spark):
    assert value(spark, T.word_count, "a b\u0085c\x1cd") == 4
    assert value(spark, T.strip, "  a  ") == "a"


def test_label_lines(spark):
    df = spark.createDataFrame([("deu", "hallo\nwelt", None)], "l string, t string, r string")
    line = lambda **k: df.select(T.label_line(F.col("l"), F.col("t"), F.col("r"), **k)).first()[0]
    assert line() == "__label__deu hallo welt "
    assert line(raw=True, literal_nulls=True) == "__label__deu hallo\nwelt None"


@pytest.mark.parametrize("line, gold, text", [("noise __label__en hello  world", "__label__en", "hello world"), ("no label", None, "no label"), ("__label__x", "__label__x", ""), ("", None, "")])
def test_parse_label_line(spark, line, gold, text):
    got = value(spark, T.parse_label_line, line)
    assert (got["gold"], got["text"]) == (gold, text)


def test_training_profile(spark):
    df = spark.createDataFrame([(v,) for v in (127, 128, 255, 256, 4999, 5000, 49999, 50000)], "v int")
    assert [r[0] for r in df.select(T.training_profile(F.col("v"))["name"]).collect()] == ["micro", "tiny", "tiny", "small", "small", "med", "med", "large"]


def test_dsub_and_cutoff(spark):
    dims = spark.createDataFrame([(d,) for d in (32, 64, 100, 200, 300, 7)], "d int")
    assert [r[0] for r in dims.select(T.pick_dsub(F.col("d"))).collect()] == [4, 4, 4, 4, 4, 1]
    assert dims.where("d = 100").select(T.pick_dsub(F.col("d"), 8)).first()[0] == 1
    cases = spark.createDataFrame([(300000, 500), (0, 500), (5, 0), (None, 500)], "w int, v int")
    assert [r[0] for r in cases.select(T.safe_cutoff(F.col("w"), F.col("v"))).collect()] == [500, 1, 1, 500]


def test_human_bytes(spark):
    df = spark.createDataFrame([(512,), (2048,), (3 << 20,), (5 << 40,)], "n long")
    assert [r[0] for r in df.select(T.human_bytes(F.col("n"))).collect()] == ["512.0 B", "2.0 KB", "3.0 MB", "5.0 TB"]


@pytest.mark.parametrize("text, script", [(None, "Unknown"), ("", "Unknown"), ("123 !?", "Unknown"), ("abc Да", "Latn"), ("Привет ok", "Cyrl"), ("aД", "Latn"), ("Дa", "Cyrl"), ("日本の", "Hani")])
def test_dominant_script(spark, text, script):
    assert value(spark, lambda c: S.dominant_script(spark, c), text) == script


def test_purity_filter(spark):
    df = spark.createDataFrame([(1, "abc Да 123 שלום", "srp"), (2, "aש", "srp"), (3, None, "srp"), (4, "abc Да", "rus"), (5, "abc", None)], "row_id int, text string, lang string")
    got = {r["row_id"]: r["text"] for r in S.purity_filter(df, "text", "lang").collect()}
    assert got == {1: "abc Да", 2: "aש", 3: None, 4: "Да", 5: ""}
    literal = {r["row_id"]: r["text"] for r in S.purity_filter(df, "text", "lang", "literal").collect()}
    assert literal[1] == "abc Да" and literal[4] == ""
