"""Writing systems of texts and words, with Unicode script extensions.

The table of code point ranges comes from the ICU library that ships with Spark, read once a session on the driver;
executors look characters up in sorted arrays.
"""

from __future__ import annotations

import functools
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..runtime import small

#: Scripts that don't make a text's script; those that don't make a word's.
TEXT_NOISE = frozenset({"Zyyy", "Zinh", "Zzzz"})
WORD_NOISE = frozenset({"Zyyy"})
#: Languages written in several scripts.
MULTI_SCRIPT = {"jpn": ("Hani", "Hira", "Kana"), "kor": ("Hang", "Hani"), "srp": ("Latn", "Cyrl")}
#: Scripts that stand for several.
_COMPOUND = {"Jpan": ("Hani", "Hira", "Kana"), "Kore": ("Hang", "Hani"), "Hans": ("Hani",), "Hant": ("Hani",)}


class ScriptTable:
    """For each elementary range of code points the scripts it may belong to."""

    def __init__(self, ranges: dict[str, list[tuple[int, int]]]):
        cuts = sorted({0} | {a for r in ranges.values() for a, _ in r} | {b + 1 for r in ranges.values() for _, b in r})
        self.starts = np.array(cuts, np.int64)
        sets: list[set[str]] = [set() for _ in cuts]
        at = {c: k for k, c in enumerate(cuts)}
        for name, spans in sorted(ranges.items()):
            for a, b in spans:
                for k in range(at[a], at[b + 1]):
                    sets[k].add(name)
        kinds = sorted({tuple(sorted(s)) for s in sets})
        index = {k: i for i, k in enumerate(kinds)}
        self.kinds = kinds
        self.kind_of = np.array([index[tuple(sorted(s))] for s in sets], np.int64)
        self.names = sorted(ranges)

    def of(self, text: str) -> np.ndarray:
        """Kind of every code point."""
        cps = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        return self.kind_of[np.searchsorted(self.starts, cps, side="right") - 1]


def _java_ranges(spark: SparkSession, prop: str) -> dict[str, list[tuple[int, int]]]:
    jvm = spark._jvm
    prop_script = 0x100A
    ucharacter, choice = jvm.com.ibm.icu.lang.UCharacter, jvm.com.ibm.icu.lang.UProperty.NameChoice
    out = {}
    for value in range(ucharacter.getIntPropertyMinValue(prop_script), ucharacter.getIntPropertyMaxValue(prop_script) + 1):
        name = ucharacter.getPropertyValueName(prop_script, value, choice.SHORT)
        if name is None:
            continue
        chars = jvm.com.ibm.icu.text.UnicodeSet(f"[:{prop}={name}:]")
        # one call for the whole set, as its pattern
        spans = [(chars.getRangeStart(k), chars.getRangeEnd(k)) for k in range(chars.getRangeCount())]
        if spans:
            out[name] = spans
    return out


@functools.lru_cache(maxsize=4)
def _table(spark: SparkSession, extensions: bool) -> ScriptTable:
    return ScriptTable(_java_ranges(spark, "scx" if extensions else "sc"))


def table(spark: SparkSession, extensions: bool = True) -> ScriptTable:
    return _table(spark, extensions)


def dominant(t: ScriptTable, text: str | None) -> str:
    """The most frequent script of a text's code points, the first met among equals; `Unknown` without any."""
    if not text:
        return "Unknown"
    if text.isascii():
        return "Latn" if any(map(str.isalpha, text)) else "Unknown"
    kinds, first, n = np.unique(t.of(text), return_index=True, return_counts=True)
    counts: Counter = Counter()
    for k, c in sorted(zip(kinds.tolist(), n.tolist()), key=lambda x: first[kinds.tolist().index(x[0])]):
        for name in t.kinds[k]:
            if name not in TEXT_NOISE:
                counts[name] += c
    return counts.most_common(1)[0][0] if counts else "Unknown"


def counts(t: ScriptTable, texts: list[str | None]) -> tuple[np.ndarray, list[str]]:
    """(texts x scripts, scripts in order): code points of each script in each text, noise left out. All texts are looked
    up as one array of code points."""
    names = [n for n in t.names if n not in TEXT_NOISE]
    column = {n: i for i, n in enumerate(names)}
    belongs = np.zeros((len(t.kinds), len(names)), np.int64)
    for k, kind in enumerate(t.kinds):
        for n in kind:
            if n in column:
                belongs[k, column[n]] = 1
    sizes = np.array([len(x) if x else 0 for x in texts], np.int64)
    kinds = t.of("".join(x for x in texts if x))
    width = len(t.kinds)
    by_kind = np.bincount(np.repeat(np.arange(len(texts)), sizes) * width + kinds, minlength=len(texts) * width).reshape(-1, width)
    return by_kind @ belongs, names


def _batches(values: pd.Series, size: int = 2000):
    for s in range(0, len(values), size):
        yield values.iloc[s : s + size].tolist()


def _plain(value) -> str | None:
    return value if isinstance(value, str) else None


def dominant_script(spark: SparkSession, c: Column, extensions: bool = True) -> Column:
    """Script code of each text; NULL, empty and scriptless texts are `Unknown`."""
    shared = spark.sparkContext.broadcast(table(spark, extensions).__dict__)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        t = ScriptTable.__new__(ScriptTable)
        t.__dict__.update(shared.value)
        out: list[str] = []
        for texts in _batches(s):
            texts = [_plain(x) for x in texts]
            n, names = counts(t, texts)
            best = n.argmax(1)
            most = n[np.arange(len(n)), best]
            tied = (n == most[:, None]).sum(1) > 1
            # where scripts tie the first met counts, which the order in the text decides
            out += ["Unknown" if not m else dominant(t, x) if two else names[b] for x, b, m, two in zip(texts, best, most, tied)]
        return pd.Series(out, index=s.index, dtype=object)

    return run(c)


def script_histogram(spark: SparkSession, df: DataFrame, id_col: str, c: Column, extensions: bool = True) -> DataFrame:
    """`id, script, n`: code points of each script in each text, noise left out."""
    shared = spark.sparkContext.broadcast(table(spark, extensions).__dict__)

    @F.pandas_udf("array<struct<script:string,n:bigint>>")
    def run(s: pd.Series) -> pd.Series:
        t = ScriptTable.__new__(ScriptTable)
        t.__dict__.update(shared.value)
        out: list[list[dict]] = []
        for texts in _batches(s):
            n, names = counts(t, [_plain(x) for x in texts])
            out += [[{"script": names[k], "n": int(row[k])} for k in np.nonzero(row)[0]] for row in n]
        return pd.Series(out, index=s.index, dtype=object)

    rows = df.select(F.col(id_col).alias("id"), F.explode(run(c)).alias("x"))
    return rows.select("id", "x.script", "x.n")


def allowed_scripts(spark: SparkSession, langs: list[str], mode: str = "likely") -> dict[str, tuple[str, ...]]:
    """Scripts each language may be written in. `likely` takes the likely script of the locale data; `literal` only
    what a bare tag says, which is nothing but for the languages of several scripts."""
    out = {}
    locale = spark._jvm.com.ibm.icu.util.ULocale
    for lang in langs:
        if lang in MULTI_SCRIPT:
            out[lang] = MULTI_SCRIPT[lang]
        elif mode == "literal":
            out[lang] = ()
        else:
            script = locale.addLikelySubtags(locale(lang)).getScript() if lang.isascii() and lang.isalpha() else ""
            out[lang] = _COMPOUND.get(script, (script,) if script else ())
    return out


def purity_filter(df: DataFrame, text_col: str, lang_col: str, mode: str = "likely", limit: int = 100_000, keep_unknown: bool = False) -> DataFrame:
    """The text with only those words that hold a character of a script its language allows; NULL and empty texts stay.
    With `keep_unknown`, so do those of labels for which no script is known.

    The distinct labels are looked up on the driver; more than `limit` of them are refused.
    """
    spark = df.sparkSession
    langs = [r[0] for r in small(df.select(lang_col).where(F.col(lang_col).isNotNull()).distinct(), limit)]
    shared = spark.sparkContext.broadcast((table(spark).__dict__, allowed_scripts(spark, langs, mode)))

    @F.pandas_udf("string")
    def run(texts: pd.Series, labels: pd.Series) -> pd.Series:
        state, allowed = shared.value
        t = ScriptTable.__new__(ScriptTable)
        t.__dict__.update(state)
        sets = {k: frozenset(v) for k, v in allowed.items()}
        scripts: dict[str, frozenset] = {}

        def keep(text, lang):
            if not text:
                return text
            may = sets.get(lang, frozenset())
            if keep_unknown and not may:
                return text
            out = []
            for w in text.split():
                s = scripts.get(w)
                if s is None:
                    s = scripts[w] = frozenset(n for k in set(t.of(w).tolist()) for n in t.kinds[k] if n not in WORD_NOISE)
                if s & may:
                    out.append(w)
            return " ".join(out)

        return pd.Series([keep(a, b) for a, b in zip(texts, labels)], dtype=object)

    return df.withColumn(text_col, run(F.col(text_col), F.col(lang_col)))
