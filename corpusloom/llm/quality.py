"""Per-document text quality statistics, and the structural profile nearest to a document.

Two passes of different cost: `basic_stats` stays in Spark's own functions; `profiles` describes a document by
distributions (function words of its language with a class for the rest, character classes, shapes of lines, gaps
between signs, plausibility and freshness of words) and takes the structural profile with the least Jensen-Shannon
divergence over all of them.

Profiles are fitted, not set: for each language its trusted texts are laid out as prose in several ways, its words as
lists and tables, and its sentences garbled or repeated as junk; a profile is the mean of the distributions of a few
such exemplars. `LAYOUTS` says how exemplars are made; it is the only place where a kind is described.
"""

from __future__ import annotations

import random
import re
import unicodedata
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import small
from .words import words

#: Largest tables of reference texts and of frequent words that are accepted.
MAX_SAMPLES, MAX_WORDS = 20_000, 100_000
ENDERS = ".!?…。！？।؟።"
_BLANK = r"[\s\x{1c}-\x{1f}\x{85}\p{Z}]"
#: Distributions a document is described by, with their number of classes, and how much each counts. Whether words are
#: plausible and new tells junk from all else alone, so these weigh more.
BLOCKS = {"chars": (12, 1.0), "length": (6, 1.0), "cells": (4, 1.0), "end": (3, 1.0), "lead": (4, 1.0), "gap": (5, 1.0), "plausible": (8, 1.5), "fresh": (3, 1.5)}
#: Exemplars of each profile and language.
EXEMPLARS = 5
_SLICES: dict[str, slice] = {}
for _name, (_n, _) in BLOCKS.items():
    _start = sum(x.stop - x.start for x in _SLICES.values())
    _SLICES[_name] = slice(_start, _start + _n)
_SIZE = sum(n for n, _ in BLOCKS.values())
_BULLET = re.compile(r"\s*(?:[-*+•·–—▪◦‣]|\(?\d{1,4}[.)]|\(?[^\W\d_][.)])\s+")
_KEY = re.compile(r"[^\s:=]+(?: [^\s:=]+){0,2}\s*(?:[:=]| [–—-])\s+\S")
_CELLS = re.compile(r"\t|\s*\|+\s*|\s{2,}|[;,](?=\S)|[;,]$")
_GAP = re.compile(rf"[,;:、،·\n{ENDERS}|\t]+|\s{{2,}}")
_NUMBER = re.compile(r"[^\w]*[+-]?\d[\d.,:%/]*[^\w]*")
_INSIDE = re.compile(r"[^\W\d_]+[^\w\s'’.\-‐·:/&@]+[^\W\d_]|[^\W\d_][_~][^\W\d_]")


def basic_stats(df: DataFrame, id_col: str, text_col: str, lang: Column, common: DataFrame) -> DataFrame:
    """`id, word_count, mean_word_length, symbol_ratio, line_end_share, common_share`.

    Words are runs of non-blank characters; symbols are characters that are neither letters, marks, digits nor
    blanks, relative to the non-blank ones; lines are the non-blank ones; common words are those of the document's
    `lang` in the table `common(lang, word)`, compared in lower case without punctuation at the ends. Ratios of empty
    and blank texts are 0; those of NULL texts are NULL, with a word count of 0.
    """
    rows = small(common.select("lang", "word").where("lang is not null and word is not null").distinct(), MAX_WORDS)
    by: dict[str, list[str]] = defaultdict(list)
    for r in sorted(rows):
        by[r[0]].append(r[1].lower())
    t = F.col(text_col)
    tokens = F.filter(F.split(t, rf"{_BLANK}+"), lambda w: w != "")
    plain = F.transform("tokens", lambda w: F.regexp_replace(F.lower(w), r"^[^\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}]+$", ""))
    lines = F.filter(F.split(t, "\n"), lambda x: F.regexp_like(x, F.lit(rf"[^{_BLANK[1:]}")))
    solid = F.regexp_count(t, F.lit(rf"[^{_BLANK[1:]}"))
    symbols = F.regexp_count(t, F.lit(rf"[^\p{{L}}\p{{M}}\p{{N}}{_BLANK[1:]}"))
    share = lambda a, b: F.round(F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0)), 6)
    # one row per language, so the join neither multiplies rows nor grows with the corpus
    sets = df.sparkSession.createDataFrame(list(by.items()), "common_lang string, common array<string>")
    base = df.select(F.col(id_col).alias("id"), lang.alias("doc_lang"), t.alias("_t"), tokens.alias("tokens"), lines.alias("lines"), solid.alias("solid"), symbols.alias("symbols"))
    base = base.withColumn("plain", plain).join(F.broadcast(sets), F.col("doc_lang") == F.col("common_lang"), "left")
    n = F.size("tokens")
    hits = F.when(F.col("common").isNull(), F.lit(0)).otherwise(F.size(F.filter("plain", lambda w: F.array_contains(F.col("common"), w))))
    ending = F.size(F.filter("lines", lambda x: F.regexp_like(x, F.lit(rf"[{ENDERS}]{_BLANK}*$"))))
    null = F.col("_t").isNull()
    keep = lambda c: F.when(~null, c)
    return base.select(
        "id", F.when(null, F.lit(0)).otherwise(n).cast("long").alias("word_count"), keep(share(F.col("solid"), n)).alias("mean_word_length"), keep(share(F.col("symbols"), F.col("solid"))).alias("symbol_ratio"),
        keep(share(ending, F.size("lines"))).alias("line_end_share"), keep(share(hits, n)).alias("common_share"),
    )


def _class_of(c: str) -> int:
    """Class of a character: letter, mark, digit, blank, line end, ender, punctuation, symbol, other, cell sign, comma,
    capital."""
    if c == "\n":
        return 4
    if c in "\t|;":
        return 9
    if c.isspace():
        return 3
    if c in ENDERS:
        return 5
    if c in ",、،":
        return 10
    k = unicodedata.category(c)
    return 11 if k == "Lu" else {"L": 0, "M": 1, "N": 2, "P": 6, "S": 7, "Z": 3}.get(k[0], 8)


def _entropy(p: np.ndarray) -> np.ndarray:
    return -(p * np.log2(np.where(p > 0, p, 1.0))).sum(-1)


def jsd(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Jensen-Shannon divergence (base 2) of distributions along the last axis."""
    return np.maximum(0.0, _entropy((p + q) / 2) - (_entropy(p) + _entropy(q)) / 2)


def _half(p: float, q: float) -> float:
    """What one class of shares p and q adds to the divergence."""
    m = (p + q) / 2
    return ((p * log2(p / m) if p > 0 else 0.0) + (q * log2(q / m) if q > 0 else 0.0)) / 2


class _Maker:
    """Parts that exemplars of a language are put together from."""

    def __init__(self, rng: random.Random, texts: list[str]):
        self.rng = rng
        self.types = sorted({w.strip(ENDERS + ",;:\"«»()") for t in texts for w in t.split()} - {""})
        self.sentences = [s.strip() for t in texts for s in re.split(rf"(?<=[{ENDERS}])\s*", t) if len(s.strip()) > 8] or ["a"]
        if not self.types or sum(map(len, self.types)) > 14 * len(self.types):  # no blanks between words
            whole = "".join(texts) or "a"
            self.types = sorted({whole[i : i + n] for i in range(0, len(whole), 5) for n in (2, 3, 4, 6)})

    def pick(self, options):
        return self.rng.choice(options)

    def word(self) -> str:
        """A word of the language, or one made of two halves, as names and rare words are."""
        w = self.pick(self.types)
        if self.rng.random() < 0.35:
            x = self.pick(self.types)
            w = w[: max(1, len(w) // 2)] + x[len(x) // 2 :]
            w = w.capitalize() if self.rng.random() < 0.6 else w
        return w

    def phrase(self, low: int = 1, high: int = 4) -> str:
        return " ".join(self.word() for _ in range(self.rng.randint(low, high)))

    def prose(self, n: int = 9) -> list[str]:
        out = []
        for _ in range(n):
            ws = self.pick(self.sentences).split(" ")
            out.append(" ".join(self.word() if len(ws) > 3 and self.rng.random() < 0.12 else w for w in ws))
        return out

    def plain(self, sep: str) -> str:
        return re.sub(rf"[{ENDERS},;:]", "", sep.join(self.prose()))

    def wrapped(self, width: int) -> str:
        lines = [""]
        for w in " ".join(self.prose()).split(" "):
            if len(lines[-1]) + len(w) > width:
                lines.append(w)
            else:
                lines[-1] = f"{lines[-1]} {w}".strip()
        return "\n".join(lines)

    def entries(self, make: Callable[[int], str], n: int = 20) -> str:
        """Entries, at times after a sentence that leads up to them."""
        return "\n".join([*(self.prose(1) if self.rng.random() < 0.4 else []), *(make(i) for i in range(1, n))])

    def number(self) -> str:
        return self.pick((f"{self.rng.uniform(100, 9999):.1f}", f"{self.rng.uniform(100, 9999):.2f}", str(self.rng.randint(1, 9999))))

    def table(self, sep: str, numbers: float) -> str:
        n = self.rng.randint(3, 5)
        return self.entries(lambda i: sep.join(self.number() if i > 1 and self.rng.random() < numbers else self.word() for _ in range(n)), 16)

    def string(self, alphabet: str, low: int, high: int) -> str:
        return "".join(self.pick(alphabet) for _ in range(self.rng.randint(low, high)))

    def garbled(self, change: Callable[[str], str]) -> str:
        return " ".join(change(w) for w in " ".join(self.prose()).split())


def _tables(sep: str):
    return {f"table/{sep!r}": lambda m: m.table(sep, 0.6), f"table/{sep!r} of words": lambda m: m.table(sep, 0.25)}


#: How exemplars of each profile are laid out. What stands before the slash is the kind.
LAYOUTS: dict[str, Callable[[_Maker], str]] = {
    "prose/plain": lambda m: " ".join(m.prose()),
    "prose/paragraphs": lambda m: "\n\n".join(" ".join(m.prose(3)) for _ in range(3)),
    "prose/sentence a line": lambda m: "\n".join(m.prose()),
    "prose/wrapped": lambda m: m.wrapped(40),
    "prose/narrow": lambda m: m.wrapped(28),
    "prose/unpunctuated": lambda m: m.plain(" "),
    "prose/unpunctuated lines": lambda m: m.plain("\n"),
    "prose/capitals": lambda m: " ".join(m.prose()).upper(),
    "prose/wide blanks": lambda m: " ".join(m.prose()).replace(" ", "  "),
    "prose/dialogue": lambda m: "\n".join("- " + s for s in m.prose()),
    "list/bullets": lambda m: m.entries(lambda i: "- " + m.phrase()),
    "list/numbered": lambda m: m.entries(lambda i: f"{i}. {m.phrase()}"),
    "list/lettered": lambda m: m.entries(lambda i: f"({chr(96 + i)}) {m.phrase()};"),
    "list/bare": lambda m: m.entries(lambda i: m.phrase()),
    "list/glossary": lambda m: m.entries(lambda i: f"{m.word()}: {m.phrase(1, 5)}"),
    "list/glossary with dashes": lambda m: m.entries(lambda i: f"{m.word()} – {m.phrase(1, 5)}"),
    "list/enumeration": lambda m: m.entries(lambda i: ", ".join(m.phrase(1, 2) for _ in range(60)), 2),
    "list/index": lambda m: m.entries(lambda i: f"{m.phrase(1, 2)}, {m.rng.randint(1, 300)}"),
    **{k: v for sep in ("\t", " | ", "|", " || ", ";", ",", "   ", "        ") for k, v in _tables(sep).items()},
    "junk/symbols": lambda m: "".join(m.pick("#$%&*+/:;<=>@[]^_{}|~!?\\-") * m.rng.randint(1, 6) + (" " if m.rng.random() < 0.05 else "") for _ in range(120)),
    "junk/encoded": lambda m: m.string("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 400, 400),
    "junk/random letters": lambda m: " ".join(m.string("bcdfghjklmnpqrstvwxz", 3, 11) for _ in range(70)),
    "junk/digits": lambda m: " ".join(m.string("0123456789", 1, 8) for _ in range(70)),
    "junk/hexadecimal": lambda m: " ".join(m.string("0123456789abcdef", 8, 8) for _ in range(60)),
    "junk/log": lambda m: "\n".join(f"{m.string('ABCDERW', 3, 3)} 0x{m.string('0123456789abcdef', 8, 8)} [{m.rng.randint(1, 99)}:{m.rng.randint(1, 99)}] fn_{m.rng.randint(1, 99)}()={m.rng.randint(-9, 9)}" for _ in range(14)),
    "junk/wrong encoding": lambda m: "".join(m.pick("ÃÂ€¢™¶¿\ufffdÐ±Ñ") if m.rng.random() < 0.35 else c for c in " ".join(m.prose())),
    "junk/shuffled": lambda m: m.garbled(lambda w: "".join(m.rng.sample(w, len(w)))),
    "junk/reversed": lambda m: m.garbled(lambda w: w[::-1]),
    "junk/reversed and spaced": lambda m: m.garbled(lambda w: m.pick("_~").join(w[::-1]) if m.rng.random() < 0.5 else w[::-1]),
    "junk/repeated line": lambda m: "\n".join([m.phrase(3, 6)] * 25),
    "junk/repeated sentence": lambda m: " ".join(m.prose(1) * 14),
    "junk/repeated words": lambda m: " ".join([m.phrase(1, 2)] * 60),
    "junk/repeated few words": lambda m: " ".join(map(m.pick, [[m.word() for _ in range(9)]] * 150)),
    "junk/repeated signs": lambda m: m.string("#$%&*+/:;<=>@[]^_{}|~!?\\-", 4, 20) * 20,
    "junk/repeated character": lambda m: m.pick("abcxe.-=") * 400,
}
PROFILES = list(LAYOUTS)
KINDS = ("prose", "list", "table", "junk")
_KIND = np.array([KINDS.index(p.split("/")[0]) for p in PROFILES])
#: Function words of a profile: as in prose, as among different words of the language, none, or whatever was repeated.
_WORDING = np.array([3 if "repeated" in p else {"prose": 0, "junk": 2}.get(p.split("/")[0], 1) for p in PROFILES])


class Reference:
    """Profiles of languages, from trusted texts and frequent words."""

    def __init__(self, samples: list[tuple[str, str]], common: list[tuple[str, str]]):
        self.langs_of: dict[str, list[str]] = defaultdict(list)
        for lang, w in sorted(set(common)):
            for x in words(w):
                self.langs_of[x].append(lang)
        self.grams: set[str] = set()
        self.script_of: dict[str, set[str]] = defaultdict(set)
        self.class_of: dict[str, int] = {}
        self.seen: dict[str, int] = {}
        by: dict[str, list[str]] = defaultdict(list)
        for lang, text in samples:
            by[lang].append(text)
        own = {lang: [w for t in texts for w in words(t)] for lang, texts in by.items()}
        for lang, ws in own.items():
            for w in set(ws):
                x = f" {w} "
                self.grams.update(x[i : i + 3] for i in range(len(x) - 2))
                self.grams.update(x[i : i + 2] for i in range(len(x) - 1))
                for c in w:
                    self.script_of[c].add(lang)
        self.function: dict[str, dict[str, float]] = {}
        self.flat: dict[str, float] = {}
        self.known_share: dict[str, float] = {}
        self.profiles: dict[str | None, np.ndarray] = {}
        for lang, ws in sorted(own.items()):
            n, count = max(1, len(ws)), Counter(w for w in ws if lang in self.langs_of.get(w, ()))
            self.function[lang] = {w: c / n for w, c in count.items()}
            self.known_share[lang] = sum(count.values()) / n
            # the share of each function word where all different words are equally frequent
            self.flat[lang] = 1 / max(1, len(set(ws)))
            maker = _Maker(random.Random(lang), by[lang])
            self.profiles[lang] = np.array([np.mean([self.describe(make(maker))[0] for _ in range(EXEMPLARS)], 0) for make in LAYOUTS.values()])
        self.profiles[None] = np.mean(list(self.profiles.values()), 0) if self.profiles else np.full((len(PROFILES), _SIZE), 0.0)

    def odd(self, word: str) -> int:
        """How few of a word's runs of three, then of two letters occur in trusted prose of any language."""
        p = self.seen.get(word)
        if p is None:
            x = f" {word} "
            n = len(x) - 2
            three = sum(x[i : i + 3] in self.grams for i in range(n)) / n
            if three >= 0.5:
                p = 0 if three >= 0.75 else 1
            else:
                two = sum(x[i : i + 2] in self.grams for i in range(n + 1)) / (n + 1)
                p = 2 if two >= 0.85 else 3 if two >= 0.4 else 4
            if len(self.seen) > 300_000:
                self.seen.clear()
            self.seen[word] = p
        return p

    def language(self, bag: Counter, text: str) -> str | None:
        """The language with most frequent words in the bag; without any, the one with most characters of the text."""
        votes: Counter = Counter()
        for w in bag.keys() & self.langs_of.keys():
            for lang in self.langs_of[w]:
                votes[lang] += bag[w]
        if not votes:
            for c, n in Counter(text).items():
                for lang in self.script_of.get(c.casefold(), ()):
                    votes[lang] += n
        return max(votes.items(), key=lambda x: (x[1], x[0]))[0] if votes else None

    def describe(self, text: str) -> tuple[np.ndarray, Counter]:
        """The distributions of BLOCKS, one after another, and the bag of words."""
        v = [0.0] * _SIZE
        at = _SLICES["chars"].start
        known = self.class_of
        for c, n in Counter(text).items():
            if c not in known:
                known[c] = _class_of(c)
            v[at + known[c]] += n
        length, cells, end, lead = (_SLICES[b].start for b in ("length", "cells", "end", "lead"))
        for line in text.split("\n"):
            line = line.strip()
            size = len(line)
            if not size:
                continue
            v[length + (0 if size < 12 else 1 if size < 25 else 2 if size < 45 else 3 if size < 80 else 4 if size < 160 else 5)] += size
            parts = len(_CELLS.split(line)) if "," in line or "  " in line or "|" in line or "\t" in line or ";" in line else 1
            v[cells + min(parts, 4) - 1] += size
            last = line[-2] if size > 1 and line[-1] in "\"'»”)’" else line[-1]
            v[end + (0 if last in ENDERS else 1 if last.isalnum() or known.get(last) == 1 else 2)] += size
            v[lead + (1 if _BULLET.match(line) else 2 if _KEY.match(line) else 3 if line[0].isdigit() else 0)] += size
        at = _SLICES["gap"].start
        for part in _GAP.split(text):
            part = part.strip()
            if part:
                n = part.count(" ") + 1
                if n < 3:  # words may not be spaced
                    n = max(n, len(part) / 7)
                v[at + (0 if n <= 2 else 1 if n <= 4 else 2 if n <= 7 else 3 if n <= 14 else 4)] += len(part)
        ws = words(text)
        bag = Counter(ws)
        at, odd, plain = _SLICES["plausible"].start, self.odd, self.seen
        for w, n in bag.items():
            k = plain.get(w)
            if k is None:
                if len(w) < 41 and w.isalpha():
                    k = odd(w)
                elif len(w) >= 41 and w.isascii():
                    k = plain[w] = 6
                elif any(map(str.isdigit, w)):
                    k = plain[w] = 5 if _NUMBER.fullmatch(w) else 7
                elif _INSIDE.search(w):
                    k = plain[w] = 7
                else:
                    k = odd(w)
            v[at + k] += n * len(w)
        tokens = ws if len(ws) * 14 >= len(text) else [text[i : i + 3] for i in range(0, len(text), 3)]
        n, three = len(tokens), max(0, len(tokens) - 2)
        again = three - len(set(zip(tokens, tokens[1:], tokens[2:])))
        at = _SLICES["fresh"].start
        v[at : at + 3] = [len(set(tokens)), max(0, n - len(set(tokens)) - again), again]
        v = np.array(v)
        for part in _SLICES.values():
            total = v[part].sum()
            if total:
                v[part] /= total
        return v, bag

    def wording(self, bag: Counter, lang: str | None) -> tuple[float, float, float]:
        """Divergence of the bag's function words from those of prose, of different words, and of none."""
        function = self.function.get(lang)
        n = sum(bag.values())
        if not function or not n:
            return 1.0, 1.0, 1.0
        own = [(bag[w] / n, function[w]) for w in bag.keys() & function.keys()]
        shared, flat = sum(p for p, _ in own), self.flat[lang]
        rest, whole = 1 - shared, self.known_share[lang]
        # words that only the profile has add half their share each
        prose = sum(_half(p, q) for p, q in own) + _half(rest, 1 - whole) + (whole - sum(q for _, q in own)) / 2
        different = sum(_half(p, flat) for p, _ in own) + _half(rest, max(0.0, 1 - flat * len(function))) + flat * (len(function) - len(own)) / 2
        return max(0.0, prose), max(0.0, different), max(0.0, shared / 2 + _half(rest, 1.0))

    def profile(self, texts: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray, np.ndarray]:
        """(languages, number of the nearest profile, divergence from the nearest of each kind, from prose by wording)."""
        described = [self.describe(t) for t in texts]
        langs = [self.language(bag, t) for (_, bag), t in zip(described, texts)]
        wording = np.array([self.wording(bag, lang) for (_, bag), lang in zip(described, langs)]).reshape(-1, 3)
        v = np.array([x for x, _ in described]).reshape(-1, _SIZE)
        total = np.concatenate([wording, wording.mean(1, keepdims=True)], 1)[:, _WORDING]
        groups: dict[str | None, list[int]] = defaultdict(list)
        for i, lang in enumerate(langs):
            groups[lang if lang in self.profiles else None].append(i)
        for lang, rows in groups.items():
            for name, (_, weight) in BLOCKS.items():
                p, q = v[rows][:, _SLICES[name]], self.profiles[lang][:, _SLICES[name]]
                total[rows] += weight * jsd(p[:, None], q[None])
        by_kind = np.stack([total[:, _KIND == k].min(1) for k in range(len(KINDS))], 1) if len(texts) else np.zeros((0, len(KINDS)))
        return langs, total.argmin(1), by_kind, wording[:, 0]


_SCHEMA = "kind string, profile string, lang string, function_jsd double, " + ", ".join(f"{k}_jsd double" for k in KINDS)


def _run(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reference: Reference = cloudpickle.loads(shared.value)
        for batch in batches:
            for s in range(0, batch.num_rows, 500):
                part = batch.slice(s, 500)
                langs, best, by_kind, wording = reference.profile(part.column(1).to_pylist())
                columns = [pa.array([KINDS[_KIND[k]] for k in best], pa.string()), pa.array([PROFILES[k] for k in best], pa.string()), pa.array(langs, pa.string()), pa.array(np.round(wording, 6))]
                columns += [pa.array(np.round(by_kind[:, k], 6)) for k in range(len(KINDS))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["id", *(c.split()[0] for c in _SCHEMA.split(", "))])

    return run


def profiles(df: DataFrame, id_col: str, text_col: str, samples: DataFrame, common: DataFrame) -> DataFrame:
    """`id, kind` (prose, list, table or junk), the nearest `profile`, the `lang` compared with, `function_jsd` from its
    prose, and the divergence from the nearest profile of each kind.

    NULL texts and texts without a visible character have no row. `samples(lang, text)` and `common(lang, word)` are
    tables of fixed size.
    """
    trusted = small(samples.select("lang", "text").where("lang is not null and text is not null"), MAX_SAMPLES)
    frequent = small(common.select("lang", "word").where("lang is not null and word is not null"), MAX_WORDS)
    trusted.sort()
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(Reference([tuple(r) for r in trusted], [tuple(r) for r in frequent])))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.regexp_like("text", F.lit(rf"[^{_BLANK[1:]}")))
    return rows.mapInArrow(_run(shared), f"id {rows.schema['id'].dataType.simpleString()}, {_SCHEMA}")
