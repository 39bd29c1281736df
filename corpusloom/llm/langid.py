"""Languages of documents and of their single-language stretches, by string kernels.

A text is the set of its words, a word the set of its character n-grams of one to four letters with its ends marked: a
blended-spectrum presence kernel, convolved over the different words and normalised by the number of n-grams. Kernel
ridge regression, one language against the rest, is fitted in the Nystroem space of landmark texts. Its dual folds into
one weight vector per n-gram, hence per word, so a batch is scored by the product of two matrices: which stretch has
which word, and the words' weights.
"""

from __future__ import annotations

import html
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..runtime import small
from .words import mix

#: Largest n-gram; landmarks a language; ridge.
N_MAX, LANDMARKS, RIDGE = 4, 16, 0.02
#: Most labelled texts used for fitting, and letters of a language that make it count.
TRAIN_ROWS, LETTERS = 20_000, 40
#: Words of a stretch of a sentence over LONG words, which may be unpunctuated text; evidence a second language needs.
STRETCH, LONG, EVIDENCE = 10, 28, 0.2
_U = np.uint64
_ENDS = ".!?…。！？।؟።"
# few ranges, as \w comes first and blanks try them all: marks of Latin, Hebrew, Arabic and Indic scripts
_TOKEN = re.compile(rf"[\w\u0300-\u036f\u0591-\u05bd\u0610-\u061a\u064b-\u065f\u0900-\u0963\u0966-\u0dff]+|[{_ENDS}\n|;«»„“”\"]")
_DROP = re.compile(r"(?is)<(script|style|code|pre)\b.*?</\1\s*>|```.*?```|<!--.*?-->|\\begin\{tabular\}.*?\\end\{tabular\}|<[/!]?[a-z][^<>]*>|\{\{[^{}]*\}\}|\\[a-z]+\*?|https?://\S+|\]\([^()\s]*\)|\[\[\w+:[^\[\]]*\]\]|`[^`\n]*`|[!-~]{40,}")
_MARKUP = re.compile(r"[<\\`{\[]|https?:|[!-~]{40}")
_DIGITS = re.compile(r"[\d_]+")
_CACHE = 150_000
#: Stretches in a block of the matrix product.
_BLOCK = 256


def _tokens(text: str) -> list[str]:
    if "&" in text:
        text = html.unescape(text)
    if _MARKUP.search(text):
        text = _DROP.sub("\n", text)
    if not text.isascii() and not unicodedata.is_normalized("NFC", text):
        text = unicodedata.normalize("NFC", text)
    return _TOKEN.findall(_DIGITS.sub(" ", text.lower()))


_SPACE = re.compile(r"&[#\w]{1,31};")


def _located(text: str) -> list[tuple[str, int, int]]:
    """Tokens with their places in the NFC form of the text; what isn't language is blanked, not removed."""
    text = unicodedata.normalize("NFC", text)
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    low = _SPACE.sub(lambda m: " " * len(m.group()), low)
    low = _DROP.sub(lambda m: "\n" + " " * (len(m.group()) - 1), low)
    return [(m.group(), m.start(), m.end()) for m in _TOKEN.finditer(re.sub(r"[\d_]", " ", low))]


def _grams(ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word, n-gram hash) of every distinct n-gram of every word."""
    joined = " " + " ".join(ws) + " "
    cps = np.frombuffer(joined.encode("utf-32-le"), np.uint32).astype(_U)
    blank = cps == _U(32)
    word = np.cumsum(blank) - 1  # the blank before a word belongs to it
    out_w, out_h = [], []
    h = np.zeros(len(cps), _U)
    m = mix(cps + _U(1))
    for n in range(1, N_MAX + 1):
        h = h[: len(cps) - n + 1] * _U(0x100000001B3) + m[n - 1 :]
        size = len(h)
        inner = np.zeros(size, bool)
        # inside one word with its two end blanks: no blank strictly inside the n-gram
        if n > 2:
            c = np.concatenate([[0], np.cumsum(blank)])
            inner = (c[n - 1 : n - 1 + size] - c[1 : 1 + size]) > 0
        keep = ~inner & ~(blank[:size] & blank[n - 1 : n - 1 + size])
        at = np.nonzero(keep)[0]
        out_w.append(word[at])
        out_h.append(mix(h[at] + _U(n)))
    w, g = np.concatenate(out_w), np.concatenate(out_h)
    order = np.lexsort((g, w))
    w, g = w[order], g[order]
    fresh = np.ones(len(w), bool)
    fresh[1:] = (w[1:] != w[:-1]) | (g[1:] != g[:-1])
    return w[fresh], g[fresh]


class Model:
    """Weights of n-grams by language."""

    def __init__(self, langs: list[str], grams: np.ndarray, weights: np.ndarray):
        self.langs, self.grams, self.weights = langs, grams, weights

    def word_vectors(self, ws: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Added weights and number of n-grams of each word."""
        w, g = _grams(ws)
        k = np.minimum(np.searchsorted(self.grams, g), len(self.grams) - 1)
        known = self.grams[k] == g
        out = np.zeros((len(ws), len(self.langs)), np.float32)
        w_known = w[known]
        if len(w_known):
            at = np.nonzero(np.diff(w_known, prepend=-1))[0]
            out[w_known[at]] = np.add.reduceat(self.weights[k[known]], at)
        return out, np.bincount(w, minlength=len(ws)).astype(np.float32)


def grams_of(text: str) -> np.ndarray:
    """N-grams of each different word of a text, one word after another."""
    ws = sorted({w for w in _tokens(text) if w[0].isalpha()})
    return _grams(ws)[1] if ws else np.zeros(0, _U)


def landmarks(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, features): a column for each landmark, its n-grams' counts over words divided by their number."""
    vocabulary = np.unique(np.concatenate(rows))
    z = np.zeros((len(vocabulary), len(rows)), np.float32)
    for c, g in enumerate(rows):
        np.add.at(z[:, c], np.searchsorted(vocabulary, g), 1.0 / max(1, len(g)))
    return vocabulary, z


def kernel(rows: list[np.ndarray], vocabulary: np.ndarray, z: np.ndarray) -> np.ndarray:
    """Kernel of texts, given by their n-grams, and landmarks."""
    out = np.zeros((len(rows), z.shape[1]))
    for i, g in enumerate(rows):
        k = np.minimum(np.searchsorted(vocabulary, g), len(vocabulary) - 1)
        out[i] = z[k[vocabulary[k] == g]].sum(0) / max(1, len(g))
    return out


def fit(texts: list[str], labels: list[str], seed: int = 3) -> Model:
    """Nystroem kernel ridge regression, one against the rest, of sentences' labels."""
    langs = sorted(set(labels))
    parts: list[tuple[str, int]] = []
    for t, lang in zip(texts, labels):
        for s in re.split(rf"(?<=[{_ENDS}])\s*", t):
            if sum(map(str.isalpha, s)) >= 15:
                parts.append((s, langs.index(lang)))
    y_of = np.array([y for _, y in parts])
    rows = [grams_of(s) for s, _ in parts]
    rng = np.random.default_rng(seed)
    chosen = np.concatenate([rng.permutation(np.nonzero(y_of == k)[0])[:LANDMARKS] for k in range(len(langs))])
    vocabulary, z = landmarks([rows[i] for i in chosen])
    k_nm, k_mm = kernel(rows, vocabulary, z), (z.T @ z).astype(np.float64)
    scale = np.mean(np.diag(k_mm)) if len(chosen) else 1.0
    k_nm, k_mm = k_nm / scale, k_mm / scale
    y = np.zeros((len(parts), len(langs)))
    y[np.arange(len(parts)), y_of] = 1
    # every language weighs the same, however many sentences it has
    weight = 1 / np.bincount(y_of, minlength=len(langs))[y_of] * len(parts) / len(langs)
    left = (k_nm * weight[:, None]).T
    alpha = np.linalg.solve(left @ k_nm / len(parts) + RIDGE * 1e-3 * (k_mm + 1e-3 * np.eye(len(chosen))), left @ y / len(parts))
    return Model(langs, vocabulary, (z @ alpha / scale).astype(np.float32))


def _products(table: np.ndarray, rows: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """For each of `n` rows the sum of the table's vectors of its different ids, as products of a block of rows' incidence
    matrix with the vectors of the ids in the block. `rows` ascend."""
    out = np.zeros((n, table.shape[1]), np.float32)
    edges = np.searchsorted(rows, np.arange(0, n + _BLOCK, _BLOCK))
    for k, (s, e) in enumerate(zip(edges, edges[1:])):
        if s < e:
            own, column = np.unique(ids[s:e], return_inverse=True)
            incidence = np.zeros((min(_BLOCK, n - k * _BLOCK), len(own)), np.float32)
            incidence[rows[s:e] - k * _BLOCK, column] = 1.0
            out[k * _BLOCK : k * _BLOCK + len(incidence)] = incidence @ table[own]
    return out


class Scorer:
    """Scores texts by sentences, remembering the vectors of words up to a bound."""

    def __init__(self, model: Model):
        self.model = model
        self.reset()

    def reset(self) -> None:
        self.known: dict[str, int] = {}
        self.table = np.zeros((1 << 14, len(self.model.langs) + 1), np.float32)
        self.letters = np.zeros(1 << 14, np.int32)
        self.used = 1  # entry 0 is the sentence end

    def _learn(self, ws: list[str]) -> None:
        need = self.used + len(ws)
        while need > len(self.letters):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
            self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
        for s in range(0, len(ws), 4096):
            part = ws[s : s + 4096]
            at = slice(self.used, self.used + len(part))
            self.table[at, :-1], self.table[at, -1] = self.model.word_vectors(part)
            self.letters[at] = [sum(map(str.isalpha, w)) for w in part]
            self.known.update(zip(part, range(self.used, self.used + len(part))))
            self.used += len(part)

    def _score(self, tokens: list[list[str]]):
        """(text, added weights, n-grams, letters, first word) of each stretch; words are counted over all texts."""
        if self.used > _CACHE:
            self.reset()
        known = self.known
        ends = _ENDS + "\n|;«»„“”\""
        for e in ends:
            known[e] = 0
        new = {w for t in tokens for w in t if w not in known}
        if new:
            self._learn(sorted(new))
        sizes = np.array([len(t) for t in tokens], np.int64)
        ids = np.array([known[w] for t in tokens for w in t], np.int64)
        doc = np.repeat(np.arange(len(tokens)), sizes)
        end = ids == 0
        sentence = np.cumsum(end) + doc  # a new text starts a new sentence, too
        keep = ~end
        ids, doc, sentence = ids[keep], doc[keep], sentence[keep]
        if not len(ids):
            return doc, np.zeros((0, len(self.model.langs)), np.float32), np.zeros(0, np.float32), np.zeros(0, np.int64), doc
        first = np.nonzero(np.diff(sentence, prepend=-1))[0]
        n = np.diff(np.append(first, len(ids)))
        index = np.arange(len(ids)) - np.repeat(first, n)
        chunks = np.where(n > LONG, (n + STRETCH // 2) // STRETCH, 1)
        chunk = np.where(np.repeat(chunks, n) > 1, np.minimum(index // STRETCH, np.repeat(chunks, n) - 1), 0)
        starts = np.nonzero((np.diff(sentence, prepend=-1) != 0) | (np.diff(chunk, prepend=0) != 0))[0]
        row = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(ids))))
        # the last column of the table is the number of n-grams
        both = _products(self.table, row, ids, len(starts))
        return doc[starts], both[:, :-1], both[:, -1], np.add.reduceat(self.letters[ids].astype(np.int64), starts), starts

    def stretches(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, added weights, n-grams, letters) of each stretch: a sentence, or STRETCH words of a long one."""
        return self._score([_tokens(t) for t in texts])[:4]

    @staticmethod
    def _label(n: int, doc: np.ndarray, v: np.ndarray, g: np.ndarray, evidence: float) -> np.ndarray:
        """Language of each stretch: its best one if that leads enough, else the main one of its text."""
        total = np.zeros((n, v.shape[1]), np.float32)
        if len(doc):
            at = np.nonzero(np.diff(doc, prepend=-1))[0]
            total[doc[at]] = np.add.reduceat(v, at)
        main = total.argmax(1)[doc]
        best = v.argmax(1) if len(doc) else doc
        rows = np.arange(len(doc))
        lead = v[rows, best] - v[rows, main]
        return np.where((best != main) & (lead > evidence * g), best, main)

    def segments(self, texts: list[str], evidence: float = EVIDENCE) -> list[tuple[int, int, int, int, str, int, float]]:
        """(text, number, start, end, language, letters, confidence) of each run of stretches in one language; the
        places are those of the first and last word in the NFC form of the text."""
        located = [_located(t) for t in texts]
        doc, v, g, l, starts = self._score([[w for w, _, _ in t] for t in located])
        if not len(doc):
            return []
        spans = np.array([(a, b) for t in located for w, a, b in t if self.known[w]], np.int64)
        label = self._label(len(texts), doc, v, g, evidence)
        ends = np.append(starts[1:], len(spans)) - 1
        cut = np.nonzero((np.diff(doc, prepend=-1) != 0) | (np.diff(label, prepend=-1) != 0))[0]
        last = np.append(cut[1:], len(doc)) - 1
        sums, grams, letters = np.add.reduceat(v, cut), np.add.reduceat(g, cut), np.add.reduceat(l, cut)
        out, number, before = [], 0, -1
        for k, (i, j) in enumerate(zip(cut.tolist(), last.tolist())):
            number = number + 1 if doc[i] == before else 0
            before = doc[i]
            own = sums[k, label[i]]
            sure = 0.5 + (own - np.delete(sums[k], label[i]).max(initial=0.0)) / max(1.0, grams[k]) / 0.5
            out.append((int(doc[i]), number, int(spans[starts[i], 0]), int(spans[ends[j], 1]), self.model.langs[label[i]], int(letters[k]), float(np.clip(sure, 0, 1))))
        return out

    def languages(self, texts: list[str], letters: int = LETTERS, evidence: float = EVIDENCE):
        """(text, language, letters, confidence) of the languages of each text, the main one first."""
        doc, v, g, l = self.stretches(texts)
        n, k = len(texts), len(self.model.langs)
        rows = np.arange(len(doc))
        label = self._label(n, doc, v, g, evidence)
        key = doc * k + label
        keys, inverse = np.unique(key, return_inverse=True)
        by_letters, by_grams, by_score = (np.bincount(inverse, x, len(keys)) for x in (l, g, v[rows, label]))
        others = v.copy()
        others[rows, label] = -np.inf
        by_second = np.bincount(inverse, others.max(1) if len(doc) else [], len(keys))
        keep = by_letters >= letters
        confidence = np.clip(0.5 + (by_score - by_second) / np.maximum(1, by_grams) / 0.5, 0, 1)
        return keys[keep] // k, keys[keep] % k, by_letters[keep].astype(np.int64), confidence[keep]


def train(samples: DataFrame, lang_col: str = "lang", text_col: str = "text", limit: int = TRAIN_ROWS) -> Model:
    """Fit on trusted texts: a table of fixed size, of which at most `limit` rows are accepted."""
    rows = small(samples.select(lang_col, text_col).where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()), limit)
    rows.sort(key=lambda r: (r[0], r[1]))
    return fit([r[1] for r in rows], [r[0] for r in rows])


def _run(shared, letters: int, evidence: float, wrong_only: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(cloudpickle.loads(shared.value))
        langs = np.array(scorer.model.langs, dtype=object)
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                doc, lang, size, sure = scorer.languages(part.column(2).to_pylist(), letters, evidence)
                found = langs[lang]
                if wrong_only:
                    label = np.array(part.column(1).to_pylist(), dtype=object)[doc]
                    keep = (np.bincount(doc, minlength=part.num_rows)[doc] > 1) | (found != label)
                    doc, found, size, sure = doc[keep], found[keep], size[keep], sure[keep]
                at = pa.array(doc)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(at), part.column(1).take(at), pa.array(found.tolist(), pa.string()), pa.array(size, pa.int64()), pa.array(np.round(sure, 6), pa.float64())], names=["id", "label", "found_lang", "letters", "confidence"]
                )

    return run


def _apply(model: Model, df: DataFrame, id_col: str, text_col: str, label: Column | None, letters: int, evidence: float, wrong_only: bool) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    rows = df.select(F.col(id_col).alias("id"), (F.lit(None) if label is None else label).cast("string").alias("label"), F.col(text_col).alias("text")).where(F.length("text") >= letters)
    return rows.mapInArrow(_run(shared, letters, evidence, wrong_only), f"id {rows.schema['id'].dataType.simpleString()}, label string, found_lang string, letters long, confidence double")


def found(model: Model, df: DataFrame, id_col: str, text_col: str, label: Column | None = None, letters: int = LETTERS, evidence: float = EVIDENCE) -> DataFrame:
    """`id, label, found_lang, letters, confidence`: one row per language with at least `letters` letters of text.

    `letters` adds up the stretches of that language in the text, `label` is carried along. NULL, empty and wordless
    texts, and those with fewer letters, have no row; repeated rows are answered each.
    """
    return _apply(model, df, id_col, text_col, label, letters, evidence, False)


def mislabelled(model: Model, df: DataFrame, id_col: str, text_col: str, label: Column, letters: int = LETTERS, evidence: float = EVIDENCE) -> DataFrame:
    """The rows of `found` whose text has several languages, or one that the label, NULL included, doesn't read as."""
    return _apply(model, df, id_col, text_col, label, letters, evidence, True)


def _run_segments(shared, evidence: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(cloudpickle.loads(shared.value))
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                rows = scorer.segments(part.column(1).to_pylist(), evidence)
                doc, number, start, end, lang, size, sure = list(zip(*rows)) or [()] * 7
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(list(doc), pa.int64())), *(pa.array(list(c), t) for c, t in zip((number, start, end, lang, size, sure), (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.float64())))],
                    names=["id", "segment", "start", "end", "found_lang", "letters", "confidence"],
                )

    return run


def segments(model: Model, df: DataFrame, id_col: str, text_col: str, evidence: float = EVIDENCE) -> DataFrame:
    """`id, segment, start, end, found_lang, letters, confidence`: each single-language stretch of each text, numbered
    from 0, with its place in code points of the text's NFC form. NULL, empty and wordless texts have no row."""
    shared = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(model))
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > 0)
    return rows.mapInArrow(_run_segments(shared, evidence), f"id {rows.schema['id'].dataType.simpleString()}, segment int, start int, end int, found_lang string, letters long, confidence double")
