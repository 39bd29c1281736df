"""Test items leaking into a corpus: template windows, hash-joined, then checked slot by slot.

Words are canonicalised to templates: numbers, units and names become typed placeholders, where a name is any word
outside the vocabulary that the test set uses in several items. Every window of WINDOW template words of the items is
hashed; the corpus streams past this index, whose size depends on the test set only. A matching window counts as an
anchor if its slots agree but for one; anchors grow into passages word by word. A document whose windows match an
item's template throughout, with slots filled consistently by other values, is reported as re-parameterised.
"""

from __future__ import annotations

import functools
import html
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import small
from .words import mix, words

#: Template words in a window, plain words it must have, slots that may differ.
WINDOW, PLAIN, FREE = 6, 3, 1
#: Words of the shorter windows, compared word for word, that find passages with an edit in every long window.
SHORT = 4
#: Words of a passage; share of the item's words that passages must make up; share of its windows for a re-parameterised one.
PASSAGE, SHARE, TEMPLATE_SHARE = 8, 0.5, 0.8
#: A word in so many different items belongs to the template vocabulary.
SHARED_BY = 3
#: Items in one index; more are searched for in several blocks.
MAX_ITEMS = 100_000
#: Words read as units of measure.
UNITS = frozenset("% ° °c °f $ € £ ¥ mm cm dm m km mg g kg t ml cl l s sec min h hz khz mhz ghz w kw mw v a ha mi ft in lb oz mph kmh km/h m/s usd eur".split())
_NAME, _NUMBER, _UNIT = 1, 2, 3
_FIRST = 4
_MARKUP = re.compile(r"<[^<>]{1,300}>|\]\([^()\s]*\)|\\[a-zA-Z]+\*?|[{}\[\]*_`~|\"“”„«»‹›]")
_U = np.uint64


def plain_words(text: str | None) -> list[str]:
    """Words without markup and quote marks."""
    if not text:
        return []
    if "&" in text:
        text = html.unescape(text)
    return words(_MARKUP.sub(" ", text))


class Index:
    """Windows of the items. `items` are (id, text); the index is as large as the test set."""

    def __init__(self, items: list[tuple[int, str | None]], common: set[str] = frozenset()):
        self.ids = [i for i, t in items]
        texts = [plain_words(t) for _, t in items]
        used = Counter(w for t in set(map(tuple, texts)) for w in set(t))
        self.word_id: dict[str, int] = {}
        kind = [0] * _FIRST
        for t in texts:
            for w in t:
                if w not in self.word_id:
                    self.word_id[w] = len(kind)
                    if w in UNITS:
                        kind.append(_UNIT)
                    elif any(c.isdigit() for c in w):
                        kind.append(_NUMBER)
                    else:
                        kind.append(len(kind) if w in common or used[w] >= SHARED_BY else _NAME)
        kind[_NAME], kind[_NUMBER], kind[_UNIT] = _NAME, _NUMBER, _UNIT
        self.kind = np.array(kind, np.int64)
        self.words = [np.array([self.word_id[w] for w in t], np.int64) for t in texts]
        flat = np.concatenate([*self.words, np.zeros(0, np.int64)])
        sizes = np.array([len(w) for w in self.words], np.int64)
        self.flat, self.starts, self.sizes = flat, np.cumsum(sizes) - sizes, sizes
        self.posts = {size: self._posts(*self.windows(flat, sizes, size)) for size in (WINDOW, SHORT)}

    def _posts(self, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """(hashes, bounds of their places, item and position of each place) in order of hashes."""
        item = np.repeat(np.arange(len(self.sizes)), self.sizes)[at]
        order = np.argsort(hashes, kind="stable")
        unique, first = np.unique(hashes[order], return_index=True)
        return unique, np.append(first, len(order)), item[order], (at - self.starts[item])[order]

    def encode(self, ws: list[str]) -> list[int]:
        known = self.word_id
        return [known.get(w) or (_NUMBER if w[0].isdigit() else _UNIT if w in UNITS else _NAME) for w in ws]

    def windows(self, exact: np.ndarray, sizes: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """Hash and position of every window inside one text. A short one, and one of few plain words, is hashed word for
        word; short ones must hold a name, number or unit of the items and no word foreign to them."""
        n = len(exact) - size + 1
        if n <= 0:
            return np.zeros(0, _U), np.zeros(0, np.int64)
        text = np.repeat(np.arange(len(sizes)), sizes)
        at = np.nonzero(text[:n] == text[size - 1 :])[0]
        plain = self.kind[exact]
        if size == WINDOW:
            is_plain = np.concatenate([[0], np.cumsum(plain >= _FIRST)])
            typed = is_plain[at + WINDOW] - is_plain[at] >= PLAIN
        else:
            # words unknown to the items can't match, and windows of template words alone say little
            known, telling = exact >= _FIRST, (exact >= _FIRST) & (plain < _FIRST)
            at = at[functools.reduce(np.logical_or, [telling[at + k] for k in range(size)])]
            at = at[functools.reduce(np.logical_and, [known[at + k] for k in range(size)])]
            typed = np.zeros(len(at), bool)
        a, b = mix(plain.astype(_U) + _U(1)), mix(exact.astype(_U) + _U(0x51ED27))
        h = np.zeros(len(at), _U)
        for k in range(size):
            h = h * _U(0x9E3779B97F4A7C15 | 1) + np.where(typed, a[at + k], b[at + k])
        return mix(h), at

    def matches(self, exact: np.ndarray, sizes: np.ndarray, size: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(position, item, position in the item) of all windows equal to one of an item's."""
        known, bounds, post_item, post_at = self.posts[size]
        hashes, at = self.windows(exact, sizes, size)
        if not len(known) or not len(hashes):
            return (np.zeros(0, np.int64),) * 3
        k = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = np.nonzero(known[k] == hashes)[0]
        k, at = k[hit], at[hit]
        n = bounds[k + 1] - bounds[k]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        post = np.repeat(bounds[k], n) + within
        return np.repeat(at, n), post_item[post], post_at[post]

    def short(self, exact: np.ndarray, sizes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """(position, text, item, position in the item) of all short windows."""
        at, item, there = self.matches(exact, sizes, SHORT)
        return at, np.searchsorted(starts, at, side="right") - 1 if len(at) else at, item, there


_STEPS = [(1, 1), (0, 1), (1, 0), (2, 2), (1, 2), (2, 1)]


def _grow(item: list[int], doc: list[int], i: int, j: int, step: int, found: list[tuple[int, int]]) -> None:
    """Follow equal words from (i, j) in one direction, past single words changed, missing or added."""
    ni, nj = len(item), len(doc)
    while 0 <= i < ni and 0 <= j < nj:
        if item[i] == doc[j]:
            found.append((i, j))
            i, j = i + step, j + step
            continue
        for di, dj in _STEPS:
            a, b = i + di * step, j + dj * step
            if 0 <= a < ni and 0 <= b < nj and item[a] == doc[b]:
                c, d = a + step, b + step
                if not (0 <= c < ni and 0 <= d < nj) or item[c] == doc[d]:
                    i, j = a, b
                    break
        else:
            return


def passages(item: list[int], doc: list[int], anchors: list[tuple[int, int]], size: int = WINDOW) -> tuple[set[int], int]:
    """Positions of the item that passages in the document hold, and the number of passages."""
    covered: set[int] = set()
    seen: set[tuple[int, int]] = set()
    count = 0
    for i, j in anchors:
        if any((i + k, j + k) in seen for k in range(size)):
            continue
        found: list[tuple[int, int]] = []
        k = next((k for k in range(size) if item[i + k] == doc[j + k]), None)
        if k is None:
            continue
        _grow(item, doc, i + k, j + k, 1, found)
        _grow(item, doc, i + k - 1, j + k - 1, -1, found)
        seen.update(found)
        if len(found) >= PASSAGE:
            covered.update(a for a, _ in found)
            count += 1
    return covered, count


def _consistent(item: np.ndarray, doc: np.ndarray) -> bool:
    """One value for each slot value, in both directions."""
    there, back = {}, {}
    for a, b in zip(item.tolist(), doc.tolist()):
        if there.setdefault(a, b) != b or (b >= _FIRST and back.setdefault(b, a) != a):
            return False
    return True


def _scan(shared, share: float, template_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = cloudpickle.loads(shared.value)
        items = [w.tolist() for w in index.words]
        for batch in batches:
            ids = batch.column(0).to_pylist()
            coded = [index.encode(plain_words(t)) for t in batch.column(1).to_pylist()]
            sizes = np.array([len(c) for c in coded], np.int64)
            exact = np.array([x for c in coded for x in c], np.int64)
            starts = np.cumsum(sizes) - sizes
            at, item, there = index.matches(exact, sizes)
            doc = np.searchsorted(starts, at, side="right") - 1 if len(at) else at
            source = index.starts[item] + there
            agree = np.zeros(len(at), np.int64)
            for k in range(WINDOW):
                agree += exact[at + k] == index.flat[source + k]
            rows: dict[tuple[int, int], list] = {}
            anchor = agree >= WINDOW - FREE
            for size, d_at, d_doc, d_item, d_there in ((WINDOW, at[anchor], doc[anchor], item[anchor], there[anchor]), (SHORT, *index.short(exact, sizes, starts))):
                pair = d_doc * len(items) + d_item
                order = np.lexsort((d_at, pair))
                pair, a_at, a_there = pair[order], (d_at - starts[d_doc])[order], d_there[order]
                firsts = np.nonzero(np.diff(pair, prepend=-1))[0]
                # an anchor covers at most its own words and gaps of a passage hold no more than as many again
                enough = np.diff(np.append(firsts, len(pair))) * 2 * size >= share * index.sizes[pair[firsts] % max(1, len(items))] if len(pair) else []
                lasts = np.append(firsts[1:], len(pair))
                for s, e in zip(firsts[enough].tolist(), lasts[enough].tolist()) if len(pair) else ():
                    d, i = divmod(int(pair[s]), len(items))
                    if (d, i) in rows:
                        continue
                    covered, n = passages(items[i], coded[d], list(zip(a_there[s:e].tolist(), a_at[s:e].tolist())), size)
                    if covered and len(covered) >= share * len(items[i]):
                        rows[d, i] = [len(covered), n, "verbatim" if len(covered) == len(items[i]) else "altered"]
            # whole templates with other values: windows of one item on one diagonal
            line = (doc * len(items) + item) * (1 << 32) + (at - starts[doc] - there + (1 << 31)) if len(at) else at
            lines, n = np.unique(line, return_counts=True)
            for v, k in zip(lines.tolist(), n.tolist()):
                (d, i), shift = divmod(v >> 32, len(items)), (v & 0xFFFFFFFF) - (1 << 31)
                size = len(items[i])
                if (d, i) in rows or size < WINDOW or k < template_share * (size - WINDOW + 1):
                    continue
                lo, hi = max(0, -shift), min(size, len(coded[d]) - shift)
                a, b = index.words[i][lo:hi], np.array(coded[d][lo + shift : hi + shift])
                same = index.kind[a] == index.kind[b]
                slot = same & (index.kind[a] < _FIRST)
                if same.sum() >= template_share * size and _consistent(a[slot], b[slot]):
                    rows[d, i] = [int((a == b).sum()), 1, "re-parameterised"]
            out = [(ids[d], index.ids[i], n, len(items[i]), p, kind) for (d, i), (n, p, kind) in rows.items()]
            columns = list(zip(*out)) or [[]] * 6
            kinds = [batch.column(0).type, pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["id", "item_id", "words", "item_words", "passages", "kind"])

    return run


def leaks(df: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text_col: str, common: DataFrame | None = None, share: float = SHARE, template_share: float = TEMPLATE_SHARE) -> DataFrame:
    """`id, item_id, words, item_words, passages, kind` of each document and item leaking into it.

    `kind` is verbatim (every word of the item), altered (passages with at least `share` of its words) or
    re-parameterised. NULL and empty texts and items match nothing; items with the same words are all listed; a
    repeated row is reported as often as it occurs. `common` may add words (column `word`) to the template vocabulary.
    """
    spark = df.sparkSession
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
    plain = {w for r in small(common.select("word").distinct()) if r[0] for w in words(r[0])} if common is not None else set()
    texts = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    schema = f"id {texts.schema['id'].dataType.simpleString()}, item_id long, words int, item_words int, passages int, kind string"
    # a test set of any size is searched for in blocks whose index has a bounded size
    blocks = max(1, -(-wanted.count() // MAX_ITEMS))
    out = None
    for b in range(blocks):
        rows = small(wanted.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else wanted, 2 * MAX_ITEMS)
        shared = spark.sparkContext.broadcast(cloudpickle.dumps(Index([(r[0], r[1]) for r in rows if r[0] is not None], plain)))
        found = texts.mapInArrow(_scan(shared, share, template_share), schema)
        out = found if out is None else out.unionByName(found)
    return out
