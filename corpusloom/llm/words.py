"""Words of a text and vectorised hashing of bags of words.

A word is a run of non-blank characters holding a letter or digit, without the punctuation at its ends; case and
Unicode form are ignored. A bag is hashed as a *set* of tokens (word, k-th occurrence), so that the Jaccard
similarity of the token sets equals the multiset Jaccard similarity of the bags.
"""

from __future__ import annotations

import re
import sys
import unicodedata

import numpy as np
import xxhash


def _mark_class() -> str:
    """Combining marks as a character-class body; they belong to the word they end."""
    spans, start = [], None
    for cp in range(sys.maxunicode + 2):
        mark = cp <= sys.maxunicode and unicodedata.category(chr(cp))[0] == "M"
        if mark and start is None:
            start = cp
        elif not mark and start is not None:
            spans.append(f"{chr(start)}-{chr(cp - 1)}")
            start = None
    return "".join(spans)


MARKS = _mark_class()
WORD = re.compile(rf"[^\W_](?:\S*(?:[^\W_]|[{MARKS}]))?")
_CACHE_LIMIT = 400_000
_U = np.uint64


def words(text: str | None) -> list[str]:
    """Words in order; NULL, empty and blank texts have none."""
    if not text:
        return []
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return WORD.findall(text.casefold())


class Hasher:
    """Stable 64-bit hashes of words, remembered up to a bounded number."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def __call__(self, ws: list[str]) -> list[int]:
        known = self.known
        out = []
        for w in ws:
            h = known.get(w)
            if h is None:
                if len(known) >= _CACHE_LIMIT:
                    known.clear()
                h = known[w] = xxhash.xxh3_64_intdigest(w)
            out.append(h)
        return out


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values (multiply, fold, multiply)."""
    x = x * _U(0x9E3779B97F4A7C15)
    x ^= x >> _U(29)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


def bags(texts: list[str | None], hasher: Hasher) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, one after another, and the number of tokens of each.

    Within a text tokens come sorted by word hash; the k-th occurrence of a word is a token of its own.
    """
    flat: list[int] = []
    sizes = np.empty(len(texts), np.int64)
    for i, t in enumerate(texts):
        hs = hasher(words(t))
        sizes[i] = len(hs)
        flat.extend(hs)
    h = np.array(flat, _U)
    doc = np.repeat(np.arange(len(texts)), sizes)
    order = np.lexsort((h, doc))
    h = h[order]
    if not len(h):
        return h, sizes
    fresh = np.ones(len(h), bool)
    fresh[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.arange(len(h))
    occurrence = at - np.maximum.accumulate(np.where(fresh, at, 0))
    return mix(h + occurrence.astype(_U) * _U(0xA24BAED4963EE407)), sizes


def bag_keys(tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each non-empty bag as two int64 arrays; texts with the same bag share it. Empty bags get 0."""
    out = []
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    for salt in (0x632BE59BD9B4E019, 0xE7037ED1A0B428DB):
        k = np.zeros(len(sizes), _U)
        if len(starts):
            k[full] = np.add.reduceat(mix(tokens ^ _U(salt)), starts)
        out.append(k.view(np.int64))
    return out[0], out[1]


def parity_bits(tokens: np.ndarray, sizes: np.ndarray, width: int = 2) -> np.ndarray:
    """(n, width) words of 64 bits: each bit is the parity of the tokens that hash to it. Every token that two sets
    don't share changes one bit at most, so the Hamming distance never exceeds the size of the difference."""
    out = np.zeros((len(sizes), width), _U)
    full = sizes > 0
    starts = (np.cumsum(sizes) - sizes)[full]
    if len(starts):
        h = mix(tokens ^ _U(0x1B873593CC9E2D51))
        word = (h >> _U(6)) % _U(width)
        for k in range(width):
            out[full, k] = np.bitwise_xor.reduceat(np.where(word == k, _U(1) << (h & _U(63)), _U(0)), starts)
    return out.view(np.int64)


def as_int32(tokens: np.ndarray) -> np.ndarray:
    return (tokens >> _U(32)).astype(np.uint32).view(np.int32)
