"""Cutting oversized texts at natural boundaries by recursive bisection, with overlaps attached afterwards.

A text over `limit` code points is cut at the strongest boundary near its midpoint; halves longer than `limit`
minus `overlap` are cut again, unless they hold no boundary and still fit the limit without a full overlap. Each
piece then repeats up to `overlap` code points from the end of the one before, starting at a boundary if there is
one. Only a run of more than `limit` code points without any boundary is cut hard, near its middle.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LIMIT, OVERLAP = 1500, 100
#: The characters that end a sentence.
ENDERS = ".!?…。！？।؟።"
#: Strength of a cut, from none to strongest.
HARD, BEFORE, BLANK, CLAUSE, SENTENCE, LINE, PARAGRAPH = range(7)
NAMES = ["hard", "word", "word", "clause", "sentence", "line", "paragraph"]
_SIGN = re.compile(rf"\s+|[{ENDERS}]+")
_CLOSERS = "\"'»”’)]}"


def boundaries(text: str) -> tuple[list[int], list[int]]:
    """Positions at which the text may be cut, ascending, and their strengths."""
    strength: dict[int, int] = {}

    def put(at: int, s: int) -> None:
        if 0 < at < len(text) and strength.get(at, 0) < s:
            strength[at] = s

    for m in _SIGN.finditer(text):
        s, e = m.span()
        run = m.group()
        if run.isspace():
            lines = run.count("\n")
            k = s - 1
            while k > 0 and text[k] in _CLOSERS:
                k -= 1
            before = text[k] if k >= 0 else ""
            kind = PARAGRAPH if lines > 1 else LINE if lines else SENTENCE if before in ENDERS and before else CLAUSE if before in ",;:،、，–—" and before else BLANK
            put(e, kind)
            if e - s > 1:  # a long run of blanks may itself be cut
                for at in range(s + 1, e):
                    put(at, BLANK)
        else:
            put(e, SENTENCE if run[0] in "。！？।؟።" else BEFORE)
            for at in range(s + 1, e):
                put(at, BEFORE)
        put(s, BEFORE)
    at = sorted(strength)
    return at, [strength[k] for k in at]


def cuts(text: str, limit: int = LIMIT, overlap: int = OVERLAP, at: list[int] | None = None, strength: list[int] | None = None) -> dict[int, int]:
    """Where the text is cut, with the strength of each cut; nowhere if it is within the limit."""
    if len(text) <= limit:
        return {}
    if at is None or strength is None:
        at, strength = boundaries(text)
    room = limit - overlap
    out: dict[int, int] = {}
    todo = [(0, len(text))]
    while todo:
        s, e = todo.pop()
        if e - s <= room:
            continue
        lo, hi = bisect.bisect_right(at, s), bisect.bisect_left(at, e)
        if lo == hi:
            if e - s <= limit:
                continue
            best, kind = (s + e) // 2, HARD
        else:
            mid, span = (s + e) / 2, e - s
            # the strongest in the middle third, the one nearest the midpoint among equals; else the nearest of all
            left, right = bisect.bisect_left(at, mid - span / 6, lo, hi), bisect.bisect_right(at, mid + span / 6, lo, hi)
            if left < right:
                k = max(range(left, right), key=lambda i: (strength[i], -abs(at[i] - mid)))
            else:
                k = min((i for i in (left - 1, left) if lo <= i < hi), key=lambda i: abs(at[i] - mid))
            best, kind = at[k], strength[k]
        out[best] = kind
        todo += [(s, best), (best, e)]
    return out


def split(text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> list[tuple[int, int, int, str]]:
    """`(start, body_start, end, cut)` of each piece: `text[start:end]`, of which `text[start:body_start]` repeats
    the end of the piece before; `cut` names the boundary at its end. A text within the limit is one piece."""
    if len(text) <= limit:
        return [(0, 0, len(text), "end")]
    at, strength = boundaries(text)
    found = cuts(text, limit, overlap, at, strength)
    ends = [*sorted(found), len(text)]
    out, body = [], 0
    for end in ends:
        start = body
        if body:
            start = max(body - overlap, end - limit, 0)
            k = bisect.bisect_left(at, start)
            if k < len(at) and at[k] < body:
                start = at[k]
            while start < body and text[start].isspace():
                start += 1
        out.append((start, body, end, NAMES[found[end]] if end in found else "end"))
        body = end
    return out


def _run(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows += [(i, k, s, b, e, cut, text[s:e]) for k, (s, b, e, cut) in enumerate(split(text, limit, overlap))]
            columns = list(zip(*rows)) or [[]] * 7
            kinds = [batch.column(0).type, pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=["id", "piece", "start", "body_start", "end", "cut", "text"])

    return run


def pieces(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP, only_long: bool = True) -> DataFrame:
    """`id, piece, start, body_start, end, cut, text` of the pieces; joining `text` from `body_start` on gives the
    text back. NULL texts have none; with `only_long` texts within the limit have none either, else one."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    if only_long:
        rows = rows.where(F.length("text") > limit)
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(_run(limit, overlap), f"id {id_type}, piece int, start int, body_start int, end int, cut string, text string")


def _judge(limit: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [cuts(t, limit, overlap) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([HARD in c.values() for c in found], pa.bool_()), pa.array([len(c) + 1 for c in found], pa.int64())], names=["id", "hard", "n"])

    return run


def oversized(df: DataFrame, id_col: str, text_col: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """`id, cut, pieces`: each text over the limit, `hard` if one of its cuts isn't at a boundary, else `soft`.

    Ids repeat where the input's do; each row's pieces are counted with those of its id. Texts are cut as in `pieces`,
    but only the kind of the cuts leaves the task."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be less than limit")
    rows = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where(F.length("text") > limit)
    judged = rows.mapInArrow(_judge(limit, overlap), f"id {rows.schema['id'].dataType.simpleString()}, hard boolean, n long")
    return judged.groupBy("id").agg(F.when(F.max("hard"), "hard").otherwise("soft").alias("cut"), F.sum("n").alias("pieces"))
