"""Repeated word windows: passages across line ends and inside longer lines.

A window is ``size`` consecutive words of a text (lower case, A-Z), whatever lines they stand
on. Every window that occurs twice or more is found, and every occurrence but the first, by
document id and position, is removed; windows that follow each other in the same way make one
span, so a span reaches to the true ends of the match.

Not every window is sent. Of the runs of ``size`` // 2 words in a window the one with the least
hash is its anchor; equal windows have equal anchors, and a text has about one anchor in
size / 4 words. Anchors that occur once are dropped by an aggregation, and only windows of
the others are hashed whole and grouped (by anchor and window, 128 bits).

Windows that touch a removed line take no part. Where an occurrence overlaps its own first, the
words of the first stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.rows import sieve
from tristar.session import write_stage

_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_inverses = np.ones(1, np.uint64)


def _inverse_powers(n: int) -> np.ndarray:
    global _inverses
    if len(_inverses) < n:
        p = np.full(max(n, 2 * len(_inverses)), _INVERSE, np.uint64)
        p[0] = 1
        _inverses = np.multiply.accumulate(p)
    return _inverses[:n]


def run_hash(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` values, by differences of prefix sums."""
    n = len(h)
    if n < size:
        return np.zeros(0, np.uint64)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * tg.powers(n)[:n], dtype=np.uint64)])
    return tg.mix((total[size:] - total[:-size]) * _inverse_powers(n - size + 1) + np.uint64(size))


def windows(h: np.ndarray, off: np.ndarray, size: int):
    """Windows inside one text: (first word, word its anchor starts at), and the hashes of all
    runs an anchor can be."""
    gram = max(size // 2, 1)
    g = run_hash(h, gram)
    if len(h) < size:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), g
    best, have, want = np.arange(len(g)), 1, size - gram + 1
    while have < want:   # leftmost least run of twice as many places, or of the last step
        step = min(have, want - have)
        a, b = best[:len(best) - step], best[step:]
        best = np.where(g[b] < g[a], b, a)
        have += step
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    start = np.flatnonzero(text[:len(h) - size + 1] == text[size - 1:])
    return start, best[start], g


def _words(data: np.ndarray, off: np.ndarray):
    low = tg.LOWER[data]
    w = tg.words(low, off)
    return w, tg.span_hash(low, w.start, w.end)


def _anchors(batches, size: int):
    for b in batches:
        for i, _, data, off in tg.blocks(b.column("text")):
            w, h = _words(data, off)
            _, anchor, g = windows(h, w.off, size)
            anchor = np.unique(anchor)
            text = w.text[anchor]
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(pa.array(text + i)), pa.array((anchor - w.off[text]).astype(np.int32)),
                 pa.array(g[anchor].view(np.int64))], names=["row", "at", "gram"])


def _windows(batches, size: int):
    """Windows with a wanted anchor and without a word on a removed line."""
    for b in batches:
        cut, at = b.column("cut"), b.column("at")
        for i, j, data, off in tg.blocks(b.column("text")):
            w, h = _words(data, off)
            start, anchor, g = windows(h, w.off, size)
            ln = tg.lines(data, off)
            line = np.searchsorted(ln.start, w.start, "right") - 1
            wanted, gone = np.zeros(len(h), bool), np.zeros(len(ln.start), bool)
            for k in range(i, j):
                wanted[w.off[k - i] + np.array(at[k].as_py(), np.int64)] = True
                gone[ln.off[k - i] + np.array(cut[k].as_py() or [], np.int64)] = True
            lost = np.concatenate([[0], np.cumsum(gone[line])])
            ok = wanted[anchor] & (lost[start + size] == lost[start])
            start, anchor = start[ok], anchor[ok]
            text = w.text[start]
            rows = pa.array(text + i)
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(rows), b.column("doc_id").take(rows),
                 pa.array((start - w.off[text]).astype(np.int32)),
                 pa.array((line[start] - ln.off[text]).astype(np.int32)),
                 pa.array(g[anchor].view(np.int64)), pa.array(run_hash(h, size)[start].view(np.int64))],
                names=["row", "doc_id", "start", "line", "gram", "window"])


def _spans(batches, size: int):
    """Windows of a text that follow each other and their first occurrences, put together."""
    names = ["row", "doc_id", "line", "start_word", "end_word", "first_row", "first_doc_id",
             "first_word", "class_size", "removed"]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
             pa.int64(), pa.int64(), pa.bool_()]
    for b in batches:
        out: list = [[] for _ in names]
        for row, doc, found in zip(b.column("row").to_pylist(), b.column("doc_id").to_pylist(),
                                   b.column("found")):
            start, line, first_row, first_doc, first, n = found.values.flatten()
            order = np.argsort(start.to_numpy(), kind="stable")
            start, line, first_row, first, n = (x.to_numpy()[order].astype(np.int64) for x in (
                start, line, first_row, first, n))
            removed = (first_row != row) | (first != start)
            # A text that repeats itself without a gap is one span; words of the first window stay.
            itself = removed & (first_row == row) & (first + size > start)
            new = np.ones(len(start), bool)
            new[1:] = (np.diff(start) != 1) | (np.diff(first_row) != 0) | (
                (np.diff(first) != 1) & ~(itself[1:] & itself[:-1]))
            at = np.flatnonzero(new)
            end = start[np.append(at[1:], len(start)) - 1] + size
            begin = np.where(itself[at], first[at] + size, start[at])
            where = np.minimum(np.searchsorted(start, begin), len(start) - 1)
            where = np.where(start[where] == begin, where, at)
            most = np.maximum.reduceat(n, at)
            docs = first_doc.take(pa.array(order[at])).to_pylist()
            for k, p in enumerate(at.tolist()):
                if begin[k] < end[k]:
                    for x, v in zip(out, (row, doc, int(line[where[k]]), int(begin[k]), int(end[k]),
                                          int(first_row[p]), docs[k], int(first[p]),
                                          int(most[k]), bool(removed[p]))):
                        x.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, kinds)], names=names)


def repeated_spans(docs: DataFrame, cut: DataFrame, size: int) -> DataFrame:
    """Every span with a like: row, doc_id, line (of its first word), start_word, end_word,
    first_row, first_doc_id, first_word, class_size and removed. ``docs``: row, doc_id, text;
    ``cut``: (row, line) of lines that are removed anyway."""
    anchors = write_stage(docs.select("row", "text").mapInArrow(
        lambda it: _anchors(it, size), "row long, at int, gram long"), "span-anchors")
    shared = anchors.groupBy("gram").agg(F.count("*").alias("n")).filter("n > 1").select("gram")
    wanted = write_stage(anchors.join(shared, "gram").groupBy("row").agg(
        F.collect_list("at").alias("at")), "span-wanted")
    lines = cut.groupBy("row").agg(F.collect_set("line").alias("cut"))
    found = write_stage(
        sieve(docs, "row", wanted.select("row")).join(wanted, "row").join(lines, "row", "left")
        .select("row", "doc_id", "text", "at", "cut")
        .mapInArrow(lambda it: _windows(it, size), "row long, doc_id long, start int, line int, "
                                                   "gram long, window long"), "span-windows")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "start")
    first = (found.groupBy("gram", "window").agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .filter("n > 1"))
    by_row = (found.join(first, ["gram", "window"]).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.collect_list(F.struct(
            "start", "line", F.col("first.row").alias("first_row"),
            F.col("first.doc_id").alias("first_doc"), F.col("first.start").alias("first"), "n"))
        .alias("found")))
    return write_stage(by_row.mapInArrow(
        lambda it: _spans(it, size),
        "row long, doc_id long, line long, start_word long, end_word long, first_row long, "
        "first_doc_id long, first_word long, class_size long, removed boolean"), "spans")


def without(text: str, lines: list[int], spans: list[tuple[int, int]]) -> str:
    """The text without whole lines and without spans of words; a line left empty goes too."""
    data = text.encode()
    buf, off = np.frombuffer(data, np.uint8), np.array([0, len(data)])
    w, ln = tg.words(buf, off), tg.lines(buf, off)
    gone = np.zeros(len(w.start) + 1, np.int64)
    for a, z in spans:
        gone[a] += 1
        gone[z] -= 1
    gone = np.cumsum(gone)[:-1] > 0
    base, stop = np.searchsorted(w.start, ln.start), np.searchsorted(w.start, ln.end)
    out, drop = [], set(lines)
    for k, (a, z) in enumerate(zip(ln.start.tolist(), ln.end.tolist())):
        i, j = int(base[k]), int(stop[k])
        if k in drop or (j > i and gone[i:j].all()):
            continue
        if not gone[i:j].any():
            out.append(data[a:z])
            continue
        kept, at = [], a
        for p in range(i, j):
            if gone[p]:
                if p == i or not gone[p - 1]:
                    kept.append(data[at:int(w.start[p])])
                at = int(w.start[p + 1]) if p + 1 < j else z
        out.append((b"".join(kept) + data[at:z]).rstrip(b" \t\r") if gone[j - 1]
                   else b"".join(kept) + data[at:z])
    return b"\n".join(out).decode()
