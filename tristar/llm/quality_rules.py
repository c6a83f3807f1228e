"""Quality rules: hashed word and character n-gram logistic regression.

A document is described by the share of each hashed word and of each hashed sequence of 3 and
of 5 characters (code points) among all of its own. A logistic regression over these shares is trained on
labelled rows (at most ``sample`` per class, lowest id hashes first; class weights restore
the labels' proportions), calibrated by Platt scaling on a fifth of the sample that the
fit does not see, and applied in Arrow batches against a fixed threshold. Because a
score is a mean of weights over a text's words and sequences, scoring is one table lookup
per character and works on whole texts of any length. The fit sees ``2 * sample`` rows
of ``DIMS`` single-precision numbers, 52 MB with the defaults however long the texts are.

Defined results: null and empty texts have no words, all counts 0, ``base_failed`` true.
With no labelled row of one of the classes there is no model and only the base rule
decides. Repeated rows each get their own result. Only ``doc_id`` and ``text`` of the
documents and ``doc_id`` and ``quality`` of the labels are read, so extra columns with
any names do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.linear import Dense, fit, platt, sigmoid
from tristar.session import write_stage

BITS = 12                 # hashed columns per feature family
DIMS = 2 << BITS          # words, then character sequences
NGRAMS = (3, 5)
SCALE = 30.0              # share -> feature value
THRESHOLD = 0.5           # fixed: a document is kept at this probability or more
SAMPLE = 800              # labelled rows per class at most

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True

RESULT = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, "
          "n_repeat_words long, base_failed boolean, kept boolean, probability double")


def hashed_columns(data: np.ndarray, off: np.ndarray, w: tg.Words,
                   word_hash: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """(column of each occurrence, offsets per text) for words, then for each n."""
    out = [((word_hash >> np.uint64(64 - BITS)).astype(np.int64), w.off)]
    char, coff = tg.characters(data, off)
    size = np.diff(coff)
    for n in NGRAMS:
        m = np.maximum(size - n + 1, 0)
        goff = np.concatenate([[0], np.cumsum(m)])
        at = np.arange(int(goff[-1])) + np.repeat(coff[:-1] - goff[:-1], m)
        key = np.full(len(at), n, np.uint64)
        for j in range(n):
            key = key * np.uint64(0xD6E8FEB86659FD93) + char[at + j]
        out.append(((tg.mix(key) >> np.uint64(64 - BITS)).astype(np.int64) + (1 << BITS), goff))
    return out


def _features(texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Sparse feature row of each text."""
    rows = []
    for _, _, data, off in tg.blocks(texts):
        w = tg.words(data, off)
        parts = hashed_columns(data, off, w, tg.span_hash(data, w.start, w.end))
        chars = np.maximum(sum(np.diff(p[1]) for p in parts[1:]), 1)
        for i in range(len(off) - 1):
            c = np.concatenate([cols[o[i]:o[i + 1]] for cols, o in parts])
            col, n = np.unique(c, return_counts=True)
            share = n / np.where(col < (1 << BITS), max(w.off[i + 1] - w.off[i], 1), chars[i])
            rows.append((col, SCALE * share))
    return rows


def _mean_weights(parts, weights: np.ndarray) -> np.ndarray:
    total = np.zeros(len(parts[0][1]) - 1)
    chars = np.maximum(sum(np.diff(o) for _, o in parts[1:]), 1)
    for k, (cols, o) in enumerate(parts):
        c = np.concatenate([[0.0], np.cumsum(weights[cols], dtype=np.float64)])
        total += (c[o[1:]] - c[o[:-1]]) / (chars if k else np.maximum(np.diff(o), 1))
    return SCALE * total


def repeat_words(word_hash: np.ndarray, off: np.ndarray, k: int = 3) -> np.ndarray:
    """Per text: words inside k-word windows that occur twice or more in that text."""
    n = len(word_hash)
    covered = np.zeros(n, bool)
    if n >= k:
        win = word_hash[:n - k + 1].copy()
        for j in range(1, k):
            win = tg.mix(win) + word_hash[j:n - k + 1 + j]
        text = np.repeat(np.arange(len(off) - 1), np.diff(off))
        at = np.flatnonzero(text[:n - k + 1] == text[k - 1:])
        key = tg.mix(win[at] ^ tg.mix(text[at].astype(np.uint64)))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        dup = np.zeros(len(at), bool)
        dup[order[1:][same]] = True
        dup[order[:-1][same]] = True
        for j in range(k):
            covered[at[dup] + j] = True
    return tg.per_text(covered, off)


def duplicate_lines(data: np.ndarray, off: np.ndarray, w: tg.Words) -> np.ndarray:
    """Per text: lines with a word that equal an earlier line of the text."""
    ln = tg.lines(data, off)
    h = tg.span_hash(data, ln.start, ln.end)
    n_words = np.searchsorted(w.start, ln.end) - np.searchsorted(w.start, ln.start)
    text, full = ln.text, n_words > 0
    key = tg.mix(h[full] ^ tg.mix(text[full].astype(np.uint64)))
    _, first = np.unique(key, return_index=True)
    again = np.ones(len(key), np.int64)
    again[first] = 0
    return np.bincount(text[full], again, len(off) - 1).astype(np.int64)


def _score(texts: pa.Array, model) -> pa.StructArray:
    cols: dict[str, list] = {k.split()[0]: [] for k in RESULT.split(", ")}
    for _, _, data, off in tg.blocks(texts):
        w = tg.words(data, off)
        h = tg.span_hash(data, w.start, w.end)
        n = np.diff(w.off)
        lead = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        chars = lead[w.end] - lead[w.start]
        rep = repeat_words(h, w.off)
        failed = (n < 50) | (100 * rep > 50 * n)
        if model is None:
            p = np.where(failed, 0.0, 1.0)
        else:
            weights, bias, a, b = model
            p = sigmoid(a * (_mean_weights(hashed_columns(data, off, w, h), weights) + bias) + b)
        for name, v in zip(cols, (n, tg.per_text(chars, w.off), tg.per_text(_SYMBOL[data], off),
                                  duplicate_lines(data, off, w), rep, failed,
                                  ~failed & (p >= THRESHOLD), p)):
            cols[name].append(v)
    types = [pa.int64()] * 5 + [pa.bool_(), pa.bool_(), pa.float64()]
    return pa.StructArray.from_arrays(
        [pa.array(np.concatenate(v), t) if v else pa.array([], t)
         for v, t in zip(cols.values(), types)], names=list(cols))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample: int
                    ) -> tuple[DataFrame, dict[int, int]]:
    """At most ``sample`` labelled texts of each class, lowest id hash first, and how many
    labelled ids each class has in all. One text per id; ids and labels that are null,
    and labels other than 0 and 1, take no part."""
    one = (labels.select(F.col("doc_id").cast("long").alias("doc_id"),
                         F.col(label).cast("int").alias("y"))
           .filter("doc_id IS NOT NULL AND y IN (0, 1)")
           .groupBy("doc_id").agg(F.max("y").alias("y")))
    size = {r["y"]: r["n"] for r in one.groupBy("y").agg(F.count("*").alias("n")).collect()}
    picked = None
    for y in size:
        part = one.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    if picked is None:
        picked = one.limit(0)
    texts = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
             .groupBy("doc_id").agg(F.max("y").alias("y"), F.max("text").alias("text")))
    return texts, size


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE):
    """Fitted (weights, intercept, slope, offset), or None without both classes."""
    texts, size = labelled_sample(docs, labels, label, sample)
    if len(size) < 2:
        return None

    def rows(batches):
        for b in batches:
            f = _features(b.column("text"))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"),
                 pa.array([c.astype(np.uint16).tobytes() for c, _ in f], pa.binary()),
                 pa.array([v.astype(np.float32).tobytes() for _, v in f], pa.binary())],
                names=["doc_id", "y", "col", "val"])

    # Written once: the rows come to the driver partition by partition, into one bounded matrix.
    found = write_stage(texts.mapInArrow(rows, "doc_id long, y int, col binary, val binary"),
                        "labelled-features")
    ids = sorted((r["doc_id"], r["y"]) for r in found.select("doc_id", "y").collect())
    y = np.array([k for _, k in ids])
    if len(set(y)) < 2:
        return None
    row_of = {i: k for k, (i, _) in enumerate(ids)}
    x = np.zeros((len(ids), DIMS), np.float32)
    for r in found.toLocalIterator():
        x[row_of[r["doc_id"]], np.frombuffer(r["col"], np.uint16)] = np.frombuffer(r["val"], np.float32)
    x = Dense(x)
    weight = np.array([size[k] / (y == k).sum() for k in (0, 1)])[y]
    aside = tg.mix(np.array([i for i, _ in ids], np.int64).view(np.uint64)) % 5 == 0
    if len(set(y[~aside])) < 2 or len(set(y[aside])) < 2:
        aside = np.zeros(len(y), bool)
    w, bias = fit(x, y, weight * ~aside, DIMS)
    check = aside if aside.any() else ~aside
    z = (x.dot(w) + bias)[check]
    return w.astype(np.float32), bias, *platt(z, y[check], weight[check])


def verdict(text: Column, model) -> Column:
    """Struct column with the counts, the calibrated probability and ``kept``."""
    @F.arrow_udf(RESULT)
    def score(texts: pa.Array) -> pa.Array:
        return _score(texts, model)

    return score.asNondeterministic()(text)  # evaluated once per row, never copied


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id and the verdict of every document."""
    model = train(docs, labels, sample=sample)
    return docs.select("doc_id", verdict(F.col("text"), model).alias("v")).select("doc_id", "v.*")


def keep_good(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    model = train(docs, labels, sample=sample)
    return docs.filter(verdict(docs["text"], model)["kept"])


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/documents.parquet"),
                 spark.read.parquet(f"{sf_dir}/labels.parquet"))
