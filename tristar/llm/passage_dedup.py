"""Substring dedup: paragraph MinHash banding.

A paragraph is a line of at least ``MIN_WORDS`` words. Its five-word shingles (words in lower
case, A-Z) are summarised by MinHash; bands of ``ROWS`` values, as many as ``tune_bands`` asks for
``RECALL``, put paragraphs into candidate buckets. Members of a bucket are compared by the
exact Jaccard similarity of their shingle sets, links of ``THRESHOLD`` or more make
classes (connected components), and of each class the first paragraph, by document id and
position, stays while the others are removed, within a document as across documents.

Passages that are not lines are found by ``passage_spans``: any ``MIN_WORDS`` equal words in
a row, across line ends and inside longer lines, wherever no line is removed already.

Equal paragraphs are put together by digest first: a passage that very many documents share is
one node and costs one comparison per similar text. Rows are numbered by their place in
the table, which must not change between two reads (a table's files do not).

Defined results: null and empty texts and texts without a repeat have no row;
rows with null ids take part, after all others of their class; repeated rows repeat their
paragraphs; extra columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.linking import components, link, tune_bands
from tristar.llm.near_dedup import compare_texts, numbered, prefixer
from tristar.llm.passage_spans import repeated_spans, without
from tristar.llm.rows import free_name, row_number_of, sieve
from tristar.session import write_stage

MIN_WORDS = 50
THRESHOLD = 0.8
WORDS = 5
ROWS = 4
RECALL = 0.997  # of a pair at the threshold


def paragraphs(data: np.ndarray, off: np.ndarray, min_words: int):
    """Long lines of a block: (text index, line number, start, end, words) and their shingle
    hashes with offsets."""
    ln = tg.lines(data, off)
    low = tg.LOWER[data]
    w = tg.words(low, off)
    first, last = np.searchsorted(w.start, ln.start), np.searchsorted(w.start, ln.end)
    long = np.flatnonzero(last - first >= min_words)
    n = (last - first)[long]
    h = tg.span_hash(low, w.start, w.end)
    woff = np.concatenate([[0], np.cumsum(n)])
    at = np.arange(int(woff[-1])) + np.repeat(first[long] - woff[:-1], n)
    s, soff = tg.shingles(h[at], woff, WORDS)
    text = ln.text[long]
    return text, long - ln.off[text], ln.start[long], ln.end[long], n, s, soff


def bands_of(s: np.ndarray, off: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """MinHash band values (paragraph, band)."""
    bands = tune_bands(THRESHOLD, RECALL, rows)
    out = np.zeros((len(off) - 1, bands), np.uint64)
    for k in range(bands * rows if len(off) > 1 else 0):
        low = np.minimum.reduceat(tg.mix(s + tg.constant(k + 1)), off[:-1])
        out[:, k // rows] = tg.mix(out[:, k // rows] + low + np.uint64(k))
    return out


def _signatures(batches, min_words: int):
    for b in batches:
        row, doc = b.column("row"), b.column("doc_id")
        for i, _, data, off in tg.blocks(b.column("text")):
            text, line, start, end, n, s, soff = paragraphs(data, off, min_words)
            raw = data.tobytes()
            digest = [hashlib.md5(raw[a:z]).digest() for a, z in zip(start.tolist(), end.tolist())]
            at = pa.array(text + i)
            yield pa.RecordBatch.from_arrays(
                [row.take(at), doc.take(at), pa.array(line), pa.array(n),
                 pa.array(digest, pa.binary()),
                 pa.array(bands_of(s, soff).view(np.int64).tolist(), pa.list_(pa.int64()))],
                names=["row", "doc_id", "line", "n_words", "digest", "bands"])


def _texts(batches, min_words: int):
    """The long lines themselves, with the row and line they stand at."""
    for b in batches:
        for i, _, data, off in tg.blocks(b.column("text")):
            text, line, start, end, *_ = paragraphs(data, off, min_words)
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(pa.array(text + i)), pa.array(line),
                 pa.array([raw[a:z].decode() for a, z in zip(start.tolist(), end.tolist())],
                          pa.string())], names=["row", "line", "text"])


def jaccard(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Exact Jaccard similarity of the shingle sets of two equally long arrays of lines."""
    out = []
    for i in range(0, len(a), 1024):
        keys = []
        for side in (a.slice(i, 1024), b.slice(i, 1024)):
            data, off = tg.buffers(side)
            data = tg.LOWER[data]
            w = tg.words(data, off)
            s, soff = tg.shingles(tg.span_hash(data, w.start, w.end), w.off, WORDS)
            s, soff, _ = tg.unique_per_group(s, soff)
            pair = np.repeat(np.arange(len(off) - 1), np.diff(soff))
            keys.append((s, pair))
        n = len(a.slice(i, 1024))
        s, pair = (np.concatenate([k[j] for k in keys]) for j in (0, 1))
        order = np.lexsort((s, pair))
        s, pair = s[order], pair[order]
        both = np.bincount(pair[1:][(s[1:] == s[:-1]) & (pair[1:] == pair[:-1])], minlength=n)
        out.append(both / np.maximum(np.bincount(pair, minlength=n) - both, 1))
    return np.concatenate(out) if out else np.zeros(0)


def repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Every paragraph that has a like: row, doc_id, line, n_words, class_id, first_doc_id,
    class_size and removed (false for the first of its class)."""
    signed = write_stage(numbered(docs).mapInArrow(
        lambda it: _signatures(it, min_words),
        "row long, doc_id long, line long, n_words long, digest binary, bands array<long>"),
        "paragraphs")
    groups = write_stage(
        signed.groupBy("digest").agg(F.min(F.struct("row", "line", "bands")).alias("first"),
                                     F.count("*").alias("n")).select(
            F.monotonically_increasing_id().alias("node"), "digest", "first.*", "n"),
        "paragraph-nodes")
    members = groups.select("node", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "node")
    shared = write_stage(members.join(
        members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"),
        "bucket"), "paragraph-members")
    wanted = write_stage(groups.select("node", "row", "line").join(
        shared.select("node").distinct(), "node"), "paragraph-wanted")
    texts = write_stage(
        sieve(numbered(docs), "row", wanted.select("row"))
        .join(wanted.select("row").distinct(), "row", "left_semi")
        .select("row", "text").mapInArrow(lambda it: _texts(it, min_words),
                                          "row long, line long, text string")
        .join(wanted, ["row", "line"]).select("node", "text"), "paragraph-texts")

    links = link(shared, lambda p: compare_texts(texts, jaccard, p), THRESHOLD, "paragraph",
                 prefixer(texts, lambda h, count: np.ones(len(h)), THRESHOLD, "paragraph"))
    found = components(links, "paragraph")
    placed = (signed.drop("bands").join(groups.select("digest", "node"), "digest")
              .join(found, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    placed = write_stage(placed.select("row", "doc_id", "line", "n_words", "component"),
                         "paragraph-classes")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row", "line")
    first = (placed.groupBy("component").agg(F.min(place).alias("first"),
                                             F.count("*").alias("class_size"))
             .filter("class_size > 1"))
    return (placed.join(first, "component")
            .select("row", "doc_id", "line", "n_words", F.col("component").alias("class_id"),
                    F.col("first.doc_id").alias("first_doc_id"), "class_size",
                    ((F.col("row") != F.col("first.row")) | (F.col("line") != F.col("first.line")))
                    .alias("removed")))


def passages(docs: DataFrame, min_words: int = MIN_WORDS) -> tuple[DataFrame, DataFrame]:
    """Paragraphs that have a like (``repeated``) and spans that have one (``repeated_spans``),
    which together cover the whole text."""
    lines = write_stage(repeated(docs, min_words), "paragraph-rows")
    return lines, repeated_spans(numbered(docs), lines.filter("removed").select("row", "line"),
                                 min_words)


def repeated_passages(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The rows of ``repeated`` and one row for each span, which has ``start_word`` too (null
    for a paragraph): its first word's place in the text. The class of a span is the place
    where its first occurrence begins."""
    lines, spans = passages(docs, min_words)
    return lines.withColumn("start_word", F.lit(None).cast("long")).unionByName(spans.select(
        "row", "doc_id", "line", (F.col("end_word") - F.col("start_word")).alias("n_words"),
        F.xxhash64("first_row", "first_word").alias("class_id"), "first_doc_id", "class_size",
        "removed", "start_word"))


def cut_repeated(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """The documents with all their columns, without the removed paragraphs and spans;
    ``n_chars``, if there is such a column, counts the characters left. Texts without a removed
    passage stay as they are."""
    lines, spans = passages(docs, min_words)
    none = F.lit(None).cast("long")
    number, at, between = (free_name(docs, c) for c in ("cut_row", "cut_lines", "cut_spans"))
    cut = (lines.filter("removed").select("row", "line", none.alias("a"), none.alias("z"))
           .unionByName(spans.filter("removed").select(
               "row", none.alias("line"), F.col("start_word").alias("a"), F.col("end_word").alias("z")))
           .groupBy(F.col("row").alias(number))
           .agg(F.collect_list("line").alias(at),
                F.collect_list(F.when(F.col("a").isNotNull(), F.struct("a", "z"))).alias(between)))
    cut = write_stage(cut, "paragraph-removals")

    @F.arrow_udf("string")
    def kept(texts: pa.Array, lines: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([t if x is None else without(t, x, [(s["a"], s["z"]) for s in y])
                         for t, x, y in zip(texts.to_pylist(), lines.to_pylist(), spans.to_pylist())],
                        pa.string())

    out = docs.withColumn(number, row_number_of(docs)).join(cut, number, "left").withColumn(
        "text", kept.asNondeterministic()(F.col("text").cast("string"), at, between))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col(at).isNull(), F.col("n_chars")).otherwise(
            F.length("text")).cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)


def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")


def op1_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("row")
