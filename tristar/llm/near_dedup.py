"""MinHash near-dedup: improved consistent weighted sampling over TF-IDF shingles.

A document is the weighted set of its five-word shingles (words in lower case, A-Z; a text of
fewer words is one shingle). A shingle's weight is its count in the text times its inverse
document frequency, 1 + ln((N + 1) / (df + 1)), with document frequencies over all
documents in 2**``BUCKET_BITS`` hashed columns (the usual hashing trick, so the table has one
fixed size; N and df grow alike, and so weights behave alike at any corpus size).
Improved consistent weighted sampling draws, per sample, the shingle and level that minimise an
exponential race; two documents draw the same with the probability of their weighted
Jaccard similarity. Bands of samples make candidate buckets, whose members are compared by
exact weighted Jaccard similarity of the whole texts, and links of ``THRESHOLD`` or more
make classes. Large buckets whose members are not all alike go through an exact prefix-filter
join (``linking``).

Copies are put together by the digest of their text before any comparison, so a group of
copies is one node. Rows are numbered by their place in the table, which must not change
between two reads (a table's files do not).

Defined results: texts that are null or have no word are classes of their own; rows with null
ids take part, and a class id is the smallest id of the class (null if it has none);
repeated rows are one class; extra columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.linking import components, link, tune_bands
from tristar.llm.rows import free_name, row_number_of, sieve
from tristar.session import write_stage

THRESHOLD = 0.8
WORDS = 5
BUCKET_BITS = 18
ROWS = 4                                        # samples per band
RECALL = 0.997                                  # of a pair at the threshold
BANDS = tune_bands(THRESHOLD, RECALL, ROWS)

_rng = np.random.default_rng(20100)
_TABLE = 1 << 16
# Random variates of the sampling scheme, drawn by 16 hash bits each.
_R = -np.log(_rng.random(_TABLE) * _rng.random(_TABLE)).astype(np.float32)
_LN_C = np.log(-np.log(_rng.random(_TABLE) * _rng.random(_TABLE))).astype(np.float32)
_BETA = _rng.random(_TABLE).astype(np.float32)


def shingle_sets(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct shingles, offsets per text, counts)."""
    data = tg.LOWER[data]
    w = tg.words(data, off)
    s, soff = tg.shingles(tg.span_hash(data, w.start, w.end), w.off, WORDS)
    return tg.unique_per_group(s, soff)


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[int, np.ndarray]:
    """Documents with a shingle, and hashed document frequencies, over all documents."""
    def run(batches):
        df, n = np.zeros(1 << BUCKET_BITS, np.int64), 0
        for b in batches:
            for _, _, data, off in tg.blocks(b.column("text")):
                h, soff, _ = shingle_sets(data, off)
                df += np.bincount(_bucket(h), minlength=len(df))
                n += int((np.diff(soff) > 0).sum())
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))],
                                         names=["bucket", "n"])

    total = (docs.select("text").mapInArrow(run, "bucket long, n long").groupBy("bucket")
             .agg(F.sum("n").alias("n")).toArrow())   # at most 2**BUCKET_BITS + 1 rows
    at, n = total.column("bucket").to_numpy(), total.column("n").to_numpy()
    out = np.zeros(1 << BUCKET_BITS, np.int64)
    out[at[at >= 0]] = n[at >= 0]
    return int(n[at < 0].sum()), out


def inverse_frequencies(docs: DataFrame) -> np.ndarray:
    n, df = document_frequencies(docs)
    return (1 + np.log((n + 1) / (np.minimum(df, n) + 1))).astype(np.float32)


def bands_of(h: np.ndarray, off: np.ndarray, weight: np.ndarray, bands: int = BANDS,
             rows: int = ROWS) -> np.ndarray:
    """Band hashes (text, band) of weighted sets; sets must not be empty."""
    n = len(off) - 1
    out = np.zeros((n, bands), np.uint64)
    if not n:
        return out
    lw = np.log(weight).astype(np.float32)
    place = np.arange(len(h), dtype=np.uint64)
    for k in range(bands * rows):
        x = tg.mix(h + tg.constant(k + 1))
        r = _R[(x & np.uint64(0xFFFF)).astype(np.int64)]
        ln_c = _LN_C[((x >> np.uint64(16)) & np.uint64(0xFFFF)).astype(np.int64)]
        beta = _BETA[((x >> np.uint64(32)) & np.uint64(0xFFFF)).astype(np.int64)]
        step = np.floor(lw / r + beta)
        race = ln_c - r * (step - beta + 1)
        # Order-preserving integers of the races, with the place below: one minimum per text.
        bits = race.view(np.uint32)
        bits = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000)).astype(np.uint64)
        best = np.minimum.reduceat((bits << np.uint64(32)) | place, off[:-1]) & np.uint64(0xFFFFFFFF)
        best = best.astype(np.int64)
        drawn = tg.mix(h[best] ^ tg.mix(step[best].astype(np.int64).view(np.uint64)
                                        + np.uint64(k)))
        out[:, k // rows] = tg.mix(out[:, k // rows] + drawn + np.uint64(k))
    return out


def signatures(docs: DataFrame, idf: np.ndarray) -> DataFrame:
    """(row, doc_id, digest, bands): one row per document; bands are null without words."""
    def run(batches):
        for b in batches:
            bands = []
            for _, _, data, off in tg.blocks(b.column("text")):
                h, soff, count = shingle_sets(data, off)
                full = np.flatnonzero(np.diff(soff))
                found = bands_of(h, np.append(soff[full], len(h)), count * idf[_bucket(h)])
                part: list = [None] * (len(off) - 1)
                for i, x in zip(full.tolist(), found.view(np.int64).tolist()):
                    part[i] = x
                bands += part
            yield pa.RecordBatch.from_arrays(
                [b.column("row"), b.column("doc_id"), b.column("digest"),
                 pa.array(bands, pa.list_(pa.int64()))], names=["row", "doc_id", "digest", "bands"])

    return (numbered(docs).withColumn("digest", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
            .select("row", "doc_id", "digest", "text")
            .mapInArrow(run, "row long, doc_id long, digest binary, bands array<long>"))


def numbered(docs: DataFrame) -> DataFrame:
    """row, doc_id and text; a row's number is its place in the table's files."""
    return docs.select(row_number_of(docs).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"))


def weighted_jaccard(a, b, idf: np.ndarray) -> np.ndarray:
    """Exact weighted Jaccard similarity of the texts of two equally long arrays."""
    out = np.zeros(len(a))
    step = 256
    for i in range(0, len(a), step):
        sides = []
        for texts in (a.slice(i, step), b.slice(i, step)):
            data, off = tg.buffers(texts)
            h, soff, count = shingle_sets(data, off)
            pair = np.repeat(np.arange(len(off) - 1), np.diff(soff))
            sides.append((pair, h, count * idf[_bucket(h)]))
        n = len(a.slice(i, step))
        pair, h, w = (np.concatenate([s[k] for s in sides]) for k in range(3))
        order = np.lexsort((h, pair))
        pair, h, w = pair[order], h[order], w[order].astype(np.float64)
        twice = np.flatnonzero((h[1:] == h[:-1]) & (pair[1:] == pair[:-1]))
        common = np.bincount(pair[twice], np.minimum(w[twice], w[twice + 1]), n)
        total = np.bincount(pair, w, n) - common
        out[i:i + n] = np.where(total > 0, common / np.maximum(total, 1e-30), 0)
    return out


def compare_texts(texts: DataFrame, sims, pairs: DataFrame) -> DataFrame:
    """(a, b, sim) for pairs of nodes, which are a written table, from texts (node, text)."""
    def run(batches):
        for p in batches:
            yield pa.RecordBatch.from_arrays(
                [p.column("a"), p.column("b"), pa.array(sims(p.column("ta"), p.column("tb")))],
                names=["a", "b", "sim"])

    left = sieve(texts, "node", pairs.select("a")).select(F.col("node").alias("a"), F.col("text").alias("ta"))
    right = sieve(texts, "node", pairs.select("b")).select(F.col("node").alias("b"), F.col("text").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb").mapInArrow(
        run, "a long, b long, sim double")


def prefixer(texts: DataFrame, weigh, threshold: float, name: str):
    """For link: the prefixes of nodes' shingle sets, weighted by ``weigh(shingles, counts)``.

    A set is put in order of document frequency among these nodes, rarest first (in hashed
    columns and then by hash: any common order gives the same links, the columns only decide
    how many candidates there are). Two sets that are similar enough share more than the
    part that follows an element with less than ``threshold`` of the weight from there on, so the
    elements before it are enough. Shingles alone in their column are shared by nobody."""
    def prefixes(nodes: DataFrame) -> DataFrame:
        chosen = write_stage(texts.join(nodes, "node", "left_semi"), f"{name}-open-texts")
        df = document_frequencies(chosen)[1].astype(np.int32)

        def run(batches):
            for b in batches:
                for i, _, data, off in tg.blocks(b.column("text")):
                    h, soff, count = shingle_sets(data, off)
                    weight = np.asarray(weigh(h, count), np.float64)
                    text = np.repeat(np.arange(len(off) - 1), np.diff(soff))
                    n = df[_bucket(h)]
                    order = np.lexsort((h, n, text))
                    h, n, weight = h[order], n[order], weight[order]
                    before = np.concatenate([[0.0], np.cumsum(weight)])
                    rest = before[soff[1:]][text] - before[:-1]
                    total = (before[soff[1:]] - before[soff[:-1]])[text]
                    at = np.flatnonzero((rest >= threshold * (1 - 1e-6) * total) & (n > 1))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("node").take(pa.array(text[at] + i)),
                         pa.array(h[at].view(np.int64)), pa.array(rest[at]), pa.array(total[at])],
                        names=["node", "key", "rest", "total"])

        return chosen.select("node", "text").mapInArrow(
            run, "node long, key long, rest double, total double")

    return prefixes


def classes(docs: DataFrame) -> DataFrame:
    """(row, doc_id, component): rows of one class have the same component, which is the
    smallest row of the class."""
    idf = inverse_frequencies(docs)
    signed = write_stage(signatures(docs, idf), "near-signatures")
    groups = write_stage(signed.filter("bands IS NOT NULL").groupBy("digest").agg(
        F.min(F.struct("row", "bands")).alias("first")).select(
        "digest", F.col("first.row").alias("node"), F.col("first.bands").alias("bands")), "near-nodes")
    members = groups.select("node", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "node")
    shared = write_stage(members.join(
        members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1").select("bucket"),
        "bucket"), "near-members")
    texts = write_stage(
        sieve(numbered(docs), "row", shared.select("node"))
        .join(shared.select(F.col("node").alias("row")).distinct(), "row")
        .select(F.col("row").alias("node"), "text"), "near-texts")

    links = link(shared, lambda p: compare_texts(
        texts, lambda a, b: weighted_jaccard(a, b, idf), p), THRESHOLD, "near",
        prefixer(texts, lambda h, count: count * idf[_bucket(h)], THRESHOLD, "near"))
    found = components(links, "near")
    return (signed.select("row", "doc_id", "digest", F.col("bands").isNotNull().alias("full"))
            .join(groups.select("digest", "node"), "digest", "left")
            .join(found, "node", "left")
            .select("row", "doc_id", F.when(F.col("full"), F.coalesce("component", "node"))
                    .otherwise(F.col("row")).alias("component")))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest id of the class) and class_size of every document."""
    found = write_stage(classes(docs), "near-classes")
    size = found.groupBy("component").agg(F.min("doc_id").alias("class_id"),
                                          F.count("*").alias("class_size"))
    return found.join(size, "component").select("doc_id", "class_id", "class_size")


def keep_one(docs: DataFrame) -> DataFrame:
    """The documents with one of each class, the first row, with all their columns."""
    number = free_name(docs, "near_row")
    kept = write_stage(classes(docs), "near-classes").filter("row = component").select(
        F.col("row").alias(number))
    return (docs.withColumn(number, row_number_of(docs)).join(kept, number, "left_semi")
            .drop(number))


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
