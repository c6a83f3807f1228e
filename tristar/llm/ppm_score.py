"""LM scoring: prediction by partial matching over a byte-context trie.

A text is the sequence of its tokens: its words in lower case (A-Z), then one end. A token
is spelled as its bytes and a space (the end is one line feed), which is unambiguous, and each
byte is predicted from the up to ``ORDER`` bytes before it in its token and the space that
precedes it. Trie nodes (context, next byte) count how often training tokens pass them.
Prediction starts at the longest context: a byte seen there n times gets n / (T + D) for T
passes and D distinct next bytes; otherwise it escapes with D / (T + D) (method C) to the
next shorter context, where the bytes already refused are excluded from T and D. Below the
empty context the bytes not seen at all share the rest equally.

There is one trie for each of ``CLASSES`` kinds of text (in practice: languages and sorts of
junk). The kinds are found by k-means over hashed byte pairs of all training texts, whose steps
are aggregations; every text is then assigned to the likeliest kind by exact integer
arithmetic. The score is the log10 probability of the kind plus that of the whole token
sequence in its trie, a two-part code; the code length in bits is -log2 of the same.

Scale: contexts end at the token, so a token's probability is computed once per distinct
token, not per occurrence. Documents are grouped by where they stand in their input file
(``CHUNK`` rows), each chunk sends its distinct tokens once, counts and probabilities come
back by a join on the token (with its kind), and chunk and table meet in a cogroup. The trie itself is a
table built with aggregations and joins; nothing of it passes the driver and nothing is
broadcast. No token is hot: it occurs at most once per chunk.

Defined results: null and empty texts are one end token; documents with null ids are
training documents; repeated rows are scored each and count each; without training
tokens every byte has probability 1/256 and base_score is 0. ``docs`` must keep its row order
between two reads (a table does); other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristar.llm import textgrid as tg
from tristar.llm.rows import row_number_of
from tristar.session import write_stage

ORDER = 5
CHUNK_BITS, VOCAB_BITS = 13, 16   # rows per chunk of documents, of tokens
END = b"\n"
CLASSES, PAIRS = 8, 512
STEPS, STEP = 20, 16              # of k-means at most; of a center's coordinates, a unit has 16
ROWS = 1024                       # texts whose pair counts are in memory at a time


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string")) % 5 == 1, F.lit(False))


def _chunk(df: DataFrame, bits: int) -> Column:
    return F.shiftright(row_number_of(df), bits)


def _numbered(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").alias("text"), _chunk(docs, CHUNK_BITS).alias("chunk"),
                       held_out().alias("held_out"))


def _pair_counts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """How often each hashed pair of neighbouring bytes occurs in each text."""
    n = len(off) - 1
    text = np.repeat(np.arange(n), np.diff(off))
    same = text[1:] == text[:-1]
    pair = (data[:-1].astype(np.int64) * 31 + data[1:].astype(np.int64) * 7) % 509
    return np.bincount((text[1:] * PAIRS + pair)[same], minlength=n * PAIRS).reshape(n, PAIRS)


def _some_texts(data: np.ndarray, off: np.ndarray):
    """A block in runs of at most ``ROWS`` texts: a table of counts per text stays small."""
    for i in range(0, len(off) - 1, ROWS):
        part = off[i:i + ROWS + 1]
        yield _pair_counts(data[part[0]:part[-1]], part - part[0])


def _pair_rows(batches):
    """The pair counts of every text that has a pair, 2 bytes a count or 4 if one is large."""
    for b in batches:
        out = []
        for _, _, data, off in tg.blocks(b.column("text")):
            for counts in _some_texts(tg.LOWER[data], off):
                out += [c.astype(np.uint16 if c.max() < 1 << 16 else np.uint32).tobytes()
                        for c in counts[counts.any(axis=1)]]
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["c"])


def _counts(column: pa.Array):
    for t in (np.uint16, np.uint32):
        rows = column.filter(pc.equal(pc.binary_length(column), PAIRS * np.dtype(t).itemsize))
        for i in range(0, len(rows), ROWS):
            yield np.frombuffer(b"".join(rows.slice(i, ROWS).to_pylist()), t).reshape(-1, PAIRS)


def _sums(rows: DataFrame, center: np.ndarray, width: int, wanted) -> np.ndarray:
    """Sums of the ``width`` columns of ``wanted(counts, x, kind)`` over all texts of each kind,
    which is the nearest center. ``x`` are the texts' features: square roots of their pairs' shares, in
    whole steps of 1/255. All numbers are integers small enough for exact floating-point sums,
    so the result depends neither on the order nor on the partitions."""
    kinds = len(center)

    def run(batches):
        total = np.zeros((kinds, width))
        for b in batches:
            for counts in _counts(b.column("c")):
                share = counts / counts.sum(1, keepdims=True, dtype=np.float64)
                x = np.round(np.sqrt(share) * 255)
                kind = (2 * STEP * (x @ center.T) - (center ** 2).sum(1)).argmax(1)
                total += (kind == np.arange(kinds)[:, None]).astype(np.float64) @ wanted(counts, x, kind)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(total.ravel()[at].astype(np.int64))], names=["at", "n"])

    got = rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(kinds * width)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out.reshape(kinds, -1)


def _moments(rows: DataFrame, center: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Texts, mean and variance of the features of each kind; an empty kind's mean is its center."""
    got = _sums(rows, center, 1 + 2 * PAIRS,
                lambda _, x, kind: np.hstack([np.ones((len(x), 1)), x, x * x]))
    n = got[:, :1]
    mean = np.where(n > 0, got[:, 1:PAIRS + 1] / np.maximum(n, 1), center / STEP)
    return n, mean, np.where(n > 0, got[:, PAIRS + 1:] / np.maximum(n, 1) - mean ** 2, 0)


def learn_classes(docs: DataFrame, classes: int = CLASSES) -> np.ndarray:
    """Integer weights (byte pair, kind): scaled log shares of the pairs in each kind.

    k-means over all training texts. Their pair counts are written once; every step is an
    aggregation over them, of which ``classes`` rows of sums reach the driver. The start is the
    mean of all texts; each kind is then split in two along the covariance of its most varied
    pair with all others until there are enough."""
    rows = write_stage(docs.filter("NOT held_out AND text IS NOT NULL").select("text")
                       .mapInArrow(_pair_rows, "c binary"), "pair-counts")
    center = np.zeros((1, PAIRS))
    n, mean, spread = _moments(rows, center)
    if not n.any():
        return np.zeros((PAIRS, 1), np.int64)
    while len(center) < classes:
        each, axis = np.arange(len(center)), spread.argmax(1)
        cross = _sums(rows, center, PAIRS,
                      lambda _, x, kind, axis=axis: x * x[np.arange(len(x)), axis[kind], None])
        along = np.where(n > 0, cross / np.maximum(n, 1) - mean * mean[each, axis][:, None], 0)
        along /= np.sqrt(np.maximum(spread[each, axis], 1e-9))[:, None]
        center = np.round(np.stack([mean + along, mean - along], 1).reshape(-1, PAIRS)[:classes] * STEP)
        for _ in range(STEPS if len(center) == classes else 2):
            n, mean, spread = _moments(rows, center)
            if (np.round(mean * STEP) == center).all():
                break
            center = np.round(mean * STEP)
        else:
            n, mean, spread = _moments(rows, center)
    total = _sums(rows, center, PAIRS, lambda counts, *_: counts.astype(np.float64)) + 0.5
    return np.round(np.log(total / total.sum(1, keepdims=True)) * 65536).astype(np.int64).T


def _by_chunk(batches):
    """(chunk, its batches) in row order."""
    now, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        chunk = b.column("chunk").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(chunk)) + 1).tolist(), len(chunk)]
        for i, j in zip(cuts, cuts[1:]):
            if now is not None and chunk[i] != now:
                yield now, parts
                parts = []
            now = int(chunk[i])
            parts.append(b.slice(i, j - i))
    if now is not None:
        yield now, parts


def _tokens(texts, weights: np.ndarray):
    """Blocks of (first row, end row, lower-case bytes, words, kinds, hashes of words with
    their text's kind)."""
    for i, j, data, off in tg.blocks(texts):
        data = tg.LOWER[data]
        w = tg.words(data, off)
        kind = np.concatenate([(c @ weights).argmax(1) for c in _some_texts(data, off)])
        yield i, j, data, w, kind, _with_kind(tg.span_hash(data, w.start, w.end), kind[w.text])


def _with_kind(h: np.ndarray, kind: np.ndarray) -> np.ndarray:
    return tg.mix(h + (kind.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA24BAED4963EE407))


def _chunk_tokens(batches, weights):
    """Distinct tokens (kind and word) of each chunk with their training count."""
    for chunk, parts in _by_chunk(batches):
        hashes, counts, spelled = [], [], []
        ends, ended = np.zeros(weights.shape[1], np.int64), np.zeros(weights.shape[1], bool)
        for b in parts:
            train = ~b.column("held_out").to_numpy(zero_copy_only=False)
            for i, j, data, w, kind, h in _tokens(b.column("text"), weights):
                ends += np.bincount(kind, train[i:j], len(ends)).astype(np.int64)
                ended[kind] = True
                u, first, group = np.unique(h, return_index=True, return_inverse=True)
                hashes.append(u)
                counts.append(np.bincount(group, train[i:j][w.text], len(u)).astype(np.int64))
                raw, mark = data.tobytes(), [bytes([65 + k]) for k in range(len(ends))]
                spelled += [mark[k] + raw[a:z] for k, a, z in zip(
                    kind[w.text[first]].tolist(), w.start[first].tolist(), w.end[first].tolist())]
        u, first, group = np.unique(np.concatenate(hashes) if hashes else np.zeros(0, np.uint64),
                                    return_index=True, return_inverse=True)
        n = np.bincount(group, np.concatenate(counts) if hashes else None, len(u)).astype(np.int64)
        units = [spelled[k] for k in first.tolist()]
        n, units = n[(by := sorted(range(len(units)), key=units.__getitem__))], [units[k] for k in by]
        units += [bytes([65 + k]) + END for k in np.flatnonzero(ended)]
        n = np.concatenate([n, ends[ended]])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(units), chunk)), pa.array(units, pa.binary()), pa.array(n)],
            names=["chunk", "unit", "n"])


def _spelling(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Longest-context nodes of every byte of every token: (node keys, tokens' offsets).

    A node key packs the kind, the context length, the context bytes and the next byte."""
    raw = [u[1:] if u[1:] == END else u[1:] + b" " for u in units]
    kind = np.array([u[0] - 65 for u in units], np.int64)
    size = np.array([len(r) for r in raw], np.int64)
    off = np.concatenate([[0], np.cumsum(size)])
    flat = np.frombuffer(b"".join(raw), np.uint8).astype(np.int64)
    at = np.arange(len(flat)) - np.repeat(off[:-1], size)
    order = np.minimum(at + 1, ORDER)
    key = flat.copy()
    pad = np.concatenate([np.zeros(ORDER, np.int64), flat])
    for j in range(1, ORDER + 1):   # byte j places before; the space before the token at the start
        before = np.where(at == j - 1, 0x20, pad[ORDER - j:ORDER - j + len(flat)])
        key += np.where(j <= order, before << (8 * j), 0)
    return (np.repeat(kind, size) << 52) + (order << 48) + key, off


def _vocabulary_nodes(batches):
    """Distinct longest-context nodes of each chunk of tokens, with training passes."""
    for chunk, parts in _by_chunk(batches):
        units = [u for b in parts for u in b.column("unit").to_pylist()]
        count = np.concatenate([b.column("n").to_numpy() for b in parts])
        key, off = _spelling(units)
        u, group = np.unique(key, return_inverse=True)
        n = np.bincount(group, np.repeat(count, np.diff(off)), len(u))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(u), chunk)), pa.array(u), pa.array(n.astype(np.int64))],
            names=["chunk", "node", "n"])


def _order(node: str) -> Column:
    return F.shiftright(F.col(node), 48).bitwiseAND(15)


def _kind(node: str) -> Column:
    return F.shiftleft(F.shiftright(F.col(node), 52), 52)


def _cut_to(node: str, order: Column) -> Column:
    """The node's suffix with a context of ``order`` bytes."""
    mask = F.pow(F.lit(256.0), order + 1).cast("long") - 1
    return F.col(node).bitwiseAND(mask) + F.shiftleft(order.cast("long"), 48) + _kind(node)


def _context(node: str) -> Column:
    """Key of a node's context: its kind, its length and its bytes."""
    return (F.shiftright(F.col(node).bitwiseAND((1 << 48) - 1), 8)
            + F.shiftleft(_order(node), 48) + _kind(node))


def build_trie(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(node, n) for all contexts up to ORDER, and (context, t, d, x): passes, distinct next
    bytes, and passes of those same bytes in the next shorter context."""
    seen = nodes.filter("n > 0")
    all_orders = (seen.select(F.explode(F.sequence(F.lit(0), _order("node").cast("int")))
                              .alias("k"), "node", "n")
                  .select(_cut_to("node", F.col("k")).alias("node"), "n")
                  .groupBy("node").agg(F.sum("n").alias("n")))
    trie = write_stage(all_orders, "trie")
    shorter = trie.select(F.col("node").alias("suffix"), F.col("n").alias("shorter"))
    wide = trie.withColumn("suffix", F.when(_order("node") > 0,
                                            _cut_to("node", (_order("node") - 1).cast("int"))))
    contexts = (wide.join(shorter, "suffix", "left").groupBy(_context("node").alias("context"))
                .agg(F.sum("n").alias("t"), F.count("*").alias("d"),
                     F.sum(F.coalesce("shorter", F.lit(0))).alias("x")))
    return trie, write_stage(contexts, "trie-contexts")


def node_costs(nodes: DataFrame, trie: DataFrame, contexts: DataFrame) -> DataFrame:
    """(node, cost): log10 probability of each node's byte after its context."""
    c = contexts.select("context", "t", "d", "x")
    direct = (nodes.filter("n > 0").withColumn("context", _context("node")).join(c, "context")
              .select("node", F.log10(F.col("n") / (F.col("t") + F.col("d"))).alias("cost")))
    levels = (nodes.filter("n = 0").select("node")
              .select("node", F.explode(F.sequence(F.lit(0), _order("node").cast("int"))).alias("k"))
              .withColumn("at", _cut_to("node", F.col("k"))).withColumn("context", _context("at"))
              .join(c, "context", "left")
              .join(trie.select(F.col("node").alias("at"), "n"), "at", "left")
              .groupBy("node").agg(F.array_sort(F.collect_list(F.struct(
                  (-F.col("k")).alias("o"), "n", "t", "d", "x"))).alias("levels")))
    # From the longest context down: (log10 so far, excluded passes, excluded bytes, found).
    start = F.struct(F.lit(0.0).alias("lp"), F.lit(0).cast("long").alias("x"),
                     F.lit(0).cast("long").alias("d"), F.lit(False).alias("done"))

    def step(acc, v):
        t, d = v["t"] - acc["x"], v["d"] - acc["d"]
        found = F.struct((acc["lp"] + F.log10(v["n"] / (t + d))).alias("lp"), acc["x"].alias("x"),
                         acc["d"].alias("d"), F.lit(True).alias("done"))
        escape = F.struct((acc["lp"] + F.when(t > 0, F.log10(d / (t + d))).otherwise(0.0))
                          .alias("lp"), v["x"].cast("long").alias("x"),
                          v["d"].cast("long").alias("d"), F.lit(False).alias("done"))
        return F.when(acc["done"] | v["t"].isNull(), acc).when(v["n"] > 0, found).otherwise(escape)

    unseen = levels.select("node", F.aggregate("levels", start, step).alias("a")).select(
        "node", (F.col("a.lp") - F.when(F.col("a.done"), 0.0).otherwise(
            F.log10(F.greatest(256 - F.col("a.d"), F.lit(1))))).alias("cost"))
    return direct.unionByName(unseen)


def _token_scores(tokens: pa.Table, costs: pa.Table) -> pa.Table:
    """log10 probability of each token of a chunk from its nodes' costs."""
    units = tokens.column("unit").to_pylist()
    key, off = _spelling(units)
    node = costs.column("node").to_numpy()
    order = np.argsort(node)
    per_byte = costs.column("cost").to_numpy()[order][np.searchsorted(node[order], key)]
    score = np.add.reduceat(per_byte, off[:-1]) if units else np.zeros(0)
    return pa.table([pa.array(units, pa.binary()), pa.array(_unit_hash(units).view(np.int64)),
                     tokens.column("c"), pa.array(score)], names=["unit", "h", "c", "lp"])


def _unit_hash(units: list[bytes]) -> np.ndarray:
    """Hashes of tokens with their kind, as _tokens gives them; used within a chunk only."""
    off = np.concatenate([[0], np.cumsum([len(u) for u in units])]).astype(np.int64)
    data = np.frombuffer(b"".join(units), np.uint8)
    return _with_kind(tg.span_hash(data, off[:-1] + 1, off[1:]), data[off[:-1]].astype(np.int64) - 65)


def _pack(batches):
    """The documents of each chunk in compressed blobs of about 4 MB: texts cross the
    network once, at about half of what a shuffle's own compression leaves."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for b in batches:
        for chunk, (part,) in _by_chunk([b]):
            for i, j, *_ in tg.blocks(part.column("text"), 1 << 22):
                piece = part.select(["doc_id", "held_out", "text"]).slice(i, j - i)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, piece.schema, options=options) as out:
                    out.write_batch(piece)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk]), pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["chunk", "blob"])


def score_documents(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document."""
    docs = _numbered(docs)
    weights = learn_classes(docs)
    pairs = write_stage(docs.mapInArrow(lambda it: _chunk_tokens(it, weights),
                                        "chunk long, unit binary, n long"), "chunk-tokens")
    word = Window.partitionBy("word")
    vocabulary = write_stage(
        pairs.groupBy("unit").agg(F.sum("n").alias("n"))
        .withColumn("word", F.expr("substring(unit, 2)"))
        .select("unit", "n", F.sum("n").over(word).alias("c"),
                (F.min("unit").over(word) == F.col("unit")).alias("first")), "vocabulary")
    total = vocabulary.agg(F.sum("n").alias("n"), F.count(F.when(
        F.col("first") & (F.col("c") > 0), 1)).alias("v")).first()
    train_tokens, distinct = total["n"] or 0, total["v"]
    ends = {r["unit"][0] - 65: r["n"] for r in vocabulary.filter(
        F.expr("substring(unit, 2)") == F.lit(END)).select("unit", "n").collect()}

    spelled = vocabulary.withColumn("chunk", _chunk(vocabulary, VOCAB_BITS)).select("chunk", "unit", "n", "c")
    node_pairs = write_stage(spelled.mapInArrow(_vocabulary_nodes, "chunk long, node long, n long"),
                             "vocabulary-nodes")
    nodes = write_stage(node_pairs.groupBy("node").agg(F.sum("n").alias("n")), "nodes")
    trie, contexts = build_trie(nodes)
    costs = node_costs(nodes, trie, contexts)
    chunk_costs = node_pairs.select("chunk", "node").join(costs, "node")
    scored = (spelled.groupBy("chunk").cogroup(chunk_costs.groupBy("chunk"))
              .applyInArrow(_token_scores, "unit binary, h long, c long, lp double"))
    table = pairs.select("chunk", "unit").join(scored, "unit").select("chunk", "h", "c", "lp")
    scale = train_tokens + 0.5 * (distinct + 1)
    kinds = weights.shape[1]
    of_kind = np.array([ends.get(k, 0) + 0.5 for k in range(kinds)])
    of_kind = np.log10(of_kind / of_kind.sum())
    empty = pa.table([pa.array([], pa.int64()), pa.array([], pa.bool_()), pa.array([], pa.string())],
                     names=["doc_id", "held_out", "text"])

    def whole(blobs: pa.Table, known: pa.Table) -> pa.Table:
        parts = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in blobs.column("blob")]
        rows = pa.concat_tables(parts) if parts else empty
        h = known.column("h").to_numpy().view(np.uint64)
        order = np.argsort(h)
        h, c = h[order], known.column("c").to_numpy()[order]
        lp = known.column("lp").to_numpy()[order]
        base = np.log10((c + 0.5) / scale)
        end = np.searchsorted(h, _with_kind(
            np.repeat(tg.span_hash(np.array([10], np.uint8), np.array([0]), np.array([1])), kinds),
            np.arange(kinds)))
        n = rows.num_rows
        out = [np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n), np.zeros(n)]
        for i, j, _, w, kind, hw in _tokens(rows.column("text").combine_chunks(), weights):
            at, last, group = np.searchsorted(h, hw), end[kind], w.text
            out[0][i:j] = np.diff(w.off) + 1
            out[1][i:j] = tg.per_text(c[at] > 0, w.off) + (c[last] > 0)
            out[2][i:j] = np.bincount(group, base[at], j - i) + base[last]
            out[3][i:j] = np.bincount(group, lp[at], j - i) + lp[last] + of_kind[kind]
        return pa.table([rows.column("doc_id"), rows.column("held_out"), pa.array(out[0]),
                         pa.array(out[1]), pa.array(np.full(n, train_tokens)),
                         pa.array(out[2]), pa.array(out[3])],
                        names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens",
                               "base_score", "score"])

    packed = docs.mapInArrow(_pack, "chunk long, blob binary")
    return (packed.groupBy("chunk").cogroup(table.groupBy("chunk"))
            .applyInArrow(whole, "doc_id long, held_out boolean, n_tokens long, n_known long, "
                                 "train_tokens long, base_score double, score double"))


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
