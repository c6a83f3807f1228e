"""Cross-tokenizer alignment by lockstep vectorised merging.

Each text is encoded by tokenizer A (byte-level BPE, of space + text) and by tokenizer B
(sentence pieces with byte fallback, which adds the space itself). The byte offsets where
tokens of both end cut the text into *groups*; two tokens are linked if they share a group.

* One NumPy state vector holds the A and B pointers of all documents of a slice. In each step
  every document advances the pointer whose token ends first, or both where the ends meet,
  which emits a cut; documents that are through are compacted away. The cuts of some
  steps at a time are expanded to the links of their groups, all documents together.
* Links are kept as id pairs with their number, per document. A group with very many tokens
  on both sides (where two tokenizers do not meet for long) is expanded through its distinct
  ids, so its links are counted without being written out.
* How many documents hold a pair is an aggregation over the distinct pairs of all documents,
  the highest count of an A id one over the counts. To bring both back to the documents, the
  most frequent pairs, at most ``HOT`` of them, are broadcast: they hold nearly all links and
  would be the hot keys of a join. All other pairs go through a join on the pair. Each way is
  exact, and both are always taken.

Documents are written once with their pairs (``write_stage``), numbered by place there, so
repeated ids stay apart and lost executors change nothing.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from space +
text (a normaliser changed them), have no tokens: zeros and an empty groups string. Strings
of special tokens inside texts are plain text. Very long texts are aligned whole; ties of counts
all count as highest; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import os
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm.bpe_words import BYTE_CHAR, public_path
from tristar.llm.packing import ByteIds
from tristar.session import write_stage

A_FILE, B_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
SLICE = 2 << 20        # characters of text aligned together
CHUNK = 1 << 18        # characters given to the libraries at once
STEPS = 512            # steps between two expansions of cuts to links
LINKS = 1 << 21        # links written out at once; larger groups go through distinct ids
SHIFT = 20             # a pair is A id << SHIFT | B id
KNOWN, LONG = 300_000, 256    # remembered units of a Python worker, and their characters
HOT = 200_000          # most frequent pairs that are broadcast
ALIGNED = ("row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, "
           "groups string, pairs array<long>, links array<long>")


def _chunks(texts: list[str], size: int):
    """The texts in lists of about so many characters (an empty text counts as some)."""
    first = chars = 0
    for k, t in enumerate(texts):
        chars += len(t) + 16
        if chars > size or k + 1 == len(texts):
            yield texts[first:k + 1]
            first, chars = k + 1, 0


class Tokenizers:
    """Both tokenizers, and the bytes of each of their tokens."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"   # Spark runs a task a core
        import sentencepiece
        import tokenizers
        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        # The same merges, quicker for the many short ASCII units (where no table of Unicode
        # classes can differ).
        self.quick = ByteIds(a_path)._bpe.encode_ordinary if self.a.normalizer is None else None
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        char_byte = {c: b for b, c in BYTE_CHAR.items()}
        vocab = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.a_bytes = [bytes(char_byte[c] for c in vocab.get(i, "") if c in char_byte)
                        for i in range(max(vocab) + 1)]
        self.b_bytes = [bytes([int(self.b.id_to_piece(i)[3:-1], 16)]) if self.b.is_byte(i)
                        else self.b.id_to_piece(i).replace("▁", " ").encode()
                        for i in range(self.b.get_piece_size())]
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        if max(len(self.a_bytes), len(self.b_bytes)) > 1 << SHIFT:
            raise ValueError(f"ids of {SHIFT} bits at most")
        # How an id is written before each separator; one table, indexed by id and kind.
        self.names = [f"{i}{sep}" for n, seps in ((len(self.a_bytes), ",|"),
                                                  (len(self.b_bytes), ",;"))
                      for sep in seps for i in range(n)]

        # B's tokens never cross from another character to a space, and A's pattern cuts there
        # unless white space lies on both sides: texts may be encoded unit by unit at single
        # spaces if no unit begins or ends with white space.
        self.by_unit = not any("▁" in self.b.id_to_piece(i).lstrip("▁")
                               for i in range(self.b.get_piece_size()))
        self.known: dict[str, tuple[bytes, bytes] | None] = {}

    def _fresh(self, texts: list[str], whole: bool) -> list[tuple[bytes, bytes] | None]:
        """(A ids, B ids) of each text by the libraries, or None where bytes differ or a part of
        a text cannot stand alone."""
        out, check_a = [], self.a.normalizer is not None   # byte-level, else A changes nothing
        for some in _chunks(texts, CHUNK):
            slow = [t for t in some if not (self.quick and t.isascii())]
            slow = iter(self.a.encode_batch_fast([" " + t for t in slow], add_special_tokens=False))
            for text, b in zip(some, self.b.encode(some, num_threads=1)):
                a = self.quick(" " + text) if self.quick and text.isascii() else next(slow).ids
                raw = (" " + text).encode()
                same = text and (whole or not (text[0].isspace() or text[-1].isspace())) \
                    and b"".join([self.b_bytes[i] for i in b]) == raw \
                    and (not check_a or b"".join([self.a_bytes[i] for i in a]) == raw)
                out.append((array("i", a).tobytes(), array("i", b).tobytes()) if same else None)
        return out

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """Ids of each text by A and B; two empty arrays where bytes differ."""
        if len(self.known) > KNOWN:
            self.known = {}
        units = [t.split(" ") if self.by_unit else [""] for t in texts]
        new = list({u for us in units for u in us} - self.known.keys())
        known = dict(zip(new, self._fresh(new, False)))
        self.known.update((u, v) for u, v in known.items() if len(u) <= LONG)
        both = [None if "" in us else [known[u] if u in known else self.known[u] for u in us]
                for us in units]
        whole = [k for k, t in enumerate(texts) if t and (both[k] is None or None in both[k])]
        for k, v in zip(whole, self._fresh([texts[k] for k in whole], True)):
            both[k] = [v or (b"", b"")]
        ids = [tuple(np.frombuffer(b"".join([u[x] for u in us or ()]), "<i4") for x in (0, 1))
               for us in both]
        return [i[0] for i in ids], [i[1] for i in ids]


@lru_cache(maxsize=2)
def load(a_path: str, b_path: str) -> Tokenizers:
    return Tokenizers(a_path, b_path)


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(sizes)))


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... (size[0] numbers), first[1], ..."""
    return np.repeat(first - _starts(size)[:-1], size) + np.arange(int(size.sum()))


def lockstep(a_end: np.ndarray, a_first: np.ndarray, b_end: np.ndarray, b_first: np.ndarray):
    """Yields arrays (document, A tokens before the cut, B tokens before the cut) of cuts, each
    document's in order. ``a_end``/``b_end``: where each token ends in its document; tokens of
    document d are [first[d], first[d + 1])."""
    doc = np.flatnonzero(np.diff(a_first))               # the state: one lane a document
    at_a, at_b, stop = a_first[doc].copy(), b_first[doc].copy(), a_first[doc + 1]
    cuts, steps = [], 0
    while len(doc):
        ea, eb = a_end[at_a], b_end[at_b]
        meet = ea == eb
        at_a += ea <= eb
        at_b += eb <= ea
        cuts.append((doc[meet], at_a[meet], at_b[meet]))
        steps += 1
        through = at_a == stop                            # both end with the text
        through &= meet
        if through.any():
            keep = ~through
            doc, at_a, at_b, stop = doc[keep], at_a[keep], at_b[keep], stop[keep]
        if steps == STEPS or not len(doc):
            yield tuple(map(np.concatenate, zip(*cuts)))
            cuts, steps = [], 0


def _count(code: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sum of each one's times."""
    order = np.argsort(code, kind="stable")
    code = code[order]
    first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))[:len(code)])
    return code[first], np.add.reduceat(times[order], first) if len(first) else times[:0]


class Pairs:
    """Sums links by (document, pair) in bounded memory: parts are merged when they pile up."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, doc: np.ndarray, pair: np.ndarray, times: np.ndarray | None = None) -> None:
        code = doc << 40 | pair
        times = np.ones(len(code), np.int64) if times is None else times
        self.parts.append(_count(code, times))
        self.size += len(self.parts[-1][0])
        if self.size > 8 * LINKS:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if self.parts:
            code, times = map(np.concatenate, zip(*self.parts))
            self.parts = [_count(code, times)]
            self.size = len(self.parts[0][0]) // 2
            return self.parts[0]
        return np.zeros(0, np.int64), np.zeros(0, np.int64)


def _link(pairs: Pairs, doc, a, a_from, a_many, b, b_from, b_many) -> None:
    """Adds the links of groups: A tokens [a_from, + a_many) with B tokens [b_from, + b_many)."""
    links = a_many * b_many
    large = links > LINKS
    for g in np.flatnonzero(large):
        ia, na = np.unique(a[a_from[g]:a_from[g] + a_many[g]], return_counts=True)
        ib, nb = np.unique(b[b_from[g]:b_from[g] + b_many[g]], return_counts=True)
        block = max(1, LINKS // len(ib))
        for k in range(0, len(ia), block):
            pair = (ia[k:k + block, None] << SHIFT | ib).ravel()
            pairs.add(np.full(len(pair), doc[g]), pair, (na[k:k + block, None] * nb).ravel())
    rest = np.flatnonzero(~large)
    ends = np.cumsum(links[rest])
    first = 0
    while first < len(rest):
        last = max(first + 1, int(np.searchsorted(
            ends, (ends[first - 1] if first else 0) + LINKS, "right")))
        g = rest[first:last]
        of_a = _ranges(a_from[g], a_many[g])              # each A token, repeated per B token
        many = np.repeat(b_many[g], a_many[g])
        of_b = _ranges(np.repeat(b_from[g], a_many[g]), many)
        pairs.add(np.repeat(doc[g], links[g]), np.repeat(a[of_a], many) << SHIFT | b[of_b])
        first = last


def align(a_ids: list, b_ids: list, a_size: np.ndarray, b_size: np.ndarray):
    """Aligns documents given by their ids. Returns (groups a document, links a document, (document
    of each group, its end among all A tokens, among all B tokens), pair starts, pairs, links
    per pair)."""
    n = len(a_ids)
    a, b = (np.concatenate(x).astype(np.int64) for x in (a_ids, b_ids))
    a_first = _starts(np.array([len(x) for x in a_ids], np.int64))
    b_first = _starts(np.array([len(x) for x in b_ids], np.int64))

    def ends(ids, size, first):
        end = _starts(size[ids])
        return end[1:] - np.repeat(end[first[:-1]], np.diff(first))

    pairs, groups, links = Pairs(), np.zeros(n, np.int64), np.zeros(n, np.int64)
    kept = []
    # The last cut of each document so far, among all tokens.
    a_last, b_last = a_first[:-1].copy(), b_first[:-1].copy()
    for doc, a_to, b_to in lockstep(ends(a, a_size, a_first), a_first,
                                    ends(b, b_size, b_first), b_first):
        order = np.argsort(doc, kind="stable")            # cuts come by step
        doc, a_to, b_to = doc[order], a_to[order], b_to[order]
        new = np.concatenate(([True], doc[1:] != doc[:-1]))[:len(doc)]
        a_from, b_from = np.empty_like(a_to), np.empty_like(b_to)
        a_from[1:], b_from[1:] = a_to[:-1], b_to[:-1]
        a_from[new], b_from[new] = a_last[doc[new]], b_last[doc[new]]
        end = np.concatenate((new[1:], [True]))[:len(doc)]
        a_last[doc[end]], b_last[doc[end]] = a_to[end], b_to[end]
        groups += np.bincount(doc, minlength=n)
        links += np.bincount(doc, (a_to - a_from) * (b_to - b_from), n).astype(np.int64)
        _link(pairs, doc, a, a_from, a_to - a_from, b, b_from, b_to - b_from)
        kept.append((doc, a_to, b_to))
    code, times = pairs.merge()
    cuts = tuple(map(np.concatenate, zip(*kept))) if kept else (np.zeros(0, np.int64),) * 3
    order = np.argsort(cuts[0], kind="stable")
    return (groups, links, tuple(c[order] for c in cuts),
            np.searchsorted(code >> 40, np.arange(n + 1)), code & ((1 << 40) - 1), times)


def group_strings(a_ids: list, b_ids: list, cuts: tuple, toks: Tokenizers) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document: ids of A and B of each group in order."""
    a, b = (np.concatenate(x).astype(np.int64) for x in (a_ids, b_ids))
    _, a_to, b_to = cuts
    # Every id is written with what follows it: a comma, or the end of its part of the group.
    a_name, b_name = a.copy(), b + 2 * len(toks.a_size)
    a_name[a_to - 1] += len(toks.a_size)
    b_name[b_to - 1] += len(toks.b_size)
    a_from, b_from = np.concatenate(([0], a_to[:-1])), np.concatenate(([0], b_to[:-1]))
    name = np.empty(len(a) + len(b), np.int64)
    name[np.arange(len(a)) + np.repeat(b_from, a_to - a_from)] = a_name
    name[np.arange(len(b)) + np.repeat(a_to, b_to - b_from)] = b_name
    first = _starts(np.array([len(x) + len(y) for x, y in zip(a_ids, b_ids)], np.int64)).tolist()
    write = toks.names.__getitem__
    return ["".join(map(write, name[i:j].tolist()))[:-1] for i, j in zip(first, first[1:])]


def align_documents(docs: DataFrame, a_path: str | None = None,
                    b_path: str | None = None) -> DataFrame:
    """Per document: row (unique), doc_id, numbers of tokens, groups and links, the groups as
    text, its distinct pairs (A id << 20 | B id) and the number of links of each."""
    def run(batches):
        toks = load(a_path or public_path(A_FILE), b_path or public_path(B_FILE))
        row = TaskContext.get().partitionId() << 36
        for batch in batches:
            # Documents of like length together, so that lanes end at about the same step.
            order = pc.sort_indices(pc.binary_length(batch.column("text")))
            batch, done = batch.take(order), 0
            ids = batch.column("doc_id")
            for texts in _chunks([t or "" for t in batch.column("text").to_pylist()], SLICE):
                a, b = toks.encode(texts)
                groups, links, cuts, first, pairs, times = align(a, b, toks.a_size, toks.b_size)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.arange(row, row + len(texts))), ids.slice(done, len(texts)),
                    pa.array([len(x) for x in a], pa.int64()),
                    pa.array([len(x) for x in b], pa.int64()), pa.array(groups), pa.array(links),
                    pa.array(group_strings(a, b, cuts, toks), pa.string()),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(pairs)),
                    pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(times))],
                    names=[c.split()[0] for c in ALIGNED.split(", ")])
                row, done = row + len(texts), done + len(texts)

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED))


def count_pairs(flat: DataFrame) -> DataFrame:
    """pair, n (documents that hold it) and best (1 if n is the highest of its A id)."""
    counts = flat.groupBy("pair").agg(F.count("*").alias("n"))
    # One row per A id, so bounded by the vocabulary (2^20 ids at most).
    top = counts.groupBy(F.shiftright("pair", SHIFT).alias("_a")).agg(F.max("n").alias("_top"))
    return (counts.join(F.broadcast(top), F.shiftright("pair", SHIFT) == F.col("_a"))
            .select("pair", "n", (F.col("n") == F.col("_top")).cast("long").alias("best")))


def link_counts(aligned: DataFrame, hot: int = HOT) -> DataFrame:
    """Adds n_best and count_sum to written rows of ``align_documents``."""
    flat = (aligned.select("row", F.explode(F.arrays_zip("pairs", "links")).alias("_p"))
            .select("row", F.col("_p.pairs").alias("pair"), F.col("_p.links").alias("links")))
    counts = write_stage(count_pairs(flat), "pair-counts")
    sizes = dict(counts.groupBy(F.floor(F.log2("n")).cast("int").alias("k"))
                 .agg(F.count("*").alias("m")).collect())      # at most 64 numbers
    least = max(sizes, default=0) + 1
    while least > 0 and sum(m for k, m in sizes.items() if k >= least - 1) <= hot:
        least -= 1
    often = F.floor(F.log2("n")) >= least
    frequent = F.broadcast(counts.filter(often))               # at most ``hot`` rows
    rare = flat.join(F.broadcast(counts.filter(often).select("pair")), "pair", "left_anti")
    each = [F.col("row"), (F.col("links") * F.col("best")).alias("b"),
            (F.col("links") * F.col("n")).alias("c")]
    sums = (flat.join(frequent, "pair").select(*each)
            .unionByName(rare.join(counts.filter(~often), "pair").select(*each))
            .groupBy("row").agg(F.sum("b").alias("n_best"), F.sum("c").alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (aligned.drop("pairs", "links").join(sums, "row", "left")
            .withColumn("n_best", F.coalesce("n_best", zero))
            .withColumn("count_sum", F.coalesce("count_sum", zero)))


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment figures of every document; its groups as a digest."""
    digest = F.when(F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise("")
    aligned = (align_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
               .withColumn("groups_sha256", digest).drop("groups"))
    return link_counts(write_stage(aligned, "aligned")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
