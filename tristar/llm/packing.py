"""Packing: shortest-pack-first over the length histogram.

Documents are tokenized and cut into pieces of at most ``size`` tokens. Only the histogram
of piece lengths (at most ``size`` numbers) decides how sequences look: going through the
lengths from the longest to the shortest, all pieces of one length are placed at once into
the shortest open packs that still have room, which changes the counts of *packing
patterns* (a multiset of lengths, and how many sequences look like it). Each step either
finishes a length or uses up a pattern whole, so there are at most ``2 * size`` patterns,
whatever the number of documents. Patterns are joined back to pieces by rank: the r-th
piece of a length takes the r-th place that the patterns offer that length.

Ranks need no global sort: a piece's rank is its position among the pieces of its length
in its own input partition, plus the number of such pieces in the partitions before it.
The pieces (with partition and position) are written once to the shared folder, so ranks
stay the same if executors are lost later. No length is a hot group: pieces of the most
common length are spread over all partitions.

Defined results: null and empty texts hold only the closing id 0; repeated rows are packed
each on their own; an empty table gives no rows; extra columns are not read.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tristar.llm.bpe_words import BYTE_CHAR, public_path
from tristar.llm.memo import Memo
from tristar.session import write_stage

SIZE = 1024
# Fixed value: how byte-level BPE of this family splits a text before merging.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
PIECE = ("doc_id long, start long, length int, ids_crc32 long, doc_tokens long, part int, "
         "place long")


class ByteIds:
    """Ids of a byte-level BPE file as little-endian unsigned 32-bit integers.

    ``encode`` splits at single spaces and line feeds, whose surroundings cannot change the
    split pattern's result, and remembers each unit; a text with runs of white space, or
    with a special string, is encoded as one unit.
    """

    def __init__(self, path: str):
        import tiktoken
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        char_byte = {c: b for b, c in BYTE_CHAR.items()}
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(char_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items()
                 if t not in special}
        merges = (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])
        ids = [spec["model"]["vocab"][a + b] for a, b in merges]
        if ids != sorted(ids):
            raise ValueError("the vocabulary's ids do not follow its merge order")
        self._bpe = tiktoken.Encoding("file", pat_str=SPLIT, mergeable_ranks=ranks,
                                      special_tokens=special)
        self._special = set(special)
        self._unit = Memo(lambda u: self._ids(u if u[0] == "\n" else " " + u), 400_000)
        self._first = Memo(self._ids, 50_000)

    def _ids(self, text: str) -> bytes:
        if any(s in text for s in self._special):
            ids = self._bpe.encode(text, allowed_special=self._special, disallowed_special=())
        else:
            ids = self._bpe.encode_ordinary(text)
        return array("I", ids).tobytes()

    def encode(self, text: str) -> bytes:
        units = text.replace("\n", " \n").split(" ")
        if "" in units or "\n" in units or any(s in text for s in self._special):
            return self._ids(text)
        return b"".join([self._first[units[0]], *map(self._unit.__getitem__, units[1:])])


@lru_cache(maxsize=2)
def load(path: str) -> ByteIds:
    return ByteIds(path)


def cut(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """The pieces of every document: id, first token, length, checksum of the ids, tokens of
    the document, and place among the pieces of that length in that input partition."""
    def run(batches):
        bpe = load(path or public_path("byte_bpe_50k.json"))
        seen, part = np.zeros(size + 1, np.int64), TaskContext.get().partitionId()
        for b in batches:
            rows = []
            for doc, text in zip(b.column("doc_id").to_pylist(), b.column("text")):
                ids = bpe.encode(text.as_py() or "") + b"\0\0\0\0"
                n = len(ids) // 4
                for at in range(0, n, size):
                    piece = ids[4 * at:4 * (at + size)]
                    k = len(piece) // 4
                    rows.append((doc, at, k, zlib.crc32(piece), n, part, int(seen[k])))
                    seen[k] += 1
            cols = list(zip(*rows)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(),
                     pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, types)],
                names=[c.split()[0] for c in PIECE.split(", ")])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text")).mapInArrow(run, PIECE))


def patterns(histogram: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Packing patterns [(lengths, longest first), number of sequences] for a histogram
    {length: pieces}: shortest pack first, longest length first."""
    open_packs: dict[int, list[tuple[list[int], int]]] = defaultdict(list)  # by room left
    done: list[tuple[list[int], int]] = []

    def put(pack: list[int], count: int, room: int) -> None:
        (open_packs[room].append if room else done.append)((pack, count))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r, packs in open_packs.items() if packs and r >= length), default=0)
            if not room:
                put([length], left, size - length)
                break
            pack, count = open_packs[room].pop()
            used = min(count, left)
            if count > used:
                open_packs[room].append((pack, count - used))
            put([*pack, length], used, room - length)
            left -= used
    return done + [p for packs in open_packs.values() for p in packs]


class Places:
    """Where the r-th piece of a length goes. Each pattern's run of one length is an interval
    of ranks; at most (patterns x distinct lengths in a pattern) intervals exist."""

    def __init__(self, found: list[tuple[list[int], int]]):
        first, taken = 0, defaultdict(int)
        runs: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        for pack, count in found:
            at = 0
            for length in dict.fromkeys(pack):
                times = pack.count(length)
                runs[length].append((taken[length], first, times, at))
                taken[length] += times * count
                at += times * length
            first += count
        self.runs = {k: np.array(v, np.int64).T for k, v in runs.items()}

    def find(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset in it) of each piece."""
        seq, off = np.zeros(len(rank), np.int64), np.zeros(len(rank), np.int64)
        order = np.argsort(length, kind="stable")
        for g in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            if len(g):
                k = int(length[g[0]])
                start, first, times, at = self.runs[k]
                i = np.searchsorted(start, rank[g], "right") - 1
                local = rank[g] - start[i]
                seq[g] = first[i] + local // times[i]
                off[g] = at[i] + local % times[i] * k
        return seq, off


def pack(pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """Adds sequence_id and offset to written pieces (see cut)."""
    count = pieces.groupBy("part", "length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in
                 pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    places = Places(patterns(histogram, size))
    before = (Window.partitionBy("length").orderBy("part")
              .rowsBetween(Window.unboundedPreceding, -1))
    base = count.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0))
                        .alias("before"))
    ranked = (pieces.join(base, ["part", "length"])
              .withColumn("rank", F.col("before") + F.col("place")))
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]

    def place(batches):
        for b in batches:
            seq, off = places.find(b.column("length").to_numpy(), b.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in columns), pa.array(seq), pa.array(off)],
                names=[*columns, "sequence_id", "offset"])

    return (ranked.select(*columns, "rank").mapInArrow(
        place, "doc_id long, start long, length int, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long")
        .withColumn("length", F.col("length").cast("long")))


def pack_documents(docs: DataFrame, path: str | None = None, size: int = SIZE) -> DataFrame:
    """Every piece of every document with its sequence and offset."""
    return pack(write_stage(cut(docs, path, size), "pieces"), size)


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
