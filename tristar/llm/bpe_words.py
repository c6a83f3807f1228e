"""BPE encoding and decoding with word-end vocabularies.

Reads a tokenizer JSON file (byte-level BPE whose last symbol of a word carries a word-end
suffix; NFC, white space to spaces, lower case; special strings are matched in the raw
text first) and encodes whole texts.

A word is encoded over a *contiguous rank array*: its parts lie next to each other in a
list, and a second list holds the merge rank of each adjacent pair. The smallest rank is
found by a scan, its boundary is deleted and the two neighbouring ranks are looked up
again, until no pair can merge. Scanning is fastest for short words; words over
``SHORT`` parts (rare, but unbounded) keep the same ranks in a heap over linked parts,
with the same result. Words are independent, so their encodings are remembered per
Python worker in a bounded memo. Decoding joins the tokens' strings with spaces, as the
library does for files without a decoder.

Defined results: null and empty texts encode to no ids and decode to an empty text; rows
are returned one for one, repeated ids included; extra columns are not read.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm.memo import Memo

SHORT = 48
NO_RANK = 1 << 60
BATCH = 1 << 23        # bytes of output per Arrow batch
# Fixed values of the file format: the byte to character table of byte-level BPE keeps
# printable Latin-1 characters and moves the other bytes, in order, to 256 and up.
_KEPT = [*range(33, 127), *range(161, 173), *range(174, 256)]
_MOVED = [b for b in range(256) if b not in set(_KEPT)]
BYTE_CHAR = {b: chr(b) for b in _KEPT} | {b: chr(256 + i) for i, b in enumerate(_MOVED)}
# str.split() also splits at these four, which the pattern \s does not match.
_NOT_WHITE = regex.compile("[\x1c-\x1f]")


class WordBpe:
    """One vocabulary file, ready to encode."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        vocab, suffix = model["vocab"], model["end_of_word_suffix"]
        self.token = {i: t for t, i in vocab.items()}
        self.inner = [vocab[BYTE_CHAR[b]] for b in range(256)]
        self.last = [vocab[BYTE_CHAR[b] + suffix] for b in range(256)]
        # Merge ranks by pair: rank in the high bits, the merged token's id in the low 32.
        self.rank = {}
        for r, (a, b) in enumerate(m if isinstance(m, list) else m.split(" ")
                                   for m in model["merges"]):
            self.rank[vocab[a] << 32 | vocab[b]] = r << 32 | vocab[a + b]
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pieces = regex.compile(split["pattern"]["Regex"])
        self.newer = self._newer(path, split["pattern"]["Regex"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token.update({i: t for t, i in self.special.items()})
        self.mark = regex.compile("(" + "|".join(map(regex.escape, sorted(
            self.special, key=len, reverse=True))) + ")") if self.special else None
        self.piece = Memo(self._piece, 200_000)
        self.unit = Memo(self._unit, 300_000)

    @staticmethod
    def _newer(path: str, pattern: str):
        """Normalizes and splits units holding characters that this Python's Unicode
        tables do not know yet, by the tables of the tokenizers library."""
        import tokenizers
        normalizer = tokenizers.Tokenizer.from_file(path).normalizer
        split = tokenizers.pre_tokenizers.Split(tokenizers.Regex(pattern), "removed", invert=True)
        return lambda unit: [p for p, _ in split.pre_tokenize_str(normalizer.normalize_str(unit))]

    def merge(self, ids: list[int]) -> list[int]:
        """Ids of a word given the ids of its single symbols."""
        return self._scan(ids) if len(ids) <= SHORT else self._heap(ids)

    def _scan(self, part: list[int]) -> list[int]:
        rank = self.rank
        near = [rank.get(a << 32 | b, NO_RANK) for a, b in zip(part, part[1:])]
        while near:
            low = min(near)
            if low == NO_RANK:
                break
            i = near.index(low)
            part[i] = low & 0xFFFFFFFF
            del part[i + 1], near[i]
            if i:
                near[i - 1] = rank.get(part[i - 1] << 32 | part[i], NO_RANK)
            if i < len(near):
                near[i] = rank.get(part[i] << 32 | part[i + 1], NO_RANK)
        return part

    def _heap(self, part: list[int]) -> list[int]:
        rank, n = self.rank, len(part)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        queue = [(r, i, a, b) for i, (a, b) in enumerate(zip(part, part[1:]))
                 if (r := rank.get(a << 32 | b)) is not None]
        heapq.heapify(queue)
        part = list(part)
        while queue:
            r, i, a, b = heapq.heappop(queue)
            j = right[i]
            if part[i] != a or j >= n or part[j] != b:
                continue  # one of the two parts has changed since
            part[i], part[j] = r & 0xFFFFFFFF, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (q := rank.get(part[x] << 32 | part[y])) is not None:
                    heapq.heappush(queue, (q, x, part[x], part[y]))
        return [p for p in part if p >= 0]

    def _piece(self, piece: str) -> list[int]:
        raw = piece.encode()
        ids = [self.inner[b] for b in raw[:-1]]
        ids.append(self.last[raw[-1]])
        return self.merge(ids)

    def _unit(self, unit: str) -> tuple[bytes, str]:
        """Ids (little-endian) and decoded tokens of a run without white space."""
        if not unit.isascii() and any(unicodedata.category(c) == "Cn" for c in unit):
            found = self.newer(unit)
        else:
            unit = unit.lower() if "Σ" not in unit else "".join(c.lower() for c in unit)
            found = [unit] if unit.isalpha() else self.pieces.findall(unit)
        ids = [i for p in found for i in self.piece[p]]
        return (np.array(ids, "<u4").tobytes(), " ".join(map(self.token.__getitem__, ids)))

    def encode(self, text: str) -> tuple[bytes, str]:
        """Ids as little-endian unsigned 32-bit integers, and their decoded text."""
        parts = self.mark.split(text) if self.mark and "<" in text else [text]
        got = []
        for i, part in enumerate(parts):
            if i % 2:
                got.append((np.array([self.special[part]], "<u4").tobytes(), part))
                continue
            if not part.isascii():
                part = unicodedata.normalize("NFC", part)
            units = part.split() if not _NOT_WHITE.search(part) else regex.split(r"\s+", part)
            got += [u for u in map(self.unit.__getitem__, units) if u[0]]
        return b"".join([g[0] for g in got]), " ".join([g[1] for g in got])

    def decode(self, ids: bytes) -> str:
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def public_path(name: str) -> str:
    """Place of an installed vocabulary file, looked up where the task runs."""
    import public_tokenizers
    return public_tokenizers.path(name)


def encode_texts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, the ids (binary, little-endian unsigned 32-bit) and the decoded text of
    every document. ``path``: the vocabulary file; default ``word_bpe_49k.json``."""
    def run(batches):
        bpe = load(path or public_path("word_bpe_49k.json"))
        for b in batches:
            ids, out, first, size = [], [], 0, 0
            for k, text in enumerate(b.column("text")):
                i, d = bpe.encode(text.as_py() or "")
                ids.append(i)
                out.append(d)
                size += len(i) + len(d)
                if size > BATCH or k + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").slice(first, k + 1 - first), pa.array(ids, pa.binary()),
                         pa.array(out, pa.string())], names=["doc_id", "ids", "decoded"])
                    ids, out, first, size = [], [], k + 1, 0

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, decoded string"))


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    return (encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
            .select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256")))
