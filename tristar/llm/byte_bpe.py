"""Byte-level BPE encoding and decoding by longest matches and backtracking.

Bytes are mapped to Latin-1 characters, so that every token of the vocabulary is a word of
one Aho-Corasick automaton over text (``pyahocorasick``). A match of the split pattern is
encoded on its own:

1. one run of the automaton over the match gives its longest tokens from left to right, which
   are the encoding if neighbours are compatible; otherwise a second run names, for each
   place, the longest token that starts there;
2. going from left to right, the longest token is tried first, then shorter ones. A token may
   follow the one before only if the two are *compatible*: merging the bytes of both by rank
   gives just these two tokens again. A sequence is the result of merging by rank if and only
   if all its neighbours are compatible, so nothing else has to be checked;
3. if no token at a place is compatible, the token before is taken back and the place is
   marked as one that no encoding reaches. Each place is marked at most once and each token
   is tried a bounded number of times a place, so the work is linear in the bytes.

Compatibility depends on two tokens only and is remembered per Python worker in a bounded
memo, like the encoding of whole matches. A match that is itself a token is that token.

Defined results: null and empty texts encode to no ids and decode to no bytes; rows come
back one for one, repeated ids included, whatever the length of a text; ties cannot occur (the
encoding is unique); an empty table gives no rows; extra columns are not read. Strings that
look like special tokens are plain text.
"""

from __future__ import annotations

import base64
import unicodedata
from array import array
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tristar.llm.bpe_words import public_path
from tristar.llm.memo import Memo
from tristar.llm.packing import SPLIT

FILE = "byte_bpe_50k.tiktoken"
BATCH = 1 << 23        # bytes of output per Arrow batch
LONG = 256             # longer matches of the pattern are not remembered


def read_ranks(path: str) -> dict[bytes, int]:
    """{token bytes: rank} of a file with one base64 token and its rank per line."""
    with open(path, "rb") as f:
        lines = (line.split() for line in f)
        return {base64.b64decode(p[0]): int(p[1]) for p in lines if p}


class ByteBpe:
    """One vocabulary with the pattern that splits texts, ready to encode and decode."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        self.ranks, self.pattern = ranks, pattern
        self.token = {i: b for b, i in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing or len(self.token) != len(ranks):
            raise ValueError("the vocabulary must hold every single byte, and each rank once")
        self.split = regex.compile(pattern)
        self.by_unit = pattern == SPLIT
        self.automaton = ahocorasick.Automaton()
        for b, i in ranks.items():
            self.automaton.add_word(b.decode("latin-1"), (i, len(b) - 1))
        self.automaton.make_automaton()
        # The next shorter token that starts the same way; -1 for single bytes.
        self.shorter = {i: next((ranks[b[:k]] for k in range(len(b) - 1, 0, -1)
                                 if b[:k] in ranks), -1) for b, i in ranks.items()}
        self.size = {i: len(b) for b, i in ranks.items()}
        self.compatible = Memo(self._compatible, 500_000)
        self.match = Memo(self._match, 200_000)
        self.unit = Memo(self._unit, 500_000)
        self.stand_in = Memo(self._stand_in, 50_000)

    def merge(self, raw: bytes) -> list[int]:
        """Plain merging by rank, for the few bytes of two tokens."""
        get, none = self.ranks.get, 1 << 60
        part = [raw[i:i + 1] for i in range(len(raw))]
        near = [get(a + b, none) for a, b in zip(part, part[1:])]
        while near:
            low = min(near)
            if low == none:
                break
            i = near.index(low)
            part[i] += part[i + 1]
            del part[i + 1], near[i]
            if i:
                near[i - 1] = get(part[i - 1] + part[i], none)
            if i < len(near):
                near[i] = get(part[i] + part[i + 1], none)
        return [self.ranks[p] for p in part]

    def _compatible(self, pair: int) -> bool:
        a, b = pair >> 32, pair & 0xFFFFFFFF
        both = self.token[a] + self.token[b]
        return both not in self.ranks and self.merge(both) == [a, b]

    def encode_match(self, raw: bytes) -> list[int]:
        """Ids of one match of the split pattern, by backtracking."""
        n, size, shorter, compatible = len(raw), self.size, self.shorter, self.compatible
        chars = raw.decode("latin-1")
        ids = [i for _, (i, _) in self.automaton.iter_long(chars)]
        last = -1                                     # longest matches only: often the encoding
        for i in ids:
            if last >= 0 and not compatible[last << 32 | i]:
                break
            last = i
        else:
            return ids
        longest = [-1] * (n + 1)                      # at each place: the longest token
        for end, (i, back) in self.automaton.iter(chars):
            longest[end - back] = i                   # ends go up, so the last is longest
        shut = bytearray(n + 1)                       # 1: no encoding has a cut here
        ids = []
        at, last, i = 0, -1, longest[0]
        while at < n:
            while i >= 0 and (shut[at + size[i]] or last >= 0 and not compatible[last << 32 | i]):
                i = shorter[i]
            if i < 0:                                 # nothing fits: take the last one back
                shut[at] = 1
                i = ids.pop()
                at -= size[i]
                last = ids[-1] if ids else -1
            else:
                ids.append(i)
                at += size[i]
                last, i = i, longest[at]
        return ids

    def _match(self, match: str) -> bytes:
        raw = match.encode()
        whole = self.ranks.get(raw)
        return array("I", self.encode_match(raw) if whole is None else (whole,)).tobytes()

    def _stand_in(self, c: str) -> str:
        """The character itself, or for one that this Python's Unicode tables do not know
        yet, a character of the class that the tokenizer library's tables give it."""
        if unicodedata.category(c) != "Cn":
            return c
        import tiktoken
        ranks = {bytes([b]): b for b in range(256)}
        ranks |= {("é" + c).encode(): 256, ("1" + c).encode(): 257}
        probe = tiktoken.Encoding("probe", pat_str=self.pattern, mergeable_ranks=ranks,
                                  special_tokens={})
        return next((kind for kind in "é1" if len(probe.encode_ordinary(kind + c)) == 1), "!")

    def matches(self, text: str) -> list[str]:
        """The matches of the split pattern, which cover the text."""
        if not text.isascii():
            other = {ord(c): s for c in set(text) if c > "\x7f" and (s := self.stand_in[c]) != c}
            if other:
                return [text[m.start():m.end()]
                        for m in self.split.finditer(text.translate(other))]
        return self.split.findall(text)

    def _whole(self, text: str) -> bytes:
        match, keep = self._match, self.match
        return b"".join([keep[m] if len(m) <= LONG else match(m) for m in self.matches(text)])

    def _unit(self, unit: str) -> bytes | None:
        """Ids of a unit after a space or from its line feed on; None if it cannot stand alone."""
        text, core = (unit, unit[1:]) if unit[:1] == "\n" else (" " + unit, unit)
        if not core or core[0].isspace() or core[-1].isspace():
            return None
        if core is unit and core.isalpha():               # a word is one match
            return self.match[text] if len(text) <= LONG else self._match(text)
        return self._whole(text)

    def encode(self, text: str) -> bytes:
        """Ids of a text as little-endian unsigned 32-bit integers.

        No match of the pattern runs from other characters into white space, and a single
        space or line feed between other characters belongs to what follows; so texts are
        split there first, and units remembered, unless white space comes in runs."""
        if not self.by_unit:
            return self._whole(text)
        units = text.replace("\n", " \n").split(" ")
        unit, keep = self._unit, self.unit
        ids = [keep[u] if len(u) <= LONG else unit(u) for u in units[1:]]
        if None in ids or units[0][-1:].isspace():
            return self._whole(text)
        return self._whole(units[0]) + b"".join(ids)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.token.__getitem__, array("I", ids)))


@lru_cache(maxsize=2)
def load(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(read_ranks(path), pattern)


def encode_texts(docs: DataFrame, path: str | None = None,
                 pattern: str | None = None) -> DataFrame:
    """doc_id, the ids (binary, little-endian unsigned 32-bit) and the decoded bytes of every
    document. ``path``: file of ranks, by default ``byte_bpe_50k.tiktoken`` where the task
    runs; ``pattern``: how texts are split, by default the public one of that file."""
    def run(batches):
        import public_tokenizers
        bpe = load(path or public_path(FILE), pattern or public_tokenizers.PATTERN)
        for b in batches:
            ids, out, first, size = [], [], 0, 0
            for k, text in enumerate(b.column("text")):
                i = bpe.encode(text.as_py() or "")
                ids.append(i)
                out.append(bpe.decode(i))
                size += len(i) + len(out[-1])
                if size > BATCH or k + 1 == b.num_rows:
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").slice(first, k + 1 - first),
                         pa.array(ids, pa.binary()), pa.array(out, pa.binary())],
                        names=["doc_id", "ids", "decoded"])
                    ids, out, first, size = [], [], k + 1, 0

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                        F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id long, ids binary, decoded binary"))


def decode_ids(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id and the bytes that a column ``ids`` (as ``encode_texts`` gives it) stands for."""
    def run(batches):
        import public_tokenizers
        bpe = load(path or public_path(FILE), public_tokenizers.PATTERN)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([bpe.decode(i.as_py() or b"")
                                               for i in b.column("ids")], pa.binary())],
                names=["doc_id", "decoded"])

    return (encoded.select(F.col("doc_id").cast("long").alias("doc_id"), "ids")
            .mapInArrow(run, "doc_id long, decoded binary"))


def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded bytes of every document."""
    return (encode_texts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
            .select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"),
                    F.sha2("decoded", 256).alias("decoded_sha256")))
