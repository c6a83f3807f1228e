"""Vectorised views of a batch of texts: words, lines, word shingles and their hashes.

Every operator that reads words works on one concatenated byte buffer per block of
documents, so the cost is a few numpy passes per byte and no Python loop over words.
A *word* is a maximal run of bytes that are none of space, tab, line feed, vertical tab,
form feed and carriage return; words never cross documents. Hashes are 64-bit.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the byte polynomial
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# Letters and digits of ASCII and every byte of a longer UTF-8 sequence.
_ALNUM = np.zeros(256, bool)
_ALNUM[128:] = True
_ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """The first n powers of the multiplier (kept between calls, grown on demand)."""
    global _powers
    if len(_powers) < n:
        m = max(n, 2 * len(_powers))
        p = np.full(m, _BASE, np.uint64)
        p[0] = 1
        _powers = np.multiply.accumulate(p)
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the word (a bijection of uint64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def constant(k: int) -> np.uint64:
    """A well spread constant for each small k."""
    return np.uint64(k * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string array; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    body = texts.buffers()[2]
    data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def blocks(texts: pa.Array, limit: int = 1 << 18) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of whole texts of about ``limit`` bytes: (first row, end row, bytes, offsets).
    A text longer than the limit is a block of its own."""
    data, off = buffers(texts)
    n, i = len(off) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + limit, "right")) - 1)
        yield i, j, data[off[i]:off[j]], off[i:j + 1] - off[i]
        i = j


def per_text(flags: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Sum of a per-byte (or per-word) array over each text."""
    c = np.concatenate([np.zeros(1, np.int64), np.cumsum(flags, dtype=np.int64)])
    return c[off[1:]] - c[off[:-1]]


def characters(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(one number per code point, offsets per text): its UTF-8 bytes read as a number."""
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    value = data[at].astype(np.uint64)
    size = np.diff(np.append(at, len(data)))
    for j in range(1, int(size.max(initial=1))):
        more = np.flatnonzero(size > j)
        value[more] = (value[more] << np.uint64(8)) | data[at[more] + j]
    return value, np.concatenate([[0], np.cumsum(lead)])[off]


@dataclass
class Words:
    start: np.ndarray  # byte position of each word in the block
    end: np.ndarray
    off: np.ndarray    # first word of each text, and the number of words

    @property
    def text(self) -> np.ndarray:
        """Index of the text each word belongs to."""
        return np.repeat(np.arange(len(self.off) - 1), np.diff(self.off))


def words(data: np.ndarray, off: np.ndarray, inside: np.ndarray | None = None) -> Words:
    """Word spans. ``inside``: which byte values belong to words (default: non-space)."""
    keep = ~_SPACE[data] if inside is None else inside[data]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[off] = True
    prev = np.concatenate([[False], keep[:-1]]) if n else keep
    start = np.flatnonzero(keep & (~prev | cut[:-1]))
    nxt = np.concatenate([keep[1:], [False]]) if n else keep
    end = np.flatnonzero(keep & (~nxt | cut[1:])) + 1
    return Words(start, end, np.searchsorted(start, off))


def tokens(data: np.ndarray, off: np.ndarray) -> Words:
    """Like words(), without ASCII punctuation: runs of letters and digits."""
    return words(data, off, _ALNUM)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each non-overlapping, ascending byte span; empty spans hash to mix(0)."""
    out = np.zeros(len(start), np.uint64)
    size = end - start
    full = np.flatnonzero(size > 0)
    if len(full):
        size = size[full]
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        at = within + np.repeat(start[full], size)
        pw = powers(int(size.max()) + 1)
        out[full] = np.add.reduceat((data[at].astype(np.uint64) + np.uint64(1)) * pw[within], first)
    return mix(out)


def lines(data: np.ndarray, off: np.ndarray) -> Words:
    """Spans of the lines of each text, split at line feeds (always at least one)."""
    feeds = np.flatnonzero(data == 0x0A)
    owner = np.searchsorted(off, feeds, "right") - 1
    start = np.concatenate([off[:-1], feeds + 1])
    end = np.concatenate([off[1:], feeds])
    s_order = np.lexsort((start, np.concatenate([np.arange(len(off) - 1), owner])))
    e_order = np.lexsort((end, np.concatenate([np.arange(len(off) - 1), owner])))
    count = 1 + np.bincount(owner, minlength=len(off) - 1)
    return Words(start[s_order], end[e_order], np.concatenate([[0], np.cumsum(count)]))


def shingles(h: np.ndarray, off: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words within each group of words, and their group offsets.
    A group with one to k-1 words has one shingle of all its words; an empty one has none."""
    n = np.diff(off)
    total = len(h)
    m = np.where(n >= k, n - k + 1, (n > 0).astype(n.dtype))
    soff = np.concatenate([[0], np.cumsum(m)])
    if total == 0:
        return np.zeros(0, np.uint64), soff
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    group = np.repeat(np.arange(len(n)), m)
    at = np.arange(int(soff[-1])) - soff[group] + off[:-1][group]
    size = np.minimum(n, k)[group]
    out = np.zeros(len(at), np.uint64)
    pw = powers(k + 1)
    for j in range(k):
        out += np.where(j < size, padded[at + j] * pw[j], np.uint64(0))
    return mix(out), soff


def unique_per_group(h: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of each group: (values, group offsets, how often each occurs)."""
    group = np.repeat(np.arange(len(off) - 1), np.diff(off))
    order = np.lexsort((h, group))
    h, group = h[order], group[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (group[1:] != group[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.concatenate([first, [len(h)]]))
    return h[first], np.searchsorted(group[first], np.arange(len(off))), count
