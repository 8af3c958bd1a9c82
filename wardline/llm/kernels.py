"""Vectorised word, line and window hashing over Arrow batches of UTF-8 text.

A *word* is a maximal run of bytes outside ``\\x20 \\x09-\\x0D`` (all of them
ASCII, so the rule on bytes equals the rule on code points).  Every hash is
a 64-bit polynomial hash over random per-byte values, computed for a whole
block of documents with a handful of numpy passes; it does not depend on
where the word stands.  Blocks are cut at document boundaries.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20         # bytes hashed at once; a longer document is a block of its own

U64 = np.uint64
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = U64(0x5851F42D4C957F2D)      # odd multipliers
_WORD_BASE = U64(0x2545F4914F6CDD1D)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
SYMBOL = np.zeros(256, bool)
SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
NEWLINE = 0x0A

_LOWER = np.arange(256)
_LOWER[ord("A"):ord("Z") + 1] += 32
BYTE_EXACT = _BYTE
BYTE_LOWER = _BYTE[_LOWER]                      # A-Z hash as a-z
_FOLD = _LOWER.copy()
_FOLD[ord("0"):ord("9") + 1] = ord("0")
BYTE_FOLDED = _BYTE[_FOLD]                      # A-Z as a-z and every digit as 0


def _inverse(odd: np.uint64) -> np.uint64:
    return U64(pow(int(odd), -1, 1 << 64))


class Powers:
    """Growing tables of base**j and base**-j modulo 2**64."""

    def __init__(self, base: np.uint64):
        self.base, self.inv = base, _inverse(base)
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            up, down = np.full(size, self.base), np.full(size, self.inv)
            up[0] = down[0] = 1
            self.up, self.down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        return self.up[:n], self.down[:n]


_P, _Q = Powers(_BASE), Powers(_WORD_BASE)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads polynomial hashes over all 64 bits."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Polynomial hash of ``values[start:end]`` for every span, mixed with the length."""
    n = len(values)
    if n == 0 or len(starts) == 0:
        return np.zeros(len(starts), U64)
    up, down = powers.get(n + 1)
    total = np.zeros(n + 1, U64)
    np.cumsum(values * up[:n], out=total[1:])
    h = (total[ends] - total[starts]) * down[starts]
    return mix(h + (ends - starts).astype(U64) * U64(0x9E3779B97F4A7C15))


def byte_span_hash(byte_values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(byte_values, starts, ends, _P)


def word_span_hash(word_hash: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(word_hash, starts, ends, _Q)


def window_hash(word_hash: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive word hashes (entry i: words i .. i+k-1)."""
    m = len(word_hash) - k + 1
    if m <= 0:
        return np.zeros(0, U64)
    starts = np.arange(m)
    return span_hash(word_hash, starts, starts + k, _Q)


@dataclass
class Block:
    """Words of some documents. ``doc`` is the document's index within the block."""

    data: np.ndarray          # bytes of all documents
    bounds: np.ndarray        # document i is data[bounds[i]:bounds[i+1]]
    starts: np.ndarray        # words, in order
    ends: np.ndarray
    doc: np.ndarray
    first: np.ndarray         # words of document i are first[i] .. first[i+1]-1
    rows: slice               # rows of the batch

    def word_hash(self, table: np.ndarray = BYTE_EXACT) -> np.ndarray:
        return span_hash(table[self.data], self.starts, self.ends, _P)

    def windows(self, word_hash: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(index of the first word, hash) of the windows that stay within a document."""
        h = window_hash(word_hash, k)
        at = np.flatnonzero(self.doc[: len(h)] == self.doc[k - 1:][: len(h)]) if len(h) else np.zeros(0, np.int64)
        return at, h[at]


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a binary or string array; null counts as empty."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset: column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data, offsets


def blocks(column: pa.Array, block_bytes: int = BLOCK_BYTES) -> Iterator[Block]:
    """Word spans of the documents of a column, in blocks of about ``block_bytes``."""
    data, offsets = text_buffers(column)
    n, i = len(column), 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + block_bytes, "right")) - 1)
        j = min(j, n)
        yield _block(data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i], slice(i, j))
        i = j


def _block(data: np.ndarray, bounds: np.ndarray, rows: slice) -> Block:
    is_word = ~SPACE[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True                                   # a document's first byte follows a break
    before = np.concatenate(([False], is_word))[:-1] if len(data) else is_word
    starts = np.flatnonzero(is_word & (~before | cut[:-1]))
    after = np.concatenate((is_word[1:], [False])) if len(data) else is_word
    ends = np.flatnonzero(is_word & (~after | cut[1:])) + 1
    first = np.searchsorted(starts, bounds)
    doc = np.repeat(np.arange(len(bounds) - 1), np.diff(first))
    return Block(data, bounds, starts, ends, doc, first, rows)


def signed(h: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return h.view(np.int64)


def per_doc(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def batch(names: list[str], arrays: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([a if isinstance(a, pa.Array) else pa.array(a) for a in arrays], names=names)


def give_back() -> None:
    """Return freed memory to the system.

    Workers are used again by the next stage, whose needs would come on top of
    what Arrow's pool and the allocator still hold of the last one.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):      # not glibc
        pass


def lean(step):
    """``step`` over batches, whose worker gives freed memory back when its task ends."""
    def run(batches):
        yield from step(batches)
        give_back()

    return run
