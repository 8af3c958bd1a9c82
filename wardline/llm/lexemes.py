"""Word spans under any byte rule, exact local dictionaries, and a bounded sieve of hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import kernels as K

SIEVE_BITS = 1 << 25      # 4 MB whatever the input; a fuller sieve lets more through and never loses a member

CHUNK = 1 << 12

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    table = np.zeros(256, bool)
    for lo, hi in ranges:
        table[lo: hi + 1] = True
    return table


def word_spans(data: np.ndarray, bounds: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of ``inside`` bytes within a document."""
    is_word = inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[bounds] = True
    starts, ends = is_word.copy(), is_word.copy()
    starts[1:] &= ~is_word[:-1] | cut[1:-1]
    ends[:-1] &= ~is_word[1:] | cut[1:-1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def dictionary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               inside: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """(number of each word, distinct words); compares the words themselves, not hashes."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets), pa.py_buffer(data[inside[data]])]).dictionary_encode()
    return words.indices.to_numpy(), words.dictionary


def word_hashes(words: pa.Array) -> np.ndarray:
    data, offsets = K.text_buffers(words)
    return K.byte_span_hash(K.BYTE_EXACT[data], offsets[:-1], offsets[1:])


def _chunk(table: pa.Table) -> pa.Table:
    words = np.zeros(CHUNK, np.int64)
    at = table.column("word").to_numpy()
    words[at % CHUNK] = table.column("bits").to_numpy()
    return pa.table({"chunk": pa.array([at[0] // CHUNK], pa.int64()), "words": pa.array([words.tobytes()], pa.binary())})


def sieve(spark: SparkSession, hashes: DataFrame, bits: int = SIEVE_BITS):
    """Broadcast bitmap of a column of hashes: ``bits`` bits, fetched as chunks of ``CHUNK`` longs."""
    cell = F.pmod(hashes[hashes.columns[0]], F.lit(bits))
    words = (hashes.select(cell.alias("c")).groupBy(F.expr("c div 64").alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(c % 64 as int)))").alias("bits")))
    chunks = words.groupBy(F.expr(f"word div {CHUNK}")).applyInArrow(_chunk, "chunk long, words binary")
    table = np.zeros(max(bits // 64, CHUNK), np.int64)
    for row in chunks.collect():
        table[row["chunk"] * CHUNK: (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["words"], np.int64)
    return spark.sparkContext.broadcast(table)


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each hash may be in the sieve (members always are)."""
    cell = np.mod(K.signed(hashes), np.int64(64 * len(table)))          # bits are a power of two
    return (table[cell >> 6] >> (cell & 63)) & 1 == 1
