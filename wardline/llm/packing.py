"""Sum-of-squares packing of tokenized documents into sequences.

A document's ids (with the end id) form one piece; only documents longer than
a sequence are cut, into full pieces with the remainder as the first piece.
A full piece is a sequence by itself, so at most one piece per document needs
placing.  Pieces are dealt by hash into groups of about ``GROUP`` documents,
each packed by one task: from the longest piece to the shortest, a piece of
length s goes to the open residual gap g >= s for which the sum over all gaps
of (number of open sequences with that gap) squared becomes smallest; a new
sequence is opened when no open one has room.  N(g) is the count at gap g;
moving a sequence from g to g - s changes the sum by 2 (N(g-s) - N(g) + 1),
and filling it (g = s) by 1 - 2 N(s).

Defined results: null text counts as empty (its piece is the end id alone);
null or repeated ids are packed like any other row; an empty table gives an
empty result; extra columns are passed over.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm.tokens import tokenizer
from wardline.session import stored

GROUP = 8192            # documents packed by one task
SEQUENCES = 1 << 24     # sequence numbers kept apart for each group

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _cutter(path: str, end_id: int, capacity: int, with_ids: bool):
    def cut(batches):
        for rb in batches:
            for rows, ids, offsets in tokenizer(path, end_id).encode(rb.column(1)):
                n = np.diff(offsets)
                count = -(-n // capacity)
                doc = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
                head = n - (count - 1) * capacity               # length of the first piece
                start = np.where(piece == 0, 0, head[doc] + (piece - 1) * capacity)
                length = np.where(piece == 0, head[doc], capacity)
                raw = memoryview(ids.astype("<u4").tobytes())
                lo = 4 * (offsets[:-1][doc] + start)
                parts = [raw[a: b] for a, b in zip(lo.tolist(), (lo + 4 * length).tolist())]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                out = [rb.column(0)[rows].take(pa.array(doc)), piece.astype(np.int32), start, length,
                       pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                if with_ids:
                    names, out = [*names, "ids"], [*out, pa.array([bytes(p) for p in parts], pa.binary())]
                yield K.batch(names, out)

    return cut


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of every piece, by the sum of squares of the open gaps."""
    sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    count = np.zeros(capacity + 1, np.int64)
    used = 0
    for i in np.argsort(-lengths, kind="stable"):
        s = int(lengths[i])
        now = count[s:]
        change = 2 * (count[: capacity + 1 - s] - now + 1)
        change[0] = 1 - 2 * now[0]
        change[now == 0] = np.iinfo(np.int64).max
        j = int(change.argmin())
        if now[j]:
            gap = s + j
            bin_ = open_at[gap].pop()
            count[gap] -= 1
        else:
            gap, j, bin_ = capacity, capacity - s, used
            used += 1
        sequence[i], offset[i] = bin_, capacity - gap
        if j:
            open_at[j].append(bin_)
            count[j] += 1
    return sequence, offset


def _packer(capacity: int):
    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True])
        sequence, offset = place(rows["length"].to_numpy(np.int64), capacity)
        base = int(rows["group"].iloc[0]) * SEQUENCES
        return rows.drop(columns="group").assign(sequence_id=base + sequence, offset=offset)

    return pack


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
                   group: int = GROUP) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset[, ids].

    ``ids`` holds the piece's token ids as little-endian unsigned 32-bit integers.
    """
    schema = PIECE + (", ids binary" if with_ids else "")
    pieces = stored(docs.select(F.col(id_col).cast("long"), text_col)
                    .mapInArrow(K.lean(_cutter(tokenizer_path, end_id, capacity, with_ids)), schema), "pieces")
    groups = max(1, -(-pieces.where("piece = 0").count() // group))
    dealt = pieces.withColumn("group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    out = dealt.groupBy("group").applyInPandas(_packer(capacity), schema + ", sequence_id long, offset long")
    return out.withColumnRenamed("doc_id", id_col)
