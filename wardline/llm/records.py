"""Length-delimited binary record files of token ids, with an offset index.

A shard holds framed records, one per document, in ascending id order:

    u64 length | u32 masked checksum of the length | payload | u32 masked checksum of the payload

(little endian; the checksum is CRC-32, masked by rotating right by 15 bits and
adding 0xa282ead8).  The payload is: u8 flags (1: id is null, 2: 16-bit ids),
i64 document id, the ids.  ``shard-N.idx`` beside it holds, per record, the
u64 byte offset and u64 number of ids, so single records can be read in any
order.  Documents are range-partitioned by id before they are encoded; shard
numbers follow the ranges.  A retried task writes the same file again under a
temporary name and renames it.

Defined results: null text counts as empty (the end id alone); null ids come
first; repeated ids are neighbours; an empty table gives no shard and an empty
result; extra columns are passed over.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm.tokens import tokenizer
from wardline.session import scratch_path

HEAD, TAIL = struct.Struct("<QI"), struct.Struct("<I")
META = struct.Struct("<Bq")
NULL_ID, NARROW = 1, 2
READ_BYTES = 4 << 20


class CorruptRecord(ValueError):
    """A record whose length or payload does not match its checksum."""


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + 0xA282EAD8) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray) -> bytes:
    narrow = len(ids) == 0 or int(ids.max()) < 1 << 16
    flags = NULL_ID * (doc_id is None) | NARROW * narrow
    payload = META.pack(flags, doc_id or 0) + ids.astype("<u2" if narrow else "<u4").tobytes()
    length = struct.pack("<Q", len(payload))
    return length + TAIL.pack(masked(length)) + payload + TAIL.pack(masked(payload))


def parse(data: memoryview | bytes, at: int = 0) -> tuple[int | None, np.ndarray, int]:
    """(document id, ids, offset of the next record) of the record at ``at``."""
    length, check = HEAD.unpack_from(data, at)
    if masked(bytes(data[at: at + 8])) != check:
        raise CorruptRecord(f"length checksum at {at}")
    body = at + HEAD.size
    payload = bytes(data[body: body + length])
    if len(payload) != length or masked(payload) != TAIL.unpack_from(data, body + length)[0]:
        raise CorruptRecord(f"payload checksum at {at}")
    flags, doc_id = META.unpack_from(payload)
    ids = np.frombuffer(payload, "<u2" if flags & NARROW else "<u4", offset=META.size).astype(np.uint32)
    return (None if flags & NULL_ID else doc_id), ids, body + length + TAIL.size


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def _writer(folder: str, path: str, end_id: int):
    def write(batches):
        fs, base = _open(folder)
        shard = TaskContext.get().partitionId()
        temp, final = f"{base}/.{uuid.uuid4().hex}", f"{base}/shard-{shard:06d}"
        out, index, at, total = None, [], 0, 0
        for rb in batches:
            names = rb.column(0).to_pylist()
            for rows, ids, offsets in tokenizer(path, end_id).encode(rb.column(1)):
                if out is None:
                    fs.create_dir(base, recursive=True)
                    out = fs.open_output_stream(temp + ".rec")
                for i, name in enumerate(names[rows]):
                    record = frame(name, ids[offsets[i]: offsets[i + 1]])
                    out.write(record)
                    index.append((at, offsets[i + 1] - offsets[i]))
                    at += len(record)
                total += len(ids)
        if out is None:
            return
        out.close()
        with fs.open_output_stream(temp + ".idx") as f:
            f.write(np.array(index, "<u8").tobytes())
        for end in (".rec", ".idx"):
            fs.move(temp + end, final + end)
        yield K.batch(["shard", "records", "n_ids", "n_bytes"],
                      [pa.array([x], pa.int64()) for x in (shard, len(index), total, at)])

    return write


def write_records(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """Write the shards; the manifest (shard, records, n_ids, n_bytes, first_id) is kept beside them.

    ``first_id`` is the number of ids in all earlier shards.
    """
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), text_col)
            .repartitionByRange("id").sortWithinPartitions("id"))
    shards = rows.mapInArrow(_writer(folder, tokenizer_path, end_id), "shard long, records long, n_ids long, n_bytes long")
    shards.write.parquet(f"{folder}/manifest")
    return read_manifest(docs.sparkSession, folder)


def read_manifest(spark, folder: str) -> DataFrame:
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)   # one row per shard
    return (spark.read.schema("shard long, records long, n_ids long, n_bytes long").parquet(f"{folder}/manifest")
            .withColumn("first_id", F.coalesce(F.sum("n_ids").over(before), F.lit(0))))


def read_index(folder: str, shard: int) -> np.ndarray:
    """(record, 2) array of byte offset and number of ids."""
    fs, base = _open(folder)
    with fs.open_input_file(f"{base}/shard-{shard:06d}.idx") as f:
        return np.frombuffer(f.read(), "<u8").reshape(-1, 2).astype(np.int64)


def read_record(folder: str, shard: int, offset: int) -> tuple[int | None, np.ndarray]:
    """One record, by its offset from the index."""
    fs, base = _open(folder)
    with fs.open_input_file(f"{base}/shard-{shard:06d}.rec") as f:
        head = f.read_at(HEAD.size, offset)
        rest = f.read_at(HEAD.unpack(head)[0] + TAIL.size, offset + HEAD.size)
    return parse(head + rest)[:2]


def iter_shard(folder: str, shard: int, n_bytes: int) -> Iterator[tuple[int | None, np.ndarray]]:
    """All records of a shard in order, read in blocks of records."""
    index = read_index(folder, shard)
    ends = np.append(index[1:, 0], n_bytes)
    fs, base = _open(folder)
    with fs.open_input_file(f"{base}/shard-{shard:06d}.rec") as f:
        i = 0
        while i < len(index):
            j = max(i + 1, int(np.searchsorted(ends, index[i, 0] + READ_BYTES, "right")))
            block = memoryview(f.read_at(int(ends[j - 1] - index[i, 0]), int(index[i, 0])))
            at = 0
            for n in index[i:j, 1]:
                doc_id, ids, at = parse(block, at)
                if len(ids) != n:
                    raise CorruptRecord(f"index of shard {shard}")
                yield doc_id, ids
            i = j


def _summariser(folder: str):
    def rows_of(shards: Iterable[tuple]) -> Iterator[tuple]:
        for shard, start, n_bytes in shards:
            for doc_id, ids in iter_shard(folder, shard, n_bytes):
                yield doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())
                start += len(ids)

    def read(batches):
        for rb in batches:
            out = []
            for row in rows_of(zip(*(c.to_pylist() for c in rb.columns))):
                out.append(row)
                if len(out) == 4096:
                    yield _summary(out)
                    out = []
            yield _summary(out)

    return read


def _summary(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows)) or [[], [], [], []]
    return K.batch(["doc_id", "start", "n_tokens", "ids_crc32"], [pa.array(c, pa.int64()) for c in cols])


def record_summary(spark, folder: str) -> DataFrame:
    """One row per record, read back from the files: doc_id, start, n_tokens, ids_crc32."""
    shards = read_manifest(spark, folder).select("shard", "first_id", "n_bytes")
    return (shards.repartition("shard")
            .mapInArrow(_summariser(folder), "doc_id long, start long, n_tokens long, ids_crc32 long"))


def encode_and_read(docs: DataFrame, tokenizer_path: str, end_id: int, folder: str | None = None, **columns) -> DataFrame:
    """Write the files (in the shared folder unless given) and return their summary."""
    folder = folder or scratch_path(docs.sparkSession, "records")
    write_records(docs, folder, tokenizer_path, end_id, **columns)
    return record_summary(docs.sparkSession, folder)
