"""Quoted records that span lines, read from byte ranges in parallel.

A line break ends a record only outside quotes, and whether a byte range
begins inside quotes depends on every range before it.  So:

1. Each range counts its quotes (one scan, a partial aggregate); only the
   parity matters, since a doubled quote counts twice.
2. A prefix parity over the ranges of a file tells how each range begins.  The
   table has one row per range.
3. Each range cuts its lines into records by itself, in the order it reads
   them.  Only the pieces at its two ends, where a record reaches into another
   range, are brought together by key.

Defined results: an empty file has no record; a record that the file ends
within is kept or dropped by ``unclosed``; blank lines outside quotes are
records of their own for :func:`quoted_records` and are no rows for the CSV
reader; files that cannot be split (compressed ones) are one range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.session import stored

MAX_BROADCAST_RANGES = 1 << 18     # above, the range table is joined by a shuffle

WHOLE, END, MIDDLE, BEGIN = range(4)       # a record, or its part in one of several ranges

PIECES = "file string, start long, seq long, kind int, record string"


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, start, line, value): lines in reading order within the byte range at ``start``.

    Ranges are the splits of the scan (``spark.sql.files.maxPartitionBytes``).
    """
    return (spark.read.option("lineSep", "\n").text(path)
            .select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
                    F.monotonically_increasing_id().alias("line"), "value"))


def _quotes(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit('"'), F.lit("")))


def range_starts(lines: DataFrame) -> DataFrame:
    """(file, start, inside): whether each range begins inside quotes."""
    parity = lines.groupBy("file", "start").agg(F.sum(_quotes(F.col("value"))).alias("quotes"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    return parity.select("file", "start", (F.coalesce(F.sum(F.col("quotes") % 2).over(before), F.lit(0)) % 2).cast("int").alias("inside"))


def _strip_cr(values: pa.Array, which: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(which), pc.replace_substring_regex(values, r"\r$", ""), values)


def _joiner(separator: str, strip_cr: bool):
    """Lines of ranges, in order -> pieces of records."""
    def joined(values: pa.Array, starts: np.ndarray) -> pa.Array:
        """Lines from each start to the next, joined."""
        offsets = pa.array(np.append(starts, len(values)).astype(np.int32))
        return pc.binary_join(pa.ListArray.from_arrays(offsets, values), separator)

    def pieces(batches) -> Iterator[pa.RecordBatch]:
        key, seq, last = None, 0, -1
        held: list[pa.Array] = []           # joined lines of the record that is open, and its kind
        kind = BEGIN

        def row(k, number, what, text):
            return pa.RecordBatch.from_arrays(
                [pa.array([k[0]]), pa.array([k[1]], pa.int64()), pa.array([number], pa.int64()),
                 pa.array([what], pa.int32()), pa.array([text])], names=["file", "start", "seq", "kind", "record"])

        def rest():
            if held:
                yield row(key, seq, MIDDLE if kind == END else BEGIN, separator.join(held))

        for rb in batches:
            if rb.num_rows == 0:
                continue
            file, start = rb.column(0).dictionary_encode(), rb.column(1).to_numpy()
            line = rb.column(2).to_numpy()
            if line[0] <= last or (np.diff(line) <= 0).any():
                raise ValueError("lines must come in reading order")
            last = int(line[-1])
            code = file.indices.to_numpy()
            cuts = np.flatnonzero((np.diff(code) != 0) | (np.diff(start) != 0)) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), rb.num_rows]):
                here = (file.dictionary[int(code[i])].as_py(), int(start[i]))
                if here != key:
                    yield from rest()
                    key, seq, held = here, 0, []
                    open_ = bool(rb.column(4)[i].as_py())
                    kind = END if open_ else BEGIN
                values = rb.column(3).slice(i, j - i)
                odd = rb.column(5).slice(i, j - i).to_numpy() % 2
                after = (np.cumsum(odd) + open_) % 2 == 1               # still inside quotes when the line ends
                if strip_cr:
                    values = _strip_cr(values, after)
                closes = np.flatnonzero(~after)
                open_ = bool(after[-1])
                if len(closes) == 0:
                    held += values.to_pylist()
                    continue
                texts = joined(values.slice(0, closes[-1] + 1), np.append(0, closes[:-1] + 1))
                if held or kind == END:
                    first = separator.join([*held, texts[0].as_py()])
                    if kind == END:
                        yield row(key, seq, END, first)
                    else:
                        yield row(key, seq, WHOLE, first)
                    texts, seq = texts.slice(1), seq + 1
                n = len(texts)
                if n:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([key[0]] * n), pa.array([key[1]] * n, pa.int64()), pa.array(np.arange(seq, seq + n)),
                         pa.array(np.full(n, WHOLE, np.int32)), texts], names=["file", "start", "seq", "kind", "record"])
                    seq += n
                held, kind = values.slice(closes[-1] + 1).to_pylist(), BEGIN
        yield from rest()

    return pieces


def quoted_records(lines: DataFrame, separator: str = "\n", strip_cr: bool = False, unclosed: str = "keep",
                   max_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """(file, start, seq, record) of the lines of :func:`physical_lines`, whose order within a file is (start, seq).

    Lines of one record are joined by ``separator``; ``strip_cr`` takes the
    carriage return off all but its last.
    """
    ranges = stored(range_starts(lines), "ranges")
    if ranges.count() <= max_broadcast:
        known = lines.join(F.broadcast(ranges), ["file", "start"])         # the scan's order stays
    else:
        known = (lines.join(ranges.hint("merge"), ["file", "start"])
                 .repartition("file", "start").sortWithinPartitions("line"))
    pieces = stored(known.select("file", "start", "line", "value", "inside", _quotes(F.col("value")).alias("quotes"))
                    .mapInArrow(_joiner(separator, strip_cr), PIECES), "pieces")
    parts = pieces.where(F.col("kind") != WHOLE)
    # the record that a part belongs to began in the last range with a beginning
    upto = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    chain = parts.select("file", "start", "kind").withColumn(
        "first", F.last(F.when(F.col("kind") == BEGIN, F.col("start")), ignorenulls=True).over(upto))
    chained = parts.join(chain.hint("merge"), ["file", "start", "kind"]).groupBy("file", "first").agg(
        F.array_sort(F.collect_list(F.struct("start", "kind", "record", "seq"))).alias("p"))
    # a beginning comes before what follows it in later ranges
    whole = chained.select("file", F.col("first").alias("start"),
                           F.element_at(F.col("p.seq"), 1).alias("seq"),
                           F.array_join(F.col("p.record"), separator).alias("record"),
                           (F.element_at(F.col("p.kind"), -1) == END).alias("closed"))
    if unclosed == "drop":
        whole = whole.where("closed")
    return pieces.where(F.col("kind") == WHOLE).select("file", "start", "seq", "record").unionByName(whole.drop("closed"))


def read_quoted_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV with line breaks in quoted fields, all columns STRING, cut into records in parallel.

    ``columns`` (in file order) spares the job that reads the header.
    """
    if columns is None:
        columns = (spark.read.option("header", True).option("escape", '"').option("multiLine", True)
                   .option("inferSchema", False).csv(path).columns)
    records = quoted_records(physical_lines(spark, path))
    body = records.where("not (start = 0 and seq = 0)").select(F.regexp_replace("record", "\r$", "").alias("r")).where(
        F.trim("r") != "")
    row = F.from_csv("r", ", ".join(f"`{c}` string" for c in columns), {"escape": '"', "multiLine": "true"})
    return body.select(row.alias("c")).select("c.*")


def clean_note_lines(lines: DataFrame) -> DataFrame:
    """The note script's edits of single lines: doubled quotes and then double
    spaces to one space, one pass each, and no blank lines."""
    edited = F.regexp_replace(F.regexp_replace("value", '""', " "), "  ", " ")
    return lines.withColumn("value", edited).where(~F.col("value").rlike(r"^\s*$"))


def clean_note_records(spark: SparkSession, path: str) -> DataFrame:
    """S13 over a whole file: one line per record, commas inside quotes as semicolons.

    Step order: edits of lines, records joined by spaces without carriage
    returns, commas last.  A record that the file ends within is not returned.
    """
    records = quoted_records(clean_note_lines(physical_lines(spark, path)), " ", strip_cr=True, unclosed="drop")
    parts = F.transform(F.split("record", '"'), lambda x, i: F.when(i % 2 == 1, F.translate(x, ",", ";")).otherwise(x))
    return records.withColumn("record", F.array_join(parts, '"'))
