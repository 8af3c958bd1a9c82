"""Line dedup by content-defined chunks (DataFrame functions only).

A text's lines (split at \\n) are hashed; a rolling hash over the last
``ROLL`` line hashes ends a chunk after a line where it is ``DIVISOR - 1``
modulo ``DIVISOR``.  Boundaries depend on the neighbouring lines alone, so a
shift of the lines before moves them along.  Of every chunk of two lines or
more that occurs anywhere else, the first occurrence (smallest id, then place)
stays and the others are removed, each after its bytes compared equal.

Defined results: null text is one empty line; null ids come last among the
occurrences; rows repeated with one id and text count as one occurrence and
are treated alike; an empty table gives an empty result; ``remove_chunks``
keeps all columns, the others pass over extra ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.rows import packed, unpacked
from wardline.session import stored

ROLL = 2
DIVISOR = 3
BASE, MODULUS = 31, 2147483647
NL = "\n"


def _line_hash(line: Column) -> Column:
    """First 32 bits of the line's MD5."""
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 8), 16, 10).cast("long")


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row (an expression named in a lambda is not)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunk_array(text: Column, divisor: int = DIVISOR, roll: int = ROLL) -> Column:
    """array<struct<place, n_lines, chunk>>; the chunks joined by line breaks are the text."""
    def rolling(hashes: Column, i: Column) -> Column:
        # the lines before the first count as 0
        parts = [F.coalesce(F.get(hashes, i - j), F.lit(0)) * F.lit(BASE ** j) for j in range(roll)]
        total = parts[0]
        for p in parts[1:]:
            total = total + p
        return F.pmod(total, F.lit(MODULUS))

    def ends_of(hashes: Column) -> Column:
        last = F.size(hashes) - 1
        return F.filter(F.sequence(F.lit(0), last),
                        lambda i: (F.pmod(rolling(hashes, i), F.lit(divisor)) == divisor - 1) | (i == last))

    def cut(lines: Column, ends: Column) -> Column:
        def chunk(end: Column, place: Column) -> Column:
            start = F.coalesce(F.get(ends, place - 1) + 1, F.lit(0))
            size = end - start + 1
            return F.struct(place.alias("place"), size.alias("n_lines"),
                            F.array_join(F.slice(lines, start + 1, size), NL).alias("chunk"))

        return F.transform(ends, chunk)

    return _let(F.split(text, NL, -1), lambda lines: _let(
        F.transform(lines, _line_hash), lambda hashes: _let(ends_of(hashes), lambda ends: cut(lines, ends))))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("_id"), F.xxhash64(text).alias("_content"), text.alias("_text"))


def _first() -> Column:
    return F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"),
                          F.col("_content").alias("content"), F.col("place").alias("place")))


def _is_first(best: str) -> Column:
    return (F.col("_id").eqNullSafe(F.col(f"{best}.id")) & (F.col("_content") == F.col(f"{best}.content"))
            & (F.col("place") == F.col(f"{best}.place")))


def repeated_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    divisor: int = DIVISOR) -> tuple[DataFrame, DataFrame]:
    """(rows that hold a repeated chunk with their text; their removed places and lines)."""
    rows = _rows(docs, id_col, text_col)
    chunks = rows.select("_id", "_content", F.inline(chunk_array(F.col("_text"), divisor))).where("n_lines > 1")
    key = ["h", "bytes"]
    keyed = stored(chunks.select("_id", "_content", "place", "n_lines", F.xxhash64("chunk").alias("h"),
                                 F.octet_length("chunk").alias("bytes")), "chunks")
    found = stored(keyed.groupBy(*key).agg(_first().alias("best"), F.count(F.lit(1)).alias("n"))
                   .where("n > 1").select(*key, "best"), "repeated")
    places = stored(keyed.join(found.hint("merge"), key)
                    .groupBy("_id", "_content").agg(F.collect_set("place").alias("places"))    # bounded by the lines
                    .withColumnsRenamed({"_id": "_pid", "_content": "_pcontent"}), "places")
    on = F.col("_id").eqNullSafe(F.col("_pid")) & (F.col("_content") == F.col("_pcontent"))
    texts = stored(rows.join(places.hint("merge"), on).select("_id", "_content", "_text", "places"), "texts")
    # byte comparison with the first occurrence
    held = (texts.dropDuplicates(["_id", "_content"])
            .select("_id", "_content", "places", F.inline(chunk_array(F.col("_text"), divisor)))
            .where(F.array_contains("places", F.col("place")))
            .select("_id", "_content", "place", "n_lines", F.xxhash64("chunk").alias("h"),
                    F.octet_length("chunk").alias("bytes"), "chunk"))
    held = stored(held, "held")
    marked = held.join(found.hint("merge"), key)
    heads = stored(marked.where(_is_first("best")).select(*key, F.col("chunk").alias("head")), "heads")
    compared = marked.join(heads.hint("merge"), key).withColumn("equal", F.col("chunk") == F.col("head"))
    gone = compared.where(F.col("equal") & ~_is_first("best")).select("_id", "_content", "place", "n_lines")
    # hash collisions, should there be any: the same rule on the bytes themselves
    odd = stored(compared.where(~F.col("equal")).drop("best", "head", "equal"), "collisions")
    by_text = odd.groupBy(*key, "chunk").agg(_first().alias("best"))
    more = (odd.join(by_text, [*key, "chunk"]).where(~_is_first("best"))
            .select("_id", "_content", "place", "n_lines"))
    lists = (gone.unionByName(more).groupBy("_id", "_content")
             .agg(F.collect_list("place").alias("gone"), F.sum("n_lines").alias("n_removed_lines"))
             .withColumnsRenamed({"_id": "_gid", "_content": "_gcontent"}))
    return texts, stored(lists, "gone")


def _kept_text(text: Column, gone: Column, divisor: int) -> Column:
    left = F.filter(chunk_array(text, divisor), lambda c: ~F.array_contains(gone, c["place"]))
    return F.array_join(F.transform(left, lambda c: c["chunk"]), NL)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """One row per input row: id, n_lines, n_removed_lines, kept_sha256."""
    texts, gone = repeated_chunks(docs, id_col, text_col, divisor)
    changed = (texts.dropDuplicates(["_id", "_content"])
               .join(gone.hint("merge"), F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_content") == F.col("_gcontent")))
               .select("_gid", "_gcontent", "n_removed_lines",
                       F.sha2(_kept_text(F.col("_text"), F.col("gone"), divisor).cast("binary"), 256).alias("_new")))
    rows = _rows(docs, id_col, text_col).select("_id", "_content", F.size(F.split("_text", NL, -1)).alias("n_lines"),
                                                F.sha2(F.col("_text").cast("binary"), 256).alias("_old"))
    on = F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_content") == F.col("_gcontent"))
    return rows.join(stored(changed, "changed").hint("merge"), on, "left").select(
        F.col("_id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce("n_removed_lines", F.lit(0)).cast("long").alias("n_removed_lines"),
        F.coalesce("_new", "_old").alias("kept_sha256"))


def remove_chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", divisor: int = DIVISOR) -> DataFrame:
    """The documents, all columns, without the removed chunks."""
    _, gone = repeated_chunks(docs, id_col, text_col, divisor)
    rows = packed(docs, _id=F.col(id_col), _text=F.col(text_col), _content=F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    on = F.col("_id").eqNullSafe(F.col("_gid")) & (F.col("_content") == F.col("_gcontent"))
    text = F.when(F.col("gone").isNull(), F.col("_text")).otherwise(_kept_text(F.col("_text"), F.col("gone"), divisor))
    return unpacked(rows.join(gone.hint("merge"), on, "left"), docs, **{text_col: text})
