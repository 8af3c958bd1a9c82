"""Quality rules: cross-document line frequency.

Every line with a word is normalised (A-Z as a-z, digits as 0, words joined by
one space) and hashed.  For each host the distinct documents holding a line are
counted; exact copies of a text count as one document.  A line of any length
is page furniture of its host when more than ``max(min_docs, share * documents
of the host)`` documents hold it.  Such lines are removed, and a document is
depleted, and rejected, when under ``keep_percent`` of its words remain.  Two plain rules come first: at least ``min_words`` words, and at
most ``repeat_percent`` of the words in 8-word windows that the text repeats.

Defined results: null text has no words and fails; a null host counts as the
host ''; rows repeated with one id, text and host are judged alike, and rows of
one id and text under several hosts by the furniture of each one's own host; an empty table gives an empty result;
extra columns are kept by ``clean_documents`` and passed over otherwise.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.llm import kernels as K
from wardline.llm.rows import packed, unpacked
from wardline.session import stored

WINDOW = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)

PROFILE = ("doc_id long, host string, content long, n_words long, word_chars long, n_symbols long, "
           "n_dup_lines long, n_repeat_words long, lines array<struct<line:long,words:int>>")


def _line_spans(b: K.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every line of a block."""
    breaks = np.flatnonzero(b.data == K.NEWLINE)
    starts = np.sort(np.concatenate((b.bounds[:-1], breaks + 1)), kind="stable")
    # a break ends its line; a document's end ends its last line
    ends = np.sort(np.concatenate((breaks, b.bounds[1:])), kind="stable")
    n_lines = np.diff(np.searchsorted(breaks, b.bounds)) + 1
    return starts, ends, np.repeat(np.arange(len(n_lines)), n_lines)


def _line_hashes(b: K.Block):
    """(document, start, end, words, normalised hash) of the lines with a word."""
    starts, ends, doc = _line_spans(b)
    first, last = np.searchsorted(b.starts, starts), np.searchsorted(b.starts, ends)
    # words of an empty last line's position belong to the next document
    words = np.where(ends > starts, last - first, 0)
    full = words > 0
    first = first[full]
    norm = K.word_span_hash(b.word_hash(K.BYTE_FOLDED), first, first + words[full])
    return doc[full], starts[full], ends[full], words[full], norm


def _in_doc(h: np.ndarray, doc: np.ndarray) -> np.ndarray:
    return K.mix(h + (doc.astype(np.uint64) + np.uint64(1)) * _ODD)


def _repeat_words(b: K.Block, n: int) -> np.ndarray:
    at, h = b.windows(b.word_hash(), WINDOW)
    key = _in_doc(h, b.doc[at])
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    repeated = np.zeros(len(at), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    change = np.zeros(len(b.starts) + 1, np.int64)
    np.add.at(change, at[repeated], 1)
    np.add.at(change, at[repeated] + WINDOW, -1)
    covered = np.cumsum(change[:-1]) > 0
    return np.bincount(b.doc[covered], minlength=n)


def _between(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags)))
    return total[bounds[1:]] - total[bounds[:-1]]


def _profile(batches):
    for rb in batches:
        for b in K.blocks(rb.column(3)):
            n = len(b.bounds) - 1
            doc, start, end, words, norm = _line_hashes(b)
            raw = K.byte_span_hash(K.BYTE_EXACT[b.data], start, end)
            _, first = np.unique(_in_doc(raw, doc), return_index=True)
            dup = np.bincount(doc, minlength=n) - np.bincount(doc[first], minlength=n)
            _, first, back = np.unique(_in_doc(norm, doc), return_index=True, return_inverse=True)
            # of a distinct line: the words of all its occurrences
            total = np.bincount(back, weights=words, minlength=len(first)).astype(np.int32)
            order = np.argsort(doc[first], kind="stable")
            offsets = np.searchsorted(doc[first][order], np.arange(n + 1)).astype(np.int32)
            lines = pa.ListArray.from_arrays(
                pa.array(offsets), pa.StructArray.from_arrays(
                    [pa.array(K.signed(norm[first][order])), pa.array(total[order])], ["line", "words"]))
            is_word = ~K.SPACE[b.data]
            yield K.batch(
                ["doc_id", "host", "content", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                 "lines"],
                [rb.column(0)[b.rows], rb.column(1)[b.rows], rb.column(2)[b.rows], np.diff(b.first),
                 _between(is_word & ((b.data & 0xC0) != 0x80), b.bounds), _between(K.SYMBOL[b.data], b.bounds),
                 dup, _repeat_words(b, n), lines])


def _inputs(docs: DataFrame, id_col: str, text_col: str, host_col: str) -> list:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(host_col), F.lit("")).alias("host"),
            F.xxhash64(text).alias("content"), text.cast("binary").alias("text")]


def furniture(profile: DataFrame, min_docs: int, share: float) -> DataFrame:
    """(host, line): lines that too many distinct documents of a host hold."""
    held = profile.select("host", "content", F.explode("lines.line").alias("line"))
    counts = (held.distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
              .where(F.col("docs") > min_docs))
    hosts = profile.select("host", "content").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("of"))
    return (stored(counts, "counts").join(stored(hosts, "hosts").hint("merge"), "host")
            .where(F.col("docs") > F.col("of") * share).select("host", "line"))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
          min_words: int = 20, repeat_percent: int = 30, min_docs: int = 10, share: float = 0.01,
          keep_percent: int = 30) -> DataFrame:
    """One row per input row: the measures, base_failed, n_removed_words, removed (line hashes or null), kept."""
    rows = docs.select(*_inputs(docs, id_col, text_col, host_col))
    profile = stored(rows.mapInArrow(K.lean(_profile), PROFILE), "profile")
    over = stored(furniture(profile, min_docs, share), "furniture")
    key = ["doc_id", "content", "host"]
    lines = (profile.dropDuplicates(key).select(*key, F.explode("lines").alias("l"))
             .select(*key, F.col("l.line").alias("line"), F.col("l.words").alias("words")))
    hit = (lines.join(over.hint("merge"), ["host", "line"]).groupBy(*key)
           .agg(F.sum("words").alias("n_removed_words"), F.sort_array(F.collect_list("line")).alias("removed"))
           .withColumnsRenamed({"doc_id": "_id", "content": "_content", "host": "_host"}))
    on = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("content") == F.col("_content")) & (F.col("host") == F.col("_host"))
    gone = F.coalesce("n_removed_words", F.lit(0))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words"))
    return (profile.drop("lines").join(stored(hit, "hit").hint("merge"), on, "left").drop("_id", "_content", "_host")
            .withColumn("n_removed_words", gone).withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed")
                        & (100 * (F.col("n_words") - F.col("n_removed_words")) >= keep_percent * F.col("n_words"))))


@F.pandas_udf(T.StringType())
def _without(text: pd.Series, removed: pd.Series) -> pd.Series:
    out = text.copy()
    at = [i for i, r in enumerate(removed) if r is not None]
    column = pa.array([text.iloc[i] for i in at], pa.large_string())
    for b in K.blocks(column):
        doc, start, end, _, norm = _line_hashes(b)
        gone = K.signed(norm)
        for k in range(len(b.bounds) - 1):
            i = at[b.rows.start + k]
            drop = set(removed.iloc[i])
            spans = [(s, e) for s, e, h in zip(start[doc == k], end[doc == k], gone[doc == k].tolist()) if h in drop]
            kept, left = [], b.bounds[k]
            for s, e in spans:                       # a removed line goes with its line break
                kept.append(b.data[left: s].tobytes())
                left = min(e + 1, b.bounds[k + 1])
            kept.append(b.data[left: b.bounds[k + 1]].tobytes())
            out.iloc[i] = b"".join(kept).decode()
    return out


def clean_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                    chars_col: str | None = "n_chars", **limits) -> DataFrame:
    """The kept documents, all columns, without the removed lines; ``chars_col`` (where present) follows the text."""
    verdict = (judge(docs, id_col, text_col, host_col, **limits).where("kept")
               .select(F.col("doc_id").alias("_id"), F.col("content").alias("_content"), F.col("host").alias("_of"),
                       F.col("removed").alias("_gone"))
               .dropDuplicates(["_id", "_content", "_of"]))
    rows = packed(docs, _key=F.col(id_col).cast("long"), _text=F.col(text_col), _host=F.coalesce(F.col(host_col), F.lit("")),
                  _hash=F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    out = rows.join(verdict.hint("merge"), F.col("_key").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_content"))
                    & (F.col("_host") == F.col("_of")))
    untouched = F.col("_gone").isNull()
    out = out.withColumn("_text", F.when(untouched, F.col("_text")).otherwise(
        _without(F.when(~untouched, F.col("_text")), "_gone")))
    new = {text_col: F.col("_text")}
    if chars_col in docs.columns:
        new[chars_col] = F.when(untouched, F.col("_row").getField(chars_col)).otherwise(
            F.char_length("_text").cast(docs.schema[chars_col].dataType))
    return unpacked(out, docs, **new)
