"""Substring dedup by seed and extend.

A *window* is ``THRESHOLD`` consecutive words.  Every window selects as its
*anchor* the GRAM-word gram with the smallest hash in it (the rightmost on a
tie), the winnowing rule: equal windows select equal anchors at equal places.

1. Seeds: documents are joined on anchors that occur in at least two of them.
2. Extension: an anchor's *context* reaches from the first word of the first
   window that selected it to the last word of the last such window.  Where a
   smaller document has the whole context, the match extends to both ends.
   A group of occurrences with one context is settled by its smallest
   document, so groups of any size cost their own size.
3. Where an anchor has several contexts, the occurrence in the smallest
   document of each context is extended word by word: its windows are looked
   up among the windows of the other contexts.
4. Adjoining matched windows merge into maximal repeats, whose words are
   removed from every document but the smallest that has the window.

Hash comparisons use 128 bits for contexts (anchor and context) and windows.

Defined results: null or short texts have no window and lose nothing; rows
with a null id neither lose nor cause a removal; rows repeated with one id do
not match each other (``doc_id`` is expected to name one text: rows that give
it several texts share their matches); an empty table gives an empty result;
extra columns are passed over.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.session import stored

THRESHOLD = 50
GRAM = 20

_OTHER = np.uint64(0xD6E8FEB86659FD93)


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the rightmost minimum of every ``width`` neighbours."""
    best, at, have = values, np.arange(len(values)), 1
    while have < width:
        step = min(have, width - have)
        right, right_at = best[step:], at[step:]
        left, left_at = best[: len(right)], at[: len(right)]
        take = right <= left
        best, at, have = np.where(take, right, left), np.where(take, right_at, left_at), have + step
    return at


def _doc_hash(raw: bytes) -> str:
    return hashlib.sha256(b" ".join(raw.split())).hexdigest()


def _seeder(threshold: int, gram: int):
    def seed(batches):
        for rb in batches:
            for b in K.blocks(rb.column(1)):
                n = len(b.bounds) - 1
                wh = b.word_hash()
                grams = K.window_hash(wh, gram)
                anchor = sliding_argmin(grams, threshold - gram + 1) if len(wh) >= threshold else np.zeros(0, np.int64)
                win = np.flatnonzero(b.doc[: len(anchor)] == b.doc[threshold - 1:][: len(anchor)])
                anchor, doc = anchor[win], b.doc[win]
                # one row for each run of windows of a document with the same anchor
                new = np.ones(len(win), bool)
                new[1:] = (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1])
                head = np.flatnonzero(new)
                size = np.diff(np.append(head, len(win)))
                first = win[head]
                start = b.first[doc[head]]
                context = K.word_span_hash(wh, first, first + size + threshold - 1)
                seeds = pa.StructArray.from_arrays(
                    [pa.array(K.signed(grams[anchor[head]])), pa.array(K.signed(context)),
                     pa.array((first - start).astype(np.int32)), pa.array(size.astype(np.int32)),
                     pa.array((anchor[head] - first).astype(np.int32))],
                    ["anchor", "context", "first", "size", "before"])
                offsets = np.searchsorted(doc[head], np.arange(n + 1)).astype(np.int32)
                raw = b.data.tobytes()
                yield K.batch(["doc_id", "n_words", "sha", "seeds"], [
                    rb.column(0)[b.rows], np.diff(b.first),
                    pa.array([_doc_hash(raw[x:y]) for x, y in zip(b.bounds[:-1], b.bounds[1:])], pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets), seeds)])

    return seed


SEEDS = ("doc_id long, n_words long, sha string, "
         "seeds array<struct<anchor:long,context:long,first:int,size:int,before:int>>")


def _ranges(first: list, size: list) -> np.ndarray:
    """All window numbers of the (first, size) ranges."""
    size = np.asarray(size, np.int64)
    ends = np.cumsum(size)
    return np.repeat(np.asarray(first, np.int64) - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


def _windows(threshold: int):
    """(doc_id, text, first[], size[]) -> (doc_id, number, two hashes) of the windows in the ranges."""
    def windows(batches):
        for rb in batches:
            firsts, sizes = rb.column(2).to_pylist(), rb.column(3).to_pylist()
            ids = rb.column(0).to_numpy()
            for b in K.blocks(rb.column(1)):
                wh = b.word_hash()
                other = K.mix(wh * _OTHER)
                for i, k in enumerate(range(b.rows.start, b.rows.stop)):
                    at = np.unique(_ranges(firsts[k], sizes[k]))
                    at = at[at + threshold <= b.first[i + 1] - b.first[i]]
                    lo = at + b.first[i]
                    yield K.batch(["doc_id", "number", "h1", "h2"], [
                        np.full(len(at), ids[k]), at.astype(np.int32),
                        K.signed(K.word_span_hash(wh, lo, lo + threshold)),
                        K.signed(K.word_span_hash(other, lo, lo + threshold))])

    def joined(batches) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for rb in windows(batches):
            held, rows = [*held, rb], rows + rb.num_rows
            if rows >= 20_000:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                held, rows = [], 0
        if held:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return joined


def _remover(threshold: int):
    def remove(batches):
        for rb in batches:
            firsts, sizes = rb.column(2).to_pylist(), rb.column(3).to_pylist()
            gone, texts, spans = [], [], []
            for b in K.blocks(rb.column(1)):
                for i, k in enumerate(range(b.rows.start, b.rows.stop)):
                    n = int(b.first[i + 1] - b.first[i])
                    change = np.zeros(n + 1, np.int64)
                    first = np.minimum(np.asarray(firsts[k], np.int64), n)
                    end = np.minimum(first + np.asarray(sizes[k], np.int64) + threshold - 1, n)
                    np.add.at(change, first, 1)
                    np.add.at(change, end, -1)
                    covered = np.cumsum(change[:-1]) > 0
                    edge = np.diff(np.concatenate(([0], covered.astype(np.int8), [0])))
                    spans.append([{"first": int(a), "end": int(z)} for a, z in
                                  zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1))])
                    kept = np.flatnonzero(~covered) + b.first[i]
                    raw = memoryview(b.data)
                    texts.append(b" ".join([bytes(raw[s:e]) for s, e in zip(b.starts[kept].tolist(), b.ends[kept].tolist())]))
                    gone.append(n - len(kept))
            yield K.batch(["doc_id", "n_removed", "kept_text", "kept_sha256", "removed"], [
                rb.column(0), pa.array(gone, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string()),
                pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])))])

    return remove


REMOVED = "doc_id long, n_removed long, kept_text string, kept_sha256 string, removed array<struct<first:long,end:long>>"


def _lists(ranges: DataFrame) -> DataFrame:
    """One row per document with its (first, size) ranges; bounded by the document's words."""
    rows = ranges.groupBy("doc_id").agg(F.collect_list(F.struct("first", "size")).alias("r"))
    return rows.select("doc_id", F.col("r.first").alias("firsts"), F.col("r.size").alias("sizes"))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: int = THRESHOLD,
            gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """One row per input row: id, n_words, n_removed, kept_sha256, removed (maximal spans of words), kept_text.

    ``kept_text`` (the kept words joined by one space) is null where nothing is removed.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    seeded = stored(source.mapInArrow(_seeder(threshold, gram), SEEDS), "seeds")
    seeds = seeded.where("doc_id is not null").select("doc_id", F.inline("seeds"))
    shared = stored(seeds.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
                    .where("lo < hi").select("anchor"), "anchors")
    seeds = stored(seeds.join(shared.hint("merge"), "anchor"), "shared")
    key = ["anchor", "context", "size", "before"]
    contexts = stored(seeds.groupBy(*key).agg(F.min("doc_id").alias("least")), "contexts")
    several = stored(contexts.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor"),
                     "several")
    settled = stored(seeds.join(contexts.hint("merge"), key), "settled")
    full = settled.where("doc_id > least").select("doc_id", "first", "size")
    heads = settled.where("doc_id = least").join(several.hint("merge"), "anchor").select("doc_id", "first", "size")
    full, heads = stored(_lists(full), "full"), stored(_lists(heads), "heads")

    wanted = stored(full.select("doc_id").union(heads.select("doc_id")).distinct(), "wanted")
    texts = stored(source.join(wanted.hint("merge"), "doc_id"), "texts")
    windows = stored(texts.join(heads.hint("merge"), "doc_id").select("doc_id", "text", "firsts", "sizes")
                     .mapInArrow(_windows(threshold), "doc_id long, number int, h1 long, h2 long"), "windows")
    least = stored(windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
                   .where("least < most"), "least")
    single = (windows.join(least.hint("merge"), ["h1", "h2"]).where("doc_id > least")
              .select("doc_id", F.col("number").alias("first"), F.lit(1).alias("size")))
    matched = (_lists(single).withColumnsRenamed({"firsts": "f2", "sizes": "s2"})
               .join(full, "doc_id", "full"))
    none = F.array().cast("array<int>")
    matched = stored(matched.select("doc_id", F.concat(F.coalesce("firsts", none), F.coalesce("f2", none)).alias("firsts"),
                                    F.concat(F.coalesce("sizes", none), F.coalesce("s2", none)).alias("sizes")), "matched")
    removed = (texts.join(matched.hint("merge"), "doc_id").select("doc_id", "text", "firsts", "sizes")
               .mapInArrow(_remover(threshold), REMOVED))
    removed = stored((removed if with_text else removed.drop("kept_text")).dropDuplicates(["doc_id"])
                     .withColumnsRenamed({"doc_id": "_id", "kept_sha256": "_sha"}), "removed")
    out = seeded.drop("seeds").join(removed.hint("merge"), F.col("doc_id") == F.col("_id"), "left")
    return out.select(F.col("doc_id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
                      F.coalesce("_sha", "sha").alias("kept_sha256"), "removed", *(["kept_text"] if with_text else []))
