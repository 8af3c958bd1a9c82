"""Ranked lexical search by pipelined term partitioning.

Terms are maximal runs of ASCII letters, digits and all characters beyond
ASCII, with A-Z lower-cased.

1. Blocks: every task gathers up to ``BLOCK`` documents, sorts them by id and
   writes one row with their ids and lengths, and one row per query term (let
   through by a bounded sieve) with the documents that hold it.  Once the
   totals are known, each posting becomes an integer impact.
2. Owners: query terms are dealt to stages by how many documents hold them, the
   rarest first.
3. Pipeline: items travel in bundles of about ``BUNDLE``.  At each stage the
   accumulators (item, document, score) of a bundle and a block meet the
   postings of the stage's terms by cogroup and take their contributions.
4. After a stage, an item's tenth-best score so far is a floor.  A document that
   cannot reach it with all that later stages may add (their weights times the
   terms' largest impacts) is let go, and no new one is taken up when even a
   full sum of the rest stays below; ties are kept, so nothing is lost.
5. The last stage returns each block's best documents, of which the best of all
   blocks are selected.

Defined results: null or empty texts hold no term and are never returned; items
without a term that some document holds give no rows; rows repeated with one
item id are one item with all their terms (null is an item like others); rows
repeated with one document id are ranked one by one; documents without an id
come last among equals; empty tables give an empty result; extra columns are
passed over.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm import kernels as K
from wardline.llm import lexemes as X
from wardline.session import discard, written

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
INSIDE = X.byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
BLOCK = 2048                    # documents (below 2**16)
BLOCK_BYTES = 16 << 20          # of text; a longer document is a block of its own
BUNDLE = 256                    # items
OWNERS = (1 / 512, 1 / 64, 1 / 8)      # upper shares of the documents of all stages but the last
TOP = 10

_POS, _IMPACT, _LONG = np.dtype("<u2"), np.dtype("<u4"), np.dtype("<i8")

BLOCKS = "block long, term string, pos binary, tf binary, n binary, ids array<long>, docs long, terms long"
IMPACTS = "block long, term string, pos binary, impact binary, df long, best long"
SCORES = "bundle int, block long, slot int, pos binary, score binary, tops array<long>"


def _hash_terms(batches):
    for rb in batches:
        yield K.batch(["h"], [K.signed(X.word_hashes(rb.column(0).cast(pa.large_binary())))])


def _block(number: int, ids: list, texts: list[bytes], sieve: np.ndarray) -> Iterator[pa.RecordBatch]:
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0))
    texts = [texts[i] for i in order]
    data = X.LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    bounds = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    starts, ends = X.word_spans(data, bounds, INSIDE)
    word, words = X.dictionary(data, starts, ends, INSIDE)
    doc = np.searchsorted(bounds, starts, "right") - 1
    n = np.bincount(doc, minlength=len(ids))
    asked = X.passes(sieve, X.word_hashes(words)) if len(words) else np.zeros(0, bool)
    at = np.flatnonzero(asked[word])
    key, tf = np.unique(word[at].astype(np.int64) * len(ids) + doc[at], return_counts=True)
    term, pos = np.divmod(key, len(ids))
    cut = np.flatnonzero(np.concatenate(([True], term[1:] != term[:-1]))) if len(term) else np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(term))
    pos, tf, length = pos.astype(_POS), tf.astype(_IMPACT), n[pos].astype(_IMPACT)
    terms = words.take(pa.array(term[cut])).cast(pa.binary()).cast(pa.string()) if len(cut) else pa.array([], pa.string())
    none = pa.nulls(len(cut), pa.list_(pa.int64()))
    lists = [pa.array([a[i:j].tobytes() for i, j in zip(cut.tolist(), ends.tolist())], pa.binary()) for a in (pos, tf, length)]
    names = ["block", "term", "pos", "tf", "n", "ids", "docs", "terms"]
    empty = pa.array([None], pa.binary())
    yield K.batch(names, [pa.array([number]), pa.array([None], pa.string()), empty, empty, empty,
                          pa.array([[ids[i] for i in order]], pa.list_(pa.int64())),
                          pa.array([int((n > 0).sum())]), pa.array([int(n.sum())])])
    for i in range(0, len(cut), 4096):
        size = min(4096, len(cut) - i)
        yield K.batch(names, [pa.array([number] * size), terms.slice(i, size), *[x.slice(i, size) for x in lists],
                              none.slice(i, size), pa.nulls(size, pa.int64()), pa.nulls(size, pa.int64())])


def _blocker(sieve, size: int):
    def blocks(batches):
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        ids, texts, held = [], [], 0
        for rb in batches:
            for i, text in zip(rb.column(0).to_pylist(), rb.column(1).to_pylist()):
                ids.append(i)
                texts.append(text)
                held += len(text)
                if len(ids) == size or held >= BLOCK_BYTES:
                    yield from _block(number, ids, texts, sieve.value)
                    number, ids, texts, held = number + 1, [], [], 0
        if ids:
            yield from _block(number, ids, texts, sieve.value)

    return blocks


def impact(tf: np.ndarray, n: np.ndarray, docs: int, terms: int) -> np.ndarray:
    """(10**9 * tf) div (1000 * tf + 8 * m) with m = 10 + (90 * n * docs) div terms."""
    tf, n = tf.astype(np.int64), n.astype(np.int64)
    return 10**9 * tf // (1000 * tf + 8 * (10 + 90 * n * docs // terms))


def _weigher(docs: int, terms: int):
    def weigh(batches):
        for rb in batches:
            out, best = [], []
            for tf, n in zip(rb.column(3), rb.column(4)):
                x = impact(np.frombuffer(tf.as_buffer(), _IMPACT), np.frombuffer(n.as_buffer(), _IMPACT), docs, terms)
                out.append(x.astype(_IMPACT).tobytes())
                best.append(int(x.max()))
            yield K.batch(["block", "term", "pos", "impact", "df", "best"], [
                rb.column(0), rb.column(1), rb.column(2), pa.array(out, pa.binary()),
                pa.array([len(x) // _IMPACT.itemsize for x in out], pa.int64()), pa.array(best, pa.int64())])

    return weigh


def _stage(top: int, last: bool):
    """Accumulators of one bundle and block, after the contributions of one stage's terms.

    ``need`` is what a document must have before the stage to stay in the
    running, ``must`` what it must have after it.
    """
    def run(key, held: pa.Table, postings: pa.Table) -> pa.Table:
        score: dict[int, np.ndarray] = {}
        bars: dict[int, int] = {}
        width = 1 + max([int(np.frombuffer(p.as_buffer(), _POS)[-1]) for t in (held, postings)
                         for p in t.column("pos")], default=0)

        def row(slot: int, need: int, must: int) -> np.ndarray:
            if slot not in score:
                # below zero: not in the running, and no sum of contributions lifts it to zero
                score[slot] = np.zeros(width, np.int64) if need <= 0 else np.full(width, -(1 << 62))
                bars[slot] = must
            return score[slot]

        for slot, need, must, pos, s in zip(*(held.column(c) for c in ("slot", "need", "must", "pos", "score"))):
            need, s = need.as_py(), np.frombuffer(s.as_buffer(), _LONG)
            live = s >= need
            row(slot.as_py(), need, must.as_py())[np.frombuffer(pos.as_buffer(), _POS)[live]] = s[live]
        for weight, slots, pos, x in zip(*(postings.column(c) for c in ("weight", "slots", "pos", "impact"))):
            pos = np.frombuffer(pos.as_buffer(), _POS)
            gain = np.frombuffer(x.as_buffer(), _IMPACT).astype(np.int64) * weight.as_py()
            for s in slots.as_py():
                row(s["slot"], s["need"], s["must"])[pos] += gain
        out = []
        for slot, s in score.items():
            pos = np.flatnonzero(s >= max(bars[slot], 1))
            if len(pos):
                best = pos[np.argsort(-s[pos], kind="stable")[:top]]          # positions ascend with the ids
                keep = best if last else pos
                out.append((slot, keep.astype(_POS).tobytes(), s[keep].astype(_LONG).tobytes(), s[best].tolist()))
        cols = list(zip(*out)) or [[], [], [], []]
        return pa.table({"bundle": pa.array([key[0].as_py()] * len(out), pa.int32()),
                         "block": pa.array([key[1].as_py()] * len(out), pa.int64()),
                         "slot": pa.array(cols[0], pa.int32()), "pos": pa.array(cols[1], pa.binary()),
                         "score": pa.array(cols[2], pa.binary()), "tops": pa.array(cols[3], pa.list_(pa.int64()))})

    return run


def _unpack(batches):
    """One row per kept document: bundle, slot, block, pos, score."""
    for rb in batches:
        pos = [np.frombuffer(p.as_buffer(), _POS) for p in rb.column(3)]
        size = [len(p) for p in pos]
        rows = pa.array(np.repeat(np.arange(rb.num_rows), size))
        yield K.batch(["bundle", "slot", "block", "pos", "score"], [
            rb.column(0).take(rows), rb.column(2).take(rows), rb.column(1).take(rows),
            np.concatenate([np.zeros(0, _POS), *pos]).astype(np.int32),
            np.concatenate([np.zeros(0, _LONG), *[np.frombuffer(s.as_buffer(), _LONG) for s in rb.column(4)]])])


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
           item_text_col: str = "text", top: int = TOP, owners: tuple = OWNERS, bundle: int = BUNDLE,
           block: int = BLOCK) -> DataFrame:
    """Each item's ``top`` documents: item, rank, id, score."""
    spark = docs.sparkSession
    lowered = F.translate(F.coalesce(F.col(item_text_col), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = (items.select(F.col(item_col).alias("item"), F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
             .distinct())
    names = asked.select("item").distinct()
    bundles = max(1, -(-names.count() // bundle))
    names = names.withColumn("bundle", F.pmod(F.xxhash64("item"), F.lit(bundles)).cast("int"))
    names = written(names.withColumn("slot", F.row_number().over(Window.partitionBy("bundle").orderBy("item"))), "items")
    asked = written(asked.join(names, asked["item"].eqNullSafe(names["item"])).select("bundle", "slot", "term"), "asked")
    sieve = X.sieve(spark, asked.select("term").distinct().mapInArrow(_hash_terms, "h long"), bits=1 << 22)

    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))
    blocks = written(source.mapInArrow(_blocker(sieve, block), BLOCKS), "blocks")
    n_docs, n_terms = blocks.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("terms"), F.lit(0))).first()
    impacts = written(blocks.where("term is not null").mapInArrow(_weigher(n_docs, n_terms), IMPACTS), "impacts")
    terms = (impacts.groupBy("term").agg(F.sum("df").alias("df"), F.max("best").alias("best"))
             .withColumn("weight", F.floor(1000 * F.log((F.lit(2.0 * n_docs + 2) / (2 * F.col("df") + 1)))).cast("long")))
    owner = F.lit(len(owners))
    for i, share in reversed(list(enumerate(owners))):
        owner = F.when(F.col("df") <= share * n_docs, i).otherwise(owner)
    asked_of = written(asked.join(terms.withColumn("owner", owner).hint("merge"), "term"), "weights")
    # what the terms of the stages from s on may add to an item at most
    rest = written(asked_of.groupBy("bundle", "slot").agg(
        *[F.sum(F.when(F.col("owner") >= s, F.col("weight") * F.col("best")).otherwise(0)).alias(f"rest{s}")
          for s in range(len(owners) + 2)]), "rest")
    discard(asked)

    held = spark.createDataFrame([], SCORES)
    floors = rest.select("bundle", "slot", F.lit(0).cast("long").alias("floor"))
    old = []
    for s in range(len(owners) + 1):
        bars = written(floors.join(rest, ["bundle", "slot"]).select(
            "bundle", "slot", (F.col("floor") - F.col(f"rest{s}")).alias("need"),
            (F.col("floor") - F.col(f"rest{s + 1}")).alias("must")), "bars")
        owned = (asked_of.where(F.col("owner") == s).join(bars, ["bundle", "slot"]).groupBy("term", "bundle")
                 .agg(F.collect_list(F.struct("slot", "need", "must")).alias("slots"), F.first("weight").alias("weight")))
        postings = impacts.join(owned.hint("merge"), "term").select("bundle", "block", "weight", "slots", "pos", "impact")
        left = held.join(bars, ["bundle", "slot"]).select("bundle", "block", "slot", "need", "must", "pos", "score")
        held = written(left.groupBy("bundle", "block").cogroup(postings.groupBy("bundle", "block"))
                       .applyInArrow(_stage(top, s == len(owners)), SCORES), "scores")
        discard(bars, *old)
        old = [held]
        best = held.select("bundle", "slot", F.explode("tops").alias("x"))
        best = best.withColumn("r", F.row_number().over(Window.partitionBy("bundle", "slot").orderBy(F.desc("x")))).where(F.col("r") <= top)
        best = best.groupBy("bundle", "slot").agg(F.min("x").alias("x"), F.count(F.lit(1)).alias("n"))
        floors = (rest.select("bundle", "slot").join(best, ["bundle", "slot"], "left")
                  .select("bundle", "slot", F.when(F.col("n") == top, F.col("x")).otherwise(0).alias("floor")))
    discard(impacts, asked_of, rest)

    found = held.mapInArrow(_unpack, "bundle int, slot int, block long, pos int, score long")
    ids = blocks.where("ids is not null").select("block", F.posexplode("ids").alias("pos", "doc"))
    best = Window.partitionBy("bundle", "slot").orderBy(F.desc("score"), F.asc_nulls_last("doc"))
    ranked = (found.join(ids.hint("merge"), ["block", "pos"]).withColumn("rank", F.row_number().over(best))
              .where(F.col("rank") <= top).join(names, ["bundle", "slot"]))
    return ranked.select(F.col("item").alias(item_col), F.col("rank").cast("int").alias("rank"),
                         F.col("doc").alias(id_col), "score")
