"""Mixing sources to target weights by cube-method balanced sampling.

Targets: the sources, in code point order with null last, have the weights
``WEIGHTS`` in turn; they share the total size by weight, a target stops at
``CAP`` times its source's size, and the excess is reshared by weight.

A document of a source with target / size = m is taken floor(m) times for
certain and once more with inclusion probability m - floor(m).  The cube
method decides these extras so that, per source, both balancing totals hold:
the number of documents and the number of words.  Flight: in a block of a
source's documents, three undecided ones move along the null space of their
two constraints until one of them reaches 0 or 1; two remain at most.  What
remains of the blocks meets in the next level's blocks, until one block per
source is left; a source's first block waits for that, so that the last one
has a choice.  Landing: its two documents at most take the integer values
that leave the smallest error in words, then in documents; two swaps of a
taken for another document of that block at most then mend what a long
document left over.

The choice depends on the rows only (a block's generator is seeded by its
number), so reruns agree.

Defined results: null text has size 0; sources of size 0 have target 0; rows
repeated with one id are drawn one by one; an empty table gives an empty
result; ``mix_documents`` keeps all columns and repeats rows taken repeatedly.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardline.llm.rows import packed, unpacked
from wardline.session import stored

WEIGHTS = (5, 2, 1)
CAP = 3
BLOCK = 4096         # documents of a block of the first level
FAN_IN = 1024        # blocks that meet in one block of the next level
EPS = 1e-9
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights=WEIGHTS, cap: float = CAP) -> DataFrame:
    """(rank, source, source_size, n_docs, target); ``sizes`` has columns source and size."""
    src = stored(sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"),
                                             F.count(F.lit(1)).alias("n_docs")), "sources")
    order = Window.orderBy(F.col("source").asc_nulls_last())           # one row per source
    turn = F.pmod(F.col("rank"), F.lit(len(weights)))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    most = F.col("source_size") * F.lit(float(cap))
    # water level: sources in the order in which they reach their cap as the level rises
    rising = Window.orderBy((F.col("most") / F.col("weight")).asc(), "rank")
    ranked = (src.withColumn("rank", F.row_number().over(order) - 1)
              .withColumn("weight", weight).withColumn("most", most))
    everything = Window.partitionBy()
    left = (F.sum("source_size").over(everything)
            - F.coalesce(F.sum("most").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    level = left / F.sum("weight").over(rising.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.withColumn("level", level)
    reached = F.min(F.when(F.col("most") >= F.col("level") * F.col("weight"), F.struct("rank_up", "level"))).over(everything)
    levels = levels.withColumn("rank_up", F.row_number().over(rising)).withColumn("stop", reached)
    target = F.least("most", F.coalesce(F.col("stop.level") * F.col("weight"), "most"))
    return levels.select("rank", "source", "source_size", "n_docs", target.alias("target"))


def flight(x: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move the probabilities, keeping sum(x) and sum(size * x), until two at most are undecided."""
    x = x.copy()
    draws = rng.random(len(x) + 1)
    undecided = [i for i in range(len(x)) if EPS < x[i] < 1 - EPS]
    hand, k, step = [], 0, 0
    while True:
        while len(hand) < 3 and k < len(undecided):
            hand.append(undecided[k])
            k += 1
        z = [size[i] for i in hand]
        if len(hand) == 3:
            u = (z[1] - z[2], z[2] - z[0], z[0] - z[1]) if not z[0] == z[1] == z[2] else (1.0, -1.0, 0.0)
        elif len(hand) == 2 and z[0] == z[1]:
            u = (1.0, -1.0)
        else:
            return x
        up = min((1 - x[i]) / c if c > 0 else x[i] / -c for i, c in zip(hand, u) if c)
        down = min(x[i] / c if c > 0 else (1 - x[i]) / -c for i, c in zip(hand, u) if c)
        move = up if draws[step % len(draws)] * (up + down) < down else -down
        step += 1
        for i, c in zip(hand, u):
            x[i] += move * c
            if x[i] <= EPS:
                x[i] = 0.0
            elif x[i] >= 1 - EPS:
                x[i] = 1.0
        hand = [i for i in hand if 0.0 < x[i] < 1.0]


def landing(x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Integer values for the few undecided ones: least error in words, then in documents."""
    x = x.copy()
    left = np.flatnonzero((x > 0) & (x < 1))
    best = None
    for choice in range(1 << len(left)):
        take = np.array([choice >> i & 1 for i in range(len(left))], float)
        error = (abs(float(((take - x[left]) * size[left]).sum())), abs(float((take - x[left]).sum())), choice)
        if best is None or error < best[0]:
            best = (error, take)
    x[left] = best[1]
    return x


def settle(x: np.ndarray, size: np.ndarray, words: float, swaps: int = 2) -> np.ndarray:
    """Swap a taken document for one that is not where that brings the words nearer to ``words``."""
    x = x.copy()
    for _ in range(swaps):
        error = float((x * size).sum()) - words
        taken, free = np.flatnonzero(x == 1), np.flatnonzero(x == 0)
        if not len(taken) or not len(free):
            break
        free = free[np.argsort(size[free], kind="stable")]
        wanted = size[taken] - error
        at = np.searchsorted(size[free], wanted)
        near = np.stack([np.clip(at - 1, 0, len(free) - 1), np.clip(at, 0, len(free) - 1)])
        off = np.abs(size[free][near] - wanted)
        i, j = np.unravel_index(off.argmin(), off.shape)
        if off[i, j] >= abs(error):
            break
        x[taken[j]], x[free[near[i, j]]] = 0.0, 1.0
    return x


def _decide(level: int, last: bool):
    def decide(rows: pd.DataFrame) -> pd.DataFrame:
        if not last and rows["block"].iloc[0] == 0:
            return rows
        rows = rows.sort_values(["doc_id", "content", "size"], kind="stable")
        seed = (level, int(rows["rank"].iloc[0]), int(rows["block"].iloc[0]))
        rng = np.random.default_rng(seed)
        rows = rows.iloc[rng.permutation(len(rows))]
        size = rows["size"].to_numpy(float)
        start = rows["x"].to_numpy(float)
        x = flight(start, size, rng)
        return rows.assign(x=settle(landing(x, size), size, float((start * size).sum())) if last else x)

    return decide


UNIT = "doc_id long, content long, size long, rank int, source_size long, target double, base int, x double, block long"


def draw(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
         weights=WEIGHTS, cap: int = CAP, block: int = BLOCK, fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, content, size, source_size, target, copies, taken."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    sizes = stored(docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"),
                               F.xxhash64(text).alias("content"),
                               F.regexp_count(text, F.lit(WORD)).cast("long").alias("size")), "sizes")
    targets = stored(source_targets(sizes, weights, cap), "targets")
    most = targets.agg(F.max("n_docs")).first()[0] or 0
    m = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    m = F.when(F.abs(m - F.round(m)) < EPS, F.round(m)).otherwise(m)
    blocks = F.ceil(F.col("n_docs") / F.lit(block))
    units = (_with_targets(sizes, targets).withColumn("m", m).withColumn("base", F.floor("m").cast("int"))
             .withColumn("x", F.col("m") - F.col("base"))
             .withColumn("block", F.pmod(F.xxhash64("doc_id", "content"), blocks))
             .select(*[c.split()[0] for c in UNIT.split(", ")]))
    done, count, level = [], -(-most // block), 0
    while True:
        last = count <= 1
        moved = stored(units.groupBy("rank", "block").applyInPandas(_decide(level, last), UNIT), "flight")
        if last:
            done.append(moved)
            break
        done.append(moved.where("x <= 0 or x >= 1"))
        units = moved.where("x > 0 and x < 1").withColumn("block", F.floor(F.col("block") / F.lit(fan_in)))
        count, level = -(-count // fan_in), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    copies = (F.col("base") + F.round("x")).cast("int")
    return out.select("doc_id", "content", "size", "source_size", "target", copies.alias("copies"),
                      (F.col("size") * copies).alias("taken"))


def _with_targets(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    right = targets.withColumnRenamed("source", "_source")
    return sizes.join(right.hint("merge"), F.col("source").eqNullSafe(F.col("_source")))


def mix_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The mix: all columns, each row as often as it is taken."""
    drawn = (draw(docs, id_col, text_col, **options).groupBy("doc_id", "content")
             .agg(F.sum("copies").cast("int").alias("_copies")).where("_copies > 0")
             .withColumnsRenamed({"doc_id": "_id", "content": "_content"}))
    rows = packed(docs, _key=F.col(id_col).cast("long"), _hash=F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    on = F.col("_id").eqNullSafe(F.col("_key")) & (F.col("_content") == F.col("_hash"))
    once = rows.join(drawn.hint("merge"), on).dropDuplicates(["_key", "_hash"])
    return unpacked(once.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))), docs)
