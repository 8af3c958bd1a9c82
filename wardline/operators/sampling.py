"""Reproducible splits and rebalancing.

Every random choice is a hash of (seed, key), so a re-run - or a task
re-executed after a lost executor - draws the same rows; no sampled state
is kept on the driver, only the hash an exact sample ends at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.functions.values import hash_uniform
from wardline.session import discard, written

HASH_BITS = 32      # of hash_uniform


def split_hash(df: DataFrame, p: float = 0.7, seed: int = 42, key: str = "pid") -> DataFrame:
    """``is_train`` = 1 iff hash-uniform(seed, key) < p (Bernoulli split)."""
    return df.withColumn("is_train", (hash_uniform(F.col(key), seed) < F.lit(float(p))).cast("int"))


def _hash_cell(key: str, seed: int) -> Column:
    """The 32-bit hash of ``hash_uniform`` plus one, as a long; 0 for a null key."""
    return F.coalesce((hash_uniform(F.col(key), seed) * F.lit(2.0 ** HASH_BITS)).cast("long") + 1, F.lit(0).cast("long"))


def _smallest(hashed: DataFrame, k: int, key: str, seed: int) -> Column:
    """The condition that holds for the ``k`` rows with the smallest (hash, key).

    ``hashed``: (_h, key) rows.  A histogram of the upper hash bits finds the cell
    of the k-th row, one of the lower bits within that cell its hash; both have a
    fixed number of cells.  Only keys of that one hash are compared themselves.
    Rows of one key stay together: where the k-th row's key has more rows than
    are wanted, none of them is taken.
    """
    h, low = _hash_cell(key, seed), (HASH_BITS + 1) // 2
    at, left = 0, k
    for shift, part in ((low, F.shiftright("_h", low)), (0, F.col("_h").bitwiseAND(F.lit((1 << low) - 1)))):
        within = hashed if shift else hashed.where(F.shiftright("_h", low) == F.lit(at >> low))
        for cell, n in sorted((r[0], r[1]) for r in within.groupBy(part.alias("c")).agg(F.count(F.lit(1))).collect()):
            if left < n:
                break
            left -= n
        else:
            return F.lit(True)                                 # as many rows as there are
        at += cell << shift
    # distinct keys of one 32-bit hash, about rows / 2**32
    ties = hashed.where(F.col("_h") == F.lit(at)).groupBy(key).agg(F.count(F.lit(1)).alias("n")).orderBy(key).collect()
    chosen = h < F.lit(at)
    for name, n in ties:
        if left < n:
            break
        left -= n
        chosen = chosen | ((h == F.lit(at)) & F.col(key).eqNullSafe(F.lit(name)))
    return chosen


def split_exact(df: DataFrame, p: float = 0.7, seed: int = 42, key: str = "pid",
                exact: bool = True) -> DataFrame:
    """Exactly floor(n * p) rows get ``is_train`` = 1, the ones with the
    smallest hash; ``exact=False`` is the Bernoulli rule of X1.  The caller
    picks the rule; it does not change with the size of the table.

    Keys are expected to be unique; rows that share one are never parted, so
    there may then be fewer.  The hashes are written once and searched by two
    histograms; the split itself is a filter, without a window or a join.
    """
    if not exact:
        return split_hash(df, p, seed, key)
    hashed = written(df.select(_hash_cell(key, seed).alias("_h"), key), "hashes")
    chosen = _smallest(hashed, math.floor(hashed.count() * float(p)), key, seed)
    discard(hashed)
    return df.withColumn("is_train", chosen.cast("int"))


def subtract_entities(left: DataFrame, right: DataFrame, key: str = "pid") -> DataFrame:
    """Rows of ``left`` whose key is not in ``right`` (every copy removed)."""
    return left.join(right.select(key), key, "left_anti")


def rebalance(train: DataFrame, labels: DataFrame | None = None, pos_share: float = 0.3, exact: bool = True,
              seed: int = 42, key: str = "pid") -> DataFrame:
    """X4 (A9, J12): keep every positive and enough negatives for a (1-s):s mix.

    If the positive share already is >= s, ``train`` is returned as is.
    Otherwise negatives are kept by hash (exact: the floor(pos/s*(1-s)) with the
    smallest, found like in :func:`split_exact`) or by a hash threshold (Bernoulli
    with the same expected count).  The filter needs no window or join.
    Without ``labels`` the rows carry their own ``label``.
    """
    if labels is None:
        lab = train.withColumn("_label", F.col("label"))
    else:
        lab = train.join(labels.select(key, F.col("label").alias("_label")), key, "left")
    hashed = written(lab.where("_label is not null").select(_hash_cell(key, seed).alias("_h"), key, "_label"), "hashes")
    total, pos = hashed.agg(F.count(F.lit(1)), F.coalesce(F.sum("_label"), F.lit(0))).first()
    if total and pos / total >= float(pos_share):
        kept = lab
    else:
        want = pos / float(pos_share) * (1.0 - pos_share)
        if exact:
            chosen = _smallest(hashed.where("_label = 0"), math.floor(want), key, seed)
        else:
            chosen = hash_uniform(F.col(key), seed) < F.lit(want / max(total - pos, 1))
        kept = lab.where((F.col("_label") == 1) | ((F.col("_label") == 0) & chosen))
    discard(hashed)
    return kept.select(*train.columns)


def kfold(df: DataFrame, k: int = 5, seed: int = 7, key: str = "pid") -> DataFrame:
    """``fold`` in 0..k-1 from the hash (equal expected sizes)."""
    return df.withColumn("fold", F.floor(hash_uniform(F.col(key), seed) * F.lit(k)).cast("int"))
