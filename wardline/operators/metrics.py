"""Evaluation: confusion counts, rates, tie-correct ROC area, attrition
counts, grid selection (A9-A14, M14).

The ROC area is the Mann-Whitney statistic with mid-ranks for tied scores:
for positives p(s) and negatives q(s) at each distinct score s,
``AUC = sum_s p(s) * (negatives below s + q(s)/2) / (P * N)``.
"Negatives below s" is a running sum over distinct scores, computed per range
of (group, score), so no evaluation is ever sorted in a single task.  Twice every summand is an integer; they are summed
as ``decimal(38, 0)`` and divided once, so the result does not depend on the
order of summation.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CONFUSION = ("tp", "fp", "tn", "fn")


def confusion_counts(pred: DataFrame, score: str = "score", label: str = "label",
                     by: Sequence[str] = (), threshold: float = 0.0,
                     mode: str = "threshold") -> DataFrame:
    """A10 + A11: tp, fp, tn, fn, total, positives, accuracy, sensitivity,
    specificity per group.

    ``mode='threshold'``: predicted positive iff score > threshold.
    ``mode='exact'``: the reference's rule - a row is "correct" iff the raw
    score equals the label (meaningless for raw margins, kept for parity).
    """
    return _rates(pred.groupBy(*by).agg(*_confusion(score, label, threshold, mode)), by)


def _confusion(score: str, label: str, threshold: float, mode: str) -> list:
    pos = F.col(label) > 0
    if mode == "exact":
        correct = F.col(score) == F.col(label)
        tp, tn = correct & pos, correct & ~pos
        fn, fp = ~correct & pos, ~correct & ~pos
    elif mode == "threshold":
        pp = F.col(score) > F.lit(float(threshold))
        tp, fp, tn, fn = pp & pos, pp & ~pos, ~pp & ~pos, ~pp & pos
    else:
        raise ValueError("mode must be 'threshold' or 'exact'")
    return [F.sum(c.cast("long")).alias(name) for c, name in zip((tp, fp, tn, fn), CONFUSION)]


def _rates(agg: DataFrame, by: Sequence[str], *more: str) -> DataFrame:
    total = F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn")
    return agg.select(
        *by, *more, "tp", "fp", "tn", "fn", total.alias("total"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        F.try_divide((F.col("tp") + F.col("tn")).cast("double"), total).alias("accuracy"),
        F.try_divide(F.col("tp").cast("double"), F.col("tp") + F.col("fn")).alias("sensitivity"),
        F.try_divide(F.col("tn").cast("double"), F.col("tn") + F.col("fp")).alias("specificity"))


def auc_midrank(pred: DataFrame, score: str = "score", label: str = "label",
                by: Sequence[str] = (), buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve per group, ties counted half.

    Null when a group has no positives or no negatives; null scores rank lowest.
    ``buckets`` (default: the session's shuffle partitions, so tasks follow the
    cluster) is the number of ranges the distinct scores are dealt to.
    """
    counts = pred.groupBy(*by, score).agg(*_class_counts(label))
    return auc_from_counts(counts, score, list(by), buckets)


def _class_counts(label: str) -> list:
    return [F.sum((F.col(label) > 0).cast("long")).alias("p"), F.sum((F.col(label) <= 0).cast("long")).alias("q")]


def auc_from_counts(counts: DataFrame, score: str, by: list[str], buckets: int | None = None,
                    totals: Sequence[str] = ()) -> DataFrame:
    """(by..., auc) from (by..., score, p positives, q negatives), one row per distinct score.

    The rows are dealt by ranges of (by, score), so that a group with most of
    them is split.  Each range sums its own pairs; the negatives of the ranges
    before it enter through one row per group and range, and no bounds or
    offsets are attached to rows.  ``totals`` are summed per group on the way.
    """
    spark = counts.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = "_part"
    rows = counts.repartitionByRange(n, *by, score).withColumn(part, F.spark_partition_id())
    own = Window.partitionBy(part, *by).orderBy(score).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_below", F.coalesce(F.sum("q").over(own), F.lit(0)))
    pairs = F.col("p").cast("decimal(18,0)") * (2 * F.col("_below") + F.col("q")).cast("decimal(19,0)")
    ranges = rows.groupBy(*by, part).agg(F.sum(pairs).alias("_c"), F.sum("p").alias("_p"), F.sum("q").alias("_q"),
                                         *[F.sum(c).alias(c) for c in totals])
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)   # <= n rows a group
    ranges = ranges.withColumn("_off", F.coalesce(F.sum("_q").over(before), F.lit(0)))
    across = F.col("_p").cast("decimal(18,0)") * (2 * F.col("_off")).cast("decimal(19,0)")
    agg = ranges.groupBy(*by).agg(F.sum(F.col("_c") + across).alias("_c"), F.sum("_p").alias("_P"), F.sum("_q").alias("_N"),
                                  *[F.sum(c).alias(c) for c in totals])
    return agg.select(*by, *totals, F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                                           F.col("_c").cast("double") / (2.0 * F.col("_P") * F.col("_N"))).alias("auc"))


def binary_metrics(pred: DataFrame, score: str = "score", label: str = "label",
                   by: Sequence[str] = (), threshold: float = 0.0, mode: str = "threshold") -> DataFrame:
    """Total, positives, auc, accuracy, sensitivity, specificity.

    ``pred`` is read once: area and confusion counts come from the same counts per score.
    """
    counts = pred.groupBy(*by, score).agg(*_class_counts(label), *_confusion(score, label, threshold, mode))
    m = _rates(auc_from_counts(counts, score, list(by), totals=CONFUSION), by, "auc")
    return m.select(*by, "total", "positives", "auc", "accuracy", "sensitivity", "specificity")


def attrition_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """One (stage, n) row per named table: one aggregate over the tagged rows
    (a row with 0 per stage keeps empty ones)."""
    spark = next(iter(stages.values())).sparkSession
    rows = [df.select(F.lit(name).alias("stage"), F.lit(1).alias("n")) for name, df in stages.items()]
    rows.append(spark.createDataFrame([(name, 0) for name in stages], "stage string, n int"))
    return reduce(DataFrame.unionByName, rows).groupBy("stage").agg(F.sum("n").alias("n"))


def best_by_mean(results: DataFrame, params: Sequence[str], metric: str = "auc",
                 order: str = "grid_pos") -> DataFrame:
    """A14 + T2: mean metric per parameter set over folds, and a flag for the
    best one (largest mean; on ties the first grid position; a mean must
    exceed 0 to be chosen, as the search starts from 0)."""
    m = results.groupBy(*params, order).agg(F.avg(metric).alias(f"mean_{metric}"))
    best = (m.where(F.col(f"mean_{metric}") > 0)
            .agg(F.min_by(order, F.struct(-F.col(f"mean_{metric}"), F.col(order))).alias("_best")))
    return m.withColumn("is_best", (F.col(order) == best.select("_best").scalar()).cast("int"))
