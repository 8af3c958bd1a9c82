import random

import pytest
from pyspark.sql import functions as F

from wardline.operators.metrics import auc_midrank, best_by_mean, confusion_counts
from wardline.operators.ranking import bucketed_row_number


def brute_auc(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    if not pos or not neg:
        return None
    tot = sum((1.0 if p > n else 0.5 if p == n else 0.0) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_auc_matches_brute_force_with_ties(spark, seed):
    rnd = random.Random(seed)
    rows = [(float(rnd.randint(0, 30)), rnd.randint(0, 1), g) for g in range(3) for _ in range(300)]
    df = spark.createDataFrame(rows, "score double, label int, g int")
    got = {r.g: r.auc for r in auc_midrank(df, by=["g"], buckets=8).collect()}
    for g in range(3):
        assert got[g] == pytest.approx(brute_auc([(s, y) for s, y, gg in rows if gg == g]), abs=1e-12)
    neg = df.withColumn("score", -F.col("score"))
    got_neg = {r.g: r.auc for r in auc_midrank(neg, by=["g"], buckets=8).collect()}
    for g in range(3):
        assert got_neg[g] == pytest.approx(1 - got[g], abs=1e-12)


def test_auc_single_class_is_null(spark):
    df = spark.createDataFrame([(0.1, 1), (0.2, 1)], "score double, label int")
    assert auc_midrank(df).first().auc is None


def test_confusion_modes(spark):
    df = spark.createDataFrame([(0.5, 1), (-0.5, 1), (0.5, 0), (-0.2, 0), (1.0, 1)], "score double, label int")
    r = confusion_counts(df).first()
    assert (r.tp, r.fp, r.tn, r.fn) == (2, 1, 1, 1)
    assert r.total == 5 and r.positives == 3
    e = confusion_counts(df, mode="exact").first()      # correct iff score == label
    assert (e.tp, e.fp, e.tn, e.fn) == (1, 2, 0, 2)


def test_bucketed_rank_is_global(spark):
    rnd = random.Random(5)
    vals = [(i, rnd.random()) for i in range(500)]
    df = spark.createDataFrame(vals, "k long, u double").withColumn("b", F.floor(F.col("u") * 16))
    got = {r.k: r.rn for r in bucketed_row_number(df, [F.col("u"), F.col("k")], "b").collect()}
    want = {k: i + 1 for i, (k, _) in enumerate(sorted(vals, key=lambda kv: (kv[1], kv[0])))}
    assert got == want


def test_best_by_mean(spark):
    df = spark.createDataFrame([(0.1, 0, 0.6), (0.1, 0, 0.8), (1.0, 1, 0.7), (1.0, 1, 0.7)],
                               "w double, grid_pos int, auc double")
    r = {x.grid_pos: x.is_best for x in best_by_mean(df, ["w"]).collect()}
    assert r == {0: 1, 1: 0}          # the means tie: the first grid position wins


def test_auc_sums_stay_exact_beyond_doubles(spark):
    """3e9 positives and negatives per score: the pair counts pass 2**53."""
    from wardline.operators import metrics

    n = 3_000_000_001
    g = spark.createDataFrame([(0.0, n, n + 1), (1.0, n + 2, n), (2.0, n, n + 4)], "score double, p long, q long")
    below, total = 0, 0
    for p, q in ((n, n + 1), (n + 2, n), (n, n + 4)):
        total += p * (2 * below + q)
        below += q
    want = total / (2 * (3 * n + 2) * (3 * n + 5))
    assert metrics.auc_from_counts(g, "score", [], 16).first().auc == pytest.approx(want, rel=1e-15)


def test_null_groups_are_kept(spark):
    df = spark.createDataFrame([(0.1, 1, None), (0.2, 0, None), (0.3, 1, "a"), (0.1, 0, "a")],
                               "score double, label int, g string")
    assert {r.g: r.auc for r in auc_midrank(df, by=["g"]).collect()} == {None: 0.0, "a": 1.0}


def test_auc_of_a_group_with_most_rows_is_split(spark):
    """A group with most scores is dealt to many ranges, and the lineage is read once."""
    rnd = random.Random(7)
    rows = [("hot", rnd.random(), rnd.randint(0, 1)) for _ in range(4000)]
    rows += [(f"g{i}", rnd.random(), rnd.randint(0, 1)) for i in range(20) for _ in range(30)]
    df = spark.createDataFrame(rows, "g string, score double, label int")
    res = auc_midrank(df, by=["g"], buckets=8)
    got = {r.g: r.auc for r in res.collect()}
    for g in ("hot", "g0", "g7"):
        assert got[g] == pytest.approx(brute_auc([(s, y) for k, s, y in rows if k == g]), abs=1e-12)
    ranges = df.groupBy("g", "score").count().repartitionByRange(8, "g", "score").withColumn("part", F.spark_partition_id())
    assert ranges.where("g = 'hot'").select("part").distinct().count() >= 5
    assert res._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1


def test_binary_metrics_reads_its_rows_once(spark):
    from wardline.operators.metrics import binary_metrics

    rows = [(1, 0.9, 1), (1, 0.4, 1), (1, 0.4, 0), (1, -0.1, 0), (2, None, 1), (2, 0.2, 0), (2, 0.3, 1), (3, 0.3, 1)]
    df = spark.createDataFrame(rows, "g int, score double, label int")
    res = binary_metrics(df, by=["g"], threshold=0.3)
    assert res._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
    got = {r.g: r for r in res.collect()}
    conf = {r.g: r for r in confusion_counts(df, by=["g"], threshold=0.3).collect()}
    for g in got:
        assert all(got[g][c] == conf[g][c] for c in ("total", "positives", "accuracy", "sensitivity", "specificity"))
    assert got[1].auc == 0.875 and got[2].auc == 0.5 and got[3].auc is None
