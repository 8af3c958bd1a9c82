from pyspark.sql import functions as F

from wardline.operators.sampling import kfold, rebalance, split_exact, split_hash, subtract_entities


def ids(spark, n):
    return spark.range(n).select(F.col("id").cast("string").alias("pid"))


def test_exact_split_size_disjoint_complete(spark):
    df = ids(spark, 1001)
    s = split_exact(df, 0.7, seed=3)
    rows = s.collect()
    assert len(rows) == 1001
    assert sum(r.is_train for r in rows) == int(1001 * 0.7)
    again = {r.pid: r.is_train for r in split_exact(df, 0.7, seed=3).collect()}
    assert again == {r.pid: r.is_train for r in rows}          # reproducible


def test_hash_split_and_folds(spark):
    df = ids(spark, 2000)
    share = split_hash(df, 0.7, 1).agg(F.avg("is_train")).first()[0]
    assert 0.65 < share < 0.75
    folds = {r.fold for r in kfold(df, 5).collect()}
    assert folds == {0, 1, 2, 3, 4}


def test_rebalance_7_3(spark):
    df = ids(spark, 200)
    labels = df.withColumn("label", (F.col("pid").cast("int") < 20).cast("int"))
    kept = rebalance(df, labels, 0.3, exact=True, seed=1).join(labels, "pid")
    pos = kept.where("label = 1").count()
    neg = kept.where("label = 0").count()
    assert pos == 20 and neg == int(20 / 0.3 * 0.7)
    # already balanced: unchanged
    lab2 = df.withColumn("label", (F.col("pid").cast("int") < 100).cast("int"))
    assert rebalance(df, lab2, 0.3).count() == 200


def test_subtract(spark):
    a = ids(spark, 10)
    b = ids(spark, 4)
    assert subtract_entities(a, b).count() == 6


def test_null_keys_are_kept(spark):
    df = ids(spark, 50).unionByName(spark.createDataFrame([(None,)], "pid string"))
    rows = split_exact(df, 0.7, seed=3).collect()
    assert len(rows) == 51 and sum(r.is_train for r in rows) == int(51 * 0.7)


def test_exact_split_equals_a_sort(spark):
    from wardline.functions.values import hash_uniform

    df = ids(spark, 777)
    order = sorted((r.u, r.pid) for r in df.select("pid", hash_uniform(F.col("pid"), 9).alias("u")).collect())
    for p in (0.0, 0.01, 0.5, 0.999, 1.0):
        got = {r.pid for r in split_exact(df, p, seed=9).where("is_train = 1").collect()}
        assert got == {pid for _, pid in order[:int(777 * p)]}
    assert split_exact(df.limit(0)).count() == 0


def test_ties_of_the_hash_go_by_key(spark, monkeypatch):
    from wardline.operators import sampling

    monkeypatch.setattr(sampling, "hash_uniform", lambda key, seed: F.lit(0.25))
    df = ids(spark, 40)
    got = {r.pid for r in split_exact(df, 0.5).where("is_train = 1").collect()}
    assert got == set(sorted(str(i) for i in range(40))[:20])


def test_rows_of_one_key_stay_together(spark):
    df = spark.createDataFrame([("hot",)] * 30 + [(f"k{i}",) for i in range(60)], "pid string")
    rows = split_exact(df, 0.7, seed=3).collect()
    assert len({r.is_train for r in rows if r.pid == "hot"}) == 1
    assert sum(r.is_train for r in rows) <= 63 and len(rows) == 90


def test_split_plan_has_no_window(spark):
    plan = split_exact(ids(spark, 100), 0.7)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Join" not in plan and "Exchange" not in plan
