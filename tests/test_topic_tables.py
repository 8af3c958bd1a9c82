"""Dense index, vocabulary places, sparse rows and the table-held topic model."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardline.operators.features import feature_index, sparse_features, sparse_points
from wardline.operators.ranking import dense_index
from wardline.operators.text import sparse_terms, vocabulary_index
from wardline.operators.topic_tables import _counts, first_shares, fit_topic_tables, fitted_topics, fold_in, table_top_terms


def made_tokens(n=40, seed=1):
    rng = random.Random(seed)
    groups = [[f"a{i}" for i in range(12)], [f"b{i}" for i in range(12)], [f"c{i}" for i in range(12)]]
    rows = [(i, rng.choices(groups[i % 3], k=rng.randint(5, 30)) + rng.choices(sum(groups, []), k=2)) for i in range(n)]
    return [*rows, (n, [f"z{i}" for i in range(150)] + ["a0"] * 50), (n + 1, []), (n + 2, None)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "note_id long, tokens array<string>").repartition(3)


def vocabulary_of(rows):
    counts = {}
    for _, tokens in rows:
        for t in tokens or []:
            counts[t] = counts.get(t, 0) + 1
    order = sorted(counts, key=lambda t: (-counts[t], t))
    return counts, {t: i for i, t in enumerate(order)}


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_dense_index_with_one_hot_first_key(spark, parts):
    rows = [(1 if i % 3 else i, i * 7919 % 1000) for i in range(1000)]
    got = dense_index(spark.createDataFrame(rows, "a long, b long").repartition(5), [F.col("a").desc(), "b"],
                      partitions=parts).collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["index"])] == sorted(rows, key=lambda r: (-r[0], r[1]))
    assert sorted(r["index"] for r in got) == list(range(1000))
    assert dense_index(spark.createDataFrame([], "a long"), ["a"]).count() == 0


def test_vocabulary_and_sparse_terms(spark):
    rows = made_tokens()
    counts, place = vocabulary_of(rows)
    tokens = frame(spark, rows)
    vocabulary = vocabulary_index(tokens)
    assert {r.term: (r.n, r["index"]) for r in vocabulary.collect()} == {t: (counts[t], place[t]) for t in counts}
    want = {i: (sorted({place[x] for x in t}), [float(t.count(x)) for x in sorted(set(t), key=place.get)])
            for i, t in rows if t}
    assert {r.note_id: (r.indices, r["values"]) for r in sparse_terms(tokens, vocabulary).collect()} == want


def test_sparse_terms_shuffle_a_token_twice(spark):
    """No shuffle by (document, term) in front of the join; repeated, null and empty documents stay right."""
    rows = [(1, ["b", "a", "b"]), (1, ["a", "c"]), (None, ["c", "c", "a"]), (None, ["c"]), (2, []), (3, None), (4, ["x", "b"])]
    tokens = frame(spark, rows)
    vocabulary = spark.createDataFrame([("a", 0), ("b", 1), ("c", 2), ("never", 3)], "term string, index long")
    got = sparse_terms(tokens, vocabulary)
    assert {r.note_id: (r.indices, r["values"]) for r in got.collect()} == {
        1: ([0, 1, 2], [2.0, 2.0, 1.0]), None: ([0, 2], [1.0, 3.0]), 4: ([1], [1.0])}
    assert got.dtypes == [("note_id", "bigint"), ("indices", "array<int>"), ("values", "array<double>")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sparse_terms(tokens, vocabulary)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("hashpartitioning(") == 3 and not re.search(r"hashpartitioning\([^)]*note_id[^)]*term", plan), plan


def test_sparse_points(spark):
    rows = [(1, "F10", 2.0), (1, "f9", 1.0), (2, "f5000", 3.0), (2, "F5000", 2.5), (3, "f9", None), (4, None, 1.0)]
    rows += [(5, f"f{i}", float(i)) for i in range(3000)]
    long = spark.createDataFrame(rows, "pid long, feature string, value double")
    index = feature_index(long)
    names = sorted({f.lower() for _, f, _ in rows if f})
    assert [r.feature for r in index.orderBy("index").collect()] == names
    labels = spark.createDataFrame([(i, i % 2, "x") for i in (1, 2, 3, 5)], "pid long, label int, features string")
    points = {r.pid: r for r in sparse_points(sparse_features(long, index), labels, len(names)).collect()}
    assert sorted(points) == [1, 2, 5] and points[1].label == 1.0 and points[2].features.size == len(names)
    assert dict(zip(points[2].features.indices, points[2].features.values)) == {names.index("f5000"): 2.5}
    assert points[5].features[names.index("f2999")] == 2999.0 and points[1].features.numNonzeros() == 2


def numpy_fit(rows, k, passes, alpha, eta, seed):
    _, place = vocabulary_of(rows)
    n = np.zeros((len(rows), len(place)))
    for i, (_, tokens) in enumerate(rows):
        for t in tokens or []:
            n[i, place[t]] += 1
    d, w = np.nonzero(n)
    c = n[d, w]
    share = first_shares(np.array([rows[i][0] for i in d]), w, k, seed)
    likelihoods, objectives = [], []
    for step in range(passes + 1):
        of_doc, of_term = np.zeros((len(rows), k)), np.zeros((len(place), k))
        np.add.at(of_doc, d, share * c[:, None])
        np.add.at(of_term, w, share * c[:, None])
        theta = of_doc + alpha - 1
        theta /= theta.sum(1, keepdims=True)
        phi = (of_term + eta - 1) / (of_term.sum(0) + len(place) * (eta - 1))
        share = phi[w] * theta[d]
        likelihoods.append((c * np.log(share.sum(1))).sum())
        objectives.append(likelihoods[-1] + (alpha - 1) * np.log(theta[n.sum(1) > 0]).sum() + (eta - 1) * np.log(phi).sum())
        share /= share.sum(1, keepdims=True)
    return theta, phi, likelihoods[:passes], objectives


def test_tables_equal_numpy(spark):
    rows = made_tokens()
    k, passes, alpha, eta = 3, 12, 1.5, 1.1
    tokens = frame(spark, rows)
    model = fit_topic_tables(tokens, k, passes, alpha=alpha, eta=eta, cells=300, span=40)     # many blocks, split documents
    theta, phi, likelihoods, objectives = numpy_fit(rows, k, passes, alpha, eta, 42)
    assert all(b >= a - 1e-9 for a, b in zip(objectives, objectives[1:]))
    assert np.allclose(model.log_likelihood, likelihoods, rtol=1e-9) and likelihoods[-1] > likelihoods[0]
    got = {r.note_id: r.topics for r in fitted_topics(model).collect()}
    assert sorted(got) == [i for i, t in rows if t]
    assert np.allclose([got[i] for i in sorted(got)], theta[sorted(got)], rtol=1e-9)
    _, place = vocabulary_of(rows)
    best = table_top_terms(model, 5).collect()
    assert len(best) == 15
    for r in best:
        assert np.isclose(r.weight, phi[place[r.term], r.topic], rtol=1e-9)
        assert r["rank"] == int((phi[:, r.topic] > r.weight * (1 + 1e-9)).sum())


def test_blocks_hold_one_span_and_send_each_term_once_per_part(spark):
    """What a pass moves is a row per term and document of each block, so blocks share few of them."""
    rows = [(i, [f"w{(i * j) % 90}" for j in range(60)]) for i in range(60)]
    tokens = frame(spark, rows)
    vocabulary = vocabulary_index(tokens)
    n, terms = sum(len(set(t)) for _, t in rows), len({x for _, t in rows for x in t})
    counts, routes = _counts(tokens, vocabulary, 2, "note_id", "tokens", 2 * -(-n // 2), 1 << 18)
    assert routes.where("kind = 0").count() <= 2 * terms and routes.where("kind = 1").count() == 60
    assert counts.agg(F.sum(F.size("term"))).first()[0] == n and counts.count() == 60       # a row per document
    counts, routes = _counts(tokens, vocabulary, 2, "note_id", "tokens", 400, 30)
    spans = routes.where("kind = 0").groupBy("block").agg(F.countDistinct(F.expr("id div 30")).alias("n"))
    assert {r.n for r in spans.collect()} == {1} and spans.count() > 3
    assert counts.agg(F.sum(F.aggregate("n", F.lit(0.0), lambda a, x: a + x))).first()[0] == 60 * 60


def test_fold_in_separates_groups(spark):
    rows = made_tokens(60)[:60]
    model = fit_topic_tables(frame(spark, rows), 3, 25, alpha=1.1)
    new = [(100 + g, [f"{'abc'[g]}{i}" for i in range(10)] + ["never seen"]) for g in range(3)] + [(200, ["unknown"])]
    got = {r.note_id: r.topics for r in fold_in(model, frame(spark, new), 10).collect()}
    assert sorted(got) == [100, 101, 102]
    assert len({int(np.argmax(v)) for v in got.values()}) == 3 and min(max(v) for v in got.values()) > 0.8


def test_solvers_of_fit_topics(spark):
    from wardline.operators.topics import fit_topics, note_topics, top_terms

    tokens = frame(spark, made_tokens(12))
    for optimizer in ("tables", "em"):
        model = fit_topics(tokens, 2, 3, optimizer=optimizer)
        assert top_terms(model, 4).count() == 8
        got = note_topics(model, tokens).collect()
        assert len(got) == 13 and all(abs(sum(r.topics) - 1) < 1e-9 for r in got)


def test_empty_model(spark):
    model = fit_topic_tables(frame(spark, [(1, []), (2, None)]), 2, 2)
    assert model.size == 0 and table_top_terms(model).count() == 0 and fitted_topics(model).count() == 0
