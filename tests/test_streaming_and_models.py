import datetime as dt
import uuid

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from wardline.operators.classify import fit_linear_svm, raw_scores
from wardline.operators.features import mean_vector
from wardline.operators.metrics import auc_midrank
from wardline.session import scratch_path
from wardline.streaming.notes import latest_note_stats, note_stats, start_note_stats

D = dt.datetime


def test_stream_equals_batch(spark):
    rows = [(i, str(i % 3), "h", D(2000, 1, 1 + i % 5), "Nursing", "word " * (i % 7) + "patient")
            for i in range(40)]
    notes = spark.createDataFrame(rows, "note_id long, pid string, hadm_id string, chart_ts timestamp_ntz, "
                                        "category string, text string")
    src = scratch_path(spark, "test-stream")
    notes.repartition(4).write.parquet(src)
    name = "t_" + uuid.uuid4().hex[:8]
    q = start_note_stats(spark, src, notes.schema, name, files_per_trigger=1)
    q.processAllAvailable()
    q.stop()
    got = sorted(map(tuple, spark.table(name).collect()))
    want = sorted(map(tuple, note_stats(notes).collect()))
    assert got == want
    out = scratch_path(spark, "test-stream-out")
    q = start_note_stats(spark, src, notes.schema, name + "_p", files_per_trigger=1, output_dir=out)
    q.processAllAvailable()
    q.stop()
    assert sorted(map(tuple, latest_note_stats(spark, out).select("pid", "first_ts", "n_tokens", "n_notes")
                      .collect())) == want


def test_svm_separates_separable_points(spark):
    rows = [(str(i), float(i % 2), [float(i % 2) * 2 - 1 + 0.01 * i, 1.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "pid string, label double, f array<double>")
    pts = df.select("pid", "label", array_to_vector("f").alias("features"))
    model = fit_linear_svm(pts, 50, 0.01)
    assert auc_midrank(raw_scores(model, pts)).first().auc == 1.0


def test_mean_vector(spark):
    df = spark.createDataFrame([("a", [1.0, 3.0]), ("a", [3.0, 5.0]), ("b", [0.5, 0.5])],
                               "pid string, features array<double>")
    got = {r.pid: r.features for r in mean_vector(df).collect()}
    assert got == {"a": [2.0, 4.0], "b": [0.5, 0.5]}


def test_topic_mixtures_sum_to_one(spark):
    from wardline.operators.topics import fit_topics, top_terms, topic_features

    df = spark.createDataFrame(
        [(str(i % 5), i, (["alpha", "beta", "gamma"] if i % 2 else ["delta", "epsilon", "alpha"]) * 3)
         for i in range(30)] + [("9", 99, [])], "pid string, note_id int, tokens array<string>")
    tm = fit_topics(df, k=3, max_iter=5)
    feats = topic_features(tm, df).collect()
    assert {r.pid for r in feats} == {"0", "1", "2", "3", "4"}        # token-less note dropped
    assert all(len(r.features) == 3 and abs(sum(r.features) - 1) < 1e-9 for r in feats)
    tt = top_terms(tm, 2).collect()
    assert len(tt) == 6 and all(t.term in {"alpha", "beta", "gamma", "delta", "epsilon"} for t in tt)


def test_topic_fits_read_the_notes_on_all_cores(spark, monkeypatch):
    from wardline.operators import topics

    rows = [(i % 5, i, ["alpha", "beta", "gamma" if i % 2 else "delta"]) for i in range(60)] + [(9, 99, []), (9, 100, None)]
    tokens = spark.createDataFrame(rows, "pid long, note_id long, tokens array<string>").coalesce(1)
    seen = []
    fit = topics.LDA.fit
    monkeypatch.setattr(topics.LDA, "fit", lambda self, counts: seen.append(counts) or fit(self, counts))
    model = topics.fit_topics(tokens, k=2, max_iter=2)
    parts = seen[0].groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == spark.sparkContext.defaultParallelism and sum(r["count"] for r in parts) == 60
    got = topics.note_topics(model, tokens)
    assert got.select(F.spark_partition_id()).distinct().count() == len(parts)
    assert sorted(r.note_id for r in got.select("note_id").collect()) == list(range(60))
    monkeypatch.setattr(topics, "NOTES_PER_PART", 10)                 # many notes: more parts than cores
    assert topics._spread(tokens.where("size(tokens) > 0")).rdd.getNumPartitions() == 6
    assert topics.topic_features(model, tokens.where("false")).count() == 0


def test_registered_fits_are_the_full_ones(monkeypatch):
    """k = 50 and 50 iterations in every topic fit, 5 folds in the derived grid."""
    from types import SimpleNamespace

    from wardline.plans import queries_models as Q

    seen = {}

    def spy(name):
        def run(*args, **kw):
            seen[name] = kw
            raise StopIteration
        return run

    some = SimpleNamespace(**dict.fromkeys(("patients", "stays", "notes", "scores", "flags", "train", "test", "labels",
                                            "train_balanced")))
    some.timeline = SimpleNamespace(cohort=None, first_note=None, tokens=None)
    monkeypatch.setattr(Q, "_prep", lambda *a: (some, some))
    for name in ("fit_topics", "run_retrospective_topics", "run_time_varying_topics", "run_derived"):
        monkeypatch.setattr(Q, name, spy(name))
    for query in (Q.q_lda_topic_features, Q.q_lda_top_terms, Q.q_report_retrospective_topics, Q.q_report_time_varying,
                  Q.q_svm_cv_derived):
        seen.clear()
        try:
            query(None, None)
        except StopIteration:
            pass
        (kw,) = seen.values()
        assert kw.get("k", 50) == 50 and kw.get("max_iter", kw.get("lda_iter", 50)) == 50
        assert kw.get("num_folds", 5) == 5
