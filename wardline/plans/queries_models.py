"""Registered queries: fitted models and report pipelines (M9, M12, M13,
M15-M21, T1, P19, P23, A6, J10, J11).

Fitted numbers have no oracle SQL; the deterministic columns of every report
(hours, totals, positives) are registered on their own and value-checked.  An
LDA iteration reads every note, so the registered fits run ``LDA_ITER`` of them.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.classify import BASELINE_GRID, fit_linear_svm, grid_search, raw_scores
from wardline.operators.features import baseline_long, labelled_points, long_to_array
from wardline.operators.topics import fit_topics, top_terms, topic_features
from wardline.plans.catalog import add_cte, register
from wardline.plans.pipelines import (
    prepare, run_all, run_baseline, run_derived, run_retrospective_topics, run_time_varying_topics,
)
from wardline.plans.queries_features import HASH
from wardline.plans.queries_text import SW
from wardline.sources.testdata import load_views


LDA_ITER = 50
TABLE_PASSES = 10       # of the model of tables: a pass is a few jobs


def _prep(spark, sf_dir):
    t = load_views(spark, sf_dir)
    return t, prepare(t.patients, t.stays, t.notes, SW)


def _train_points(t, p):
    feats = long_to_array(baseline_long(p.train_balanced, t.scores))
    return labelled_points(feats, p.labels)


@register("svm_scores")
def q_svm_scores(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    model = fit_linear_svm(_train_points(t, p), 300, 0.1)
    test = labelled_points(long_to_array(baseline_long(p.test, t.scores)), p.labels)
    return raw_scores(model, test)


@register("svm_cv")
def q_svm_cv(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    _, res = grid_search(_train_points(t, p), BASELINE_GRID, 5)
    return res


@register("lda_topic_features")
def q_lda_topic_features(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    tm = fit_topics(p.timeline.tokens, k=50, max_iter=LDA_ITER)
    return topic_features(tm, p.timeline.tokens).select("pid", F.posexplode("features").alias("pos", "value"))


@register("lda_top_terms")
def q_lda_top_terms(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    return top_terms(fit_topics(p.timeline.tokens, k=50, max_iter=LDA_ITER), 10)


@register("lda_table_top_terms")
def q_lda_table_top_terms(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    return top_terms(fit_topics(p.timeline.tokens, k=50, max_iter=TABLE_PASSES, optimizer="tables"), 10)


# the fitted counts of a note's topics add up to its tokens, whatever the fit
@register("lda_table_note_mass", "SELECT note_id, len(tokens) AS mass FROM tokens_v WHERE len(tokens) > 0")
def q_lda_table_note_mass(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    model = fit_topics(p.timeline.tokens, k=50, max_iter=TABLE_PASSES, optimizer="tables")
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return model.documents.select(F.col("id").alias("note_id"), F.round(total, 6).cast("long").alias("mass"))


@register("report_baseline_train")
def q_report_baseline_train(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    return run_baseline(p.train_balanced, p.test, t.scores, p.timeline.first_note, p.labels).extra["train"]


@register("report_baseline_sweep")
def q_report_baseline_sweep(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    return run_baseline(p.train_balanced, p.test, t.scores, p.timeline.first_note, p.labels).rows


@register("report_retrospective_topics")
def q_report_retrospective_topics(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    return run_retrospective_topics(p.train_balanced, p.test, p.timeline.tokens, p.labels, lda_iter=LDA_ITER).rows


@register("report_derived")
def q_report_derived(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    return run_derived(p.train, p.test, p.labels, p.timeline.cohort, t.scores, t.flags).rows


@register("report_time_varying")
def q_report_time_varying(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    tl = p.timeline
    return run_time_varying_topics(p.train, p.test, p.labels, tl.first_note, tl.tokens, k=50, lda_iter=LDA_ITER).rows


# --- deterministic columns of the reports, value-checked ---------------------
def _balanced_sql() -> str:
    h = HASH.format(seed=42, key="pid")
    return f"""
    SELECT pid, label FROM (
      WITH lab AS (SELECT s.pid, l.label_in_stay AS label FROM split_q_v s JOIN labels_v l ON s.pid = l.pid
                   WHERE s.is_train = 1),
           st AS (SELECT COUNT(*) AS t, SUM(label) AS p FROM lab),
           kept AS (SELECT pid FROM lab WHERE label = 1 UNION ALL
                    SELECT pid FROM (SELECT pid, ROW_NUMBER() OVER (ORDER BY {h}, pid) AS rn
                                     FROM lab WHERE label = 0), st WHERE rn <= floor(st.p / 0.3 * 0.7))
      SELECT lab.pid, lab.label FROM lab, st WHERE st.p / st.t >= 0.3 OR lab.pid IN (SELECT pid FROM kept))"""


add_cte("balanced_q_v", _balanced_sql())
add_cte("side_q_v", """
    SELECT s.pid, s.is_train, l.label_in_stay AS label FROM split_q_v s JOIN labels_v l ON s.pid = l.pid""")
add_cte("noted_v", "SELECT t.pid, t.chart_ts FROM tokens_v t WHERE len(t.tokens) > 0")

_SUM = "COUNT(*) AS {n}, CAST(SUM(label) AS BIGINT) AS {p}"
BASELINE_TRAIN_SQL = f"""
    SELECT {_SUM.format(n="total", p="positives")} FROM balanced_q_v b WHERE b.pid IN (SELECT pid FROM sev_v)"""
SWEEP_SQL = """
    SELECT h.hr, COUNT(*) AS total, CAST(SUM(x.label) AS BIGINT) AS positives
    FROM (SELECT UNNEST(generate_series(0, 240, 12)) AS hr) h, side_q_v x JOIN cohort_q_v c ON x.pid = c.pid
         JOIN first_note_v f ON x.pid = f.pid
    WHERE x.is_train = 0 AND x.pid IN (SELECT pid FROM sev_v)
      AND (h.hr <= 0 OR ((c.out_ts IS NULL OR c.out_ts > f.first_ts + INTERVAL 1 HOUR * h.hr)
                         AND (c.dod IS NULL OR c.dod > f.first_ts + INTERVAL 1 HOUR * h.hr)))
    GROUP BY h.hr"""


def _pair_sql(train: str, test: str, where: str) -> str:
    return f"""
    SELECT a.total, a.pos, b.test_total, b.test_pos
    FROM (SELECT {_SUM.format(n="total", p="pos")} FROM {train} x WHERE {where}) a,
         (SELECT {_SUM.format(n="test_total", p="test_pos")} FROM {test} x WHERE {where}) b"""


TRAIN_Q = "(SELECT pid, label FROM side_q_v WHERE is_train = 1)"
TEST_Q = "(SELECT pid, label FROM side_q_v WHERE is_train = 0)"
DERIVED_SQL = _pair_sql(TRAIN_Q, TEST_Q, "x.pid IN (SELECT pid FROM sev_v) AND x.pid IN (SELECT pid FROM flag_feat_v)")
RETRO_SQL = _pair_sql("balanced_q_v", TEST_Q, "x.pid IN (SELECT pid FROM noted_v)")


def _varying_sql(hours) -> str:
    return f"""
    SELECT hr, COUNT(*) FILTER (WHERE is_train = 1) AS total,
           CAST(SUM(label) FILTER (WHERE is_train = 1) AS BIGINT) AS pos,
           COUNT(*) FILTER (WHERE is_train = 0) AS test_total,
           CAST(SUM(label) FILTER (WHERE is_train = 0) AS BIGINT) AS test_pos
    FROM (SELECT UNNEST({list(hours)}) AS hr) h, side_q_v x
    WHERE x.pid IN (SELECT n.pid FROM noted_v n JOIN first_note_v f ON n.pid = f.pid
                    WHERE n.chart_ts < f.first_ts + INTERVAL 1 HOUR * h.hr)
    GROUP BY hr"""


PAIR = ["total", "pos", "test_total", "test_pos"]


@register("report_baseline_train_counts", BASELINE_TRAIN_SQL)
def q_report_baseline_train_counts(spark, sf_dir):
    return q_report_baseline_train(spark, sf_dir).select("total", F.col("num_positives").alias("positives"))


@register("report_baseline_sweep_counts", SWEEP_SQL)
def q_report_baseline_sweep_counts(spark, sf_dir):
    return q_report_baseline_sweep(spark, sf_dir).select("hr", "total", "positives")


@register("report_derived_counts", DERIVED_SQL)
def q_report_derived_counts(spark, sf_dir):
    return q_report_derived(spark, sf_dir).select(PAIR)


@register("report_retrospective_counts", RETRO_SQL)
def q_report_retrospective_counts(spark, sf_dir):
    return q_report_retrospective_topics(spark, sf_dir).select(PAIR)


VARYING_HOURS = range(12, 241, 12)


@register("report_time_varying_counts", _varying_sql(VARYING_HOURS))
def q_report_time_varying_counts(spark, sf_dir):
    return q_report_time_varying(spark, sf_dir).select("hr", *PAIR)


# The whole run; every report's deterministic columns in one table (-1 where a report has none)
@register("run_all_counts", f"""
    SELECT 'baseline_train' AS report, -1 AS hr, total, positives AS pos, -1 AS test_total, -1 AS test_pos
    FROM ({BASELINE_TRAIN_SQL})
    UNION ALL SELECT 'baseline_sweep', hr, total, positives, -1, -1 FROM ({SWEEP_SQL})
    UNION ALL SELECT 'derived', -1, total, pos, test_total, test_pos FROM ({DERIVED_SQL})
    UNION ALL SELECT 'retrospective_topics', -1, total, pos, test_total, test_pos FROM ({RETRO_SQL})
    UNION ALL SELECT 'time_varying_topics', hr, total, pos, test_total, test_pos
    FROM ({_varying_sql(VARYING_HOURS)})""")
def q_run_all_counts(spark, sf_dir):
    t = load_views(spark, sf_dir)
    reports = run_all(t.patients, t.stays, t.notes, t.scores, t.flags, SW)
    out = None
    for name, rows in reports.items():
        have = {"pos": next((c for c in ("pos", "positives", "num_positives") if c in rows.columns))}
        part = rows.select(F.lit(name).alias("report"), *[
            (F.col(have.get(c, c)) if have.get(c, c) in rows.columns else F.lit(-1)).cast("long").alias(c)
            for c in ("hr", *PAIR)])
        out = part if out is None else out.unionByName(part)
    return out


# The notes of the training and the test entities
@register("split_notes_semi", """
    SELECT t.note_id, s.is_train FROM tokens_v t JOIN split_q_v s ON t.pid = s.pid""")
def q_split_notes_semi(spark, sf_dir):
    _, p = _prep(spark, sf_dir)
    notes = p.timeline.tokens.select("note_id", "pid")
    return (notes.join(p.train.select("pid"), "pid", "left_semi").select("note_id", F.lit(1).alias("is_train"))
            .unionByName(notes.join(p.test.select("pid"), "pid", "left_semi").select("note_id", F.lit(0).alias("is_train"))))


# The derived model's grid (five folds)
@register("svm_cv_derived")
def q_svm_cv_derived(spark, sf_dir):
    t, p = _prep(spark, sf_dir)
    return run_derived(p.train, p.test, p.labels, p.timeline.cohort, t.scores, t.flags, use_cv=True,
                       num_folds=5).extra["grid"]
