"""Registered queries: features, splits, rebalancing, folds, confusion
counts, ROC areas, attrition, grid selection and the hour sweep
(M4-M8, M10, M11, J2, J7-J9, A6-A14, X1-X5, U2, M14, M17 skeleton)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.operators.cohort import adult_cohort, death_labels, labels_for, with_death_labels
from wardline.operators.features import (
    baseline_array, baseline_array_at_hours, baseline_long, combine_features,
    comorbidity_features, feature_index, labelled_points, mean_vector, pivot_features, sparse_features,
)
from wardline.operators.metrics import (
    attrition_counts, auc_midrank, best_by_mean, binary_metrics, confusion_counts,
)
from wardline.operators.sampling import kfold, rebalance, split_exact, split_hash
from wardline.operators.text import term_frequency
from wardline.operators.timeline import entities_at_hours, notes_in_stay
from wardline.plans.catalog import add_cte, register
from wardline.plans.pipelines import FIXED_WEIGHTS, fixed_linear_score, hour_sweep
from wardline.plans.queries_text import HOURS, SW, timeline
from wardline.session import written
from wardline.sources.testdata import load_views

W = FIXED_WEIGHTS


def _base(spark, sf_dir):
    t = load_views(spark, sf_dir)
    return t, adult_cohort(t.patients, t.stays)


def _posexplode(df: DataFrame, keys, col="features") -> DataFrame:
    return df.select(*keys, F.posexplode(col).alias("pos", "value"))


POSX = "UNNEST(generate_series(0, len(f) - 1)) AS pos, UNNEST(f) AS value"
HASH = "(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8))::UBIGINT / 4294967296.0)"

add_cte("sev_v", """
    SELECT c.pid, c.age, c.is_male, s.score FROM cohort_v c JOIN scores_v s
      ON c.pid = s.pid AND c.hadm_id = s.hadm_id AND c.stay_id = s.stay_id""")
add_cte("base_arr_v", "SELECT pid, [age / 89.0, CAST(is_male AS DOUBLE), score / 163.0] AS f FROM sev_v")
add_cte("flag_feat_v", """
    SELECT f.pid, list_transform(f.flags, lambda x: CAST(x AS DOUBLE)) AS f FROM flags_v f
    WHERE (f.pid, f.hadm_id) IN (SELECT (pid, hadm_id) FROM cohort_v)""")
add_cte("lin_score_v", f"""
    SELECT pid, f[1] * {W[0]} + f[2] * {W[1]} + f[3] * {W[2]} AS score FROM base_arr_v""")


@register("feature_long_baseline", """
    SELECT pid, 'patient_age' AS feature, age / 89.0 AS value FROM sev_v
    UNION ALL SELECT pid, 'patient_sex', CAST(is_male AS DOUBLE) FROM sev_v
    UNION ALL SELECT pid, 'saps_score', score / 163.0 FROM sev_v""")
def q_feature_long_baseline(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    return baseline_long(c, t.scores)


@register("feature_array_baseline", f"SELECT pid, {POSX} FROM base_arr_v")
def q_feature_array_baseline(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    return _posexplode(baseline_array(c, t.scores), ["pid"])


@register("feature_baseline_at_hours", """
    SELECT e.hours, s.pid, 'patient_age' AS feature, s.age / 89.0 AS value
    FROM hours_entities_v e JOIN sev_v s ON e.pid = s.pid
    UNION ALL SELECT e.hours, s.pid, 'patient_sex', CAST(s.is_male AS DOUBLE)
    FROM hours_entities_v e JOIN sev_v s ON e.pid = s.pid
    UNION ALL SELECT e.hours, s.pid, 'saps_score', s.score / 163.0
    FROM hours_entities_v e JOIN sev_v s ON e.pid = s.pid""")
def q_feature_baseline_at_hours(spark, sf_dir):
    t = load_views(spark, sf_dir)
    _, _, tl = timeline(spark, sf_dir)
    at = entities_at_hours(tl.cohort, tl.first_note, HOURS).select("pid", "hours")
    return at.join(baseline_long(tl.cohort, t.scores), "pid").select("hours", "pid", "feature", "value")


# M7: the array form at one offset
@register("feature_array_at_hours", f"""
    SELECT pid, {POSX} FROM base_arr_v WHERE pid IN (SELECT pid FROM hours_entities_v WHERE hours = 48)""")
def q_feature_array_at_hours(spark, sf_dir):
    t = load_views(spark, sf_dir)
    tl = timeline(spark, sf_dir)[2]
    return _posexplode(baseline_array_at_hours(tl.cohort, t.scores, tl.first_note, 48), ["pid"])


@register("flag_vector", f"SELECT pid, {POSX} FROM flag_feat_v")
def q_flag_vector(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    return _posexplode(comorbidity_features(c, t.flags), ["pid"])


@register("feature_combined_33", f"""
    SELECT pid, {POSX} FROM (SELECT b.pid, list_concat(b.f, c.f) AS f
                             FROM base_arr_v b JOIN flag_feat_v c ON b.pid = c.pid)""")
def q_feature_combined_33(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    return _posexplode(combine_features(baseline_array(c, t.scores), comorbidity_features(c, t.flags)), ["pid"])


@register("feature_pivot", """
    SELECT pid, age / 89.0 AS patient_age, CAST(is_male AS DOUBLE) AS patient_sex,
           score / 163.0 AS saps_score FROM sev_v""")
def q_feature_pivot(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    return pivot_features(baseline_long(c, t.scores))


@register("feature_label_points", f"""
    SELECT pid, label, {POSX} FROM (
      SELECT b.pid, CAST(l.label_in_stay AS DOUBLE) AS label, b.f FROM base_arr_v b JOIN labels_v l ON b.pid = l.pid)""")
def q_feature_label_points(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    pts = labelled_points(baseline_array(c, t.scores), labels_for(c, "in_stay"))
    return pts.select("pid", "label", F.posexplode(vector_to_array("features")).alias("pos", "value"))


# Every term of an entity's notes is a feature; the names are learned
add_cte("term_feature_v", """
    SELECT t.pid, t.term AS feature, COUNT(*) AS value FROM (SELECT pid, UNNEST(tokens) AS term FROM tokens_v) t
    GROUP BY t.pid, t.term""")


@register("sparse_label_points", """
    WITH places AS (SELECT feature, ROW_NUMBER() OVER (ORDER BY feature) - 1 AS i, COUNT(*) OVER () AS size
                    FROM (SELECT DISTINCT feature FROM term_feature_v))
    SELECT f.pid, CAST(l.label_in_stay AS DOUBLE) AS label, MAX(p.size) AS size,
           string_agg(CAST(p.i AS VARCHAR), ' ' ORDER BY p.i) AS indices,
           string_agg(CAST(f.value AS VARCHAR), ' ' ORDER BY p.i) AS counts
    FROM term_feature_v f JOIN places p USING (feature) JOIN labels_v l ON f.pid = l.pid GROUP BY f.pid, l.label_in_stay""")
def q_sparse_label_points(spark, sf_dir):
    tl = timeline(spark, sf_dir, materialize=False)[2]
    counts = term_frequency(tl.tokens, "pid").withColumnsRenamed({"term": "feature", "count": "value"})
    long = written(counts, "features")
    index = feature_index(long)
    size = index.agg(F.count(F.lit(1)).alias("n")).scalar()
    labels = labels_for(_base(spark, sf_dir)[1], "in_stay")
    return (sparse_features(long, index).join(labels, "pid")
            .select("pid", F.col("label").cast("double").alias("label"), size.alias("size"),
                    F.array_join("indices", " ").alias("indices"),
                    F.array_join(F.transform("values", lambda v: v.cast("long")), " ").alias("counts")))


@register("mean_feature_vector", """
    SELECT pid, pos, ROUND(AVG(value), 9) AS value FROM (
      SELECT n.pid, UNNEST(generate_series(0, 2)) AS pos,
             UNNEST([len(n.tokens) * 1.0, CAST(hour(n.chart_ts) AS DOUBLE), CAST(n.note_id % 7 AS DOUBLE)]) AS value
      FROM tokens_v n) GROUP BY pid, pos""")
def q_mean_feature_vector(spark, sf_dir):
    toks = timeline(spark, sf_dir)[2].tokens
    rows = toks.select("pid", F.array(F.size("tokens").cast("double"), F.hour("chart_ts").cast("double"),
                                      (F.col("note_id") % 7).cast("double")).alias("features"))
    # the mean of doubles depends on summation order in the last bits: round
    return _posexplode(mean_vector(rows), ["pid"]).withColumn("value", F.round("value", 9))


# --- splits and rebalancing -------------------------------------------------
add_cte("split_v", f"""
    SELECT pid, CAST(rn <= floor(n * 0.7) AS INTEGER) AS is_train FROM (
      SELECT pid, ROW_NUMBER() OVER (ORDER BY {HASH.format(seed=42, key='pid')}, pid) AS rn,
             COUNT(*) OVER () AS n FROM cohort_v)""")


@register("split_hash", f"SELECT pid, CAST({HASH.format(seed=42, key='pid')} < 0.7 AS INTEGER) AS is_train FROM cohort_v")
def q_split_hash(spark, sf_dir):
    return split_hash(_base(spark, sf_dir)[1], 0.7, 42).select("pid", "is_train")


@register("split_exact", "SELECT pid, is_train FROM split_v")
def q_split_exact(spark, sf_dir):
    return split_exact(_base(spark, sf_dir)[1], 0.7, 42, exact=True).select("pid", "is_train")


def _rebalance_sql(exact: bool) -> str:
    h = HASH.format(seed=42, key="pid")
    if exact:
        neg = f"""SELECT pid FROM (SELECT pid, ROW_NUMBER() OVER (ORDER BY {h}, pid) AS rn
                  FROM lab WHERE label = 0), st WHERE rn <= floor(st.p / 0.3 * 0.7)"""
    else:
        neg = f"SELECT pid FROM lab, st WHERE label = 0 AND {h} < (st.p / 0.3 * 0.7) / (st.t - st.p)"
    return f"""
    SELECT pid, label FROM (
      WITH lab AS (SELECT s.pid, l.label_in_stay AS label FROM split_v s JOIN labels_v l ON s.pid = l.pid
                   WHERE s.is_train = 1),
           st AS (SELECT COUNT(*) AS t, SUM(label) AS p FROM lab),
           kept AS (SELECT pid FROM lab WHERE label = 1 UNION ALL {neg})
      SELECT lab.pid, lab.label FROM lab, st
      WHERE st.p / st.t >= 0.3 OR lab.pid IN (SELECT pid FROM kept))"""


def _rebalanced(spark, sf_dir, exact):
    c = with_death_labels(_base(spark, sf_dir)[1]).select("pid", F.col("label_in_stay").alias("label"))
    train = split_exact(c, 0.7, 42).where("is_train = 1").select("pid", "label")
    return rebalance(train, None, 0.3, exact=exact, seed=42)


@register("subsample_7_3", _rebalance_sql(True))
def q_subsample_exact(spark, sf_dir):
    return _rebalanced(spark, sf_dir, True)


@register("subsample_bernoulli", _rebalance_sql(False))
def q_subsample_bernoulli(spark, sf_dir):
    return _rebalanced(spark, sf_dir, False)


@register("kfold_assign", f"SELECT pid, CAST(floor({HASH.format(seed=7, key='pid')} * 5) AS INTEGER) AS fold FROM cohort_v")
def q_kfold_assign(spark, sf_dir):
    return kfold(_base(spark, sf_dir)[1], 5, seed=7).select("pid", "fold")


@register("subtract_train", "SELECT pid FROM cohort_v WHERE pid NOT IN (SELECT pid FROM split_v WHERE is_train = 1)")
def q_subtract_train(spark, sf_dir):
    from wardline.operators.sampling import subtract_entities
    c = _base(spark, sf_dir)[1]
    train = split_exact(c, 0.7, 42).where("is_train = 1")
    return subtract_entities(c, train).select("pid")


# --- metrics ------------------------------------------------------------------
def _scored(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    s = fixed_linear_score(baseline_array(c, t.scores), W)
    lab = death_labels(c)
    horizons = F.explode(F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(col).alias("label"))
                                   for h, col in (("in_stay", "label_in_stay"), ("30d", "label_30d"),
                                                  ("1y", "label_1y"))])).alias("hl")
    return (s.join(lab, "pid").select("pid", "score", horizons)
            .select("pid", "score", "hl.horizon", "hl.label"))


add_cte("scored_v", """
    SELECT s.pid, s.score, h.horizon, h.label FROM lin_score_v s JOIN (
      SELECT pid, 'in_stay' AS horizon, label_in_stay AS label FROM labels_v
      UNION ALL SELECT pid, '30d', label_30d FROM labels_v
      UNION ALL SELECT pid, '1y', label_1y FROM labels_v) h ON s.pid = h.pid""")

CONF_SQL = """
    SELECT horizon, tp, fp, tn, fn, tp + fp + tn + fn AS total, tp + fn AS positives,
           CASE WHEN tp + fp + tn + fn > 0 THEN (tp + tn) / CAST(tp + fp + tn + fn AS DOUBLE) END AS accuracy,
           CASE WHEN tp + fn > 0 THEN tp / CAST(tp + fn AS DOUBLE) END AS sensitivity,
           CASE WHEN tn + fp > 0 THEN tn / CAST(tn + fp AS DOUBLE) END AS specificity
    FROM (SELECT horizon, CAST(SUM(CASE WHEN {pp} AND label > 0 THEN 1 ELSE 0 END) AS BIGINT) AS tp,
                 CAST(SUM(CASE WHEN {pp} AND label <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS {fp},
                 CAST(SUM(CASE WHEN NOT ({pp}) AND label <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS {tn},
                 CAST(SUM(CASE WHEN NOT ({pp}) AND label > 0 THEN 1 ELSE 0 END) AS BIGINT) AS fn
          FROM {src} GROUP BY horizon)"""


@register("confusion_counts", CONF_SQL.format(pp="score > 1.5", fp="fp", tn="tn", src="scored_v"))
def q_confusion_counts(spark, sf_dir):
    return confusion_counts(_scored(spark, sf_dir), by=["horizon"], threshold=1.5)


# reference rule: "correct" iff score == label; with score = sex flag
@register("confusion_counts_exact", CONF_SQL.format(
    pp="score = label", fp="tn", tn="fp",
    src="(SELECT s.horizon, CAST(b.f[2] AS DOUBLE) AS score, s.label FROM scored_v s JOIN base_arr_v b ON s.pid = b.pid)"))
def q_confusion_counts_exact(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    s = _scored(spark, sf_dir).drop("score").join(
        baseline_array(c, t.scores).select("pid", F.col("features")[1].alias("score")), "pid")
    return confusion_counts(s, by=["horizon"], mode="exact")


AUC_SQL = """
    SELECT {by}, CASE WHEN SUM(p) > 0 AND SUM(q) > 0 THEN SUM(p * (below + q / 2.0)) / (SUM(p) * CAST(SUM(q) AS DOUBLE)) END AS auc
    FROM (SELECT *, COALESCE(SUM(q) OVER (PARTITION BY {by} ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below
          FROM (SELECT {by}, score, SUM(CASE WHEN label > 0 THEN 1 ELSE 0 END) AS p,
                       SUM(CASE WHEN label <= 0 THEN 1 ELSE 0 END) AS q FROM {src} GROUP BY {by}, score))
    GROUP BY {by}"""


@register("auc_midrank", AUC_SQL.format(by="horizon, scorer", src="""(
    SELECT horizon, 'linear' AS scorer, score, label FROM scored_v
    UNION ALL SELECT horizon, 'coarse', floor(score * 4) / 4, label FROM scored_v)"""))
def q_auc_midrank(spark, sf_dir):
    s = _scored(spark, sf_dir)
    both = s.withColumn("scorer", F.lit("linear")).unionByName(
        s.withColumn("score", F.floor(F.col("score") * 4) / 4).withColumn("scorer", F.lit("coarse")))
    return auc_midrank(both, by=["horizon", "scorer"])


@register("binary_metrics", f"""
    SELECT c.horizon, c.total, c.positives, a.auc, c.accuracy, c.sensitivity, c.specificity
    FROM ({CONF_SQL.format(pp="score > 1.5", fp="fp", tn="tn", src="scored_v")}) c
    JOIN ({AUC_SQL.format(by="horizon", src="scored_v")}) a ON c.horizon = a.horizon""")
def q_binary_metrics(spark, sf_dir):
    return binary_metrics(_scored(spark, sf_dir), by=["horizon"], threshold=1.5)


@register("attrition_counts", """
    SELECT 'patients' AS stage, COUNT(*) AS n FROM patients_v
    UNION ALL SELECT 'stays', COUNT(*) FROM stays_v
    UNION ALL SELECT 'adult_cohort', COUNT(*) FROM cohort_v
    UNION ALL SELECT 'with_severity', COUNT(*) FROM sev_v
    UNION ALL SELECT 'notes_kept', COUNT(*) FROM notes_f_v
    UNION ALL SELECT 'notes_in_stay', COUNT(*) FROM notes_in_stay_v
    UNION ALL SELECT 'with_first_note', COUNT(*) FROM cohort_q_v""")
def q_attrition_counts(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    _, notes, tl = timeline(spark, sf_dir)
    return attrition_counts({
        "patients": t.patients, "stays": t.stays, "adult_cohort": c,
        "with_severity": baseline_array(c, t.scores), "notes_kept": notes,
        "notes_in_stay": notes_in_stay(c, notes), "with_first_note": tl.cohort})


GRID = (0.0, 0.5, 1.0, 2.0, 4.0)   # weight of the severity term in the grid


@register("grid_mean_auc", f"""
    WITH f AS (SELECT b.pid, b.f, l.label_in_stay AS label,
                      CAST(floor({HASH.format(seed=7, key='b.pid')} * 5) AS INTEGER) AS fold
               FROM base_arr_v b JOIN labels_v l ON b.pid = l.pid),
         g AS (SELECT UNNEST({list(GRID)}) AS w, UNNEST(generate_series(0, {len(GRID) - 1})) AS grid_pos),
         s AS (SELECT g.w, g.grid_pos, f.fold, f.f[1] + g.w * f.f[3] AS score, f.label FROM f, g),
         a AS ({AUC_SQL.format(by="w, grid_pos, fold", src="s")}),
         m AS (SELECT w, grid_pos, AVG(auc) AS mean_auc FROM a GROUP BY w, grid_pos)
    SELECT w, grid_pos, ROUND(mean_auc, 12) AS mean_auc, CAST(grid_pos = (
        SELECT grid_pos FROM m WHERE mean_auc > 0 ORDER BY mean_auc DESC, grid_pos LIMIT 1) AS INTEGER) AS is_best
    FROM m""")
def q_grid_mean_auc(spark, sf_dir):
    t, c = _base(spark, sf_dir)
    pts = kfold(baseline_array(c, t.scores).join(labels_for(c, "in_stay"), "pid"), 5, seed=7)
    grid = F.explode(F.arrays_zip(F.array(*[F.lit(w) for w in GRID]).alias("w"),
                                  F.sequence(F.lit(0), F.lit(len(GRID) - 1)).alias("grid_pos")))
    s = (pts.select("pid", "fold", "label", "features", grid.alias("g"))
         .select("fold", "label", F.col("g.w").alias("w"), F.col("g.grid_pos").alias("grid_pos"),
                 (F.col("features")[0] + F.col("g.w") * F.col("features")[2]).alias("score")))
    a = auc_midrank(s, by=["w", "grid_pos", "fold"])
    # means of 5 doubles depend on summation order in the last bit: round
    return best_by_mean(a, ["w"], "auc", "grid_pos").withColumn("mean_auc", F.round("mean_auc", 12))


add_cte("split_q_v", f"""
    SELECT pid, CAST(rn <= floor(n * 0.7) AS INTEGER) AS is_train FROM (
      SELECT pid, ROW_NUMBER() OVER (ORDER BY {HASH.format(seed=42, key='pid')}, pid) AS rn,
             COUNT(*) OVER () AS n FROM cohort_q_v)""")


@register("hour_sweep_population", f"""
    SELECT hr, COUNT(*) AS total, CAST(SUM(label) AS BIGINT) AS positives, auc FROM (
      SELECT h.hr, s.pid, s.score, l.label_in_stay AS label
      FROM (SELECT UNNEST(generate_series(0, 240, 12)) AS hr) h,
           lin_score_v s JOIN labels_v l ON s.pid = l.pid JOIN cohort_q_v c ON s.pid = c.pid
           JOIN first_note_v f ON s.pid = f.pid
      WHERE s.pid IN (SELECT pid FROM split_q_v WHERE is_train = 0)
        AND (h.hr <= 0 OR ((c.out_ts IS NULL OR c.out_ts > f.first_ts + INTERVAL 1 HOUR * h.hr)
                           AND (c.dod IS NULL OR c.dod > f.first_ts + INTERVAL 1 HOUR * h.hr)))) x
    JOIN ({AUC_SQL.format(by="hr", src='''(
      SELECT h.hr, s.score, l.label_in_stay AS label
      FROM (SELECT UNNEST(generate_series(0, 240, 12)) AS hr) h,
           lin_score_v s JOIN labels_v l ON s.pid = l.pid JOIN cohort_q_v c ON s.pid = c.pid
           JOIN first_note_v f ON s.pid = f.pid
      WHERE s.pid IN (SELECT pid FROM split_q_v WHERE is_train = 0)
        AND (h.hr <= 0 OR ((c.out_ts IS NULL OR c.out_ts > f.first_ts + INTERVAL 1 HOUR * h.hr)
                           AND (c.dod IS NULL OR c.dod > f.first_ts + INTERVAL 1 HOUR * h.hr))))''')}) a USING (hr)
    GROUP BY hr, auc""")
def q_hour_sweep_population(spark, sf_dir):
    from wardline.plans.pipelines import prepare

    t = load_views(spark, sf_dir)
    # the per-entity table (cohort, first note, label, split) is written
    # once; the sweep's metrics read it instead of re-running the tokenizer
    p = prepare(t.patients, t.stays, t.notes, SW, materialize_tokens=False)
    return hour_sweep(p.test, t.scores, p.timeline.first_note, p.labels, weights=W)


