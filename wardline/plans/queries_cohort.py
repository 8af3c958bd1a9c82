"""Registered queries: cohort, latest stay, labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardline.operators.cohort import adult_cohort, death_labels, latest_interval, with_death_labels
from wardline.plans.catalog import add_cte, register
from wardline.sources.testdata import load_views, stays_view

AGE_SQL = "date_diff('millisecond', p.dob, s.in_ts) / 31536000000.0"

add_cte("cohort_all_v", f"""
    SELECT s.pid, s.hadm_id, s.stay_id, s.in_ts, s.out_ts, p.is_male, p.dob, p.is_dead,
           CASE WHEN p.is_dead = 1 THEN p.dod END AS dod, p.index_date,
           CASE WHEN {AGE_SQL} >= 300 THEN 89.0 ELSE {AGE_SQL} END AS age
    FROM latest_v s JOIN patients_v p ON s.pid = p.pid""")
add_cte("cohort_v", "SELECT * FROM cohort_all_v WHERE age >= 18")
add_cte("labels_v", """
    SELECT pid,
      CAST(COALESCE(dod IS NOT NULL AND dod >= in_ts AND (out_ts IS NULL OR dod <= out_ts), FALSE) AS INTEGER) AS label_in_stay,
      CAST(COALESCE(dod IS NOT NULL AND out_ts IS NOT NULL AND dod > out_ts
                    AND date_diff('millisecond', out_ts, dod) // 86400000 <= 30, FALSE) AS INTEGER) AS label_30d,
      CAST(COALESCE(dod IS NOT NULL AND out_ts IS NOT NULL AND dod > out_ts
                    AND date_diff('millisecond', out_ts, dod) // 86400000 <= 365, FALSE) AS INTEGER) AS label_1y
    FROM cohort_v""")
# sentinel mode: unknown dates become 9000-01-01 and are compared as dates
add_cte("cohort_sentinel_v", f"""
    SELECT * FROM (
      SELECT s.pid, s.hadm_id, s.stay_id,
             COALESCE(s.in_ts, TIMESTAMP '9000-01-01') AS in_ts,
             COALESCE(s.out_ts, TIMESTAMP '9000-01-01') AS out_ts,
             p.is_male, p.dob, p.is_dead,
             COALESCE(CASE WHEN p.is_dead = 1 THEN p.dod END, TIMESTAMP '9000-01-01') AS dod,
             CASE WHEN date_diff('millisecond', p.dob, COALESCE(s.in_ts, TIMESTAMP '9000-01-01')) / 31536000000.0 >= 300
                  THEN 89.0
                  ELSE date_diff('millisecond', p.dob, COALESCE(s.in_ts, TIMESTAMP '9000-01-01')) / 31536000000.0 END AS age
      FROM latest_v s JOIN patients_v p ON s.pid = p.pid) WHERE age >= 18""")


def cohort(spark, sf_dir, missing="null"):
    t = load_views(spark, sf_dir)
    return adult_cohort(t.patients, t.stays, missing=missing)


@register("latest_stay", """
    SELECT pid, hadm_id, stay_id, in_ts, out_ts FROM latest_v""")
def q_latest_stay(spark, sf_dir):
    return latest_interval(stays_view(spark, sf_dir))


@register("cohort_adults", """
    SELECT pid, hadm_id, stay_id, in_ts, out_ts, is_male, dob, is_dead, dod, index_date,
           ROUND(age, 6) AS age
    FROM cohort_v""")
def q_cohort_adults(spark, sf_dir):
    return cohort(spark, sf_dir).withColumn("age", F.round("age", 6))


@register("cohort_sentinel", """
    SELECT pid, strftime(in_ts, '%Y-%m-%d %H:%M:%S') AS in_ts,
           strftime(out_ts, '%Y-%m-%d %H:%M:%S') AS out_ts,
           strftime(dod, '%Y-%m-%d %H:%M:%S') AS dod, ROUND(age, 6) AS age
    FROM cohort_sentinel_v""")
def q_cohort_sentinel(spark, sf_dir):
    # year-9000 sentinels do not fit pandas' nanosecond range: render as text
    fmt = "yyyy-MM-dd HH:mm:ss"
    return (cohort(spark, sf_dir, missing="sentinel")
            .select("pid", F.date_format("in_ts", fmt).alias("in_ts"),
                    F.date_format("out_ts", fmt).alias("out_ts"),
                    F.date_format("dod", fmt).alias("dod"), F.round("age", 6).alias("age")))


for _h, _c in (("in_stay", "label_in_stay"), ("30d", "label_30d"), ("1y", "label_1y")):
    def _make(col):
        def fn(spark, sf_dir):
            return death_labels(cohort(spark, sf_dir)).select("pid", F.col(col).alias("label"))
        return fn
    register(f"labels_{_h}", f"SELECT pid, {_c} AS label FROM labels_v")(_make(_c))


@register("labels_sentinel", """
    SELECT pid,
      CAST(dod >= in_ts AND dod <= out_ts AS INTEGER) AS label_in_stay,
      CAST(dod > out_ts AND date_diff('millisecond', out_ts, dod) // 86400000 <= 30 AS INTEGER) AS label_30d,
      CAST(dod > out_ts AND date_diff('millisecond', out_ts, dod) // 86400000 <= 365 AS INTEGER) AS label_1y
    FROM cohort_sentinel_v""")
def q_labels_sentinel(spark, sf_dir):
    return death_labels(cohort(spark, sf_dir, missing="sentinel"))


@register("label_summary", """
    SELECT COUNT(*) AS n_patients, ROUND(SUM(c.age), 6) AS sum_age,
           CAST(SUM(l.label_in_stay) AS BIGINT) AS n_in_stay, CAST(SUM(l.label_30d) AS BIGINT) AS n_30d,
           CAST(SUM(l.label_1y) AS BIGINT) AS n_1y
    FROM cohort_v c JOIN labels_v l ON c.pid = l.pid""")
def q_label_summary(spark, sf_dir):
    return (with_death_labels(cohort(spark, sf_dir))
            .agg(F.count(F.lit(1)).alias("n_patients"), F.round(F.sum("age"), 6).alias("sum_age"),
                 F.sum("label_in_stay").alias("n_in_stay"), F.sum("label_30d").alias("n_30d"),
                 F.sum("label_1y").alias("n_1y")))
