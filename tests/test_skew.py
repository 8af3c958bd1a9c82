"""One entity holds a third of all rows: results stay whole and the
per-entity reductions are partial (map-side) aggregates, not windows."""

import datetime as dt

from pyspark.sql import functions as F

from wardline.operators.cohort import latest_interval
from wardline.operators.text import entity_token_counts, tokenize_notes

D = dt.datetime


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_entity_latest_stay(spark):
    rows = [("hot", f"h{i}", f"s{i:05d}", D(2000, 1, 1), D(2000, 1, 1) + dt.timedelta(hours=i % 97))
            for i in range(3000)]
    rows += [(f"p{i}", f"k{i}", f"t{i}", D(2000, 1, 1), D(2000, 1, 2)) for i in range(6000)]
    s = spark.createDataFrame(rows, "pid string, hadm_id string, stay_id string, in_ts timestamp_ntz, out_ts timestamp_ntz")
    got = latest_interval(s)
    hot = got.where("pid = 'hot'").first()
    # latest end is 96 h; among those, the largest stay id
    want = max((r for r in rows if r[0] == "hot"), key=lambda r: (r[4], r[2]))
    assert hot.stay_id == want[2]
    assert got.count() == 6001
    p = plan(got)
    assert "partial_max_by" in p and "Window" not in p


def test_hot_entity_token_counts(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"p{i}", "alpha beta gamma delta") for i in range(3000)]
    n = spark.createDataFrame(rows, "note_id long, pid string, text string")
    c = entity_token_counts(tokenize_notes(n))
    assert c.where("pid = 'hot'").first().n_tokens == 1000 * 4
    assert c.agg(F.sum("n_tokens")).first()[0] == 3000 * 4
    assert "partial_sum" in plan(c)


def test_hot_entity_join(spark):
    """A hot entity's notes against one cohort row; nothing is lost or doubled."""
    from wardline.operators.timeline import notes_in_stay

    rows = [(i, "hot" if i % 3 == 0 else f"p{i}", "h", D(2000, 1, 1, 1), "x") for i in range(3000)]
    n = spark.createDataFrame(rows, "note_id long, pid string, hadm_id string, chart_ts timestamp_ntz, text string")
    c = n.select("pid").distinct().selectExpr("pid", "'h' AS hadm_id", "timestamp_ntz'2000-01-01' AS in_ts",
                                              "timestamp_ntz'2000-01-02' AS out_ts", "CAST(NULL AS timestamp_ntz) AS dod")
    kept = notes_in_stay(c, n)
    assert kept.count() == 3000 and kept.select("note_id").distinct().count() == 3000
    assert kept.where("pid = 'hot'").count() == 1000
