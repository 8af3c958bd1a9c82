import datetime as dt

from wardline.operators.cohort import adult_cohort
from wardline.operators.timeline import (
    events_before_hours, filter_notes, filter_on_hours, notes_in_stay, process_notes,
)

D = dt.datetime


def setup(spark):
    p = spark.createDataFrame([("x", 1, D(1950, 1, 1), 1, D(2000, 1, 3)), ("y", 0, D(1950, 1, 1), 0, None)],
                              "pid string, is_male int, dob timestamp_ntz, is_dead int, dod timestamp_ntz")
    s = spark.createDataFrame([("x", "h", "s", D(2000, 1, 1), D(2000, 1, 5)), ("y", "k", "t", D(2000, 1, 1), None)],
                              "pid string, hadm_id string, stay_id string, in_ts timestamp_ntz, out_ts timestamp_ntz")
    return adult_cohort(p, s)


def notes(spark, rows):
    return spark.createDataFrame(rows, "note_id long, pid string, hadm_id string, chart_ts timestamp_ntz, category string, text string")


def test_in_stay_bounds(spark):
    c = setup(spark)
    n = notes(spark, [
        (1, "x", "h", D(2000, 1, 1), "Nursing", "t"),     # at in: kept
        (2, "x", "h", D(2000, 1, 3), "Nursing", "t"),     # at death: dropped
        (3, "x", "h", D(1999, 12, 31), "Nursing", "t"),   # before in
        (4, "x", "other", D(2000, 1, 2), "Nursing", "t"),  # other admission
        (5, "y", "k", D(2001, 1, 1), "Nursing", "t"),     # open stay, alive: kept
        (6, "y", "k", D(2000, 1, 2), "Discharge summary", "t"),
        (7, "y", None, D(2000, 1, 2), "Nursing", "t"),
    ])
    kept = {r.note_id for r in notes_in_stay(c, filter_notes(n)).collect()}
    assert kept == {1, 5}


def test_min_tokens_and_first_note(spark):
    c = setup(spark)
    words99 = " ".join(["word"] * 99)
    n = notes(spark, [(1, "x", "h", D(2000, 1, 1, 5), "N", words99), (2, "y", "k", D(2000, 1, 2), "N", words99),
                      (3, "y", "k", D(2000, 1, 1, 3), "N", "word")])
    tl = process_notes(c, n)
    assert {r.pid for r in tl.cohort.collect()} == {"y"}
    assert tl.first_note.first().first_ts == D(2000, 1, 1, 3)
    assert tl.tokens.count() == 3          # tokens are not cut by the threshold


def test_hours_filters(spark):
    c = setup(spark)
    first = spark.createDataFrame([("x", D(2000, 1, 1)), ("y", D(2000, 1, 1))], "pid string, first_ts timestamp_ntz")
    assert filter_on_hours(c, first, 0).count() == 2
    # x dies at +48h: strictly later bound needed
    assert {r.pid for r in filter_on_hours(c, first, 47).collect()} == {"x", "y"}
    assert {r.pid for r in filter_on_hours(c, first, 48).collect()} == {"y"}
    ev = notes(spark, [(1, "x", "h", D(2000, 1, 1, 11), "N", ""), (2, "x", "h", D(2000, 1, 1, 12), "N", "")])
    assert {r.note_id for r in events_before_hours(ev, first, 12).collect()} == {1}
