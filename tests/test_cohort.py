import datetime as dt

from wardline.operators.cohort import adult_cohort, death_labels, latest_interval

D = dt.datetime


def make(spark, patients, stays):
    p = spark.createDataFrame(patients, "pid string, is_male int, dob timestamp_ntz, is_dead int, dod timestamp_ntz")
    s = spark.createDataFrame(stays, "pid string, hadm_id string, stay_id string, in_ts timestamp_ntz, out_ts timestamp_ntz")
    return p, s


def test_latest_stay_open_and_ties(spark):
    _, s = make(spark, [], [
        ("1", "h1", "s1", D(2000, 1, 1), D(2000, 1, 5)),
        ("1", "h2", "s2", D(2000, 2, 1), None),            # open stay is the latest
        ("2", "h3", "s3", D(2000, 1, 1), D(2000, 1, 5)),
        ("2", "h4", "s4", D(2000, 1, 2), D(2000, 1, 5)),   # tie on end: larger stay id
    ])
    got = {r.pid: r.stay_id for r in latest_interval(s).collect()}
    assert got == {"1": "s2", "2": "s4"}


def test_age_clamp_and_adults(spark):
    year = dt.timedelta(days=365)
    stay_in = D(2000, 1, 1)
    p, s = make(spark, [
        ("a", 1, stay_in - 18 * year, 0, None),                        # exactly 18.0
        ("b", 0, stay_in - 18 * year + dt.timedelta(days=4), 0, None), # 17.99
        ("c", 0, stay_in - 301 * year, 0, None),                       # shifted -> 89
        ("d", 0, stay_in - 120 * year, 0, None),                       # 120: kept as is
    ], [(x, "h" + x, "s" + x, stay_in, D(2000, 1, 3)) for x in "abcd"])
    got = {r.pid: r.age for r in adult_cohort(p, s).collect()}
    assert set(got) == {"a", "c", "d"}
    assert got["a"] == 18.0 and got["c"] == 89.0 and 119.9 < got["d"] < 120.1


def labels(spark, dod, out, dead=1, missing="null"):
    p, s = make(spark, [("x", 1, D(1950, 1, 1), dead, dod)], [("x", "h", "s", D(2000, 1, 1), out)])
    r = death_labels(adult_cohort(p, s, missing=missing)).first()
    return r.label_in_stay, r.label_30d, r.label_1y


def test_label_horizons(spark):
    out = D(2000, 1, 10)
    assert labels(spark, out, out) == (1, 0, 0)                                      # death at out
    assert labels(spark, out + dt.timedelta(days=30, hours=23, minutes=59, seconds=59), out) == (0, 1, 1)
    assert labels(spark, out + dt.timedelta(days=31), out) == (0, 0, 1)
    assert labels(spark, out + dt.timedelta(days=365), out) == (0, 0, 1)
    assert labels(spark, out + dt.timedelta(days=366), out) == (0, 0, 0)
    assert labels(spark, out, out, dead=0) == (0, 0, 0)                              # flag 0: no death


def test_missing_modes(spark):
    # living patient, open stay: the sentinel rule labels it "died in stay"
    assert labels(spark, None, None, dead=0, missing="null") == (0, 0, 0)
    assert labels(spark, None, None, dead=0, missing="sentinel") == (1, 0, 0)
    # flag 1 but no date of death
    assert labels(spark, None, D(2000, 1, 2), dead=1, missing="null") == (0, 0, 0)
