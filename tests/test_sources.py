import datetime as dt
import os
import tempfile

import pytest

from pyspark.sql import functions as F

from wardline.sources import loaders
from wardline.sources.csv import (
    infer_table_name, load_csv_as_table, normalize_note_text, read_csv_strings, read_stopwords,
    stopword_list,
)


def write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_table_name_rule():
    assert infer_table_name("a/b/PATIENTS.csv") == "PATIENTS"
    assert infer_table_name("a/b.parquet") == "parquet"
    assert infer_table_name("x.csv.gz") == "gz"
    assert infer_table_name("dir/") == "dir/"


def test_loaders_missing_cells(spark):
    tmp = tempfile.mkdtemp(prefix="wl-src-")
    others = [c for c in loaders.SCORE_COMPONENTS if c != "hr_score"]
    blank = "," * len(others)
    p = write(tmp, "SAPSII.csv", f"subject_id,hadm_id,icustay_id,sapsii,sapsii_prob,hr_score,{','.join(others)}\n"
                                 f'1,2,3,40,"0.2",{blank}\n1,2,4,,"",5{blank}\n')
    rows = loaders.scores(read_csv_strings(spark, p)).orderBy("stay_id").collect()
    assert [(r.score, r.score_prob, r.hr_score) for r in rows] == [(40.0, 0.2, 0.0), (0.0, 0.0, 5.0)]
    assert all(r[c] == 0.0 for r in rows for c in others)
    short = write(tmp, "SHORT.csv", "subject_id,hadm_id,icustay_id,sapsii,sapsii_prob\n1,2,3,4,5\n")
    with pytest.raises(KeyError):
        loaders.scores(read_csv_strings(spark, short))
    pt = write(tmp, "PATIENTS.csv", "ROW_ID,SUBJECT_ID,GENDER,DOB,DOD,EXPIRE_FLAG\n"
                                    '1,10,"M",2000-01-01 00:00:00,2050-01-01 00:00:00,1\n'
                                    '2,11,"F",2000-01-01 00:00:00,2050-01-01 00:00:00,0\n'
                                    '3,12,"f",bad date,,1\n')
    got = {r.pid: (r.is_male, r.is_dead, r.dod, r.dob) for r in loaders.patients(read_csv_strings(spark, pt)).collect()}
    assert got["10"] == (1, 1, dt.datetime(2050, 1, 1), dt.datetime(2000, 1, 1))
    assert got["11"][2] is None          # flag 0: date ignored
    assert got["12"][3] is None          # malformed: null, no failure


def test_notes_loader_time_fallback(spark):
    tmp = tempfile.mkdtemp(prefix="wl-src-")
    p = write(tmp, "NOTEEVENTS.csv",
              "ROW_ID,SUBJECT_ID,HADM_ID,CHARTDATE,CHARTTIME,STORETIME,CATEGORY,DESCRIPTION,TEXT\n"
              '1,1,5,2000-01-02,2000-01-02 10:00:00,,Nursing,d,"multi\nline, ""quoted"""\n'
              "2,1,5,2000-01-03,,2000-01-03 11:00:00,Nursing,d,x\n"
              "3,1,5,2000-01-04,,,Nursing,d,y\n"
              "4,1,,2000-01-04,,,Nursing,d,no admission\n"
              "5,1,5,2000-01-04,,,Discharge summary,d,z\n")
    rows = {r.note_id: r for r in loaders.notes(read_csv_strings(spark, p, multiline=True)).collect()}
    assert set(rows) == {"1", "2", "3"}
    assert rows["1"].chart_ts == dt.datetime(2000, 1, 2, 10) and rows["1"].text == 'multi\nline, "quoted"'
    assert rows["2"].chart_ts == dt.datetime(2000, 1, 3, 11)
    assert rows["3"].chart_ts == dt.datetime(2000, 1, 4)


def test_csv_table_and_stopwords(spark):
    tmp = tempfile.mkdtemp(prefix="wl-src-")
    p = write(tmp, "ICUSTAYS.csv", "SUBJECT_ID,HADM_ID\n1,2\n")
    load_csv_as_table(spark, p)
    assert spark.sql("SELECT HADM_ID FROM ICUSTAYS").first()[0] == "2"
    sw = write(tmp, "stop.txt", "with\nthese\n\nwith\n")
    assert sorted(stopword_list(read_stopwords(spark, sw))) == ["these", "with"]


def test_note_text_normalisation(spark):
    df = spark.createDataFrame([('a "b"  c\n\nline2,x\r\nend',)], "t string")
    assert df.select(normalize_note_text(F.col("t"))).first()[0] == "a b  c line2;x end"   # one fold pass: 3 spaces -> 2
