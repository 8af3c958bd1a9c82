"""Typed loaders for the hospital-shaped CSV tables.

Each returns a lazy DataFrame in the library's schema:

* patients : pid, is_male, dob, is_dead, dod, index_date
* stays    : pid, hadm_id, stay_id, in_ts, out_ts
* scores   : pid, hadm_id, stay_id, score, score_prob, 15 component scores
* flags    : pid, hadm_id, flags array<int>(30)
* notes    : note_id, pid, hadm_id, chart_ts, category, description, text
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.values import (
    INDEX_DATE, blank_to_null, gender_flag, parse_timestamp, to_double_or_zero,
    to_int_or_zero, ts_literal,
)
from wardline.operators.timeline import filter_notes
from wardline.sources.csv import read_csv_strings
from wardline.sources.records import read_quoted_csv
from wardline.session import stored
from wardline.sources.testdata import FLAG_NAMES

# fixed values: component score columns of the severity table, in order
SCORE_COMPONENTS = [
    "age_score", "hr_score", "sysbp_score", "temp_score", "pao2fio2_score",
    "uo_score", "bun_score", "wbc_score", "potassium_score", "sodium_score",
    "bicarbonate_score", "bilirubin_score", "gcs_score", "comorbidity_score",
    "admissiontype_score",
]


def _c(df: DataFrame, name: str):
    """Case-insensitive column lookup."""
    for c in df.columns:
        if c.lower() == name.lower():
            return F.col(f"`{c}`")
    raise KeyError(name)


def patients(df: DataFrame) -> DataFrame:
    """S5 (+P2, P3, P4, P7)."""
    dead = to_int_or_zero(_c(df, "EXPIRE_FLAG"))
    return df.select(
        blank_to_null(_c(df, "SUBJECT_ID")).alias("pid"),
        gender_flag(_c(df, "GENDER")).alias("is_male"),
        parse_timestamp(_c(df, "DOB")).alias("dob"),
        dead.alias("is_dead"),
        F.when(dead == 1, parse_timestamp(_c(df, "DOD"))).alias("dod"),
        ts_literal(INDEX_DATE).alias("index_date"))


def stays(df: DataFrame) -> DataFrame:
    """Empty in/out -> null (the cohort's ``missing`` mode decides)."""
    return df.select(
        blank_to_null(_c(df, "SUBJECT_ID")).alias("pid"),
        blank_to_null(_c(df, "HADM_ID")).alias("hadm_id"),
        blank_to_null(_c(df, "ICUSTAY_ID")).alias("stay_id"),
        parse_timestamp(_c(df, "INTIME")).alias("in_ts"),
        parse_timestamp(_c(df, "OUTTIME")).alias("out_ts"))


def scores(df: DataFrame) -> DataFrame:
    """3 keys + 17 doubles, missing cell -> 0.0 (a missing column is an error)."""
    return df.select(
        blank_to_null(_c(df, "subject_id")).alias("pid"),
        blank_to_null(_c(df, "hadm_id")).alias("hadm_id"),
        blank_to_null(_c(df, "icustay_id")).alias("stay_id"),
        to_double_or_zero(_c(df, "sapsii")).alias("score"),
        to_double_or_zero(_c(df, "sapsii_prob")).alias("score_prob"),
        *[to_double_or_zero(_c(df, n)).alias(n) for n in SCORE_COMPONENTS])


def flags(df: DataFrame) -> DataFrame:
    """S7 + P8: the 30 flags as one array<int>, missing -> 0."""
    return df.select(
        blank_to_null(_c(df, "subject_id")).alias("pid"),
        blank_to_null(_c(df, "hadm_id")).alias("hadm_id"),
        F.array(*[to_int_or_zero(_c(df, n)) for n in FLAG_NAMES]).alias("flags"))


def notes(df: DataFrame) -> DataFrame:
    """S6 (+P4-P6, F1, F2): time = CHARTTIME, else STORETIME, else CHARTDATE."""
    cols = {c.lower() for c in df.columns}
    when = F.coalesce(*[blank_to_null(_c(df, n)) for n in ("CHARTTIME", "STORETIME", "CHARTDATE")
                        if n.lower() in cols])
    key = (blank_to_null(_c(df, "ROW_ID")) if "row_id" in cols else
           F.xxhash64(*[_c(df, n) for n in df.columns]).cast("string"))   # all columns: equal rows only share it
    out = df.select(
        key.alias("note_id"),
        blank_to_null(_c(df, "SUBJECT_ID")).alias("pid"),
        blank_to_null(_c(df, "HADM_ID")).alias("hadm_id"),
        parse_timestamp(when).alias("chart_ts"),
        _c(df, "CATEGORY").alias("category"),
        _c(df, "DESCRIPTION").alias("description"),
        _c(df, "TEXT").alias("text"))
    return filter_notes(out)


@dataclass
class RawTables:
    patients: DataFrame
    notes: DataFrame
    flags: DataFrame
    stays: DataFrame
    scores: DataFrame


FILES = {"patients": "PATIENTS.csv", "notes": "NOTEEVENTS.csv", "flags": "EHCOMORBIDITIES.csv",
         "stays": "ICUSTAYS.csv", "scores": "SAPSII.csv"}


def load_all(spark: SparkSession, data_dir: str, files: dict | None = None) -> RawTables:
    """The five tables as typed DataFrames, staged once as Parquet in the
    shared folder (later plans prune columns and split scans)."""
    f = dict(FILES, **(files or {}))
    base = data_dir.rstrip("/")

    def rd(name, typed):
        # only notes hold line breaks inside their fields
        read = read_quoted_csv if name == "notes" else read_csv_strings
        return stored(typed(read(spark, f"{base}/{f[name]}")), name)

    return RawTables(patients=rd("patients", patients), notes=rd("notes", notes), flags=rd("flags", flags),
                     stays=rd("stays", stays), scores=rd("scores", scores))


def quality_report(t: RawTables) -> DataFrame:
    """Q25/Q26: rows whose timestamps did not parse and duplicated keys."""
    from functools import reduce

    def count(name, cond):
        return F.count(F.when(cond, 1)).alias(name)

    def by_key(df, keys, *others):
        """One aggregate per key, one over the keys: duplicates and the sums of ``others``."""
        per = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *others)
        names = [c for c in per.columns if c not in keys and c != "_n"]
        return per, names

    pats, bad = by_key(t.patients, ["pid"], count("patients_bad_dob", F.col("dob").isNull()))
    parts = [
        pats.agg(*[F.sum(c).alias(c) for c in bad], count("patients_duplicate_pid", F.col("_n") > 1)),
        t.stays.agg(count("stays_missing_in", F.col("in_ts").isNull()), count("stays_missing_out", F.col("out_ts").isNull())),
        t.notes.agg(count("notes_bad_time", F.col("chart_ts").isNull())),
        by_key(t.scores, ["pid", "hadm_id", "stay_id"])[0].agg(count("scores_duplicate_key", F.col("_n") > 1)),
        by_key(t.flags, ["pid", "hadm_id"])[0].agg(count("flags_duplicate_key", F.col("_n") > 1)),
    ]
    long = [p.select(F.explode(F.array(*[F.struct(F.lit(c).alias("check"), F.coalesce(c, F.lit(0)).alias("n"))
                                         for c in p.columns])).alias("r")).select("r.*") for p in parts]
    return reduce(DataFrame.unionByName, long)
