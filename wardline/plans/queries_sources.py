"""Registered queries: CSV round trips through the typed loaders, table
names from paths, text normalisation, single-file report sink
(S1-S9, S12-S14, P2-P8).

The hospital-shaped CSVs are staged from the test tables into the shared
checkpoint folder (``spark.checkpoint.dir``), then read back with the
loaders; the oracle computes the same typed rows straight from the views.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.plans.catalog import REGISTRY, register
from wardline.session import scratch_path
from wardline.sources import loaders
from wardline.sources.loaders import SCORE_COMPONENTS
from wardline.sources.csv import (
    load_csv_as_table, normalize_note_text, normalize_quoted_field, read_csv_strings,
    table_name_column, write_report,
)
from wardline.sources.records import clean_note_records, read_quoted_csv
from wardline.sources.testdata import FLAG_NAMES, load_views, read_table

FMT = "yyyy-MM-dd HH:mm:ss"
SQL_FMT = "'%Y-%m-%d %H:%M:%S'"


def _fmt(c):
    return F.date_format(c, FMT)


def stage_csv(spark, df: DataFrame, name: str, base: str | None = None) -> str:
    """Write ``df`` as header CSV (doubled-quote escaping) in the shared folder."""
    path = f"{base or scratch_path(spark, 'csv')}/{name}"
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("quoteAll", False).csv(path))
    return path


@register("csv_scan_roundtrip", f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,
           o_orderstatus, o_orderpriority, strftime(o_orderdate, {SQL_FMT}) AS o_orderdate FROM orders""")
def q_csv_scan_roundtrip(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", _fmt("o_orderdate").alias("o_orderdate"))
    path = stage_csv(spark, o, "ORDERS.csv")
    load_csv_as_table(spark, path)          # view name inferred from the path: ORDERS
    return spark.sql("SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_orderdate FROM ORDERS")


@register("view_name_from_path", r"""
    SELECT page_id, CASE WHEN regexp_extract(url, '(\w+)(\.csv)?$', 1) = '' THEN url
                         ELSE regexp_extract(url, '(\w+)(\.csv)?$', 1) END AS table_name FROM pages""")
def q_view_name_from_path(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return p.select("page_id", table_name_column(F.col("url")).alias("table_name"))


@register("load_patients", """
    SELECT CAST(pid AS VARCHAR) AS pid, is_male, dob, is_dead, dod, index_date FROM patients_v""")
def q_load_patients(spark, sf_dir):
    return loaders.patients(read_csv_strings(spark, stage_csv(spark, _raw_patients(spark, sf_dir), "PATIENTS.csv")))


def _raw_patients(spark, sf_dir):
    p = load_views(spark, sf_dir).patients
    return p.select(F.col("pid").cast("string").alias("SUBJECT_ID"),
                   F.when(F.col("is_male") == 1, "M").otherwise("F").alias("GENDER"),
                   _fmt("dob").alias("DOB"), _fmt("dod").alias("DOD"),
                    F.col("is_dead").cast("string").alias("EXPIRE_FLAG"))


@register("load_stays", """
    SELECT CAST(pid AS VARCHAR) AS pid, CAST(hadm_id AS VARCHAR) AS hadm_id,
           CAST(stay_id AS VARCHAR) AS stay_id, in_ts, out_ts FROM stays_v""")
def q_load_stays(spark, sf_dir):
    return loaders.stays(read_csv_strings(spark, stage_csv(spark, _raw_stays(spark, sf_dir), "ICUSTAYS.csv")))


def _raw_stays(spark, sf_dir):
    s = load_views(spark, sf_dir).stays
    return s.select(F.col("pid").cast("string").alias("SUBJECT_ID"), F.col("hadm_id").cast("string").alias("HADM_ID"),
                   F.col("stay_id").cast("string").alias("ICUSTAY_ID"), _fmt("in_ts").alias("INTIME"),
                    _fmt("out_ts").alias("OUTTIME"))


@register("load_scores", """
    SELECT CAST(pid AS VARCHAR) AS pid, CAST(hadm_id AS VARCHAR) AS hadm_id, CAST(stay_id AS VARCHAR) AS stay_id,
           score, CASE WHEN hadm_id % 5 = 0 THEN 0.0 ELSE score_prob END AS score_prob, """ + ", ".join(
    f"CASE WHEN (hadm_id + {i}) % 4 = 0 THEN 0.0 ELSE CAST((hadm_id * {i + 3}) % 27 AS DOUBLE) END AS {c}"
    for i, c in enumerate(SCORE_COMPONENTS)) + " FROM scores_v")
def q_load_scores(spark, sf_dir):
    return loaders.scores(read_csv_strings(spark, stage_csv(spark, _raw_scores(spark, sf_dir), "SAPSII.csv")))


def _raw_scores(spark, sf_dir):
    s = load_views(spark, sf_dir).scores
    return s.select(F.col("pid").cast("string").alias("subject_id"), F.col("hadm_id").cast("string").alias("hadm_id"),
                   F.col("stay_id").cast("string").alias("icustay_id"), F.col("score").cast("string").alias("sapsii"),
                   # every 5th probability cell is left empty: loads as 0.0
                   F.when(F.col("hadm_id") % 5 == 0, F.lit(None))
                    .otherwise(F.col("score_prob").cast("string")).alias("sapsii_prob"),
                   # component scores from the key, some cells empty
                   *[F.when((F.col("hadm_id") + i) % 4 != 0, ((F.col("hadm_id") * (i + 3)) % 27).cast("string")).alias(c)
                     for i, c in enumerate(SCORE_COMPONENTS)])


@register("load_flags", """
    SELECT CAST(pid AS VARCHAR) AS pid, CAST(hadm_id AS VARCHAR) AS hadm_id,
           UNNEST(generate_series(0, 29)) AS pos, UNNEST(flags) AS value FROM flags_v""")
def q_load_flags(spark, sf_dir):
    loaded = loaders.flags(read_csv_strings(spark, stage_csv(spark, _raw_flags(spark, sf_dir), "EHCOMORBIDITIES.csv")))
    return loaded.select("pid", "hadm_id", F.posexplode("flags").alias("pos", "value"))


def _raw_flags(spark, sf_dir):
    f = load_views(spark, sf_dir).flags
    cells = [F.when((F.col("flags")[i] == 0) & (F.col("hadm_id") % 7 == 0), F.lit(None))   # blank cells
             .otherwise(F.col("flags")[i].cast("string")).alias(n) for i, n in enumerate(FLAG_NAMES)]
    return f.select(F.col("pid").cast("string").alias("subject_id"),
                    F.col("hadm_id").cast("string").alias("hadm_id"), *cells)


@register("load_notes", """
    SELECT CAST(note_id AS VARCHAR) AS note_id, CAST(pid AS VARCHAR) AS pid, CAST(hadm_id AS VARCHAR) AS hadm_id,
           CASE WHEN note_id % 3 = 0 AND note_id % 2 = 1 THEN date_trunc('day', chart_ts) ELSE chart_ts END AS chart_ts,
           category, md5(text) AS text_md5
    FROM notes_v WHERE NOT contains(lower(category), 'discharge') AND hadm_id IS NOT NULL""")
def q_load_notes(spark, sf_dir):
    loaded = loaders.notes(read_quoted_csv(spark, stage_csv(spark, _raw_notes(spark, sf_dir), "NOTEEVENTS.csv")))
    return loaded.select("note_id", "pid", "hadm_id", "chart_ts", "category", F.md5("text").alias("text_md5"))


def _raw_notes(spark, sf_dir):
    n = load_views(spark, sf_dir).notes
    k = F.col("note_id")
    return n.select(k.cast("string").alias("ROW_ID"), F.col("pid").cast("string").alias("SUBJECT_ID"),
                   F.col("hadm_id").cast("string").alias("HADM_ID"),
                   F.date_format("chart_ts", "yyyy-MM-dd").alias("CHARTDATE"),
                   F.when(k % 3 == 0, F.lit(None)).otherwise(_fmt("chart_ts")).alias("CHARTTIME"),
                   F.when((k % 3 == 0) & (k % 2 == 0), _fmt("chart_ts")).alias("STORETIME"),
                   F.col("category").alias("CATEGORY"), F.col("description").alias("DESCRIPTION"),
                   F.col("text").alias("TEXT"))


@register("csv_style_clean", r"""
    SELECT doc_id, md5(translate(replace(COALESCE(text, ''), '"', ' '), ',', ';')) AS field_md5,
           md5(translate(array_to_string(list_transform(list_filter(
               string_split(regexp_replace(replace(COALESCE(text, ''), '"', ' '), '  ', ' ', 'g'), chr(10)),
               lambda s: s <> ''), lambda s: regexp_replace(s, '\r$', '')), ' '), ',', ';')) AS note_md5
    FROM documents""")
def q_csv_style_clean(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    return d.select("doc_id", F.md5(normalize_quoted_field(F.col("t"))).alias("field_md5"),
                    F.md5(normalize_note_text(F.col("t"))).alias("note_md5"))


@register("notes_clean_records", r"""
    SELECT doc_id, md5(array_to_string(list_transform(part, lambda x, i:
               CASE WHEN i % 2 = 0 THEN replace(x, ',', ';') ELSE x END), '"')) AS record_md5
    FROM (SELECT doc_id, string_split(array_to_string(list_append(list_transform(line[1 : len(line) - 1],
                 lambda x: regexp_replace(x, '\r$', '')), line[len(line)]), ' '), '"') AS part
          FROM (SELECT doc_id, list_filter(list_transform(string_split(
                         concat(doc_id, ',"', replace(COALESCE(text, ''), '"', '""'), '"'), chr(10)),
                       lambda x: replace(replace(x, '""', ' '), '  ', ' ')),
                       lambda x: NOT regexp_full_match(x, '\s*')) AS line FROM documents))""")
def q_notes_clean_records(spark, sf_dir):
    """S13 over quoted multi-line records: written as lines, cut by byte ranges, cleaned."""
    d = read_table(spark, sf_dir, "documents")
    path = scratch_path(spark, "notes")
    d.select(F.concat(F.col("doc_id"), F.lit(',"'), F.replace(F.coalesce("text", F.lit("")), F.lit('"'), F.lit('""')),
                      F.lit('"'))).write.text(path)
    records = clean_note_records(spark, path)
    return records.select(F.regexp_extract("record", "^([0-9]+),", 1).cast("long").alias("doc_id"),
                          F.md5("record").alias("record_md5"))


@register("single_file_sink", """
    SELECT CAST(n_patients AS VARCHAR) AS n_patients, CAST(n_in_stay AS VARCHAR) AS n_in_stay,
           CAST(n_30d AS VARCHAR) AS n_30d, CAST(n_1y AS VARCHAR) AS n_1y FROM (
      SELECT COUNT(*) AS n_patients, CAST(SUM(l.label_in_stay) AS BIGINT) AS n_in_stay,
             CAST(SUM(l.label_30d) AS BIGINT) AS n_30d, CAST(SUM(l.label_1y) AS BIGINT) AS n_1y
      FROM cohort_v c JOIN labels_v l ON c.pid = l.pid)""")
def q_single_file_sink(spark, sf_dir):
    report = REGISTRY["label_summary"][0](spark, sf_dir).drop("sum_age")
    path = write_report(report, scratch_path(spark, "report"))
    return read_csv_strings(spark, path)


@register("loader_quality_report", """
    SELECT 'patients_bad_dob' AS "check", COUNT(*) FILTER (WHERE dob IS NULL) AS n FROM patients_v
    UNION ALL SELECT 'stays_missing_in', COUNT(*) FILTER (WHERE in_ts IS NULL) FROM stays_v
    UNION ALL SELECT 'stays_missing_out', COUNT(*) FILTER (WHERE out_ts IS NULL) FROM stays_v
    UNION ALL SELECT 'notes_bad_time', COUNT(*) FILTER (WHERE chart_ts IS NULL) FROM notes_f_v
    UNION ALL SELECT 'patients_duplicate_pid', COUNT(*) FROM (SELECT pid FROM patients_v GROUP BY pid HAVING COUNT(*) > 1)
    UNION ALL SELECT 'scores_duplicate_key', COUNT(*) FROM (SELECT 1 FROM scores_v GROUP BY pid, hadm_id, stay_id HAVING COUNT(*) > 1)
    UNION ALL SELECT 'flags_duplicate_key', COUNT(*) FROM (SELECT 1 FROM flags_v GROUP BY pid, hadm_id HAVING COUNT(*) > 1)""")
def q_loader_quality_report(spark, sf_dir):
    """S10 end to end: all five tables staged in one folder, ``load_all``,
    then the data-quality counts (Q25, Q26)."""
    base = scratch_path(spark, "hospital")
    for name, raw in (("PATIENTS.csv", _raw_patients), ("ICUSTAYS.csv", _raw_stays),
                      ("SAPSII.csv", _raw_scores), ("EHCOMORBIDITIES.csv", _raw_flags),
                      ("NOTEEVENTS.csv", _raw_notes)):
        stage_csv(spark, raw(spark, sf_dir), name, base)
    return loaders.quality_report(loaders.load_all(spark, base))
