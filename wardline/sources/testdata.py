"""Adapters: the driver's parquet test tables -> entity-timeline tables.

No hospital tables ship with the tests, so they are *derived* from the
TPC-H-like tables with deterministic rules (the same rules are written in
DuckDB SQL in ``ORACLE_VIEWS`` so every query can be value-checked):

* stays    : one per order; pid = o_custkey, in = o_orderdate,
             out = in + SUM(l_quantity) hours (no lines -> open stay)
* patients : one per customer; male iff c_custkey odd; birth date from the
             key (every 40th customer gets a shifted 1690 birth date);
             every 3rd customer died some hours after the latest stay start
* scores   : severity per order (o_orderkey % 164); every 17th order has none
* flags    : 30 comorbidity flags per order, bit i of o_orderkey
* notes    : one per document; pid = doc_id div 4 (four notes per patient,
             so note-bearing patients grow with the corpus), admission = that
             patient's latest stay (every 50th note has none), time = stay
             start + (doc_id*7 % 400) hours, 'src0' documents are discharge
             summaries
* conversations / events / labels: second text source, event timeline and
  document classes, used as is.

All reads are column-pruned parquet scans; join strategies are left to AQE.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.functions.values import add_hours, ts_literal
from wardline.operators.cohort import latest_interval

NOTES_PER_ENTITY = 4         # notes doc_id 4p..4p+3 belong to patient p
N_FLAGS = 30

# fixed values: comorbidity flag names, in column order
FLAG_NAMES = [
    "congestive_heart_failure", "cardiac_arrhythmias", "valvular_disease",
    "pulmonary_circulation", "peripheral_vascular", "hypertension", "paralysis",
    "other_neurological", "chronic_pulmonary", "diabetes_uncomplicated",
    "diabetes_complicated", "hypothyroidism", "renal_failure", "liver_disease",
    "peptic_ulcer", "aids", "lymphoma", "metastatic_cancer", "solid_tumor",
    "rheumatoid_arthritis", "coagulopathy", "obesity", "weight_loss",
    "fluid_electrolyte", "blood_loss_anemia", "deficiency_anemias",
    "alcohol_abuse", "drug_abuse", "psychoses", "depression",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stays_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    qty = (read_table(spark, sf_dir, "lineitem")
           .groupBy("l_orderkey").agg(F.sum("l_quantity").alias("qty")))
    return (orders.join(qty, orders.o_orderkey == qty.l_orderkey, "left")
            .select(F.col("o_custkey").alias("pid"),
                    F.col("o_orderkey").alias("hadm_id"),
                    F.col("o_orderkey").alias("stay_id"),
                    F.col("o_orderdate").alias("in_ts"),
                    add_hours(F.col("o_orderdate"), F.col("qty").cast("int")).alias("out_ts")))


def patients_view(spark: SparkSession, sf_dir: str, stays: DataFrame | None = None) -> DataFrame:
    stays = stays if stays is not None else stays_view(spark, sf_dir)
    last_in = latest_interval(stays).select(F.col("pid").alias("_pid"), F.col("in_ts").alias("_last_in"))
    cust = read_table(spark, sf_dir, "customer").select("c_custkey")
    k = F.col("c_custkey")
    dob = F.when(k % 40 == 0, ts_literal("1690-01-01 00:00:00")).otherwise(
        F.timestamp_add("DAY", ((k * 97) % 30000).cast("int"), ts_literal("1930-01-01 00:00:00")))
    dead = k % 3 == 0
    return (cust.join(last_in, k == F.col("_pid"), "left")
            .select(k.alias("pid"),
                    (k % 2).cast("int").alias("is_male"),
                    dob.alias("dob"),
                    dead.cast("int").alias("is_dead"),
                    F.when(dead, add_hours(F.col("_last_in"), ((k * 37) % 2400).cast("int"))).alias("dod"),
                    ts_literal("1971-01-01 00:00:00").alias("index_date")))


def scores_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    score = (F.col("o_orderkey") % 164).cast("double")
    return (o.where(F.col("o_orderkey") % 17 != 0)
            .select(F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("hadm_id"),
                    F.col("o_orderkey").alias("stay_id"), score.alias("score"),
                    (score / F.lit(163.0)).alias("score_prob")))


def flags_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    bits = [F.shiftright(F.col("o_orderkey"), i).bitwiseAND(F.lit(1)).cast("int") for i in range(N_FLAGS)]
    return o.select(F.col("o_custkey").alias("pid"), F.col("o_orderkey").alias("hadm_id"),
                    F.array(*bits).alias("flags"))


def notes_view(spark: SparkSession, sf_dir: str, stays: DataFrame | None = None) -> DataFrame:
    stays = stays if stays is not None else stays_view(spark, sf_dir)
    latest = (latest_interval(stays)
              .select(F.col("pid").alias("_pid"), F.col("hadm_id").alias("_hadm"),
                      F.col("in_ts").alias("_in")))
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    d = F.col("doc_id")
    pid = F.floor(d / F.lit(NOTES_PER_ENTITY))
    return (docs.withColumn("_p", pid).join(latest, F.col("_p") == F.col("_pid"), "left")
            .select(d.alias("note_id"),
                    F.col("_p").alias("pid"),
                    F.when(d % 50 == 0, F.lit(None)).otherwise(F.col("_hadm")).alias("hadm_id"),
                    add_hours(F.col("_in"), ((d * 7) % 400).cast("int")).alias("chart_ts"),
                    F.when(F.col("source") == "src0", F.lit("Discharge summary"))
                     .otherwise(F.lit("Nursing")).alias("category"),
                    F.col("lang").alias("description"),
                    F.col("text")))


def conversation_notes_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second text source: conv_id = entity, turn * 6 h after 2024-01-01 = time."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return c.select(F.col("conv_id").alias("pid"),
                    (F.col("conv_id") * 100000 + F.col("turn")).alias("note_id"),
                    add_hours(ts_literal("2024-01-01 00:00:00"), (F.col("turn") * 6).cast("int")).alias("chart_ts"),
                    F.col("role").alias("category"), F.col("text"))


@dataclass
class Tables:
    patients: DataFrame
    stays: DataFrame
    scores: DataFrame
    flags: DataFrame
    notes: DataFrame


def load_views(spark: SparkSession, sf_dir: str) -> Tables:
    stays = stays_view(spark, sf_dir)
    return Tables(patients=patients_view(spark, sf_dir, stays), stays=stays,
                  scores=scores_view(spark, sf_dir), flags=flags_view(spark, sf_dir),
                  notes=notes_view(spark, sf_dir, stays))


# ---------------------------------------------------------------------------
# The same views in DuckDB SQL (CTE bodies) for the oracle queries.
_FLAG_SQL = ", ".join(f"CAST((o_orderkey >> {i}) & 1 AS INTEGER)" for i in range(N_FLAGS))

ORACLE_VIEWS = {
    "stays_v": """
        SELECT o.o_custkey AS pid, o.o_orderkey AS hadm_id, o.o_orderkey AS stay_id,
               o.o_orderdate AS in_ts,
               o.o_orderdate + INTERVAL 1 HOUR * CAST(q.qty AS INTEGER) AS out_ts
        FROM orders o LEFT JOIN (SELECT l_orderkey, SUM(l_quantity) AS qty
                                 FROM lineitem GROUP BY l_orderkey) q
          ON o.o_orderkey = q.l_orderkey""",
    "latest_v": """
        SELECT * EXCLUDE (rn) FROM (
          SELECT *, ROW_NUMBER() OVER (PARTITION BY pid ORDER BY
                 COALESCE(out_ts, TIMESTAMP '9000-01-01') DESC, stay_id DESC) AS rn
          FROM stays_v) WHERE rn = 1""",
    "patients_v": """
        SELECT c.c_custkey AS pid, CAST(c.c_custkey % 2 AS INTEGER) AS is_male,
               CASE WHEN c.c_custkey % 40 = 0 THEN TIMESTAMP '1690-01-01'
                    ELSE TIMESTAMP '1930-01-01' + INTERVAL 1 DAY * CAST((c.c_custkey * 97) % 30000 AS INTEGER) END AS dob,
               CAST(c.c_custkey % 3 = 0 AS INTEGER) AS is_dead,
               CASE WHEN c.c_custkey % 3 = 0
                    THEN l.in_ts + INTERVAL 1 HOUR * CAST((c.c_custkey * 37) % 2400 AS INTEGER) END AS dod,
               TIMESTAMP '1971-01-01' AS index_date
        FROM customer c LEFT JOIN latest_v l ON c.c_custkey = l.pid""",
    "scores_v": """
        SELECT o_custkey AS pid, o_orderkey AS hadm_id, o_orderkey AS stay_id,
               CAST(o_orderkey % 164 AS DOUBLE) AS score,
               CAST(o_orderkey % 164 AS DOUBLE) / 163.0 AS score_prob
        FROM orders WHERE o_orderkey % 17 <> 0""",
    "flags_v": f"""
        SELECT o_custkey AS pid, o_orderkey AS hadm_id, [{_FLAG_SQL}] AS flags FROM orders""",
    "notes_v": f"""
        SELECT d.doc_id AS note_id, d.doc_id // {NOTES_PER_ENTITY} AS pid,
               CASE WHEN d.doc_id % 50 = 0 THEN NULL ELSE l.hadm_id END AS hadm_id,
               l.in_ts + INTERVAL 1 HOUR * CAST((d.doc_id * 7) % 400 AS INTEGER) AS chart_ts,
               CASE WHEN d.source = 'src0' THEN 'Discharge summary' ELSE 'Nursing' END AS category,
               d.lang AS description, d.text
        FROM documents d LEFT JOIN latest_v l ON d.doc_id // {NOTES_PER_ENTITY} = l.pid""",
    "conv_notes_v": """
        SELECT conv_id AS pid, conv_id * 100000 + turn AS note_id,
               TIMESTAMP '2024-01-01' + INTERVAL 6 HOUR * CAST(turn AS INTEGER) AS chart_ts,
               role AS category, text
        FROM conversations""",
}
