"""Cohort selection (A1, J1, P10, P11, F3 = M1) and label generation (M3).

``missing`` selects how unknown dates behave:

* ``'null'`` (default): an unknown death never counts as a death, an open
  stay (no end) lasts for ever, an unknown start makes the age unknown.
* ``'sentinel'``: the reference's behaviour: every unknown date becomes
  9000-01-01 and takes part in comparisons like a real date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.values import (
    ADULT_AGE, MS_PER_DAY, SENTINEL_FUTURE, age_years, clamp_deidentified_age,
    ts_literal,
)

MISSING_MODES = ("null", "sentinel")


def _check_mode(missing: str) -> None:
    if missing not in MISSING_MODES:
        raise ValueError(f"missing must be one of {MISSING_MODES}, got {missing!r}")


def latest_interval(stays: DataFrame, entity: str = "pid", end: str = "out_ts",
                    tiebreak: str = "stay_id") -> DataFrame:
    """A1: the latest interval of each entity by end time.

    An open interval (no end) counts as the latest.  Ties on the end time
    go to the largest ``tiebreak`` value, so the choice is deterministic.
    ``max_by`` is an aggregate with a partial (map-side) phase, so an entity
    holding a third of all rows is reduced before the shuffle instead of
    being sorted in one task as a ``row_number`` window would be.
    """
    cols = stays.columns
    order_key = F.struct(F.coalesce(F.col(end), ts_literal(SENTINEL_FUTURE)).alias("k"),
                         F.col(tiebreak).alias("t"))
    return (stays.groupBy(entity)
            .agg(F.max_by(F.struct(*[F.col(c) for c in cols if c != entity]), order_key).alias("_r"))
            .select(entity, "_r.*"))


def effective_times(df: DataFrame, missing: str = "null", in_col: str = "in_ts",
                    out_col: str = "out_ts", death_col: str = "dod",
                    dead_flag: str = "is_dead") -> DataFrame:
    """Death time only when the death flag is set; sentinels if asked."""
    _check_mode(missing)
    death = F.when(F.col(dead_flag) == 1, F.col(death_col))
    if missing == "sentinel":
        s = ts_literal(SENTINEL_FUTURE)
        return df.withColumns({
            death_col: F.coalesce(death, s),
            in_col: F.coalesce(F.col(in_col), s),
            out_col: F.coalesce(F.col(out_col), s),
        })
    return df.withColumn(death_col, death)


def adult_cohort(patients: DataFrame, stays: DataFrame, missing: str = "null",
                 entity: str = "pid", min_age: float = ADULT_AGE) -> DataFrame:
    """M1: latest stay per patient, joined to the patient, adults only.

    Output: one row per entity with the stay columns, the patient columns
    and ``age`` (years at the stay's start, 300+ clamped to 89).
    """
    latest = latest_interval(stays, entity=entity)
    pats = patients.drop("age") if "age" in patients.columns else patients
    joined = effective_times(latest.join(pats, entity), missing)
    age = clamp_deidentified_age(age_years(F.col("dob"), F.col("in_ts")))
    return joined.withColumn("age", age).where(F.col("age") >= min_age)


def with_death_labels(cohort: DataFrame) -> DataFrame:
    """The cohort with the three mortality labels as columns, in one pass.

    * ``label_in_stay``: in <= death <= out (open stay: no upper bound)
    * ``label_30d``:     death after out, truncated days since out <= 30
    * ``label_1y``:      same with 365 (includes the 30-day deaths)

    Expects the times already passed through ``effective_times``.
    """
    dod, in_ts, out_ts = F.col("dod"), F.col("in_ts"), F.col("out_ts")
    in_stay = dod.isNotNull() & (dod >= in_ts) & (out_ts.isNull() | (dod <= out_ts))
    after = dod.isNotNull() & out_ts.isNotNull() & (dod > out_ts)
    days = F.floor(F.timestamp_diff("MILLISECOND", out_ts, dod) / F.lit(MS_PER_DAY))

    def flag(c):
        return F.coalesce(c, F.lit(False)).cast("int")

    return cohort.withColumns({"label_in_stay": flag(in_stay), "label_30d": flag(after & (days <= 30)),
                               "label_1y": flag(after & (days <= 365))})


def death_labels(cohort: DataFrame, entity: str = "pid") -> DataFrame:
    """The three labels as a table of their own."""
    return with_death_labels(cohort).select(entity, *LABEL_COLUMNS.values())


LABEL_COLUMNS = {"in_stay": "label_in_stay", "30d": "label_30d", "1y": "label_1y"}


def labels_for(cohort: DataFrame, horizon: str = "in_stay", entity: str = "pid") -> DataFrame:
    """(entity, label) for one horizon: 'in_stay' | '30d' | '1y'."""
    col = LABEL_COLUMNS[horizon]
    return death_labels(cohort, entity).select(entity, F.col(col).alias("label"))
