"""Scalar conversions used by the loaders and the cohort (P2-P12, X1 hash).

Missing cells arrive as null *or* as the empty string (old CSV readers gave
``""``); every helper treats both the same.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values --------------------------------------------------------
TIMESTAMP_PATTERN = r"^\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}$"   # yyyy-MM-dd HH:mm:ss
SENTINEL_FUTURE = "9000-01-01 00:00:00"    # stands for "no date" (dod, in, out)
INDEX_DATE = "1971-01-01 00:00:00"         # constant index date of a patient
MAX_SEVERITY = 163.0                        # largest SAPS II score
MAX_AGE = 89.0                              # age cap used for de-identified ages
DEIDENTIFIED_AGE = 300.0                    # ages at or above this are shifted
MS_PER_DAY = 86_400_000
MS_PER_YEAR = 365 * MS_PER_DAY              # 365-day years
ADULT_AGE = 18.0
# --- end of fixed values -------------------------------------------------


def blank_to_null(c: Column) -> Column:
    """'' and whitespace-only become null (null stays null)."""
    return F.when(F.trim(c) == "", F.lit(None)).otherwise(c)


def gender_flag(c: Column) -> Column:
    """1 iff lower(value) == 'm', else 0 (also for null / '')."""
    return F.coalesce((F.lower(c) == "m").cast("int"), F.lit(0))


def to_int_or_zero(c: Column) -> Column:
    """Integer cell, missing or malformed -> 0."""
    return F.coalesce(c.try_cast("int"), F.lit(0))


def to_double_or_zero(c: Column) -> Column:
    """Double cell, missing or malformed -> 0.0."""
    return F.coalesce(c.try_cast("double"), F.lit(0.0))


def parse_timestamp(c: Column) -> Column:
    """P4 + P5: 'yyyy-MM-dd HH:mm:ss' -> TIMESTAMP_NTZ; date-only values padded.

    Malformed values become null (counted by the loaders' quality report)
    instead of failing the job.
    """
    t = F.trim(c)
    padded = F.when(F.length(t) == 10, F.concat(t, F.lit(" 00:00:00"))).otherwise(t)
    # straight to the zone-less type: no session zone can move a value
    return F.when(padded.rlike(TIMESTAMP_PATTERN), padded.try_cast("timestamp_ntz"))


def ts_literal(value: str) -> Column:
    return F.lit(value).cast("timestamp_ntz")


def millis_between(start: Column, end: Column) -> Column:
    """end - start in milliseconds (works on TIMESTAMP and TIMESTAMP_NTZ)."""
    return F.timestamp_diff("MILLISECOND", start, end)


def add_hours(ts: Column, hours) -> Column:
    """ts + hours (hours: int or integer Column)."""
    h = hours if isinstance(hours, Column) else F.lit(int(hours))
    return F.timestamp_add("HOUR", h, ts)


def age_years(dob: Column, at: Column) -> Column:
    """P10: (at - dob) in ms / 365-day year, as double."""
    return millis_between(dob, at).cast("double") / F.lit(float(MS_PER_YEAR))


def clamp_deidentified_age(age: Column) -> Column:
    """Ages of 300 years or more (shifted birth dates) become 89."""
    return F.when(age >= DEIDENTIFIED_AGE, F.lit(MAX_AGE)).otherwise(age)


def hash_uniform(key: Column, seed: int) -> Column:
    """A reproducible uniform value in [0, 1) from md5(seed ':' key).

    The same number is computed by ``('0x'||substr(md5(s),1,8))::UBIGINT
    / 4294967296`` in DuckDB, so hash splits are value-checkable.
    """
    s = F.concat(F.lit(f"{seed}:"), key.cast("string"))
    return F.conv(F.substring(F.md5(s), 1, 8), 16, 10).cast("bigint") / F.lit(4294967296.0)
