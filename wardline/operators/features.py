"""Feature tables: long (entity, feature, value), wide arrays, pivots and
labelled points (J2, M4-M8, J7-J9, P9, P12, P20-P23, A7, A8, M10, M11).

Arrays stay ``array<double>`` through every join; they become ML vectors
only at the model edge (``labelled_points``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardline.functions.values import MAX_AGE, MAX_SEVERITY
from wardline.operators.ranking import dense_index
from wardline.operators.text import sparse_rows
from wardline.operators.timeline import filter_on_hours
from wardline.session import scratch_path

# fixed feature names and order of the baseline model
BASELINE_FEATURES = ["patient_age", "patient_sex", "saps_score"]


def _with_severity(cohort: DataFrame, scores: DataFrame, entity: str = "pid") -> DataFrame:
    """Cohort stay joined to its severity row on (entity, admission, stay)."""
    keys = [entity, "hadm_id", "stay_id"]
    return cohort.select(*keys, "age", "is_male").join(scores.select(*keys, "score"), keys)


def _scaled(df: DataFrame) -> dict:
    """Constants-scaled baseline values (no upper clip)."""
    return {
        "patient_age": F.col("age") / F.lit(MAX_AGE),
        "patient_sex": F.col("is_male").cast("double"),
        "saps_score": F.col("score") / F.lit(MAX_SEVERITY),
    }


def baseline_long(cohort: DataFrame, scores: DataFrame, entity: str = "pid") -> DataFrame:
    """M4 (+U1): long rows (entity, feature, value), one scan, ``unpivot``."""
    j = _with_severity(cohort, scores, entity)
    wide = j.select(entity, *[c.alias(n) for n, c in _scaled(j).items()])
    return wide.unpivot(entity, BASELINE_FEATURES, "feature", "value")


def baseline_array(cohort: DataFrame, scores: DataFrame, entity: str = "pid") -> DataFrame:
    """M6 (+P20): (entity, features = [age/89, sex, score/163])."""
    j = _with_severity(cohort, scores, entity)
    s = _scaled(j)
    return j.select(entity, F.array(*[s[n] for n in BASELINE_FEATURES]).alias("features"))


def baseline_long_at_hours(cohort, scores, first_note, hours, entity="pid"):
    """M5: F5 then M4."""
    return baseline_long(filter_on_hours(cohort, first_note, hours, entity), scores, entity)


def baseline_array_at_hours(cohort, scores, first_note, hours, entity="pid"):
    """M7: F5 then M6."""
    return baseline_array(filter_on_hours(cohort, first_note, hours, entity), scores, entity)


def comorbidity_features(cohort: DataFrame, flags: DataFrame, entity: str = "pid") -> DataFrame:
    """M8 (J7 + P9): the 30 flags of the cohort's own admission, as doubles."""
    own = flags.join(cohort.select(entity, "hadm_id"), [entity, "hadm_id"], "left_semi")
    return own.select(entity, F.transform("flags", lambda x: x.cast("double")).alias("features"))


def combine_features(left: DataFrame, right: DataFrame, entity: str = "pid") -> DataFrame:
    """J9 + P21: inner join on the entity, arrays concatenated (3 + 30 = 33)."""
    return (left.select(entity, F.col("features").alias("_a"))
            .join(right.select(entity, F.col("features").alias("_b")), entity)
            .select(entity, F.concat("_a", "_b").alias("features")))


def pivot_features(long: DataFrame, names=None, entity: str = "pid") -> DataFrame:
    """A7 + A8: long -> one column per (lower-cased) feature name.

    The name list is fixed (given), so the pivot is a single aggregation
    with no extra job to discover the distinct names, and train and test
    share one column order.
    """
    names = [n.lower() for n in (names or BASELINE_FEATURES)]
    return (long.withColumn("feature", F.lower("feature"))
            .groupBy(entity).pivot("feature", names).agg(F.first("value")))


def long_to_array(long: DataFrame, names=None, entity: str = "pid") -> DataFrame:
    """M11's sparse build: pivot, then absent features as 0.0, as an array."""
    names = [n.lower() for n in (names or BASELINE_FEATURES)]
    p = pivot_features(long, names, entity)
    return p.select(entity, F.array(*[F.coalesce(F.col(n), F.lit(0.0)) for n in names]).alias("features"))


def mean_vector(rows: DataFrame, entity: str = "pid", col: str = "features") -> DataFrame:
    """Element-wise mean of equal-length arrays per entity, one
    partial aggregate (``Summarizer``)."""
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    v = rows.select(entity, array_to_vector(col).alias("_v"))
    return (v.groupBy(entity).agg(Summarizer.mean(F.col("_v")).alias("_m"))
            .select(entity, vector_to_array("_m").alias(col)))


def labelled_points(features: DataFrame, labels: DataFrame, entity: str = "pid",
                    label: str = "label") -> DataFrame:
    """(entity, label double, features vector) for pyspark.ml."""
    from pyspark.ml.functions import array_to_vector

    return (features.join(labels.select(entity, label), entity)
            .select(entity, F.col(label).cast("double").alias("label"),
                    array_to_vector("features").alias("features")))


def feature_index(long: DataFrame) -> DataFrame:
    """(feature, index) of every lower-cased name found, by name; learned, so none need be given."""
    names = long.select(F.lower("feature").alias("feature")).where("feature is not null").distinct()
    return dense_index(names, ["feature"])


def sparse_features(long: DataFrame, index: DataFrame, entity: str = "pid") -> DataFrame:
    """(entity, indices, values) over a learned index, without a pivot.

    Absent features are simply not listed, and so are names that the index
    lacks (those only the test rows have) and null values; an entity without
    any feature has no row.  Of repeated rows the smallest value counts.
    """
    one = (long.select(entity, F.lower("feature").alias("feature"), "value").where("value is not null")
           .groupBy(entity, "feature").agg(F.min("value").alias("value")))
    return sparse_rows(one.join(index, "feature"), [entity])


def sparse_points(rows: DataFrame, labels: DataFrame, size: int, entity: str = "pid", label: str = "label") -> DataFrame:
    """(entity, label double, features sparse vector of ``size``) for pyspark.ml.

    A vector column is a struct in Parquet: the points are written as such, which
    every fit that reads them several times needs anyway, and read as vectors,
    so no Python function builds them.
    """
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, StructField, StructType

    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), "indices", "values")
    points = (rows.join(labels.select(entity, label), entity)
              .select(entity, F.col(label).cast("double").alias("label"), vector.alias("features")))
    path = scratch_path(rows.sparkSession, "points")
    points.write.parquet(path)
    schema = StructType([points.schema[entity], StructField("label", DoubleType()), StructField("features", VectorUDT())])
    return rows.sparkSession.read.schema(schema).parquet(path)
