"""CSV / text sources and sinks.

Tables are read with every column as STRING (no schema inference), quoted
multi-line fields allowed, doubled quotes as the escape.  Blank and missing
cells are treated alike downstream (``blank_to_null``).
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed value: table-name rule, last word of the path, optional ".csv"
TABLE_NAME_PATTERN = r"(\w+)(\.csv)?$"


def infer_table_name(path: str) -> str:
    """S3: 'a/b/PATIENTS.csv' -> 'PATIENTS'; no match -> the path itself."""
    m = re.search(TABLE_NAME_PATTERN, path, flags=re.ASCII)
    return m.group(1) if m else path


def table_name_column(path: Column) -> Column:
    """S3 as a column expression (same rule, evaluated per row)."""
    name = F.regexp_extract(path, TABLE_NAME_PATTERN, 1)
    return F.when(name == "", path).otherwise(name)


def read_csv_strings(spark: SparkSession, path: str, multiline: bool = False,
                     columns: Sequence[str] | None = None) -> DataFrame:
    """Header CSV, all columns STRING.

    ``multiline`` allows line breaks in quoted fields, at the price of one task
    per file; without it a file is split like any text.  ``columns`` (in file
    order) spares the job that reads the header.
    """
    reader = spark.read
    if columns is not None:
        reader = reader.schema(", ".join(f"`{c}` string" for c in columns))
    return (reader.option("header", True).option("escape", '"')
            .option("multiLine", multiline).option("inferSchema", False).csv(path))


def load_csv_as_table(spark: SparkSession, path: str, table_name: str | None = None) -> DataFrame:
    """Read a header CSV and register it as a temp view."""
    df = read_csv_strings(spark, path)
    df.createOrReplaceTempView(table_name or infer_table_name(path))
    return df


def write_report(df: DataFrame, path: str, header: bool = True) -> str:
    """A report table as header CSV in ``path`` (parallel writer)."""
    df.write.mode("overwrite").option("header", header).csv(path)
    return path


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> distinct non-empty words (column ``word``)."""
    return (spark.read.text(path).select(F.trim("value").alias("word"))
            .where(F.col("word") != "").distinct())


def stopword_list(words: DataFrame) -> list[str]:
    """A short stop list as a plain list for the tokenizer's INSET test.

    For lists of any size keep the DataFrame and use
    ``operators.text.without_stopwords`` (an anti join).
    """
    return [r.word for r in words.collect()]


def normalize_quoted_field(c: Column) -> Column:
    """Inside a field, quotes become spaces and commas semicolons."""
    return F.translate(F.regexp_replace(c, '"', " "), ",", ";")


def normalize_note_text(c: Column) -> Column:
    """S13 on a parsed multi-line field: quotes -> space, one pass of
    double-space folding, blank lines dropped, lines joined by a space
    (trailing CR removed), commas -> semicolons."""
    t = F.regexp_replace(F.regexp_replace(c, '"', " "), "  ", " ")
    lines = F.filter(F.split(t, "\n"), lambda s: s != "")
    lines = F.transform(lines, lambda s: F.regexp_replace(s, "\r$", ""))
    return F.translate(F.array_join(lines, " "), ",", ";")
