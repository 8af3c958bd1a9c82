"""Registered queries: each has a Spark plan over the test tables and,
where the result is deterministic, the same query in DuckDB SQL.

``queries()`` / ``oracle_sql()`` in ``__spark_entry__`` are views of
``REGISTRY``.  Spark callables take ``(spark, sf_dir)``; SQL strings run
on DuckDB with the driver's tables registered as views.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardline.sources.testdata import ORACLE_VIEWS

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}

# CTEs shared by the oracle queries, in dependency order.  DuckDB only
# evaluates the ones a query references.
ORACLE_CTES: dict[str, str] = dict(ORACLE_VIEWS)


def add_cte(name: str, body: str) -> None:
    ORACLE_CTES[name] = body


def with_ctes(final_select: str) -> str:
    ctes = ",\n".join(f"{k} AS ({v})" for k, v in ORACLE_CTES.items())
    body = final_select.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def register(name: str, sql: str | None = None):
    def deco(fn):
        REGISTRY[name] = (fn, with_ctes(sql) if sql else None)
        return fn
    return deco
