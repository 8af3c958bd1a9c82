"""Registered queries against their DuckDB oracle on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as E
from tools.oracle_check import TABLES, digest

SF = "/root/testdata/sf0.001"
FAST = ["cohort_adults", "labels_in_stay", "labels_sentinel", "notes_in_stay", "tokens_clean",
        "first_note", "filter_hours_entities", "feature_pivot", "split_exact", "subsample_7_3",
        "auc_midrank", "hour_sweep_population", "load_notes", "csv_style_clean"]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_matches_oracle(spark, con, name):
    sp = E.queries()[name](spark, SF).toPandas()
    dk = con.execute(E.oracle_sql()[name]).df()
    assert digest(sp)[:3] == digest(dk)[:3]


def test_every_query_has_a_callable_and_most_have_sql():
    q, s = E.queries(), E.oracle_sql()
    assert set(s) <= set(q)
    assert len(s) >= 50
