"""Every registered query with a SQL twin must agree with DuckDB (sf0.001)."""

import pytest

from tests.conftest import SMOKE_DIR
from tests.oracle_harness import compare

import __spark_entry__ as entry_mod

ORACLES = entry_mod.oracle_sql()
QUERIES = entry_mod.queries()
# Slow model-bound twins are covered by the driver's sf0.01 run.
SLOW = {"k2_smote"}


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n not in SLOW))
def test_matches_duckdb(spark, duck_smoke, name):
    problems, _ = compare(spark, duck_smoke, name, QUERIES[name], ORACLES[name], SMOKE_DIR)
    assert not problems, problems


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert [r["hour_bin"] for r in rows] == ["Late_Night", "Morning", "Afternoon", "Evening"]
    assert sum(r["count"] for r in rows) == 1500
