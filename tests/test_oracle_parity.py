"""Every registered query with an oracle matches DuckDB on the same Parquet tables."""

import os
import re
from functools import partial

import pytest

import __spark_entry__ as entry
from basketry.operators import learning
from tools.check_oracle import compare, duck

SF = os.environ.get("BASKETRY_TEST_SF", "/root/testdata/sf0.001")
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


#: What windows without PARTITION BY may run over: range offsets, vocabularies of the catalog,
#: groups of a metric, and extracts of at most one row per segment or department.
BOUNDED = ("_range", "dense_rank", "_gneg", "total_monetary", "customers", "_n#", "_n_c", "n_c", "_cents", "reorder_rate", "unique_customers")


def check_plan(name: str, plan: str) -> None:
    """No Cartesian product, no Python worker in the analytics, no unbounded single-task window."""
    assert "CartesianProduct" not in plan, name
    for line in plan.splitlines():
        if re.search(r"\bWindow \[", line) and "], [], [" in line:
            assert any(b in line for b in BOUNDED), (name, line)
        if not name.startswith("op"):
            assert not re.search("Python|Pandas|MapInArrow", line), (name, line)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    made = []

    def query(spark, sf):
        made.append(entry.queries()[name](spark, sf))
        return made[-1]

    r = compare(spark, con, name, query, ORACLES[name], SF)
    assert r["ok"], r
    check_plan(name, made[0]._jdf.queryExecution().executedPlan().toString())


def test_every_query_registered_and_runs_schema(spark):
    qs = entry.queries()
    assert set(ORACLES) <= set(qs)
    df = entry.entry(spark)
    assert "segment" in df.columns and df.count() > 0


ROWS_ONLY = sorted(set(entry.queries()) - set(ORACLES))


@pytest.fixture(scope="module")
def few_rounds():
    """The plans that share the boosted model run here with 10 rounds of it; tests/test_models.py tests the fit."""
    whole = learning.fit_gbt
    learning.fit_gbt = partial(whole, rounds=10)
    yield
    learning.fit_gbt = whole


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_query_runs(spark, few_rounds, name):
    df = entry.queries()[name](spark, SF)
    assert df.count() > 0 and len(df.columns) > 0
