"""Every registered query against its expected result, on whole tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as entry
from oracle import catalog as expected_results
from silverlode import catalog
from tests.compare import DATA, actual, connect, expected

SF = os.environ.get("TEST_SF", "0.001")
# The medallion models and operators; the text operators have tests of their own.
QUERIES = catalog.queries()
ORACLE = expected_results.oracle_sql()
# Operators that try all pairs of rows, or leave the JVM.
PAIRWISE_OR_PYTHON = ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def db():
    return connect(f"{DATA}/sf{SF}")


def test_every_query_has_an_expected_result():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, f"{DATA}/sf{SF}")
    got_types, got = actual(df)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in PAIRWISE_OR_PYTHON if node in plan]
    want_types, want = expected(db, ORACLE[name])
    assert got_types == want_types
    assert len(got) == len(want)
    differing = [(g, w) for g, w in zip(got, want) if g != w]
    assert not differing, differing[:3]


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "label_churn_next_90d" in df.columns
