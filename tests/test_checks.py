"""Each check on a table that passes and on one that fails."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import checks
from silverlode.operators.checks import Check, run_suite
from silverlode.plans.suite import CHECKS


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(1, "a"), (1, "b"), (None, "c"), (None, "c"), (7, None)], "n int, s string")


def test_not_null(table):
    assert checks.not_null(table, "n").count() == 2
    assert checks.not_null(table.filter("n is not null"), "n").count() == 0


def test_unique(table):
    assert [tuple(r) for r in checks.unique(table, "n").collect()] == [(1, 2)]
    assert checks.unique(table.filter("s in ('a', 'c')"), "n").count() == 0


def test_accepted_values(table):
    assert [r.n for r in checks.accepted_values(table, "n", (1,)).collect()] == [7]
    assert checks.accepted_values(table, "n", (1, 7)).count() == 0


def test_between(table):
    assert [r.n for r in checks.between(table, "n", 1, 6).collect()] == [7]
    assert checks.between(table, "n", 1, 7).count() == 0


def test_relationships(table):
    parent = table.filter("s = 'a'")
    assert [r.n for r in checks.relationships(table, "n", parent, "n").collect()] == [7]
    assert checks.relationships(table, "n", table, "n").count() == 0


def test_discount(spark):
    rows = spark.createDataFrame([(1, 1, 10.0, -10.0), (1, 2, 10.0, -10.5)], "order_key int, line_number int, extended_price double, item_discount_amount double")
    assert [r.line_number for r in checks.discount_is_reasonable(rows).collect()] == [2]


def test_suite_counts_failures(spark, table):
    wanted = [
        Check("t", "n", "not_null"),
        Check("t", "n", "unique"),
        Check("t", "n", "accepted_values", (1,)),
        Check("t", "n", "between", (1, 6)),
        Check("t", "n", "relationships", ("n",), "p"),
        Check("p", "n", "not_null"),
    ]
    got = run_suite({"t": table, "p": table.filter("s = 'a'")}, wanted)
    assert {(r.model, r.check_name): r.failures for r in got.collect()} == {
        ("t", "not_null"): 2,
        ("t", "unique"): 1,
        ("t", "accepted_values"): 1,
        ("t", "between"): 1,
        ("t", "relationships"): 1,
        ("p", "not_null"): 0,
    }


def test_suite_of_the_models():
    kinds = [c.kind for c in CHECKS if c.model != "order_item"]
    assert {k: kinds.count(k) for k in set(kinds)} == {
        "not_null": 43,
        "unique": 32,
        "accepted_values": 2,
        "relationships": 2,
        "between": 2,
    }


def test_freshness(spark):
    loaded = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 31),)], "at timestamp")
    now = dt.datetime(2024, 2, 1)
    day = dt.timedelta(hours=24)
    ages = {"a": day, "b": day - dt.timedelta(seconds=1), "none": day}
    sources = {"a": loaded, "b": loaded, "none": loaded.filter("false")}
    got = {r.source_name: (r.age_seconds, r.status) for r in checks.freshness(sources, now, ages, "at").collect()}
    assert got == {"a": (86400, "pass"), "b": (86400, "warn"), "none": (None, "warn")}


def test_digests_are_counted_in_their_short_form(spark):
    digest = F.md5(F.col("id").cast("string"))
    # Twice a digest, once and twice other text, and two missing keys.
    keys = F.when(F.col("id") < 2, F.md5(F.lit("a"))).when(F.col("id") < 4, "text").when(F.col("id") < 6, F.lit(None)).otherwise(digest)
    rows = spark.range(10).select(keys.alias("some_key"))
    got = checks.run_suite({"t": rows}, [checks.Check("t", "some_key", "unique")])
    assert [r.failures for r in got.collect()] == [2] == [checks.unique(rows, "some_key").count()]
    assert "unhex" in got._jdf.queryExecution().optimizedPlan().toString()
