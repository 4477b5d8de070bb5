"""Tables replaced as a whole, checks counted while writing, and searches that open few row groups."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import checks, merge, versioned


def test_a_reader_keeps_the_version_it_began_with(spark, tmp_path):
    path = str(tmp_path / "t")
    first = versioned.replace_table(spark.range(10), path)
    second = versioned.replace_table(spark.range(20), path)
    assert (first.count(), second.count(), versioned.read_current(spark, path).count()) == (10, 20, 20)
    versioned.replace_table(spark.range(30), path)
    assert second.count() == 20
    assert len(list((tmp_path / "t").glob("version-*"))) == versioned.KEPT


def test_a_writer_that_dies_changes_nothing_visible(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versioned.replace_table(spark.range(10), path)
    broken = spark.range(5).select(F.when(F.col("id") > 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("id").cast("string")).alias("id"))
    with pytest.raises(Exception, match="bad row"):
        versioned.replace_table(broken, path)
    assert versioned.read_current(spark, path).count() == 10
    with monkeypatch.context() as patch:
        patch.setattr(versioned, "write_note", lambda *_: (_ for _ in ()).throw(RuntimeError("driver lost")))
        with pytest.raises(RuntimeError):
            versioned.replace_table(spark.range(7), path)
    assert versioned.read_current(spark, path).count() == 10
    # What they left is cleared by the next writer.
    versioned.replace_table(spark.range(8), path)
    assert len(list((tmp_path / "t").glob("version-*"))) == versioned.KEPT


def test_empty_table_and_unknown_table(spark, tmp_path):
    assert versioned.replace_table(spark.range(0), str(tmp_path / "t")).count() == 0
    with pytest.raises(FileNotFoundError):
        versioned.read_current(spark, str(tmp_path / "none"))


def test_checks_counted_while_writing_equal_the_suite(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (1, None), (2, 900), (None, -1)], "k int, v int")
    wanted = [
        checks.Check("t", "k", "not_null"),
        checks.Check("t", "k", "unique"),
        checks.Check("t", "v", "between", (0, 100)),
        checks.Check("t", "v", "accepted_values", (5, -1)),
    ]
    watched, counts = checks.observed(rows, wanted)
    stored = versioned.replace_table(watched, str(tmp_path / "t"))
    counted = counts()
    assert set(counted) == {wanted[0], wanted[2], wanted[3]}
    plain = checks.run_suite({"t": stored}, wanted)
    spared = checks.run_suite({"t": stored}, wanted, counted)
    assert sorted(plain.collect()) == sorted(spared.collect())
    assert plain.filter("failures > 0").count() == 4
    # One scan is left, for the repeated values.
    assert spared._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].count("FileScan") == 1


def _rows_read(df):
    """Rows that come out of the scans of a finished query."""
    total = 0

    def walk(plan):
        nonlocal total
        if "Scan parquet" in plan.nodeName():
            total += plan.metrics().apply("numOutputRows").value()
        if plan.nodeName().startswith("AdaptiveSparkPlan"):
            walk(plan.executedPlan())
        elif plan.nodeName().endswith("QueryStage"):
            walk(plan.plan())
        for i in range(plan.children().size()):
            walk(plan.children().apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return total


def test_a_search_for_one_hundredth_of_the_keys_leaves_most_of_the_key_column_unread(spark, tmp_path, monkeypatch):
    table = merge.MergeTable(str(tmp_path / "fact"), "k", "day", buckets=1)
    day = F.date_add(F.lit(dt.date(2023, 1, 1)), (F.col("id") / 1000).cast("int") * 31)
    rows = spark.range(40_000).select(F.md5(F.col("id").cast("string")).alias("k"), day.alias("day"), F.col("id").alias("v"))
    merge.upsert(spark, table, rows)
    keys = rows.filter("v >= 7000 AND v < 7400").select("k")
    found = merge.rows_of_keys(spark, table, keys, [])
    assert len(found.collect()) == 400
    assert "PushedFilters: [In(k" in found._jdf.queryExecution().executedPlan().toString()
    # The keys lie in one month of forty.
    assert _rows_read(found) < 40_000 / 10
    unknown = spark.range(40_000, 40_400).select(F.md5(F.col("id").cast("string")).alias("k"))
    none = merge.rows_of_keys(spark, table, unknown, [])
    assert none.collect() == [] and _rows_read(none) < 40_000 / 10
    monkeypatch.setattr(merge, "PUSHED_KEYS", 10)
    assert sorted(merge.rows_of_keys(spark, table, keys, []).collect()) == sorted(found.collect())
