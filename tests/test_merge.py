"""Merging by key, watermarks, and recovery."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.functions.keys import packed_digest, surrogate_key, unpacked_digest
from silverlode.operators import merge as m
from silverlode.operators.incremental import changed_versions, high_water_mark, incremental_slice
from silverlode.operators.latest import EXTRACTED_AT, latest_version
from silverlode.operators.storage import CHECKPOINT_DIR, scratch_path

SCHEMA = "k string, day date, v int, source_extracted_at timestamp"
T1, T2, T3 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
JAN, FEB, MAR = (dt.date(2024, i, 15) for i in (1, 2, 3))


def batch(spark, *rows, schema=SCHEMA):
    return spark.createDataFrame(list(rows), schema)


def content(spark, table):
    return sorted((r.k, r.day, r.v) for r in m.read_table(spark, table).collect())


@pytest.fixture
def table(tmp_path):
    return m.MergeTable(str(tmp_path / "fact"), "k", "day")


def months_of(tmp_path):
    """Folders of the table, by month."""
    return {p.name.removeprefix(f"{m.MONTH}=") for p in (tmp_path / "fact").glob(f"{m.BUCKET}=*/{m.MONTH}=*")}


def test_upsert_updates_adds_and_keeps(spark, table):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1), ("b", FEB, 1, T1), ("c", None, 1, T1)))
    second = batch(spark, ("a", JAN, 2, T2), ("d", MAR, 2, T2))
    m.upsert(spark, table, second)
    want = [("a", JAN, 2), ("b", FEB, 1), ("c", None, 1), ("d", MAR, 2)]
    assert sorted(content(spark, table), key=str) == sorted(want, key=str)
    m.upsert(spark, table, second)
    assert sorted(content(spark, table), key=str) == sorted(want, key=str)


def test_row_moves_to_another_month_and_empties_its_old_one(spark, table, tmp_path):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1), ("b", FEB, 1, T1)))
    m.upsert(spark, table, batch(spark, ("a", MAR, 2, T2)))
    assert content(spark, table) == [("a", MAR, 2), ("b", FEB, 1)]
    assert "202401" not in months_of(tmp_path)


def test_only_the_buckets_and_months_of_the_batch_are_rewritten(spark, tmp_path):
    table = m.MergeTable(str(tmp_path / "fact"), "k", "day", buckets=64)
    m.upsert(spark, table, batch(spark, *[(f"k{i}", JAN if i % 2 else FEB, 1, T1) for i in range(400)]))

    def files():
        return {p.relative_to(tmp_path) for p in (tmp_path / "fact").rglob("*.parquet")}

    before = files()
    changed = [f"k{i}" for i in range(10)]
    m.upsert(spark, table, batch(spark, *[(k, MAR, 2, T2) for k in changed]))
    kept = {p.parent for p in before & files()}
    rewritten = {p.parent for p in before} - kept
    buckets = {r[0] for r in batch(spark, *[(k, MAR, 2, T2) for k in changed]).select(m.bucket_of(table)).collect()}
    assert {p.parts[1] for p in rewritten} <= {f"{m.BUCKET}={b}" for b in buckets}
    assert len(rewritten) <= 10
    assert m.read_table(spark, table).count() == 400
    assert m.read_table(spark, table).filter(F.col("v") == 2).count() == 10


def test_a_missing_success_marker_does_not_turn_a_merge_into_an_overwrite(spark, table):
    hadoop = spark._jsc.hadoopConfiguration()
    hadoop.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    try:
        m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1)))
        m.upsert(spark, table, batch(spark, ("b", JAN, 1, T2)))
        assert content(spark, table) == [("a", JAN, 1), ("b", JAN, 1)]
        assert m.table_mark(spark, table) is not None
    finally:
        hadoop.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")


def test_repeated_keys_in_a_batch_are_refused(spark, table):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1)))
    with pytest.raises(m.DuplicateKeys):
        m.upsert(spark, table, batch(spark, ("b", JAN, 1, T2), ("b", FEB, 2, T2)))
    assert content(spark, table) == [("a", JAN, 1)]


def test_empty_batch_changes_nothing(spark, table):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1)))
    m.upsert(spark, table, batch(spark))
    assert content(spark, table) == [("a", JAN, 1)]


@pytest.mark.parametrize("at", ["before", "within", "emptying", "after"])
def test_load_that_died_is_mended_by_running_it_again(spark, table, tmp_path, monkeypatch, at):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1), ("b", FEB, 1, T1), ("c", MAR, 1, T1)))
    mark = m.table_mark(spark, table)
    second = batch(spark, ("a", MAR, 2, T2), ("b", MAR, 2, T2), ("d", JAN, 2, T2))

    def die(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        write, delete = m._write_parts, m.delete_path
        if at == "before":
            patch.setattr(m, "_write_parts", die)
        elif at == "within":

            def half(rows, path):
                write(rows.filter("k <> 'b'"), path)
                die()

            patch.setattr(m, "_write_parts", half)
        elif at == "emptying":
            patch.setattr(m, "delete_path", lambda s, p: die() if m.MONTH in p else delete(s, p))
        else:
            patch.setattr(m, "_note_state", die)
        with pytest.raises(RuntimeError):
            m.upsert(spark, table, second)
    assert m.table_mark(spark, table) == mark
    m.upsert(spark, table, second)
    assert content(spark, table) == [("a", MAR, 2), ("b", MAR, 2), ("c", MAR, 1), ("d", JAN, 2)]
    assert m.table_mark(spark, table) > mark
    assert "202402" not in months_of(tmp_path)


def test_reading_changes_nothing_and_opens_no_foreign_month(spark, table, tmp_path):
    m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1), ("b", FEB, 1, T1)))
    before = sorted(str(p) for p in tmp_path.rglob("*"))
    assert len(content(spark, table)) == 2
    assert m.table_mark(spark, table) == high_water_mark(m.read_table(spark, table))
    assert sorted(str(p) for p in tmp_path.rglob("*")) == before


def test_dropped_column_is_gone_in_untouched_months_too(spark, tmp_path):
    wide = "k string, day date, extra string, source_extracted_at timestamp"
    narrow = "k string, day date, source_extracted_at timestamp"
    table = m.MergeTable(str(tmp_path / "fact"), "k", "day", sync_columns=True)
    m.upsert(spark, table, batch(spark, ("a", JAN, "x", T1), ("b", FEB, "y", T1), schema=wide))
    m.upsert(spark, table, batch(spark, ("a", JAN, T2), schema=narrow))
    assert m.read_table(spark, table).columns == ["k", "day", "source_extracted_at"]
    assert m.read_table(spark, table).count() == 2


def test_key_that_fixes_the_month_keeps_stale_rows(spark, tmp_path):
    """The key holds the date, so a corrected date is another row."""
    table = m.MergeTable(str(tmp_path / "events"), "k", "day", key_fixes_month=True)
    m.upsert(spark, table, batch(spark, ("c1|2024-01-15", JAN, 1, T1)))
    m.upsert(spark, table, batch(spark, ("c1|2024-02-15", FEB, 2, T2)))
    assert len(content(spark, table)) == 2


def test_columns_follow_the_batch_or_stay(spark, tmp_path):
    wide = "k string, day date, extra string, source_extracted_at timestamp"
    for sync in (True, False):
        table = m.MergeTable(str(tmp_path / f"sync{sync}"), "k", "day", sync_columns=sync)
        m.upsert(spark, table, batch(spark, ("a", JAN, 1, T1), ("b", JAN, 1, T1)))
        if sync:
            m.upsert(spark, table, batch(spark, ("a", JAN, "new", T2), schema=wide))
            got = {r.k: r.extra for r in m.read_table(spark, table).collect()}
            assert got == {"a": "new", "b": None}
        else:
            more = batch(spark, ("a", JAN, 5, T2)).withColumn("extra", F.lit("ignored"))
            m.upsert(spark, table, more)
            assert m.read_table(spark, table).columns == ["k", "day", "v", "source_extracted_at"]
            assert content(spark, table) == [("a", JAN, 5), ("b", JAN, 1)]


def test_slice_is_strict_and_lookback_reads_again(spark):
    rows = batch(spark, ("a", JAN, 1, T1), ("b", JAN, 1, T2), ("c", JAN, 1, T3), ("d", JAN, 1, None))
    mark = high_water_mark(rows.filter("k in ('a', 'b')"))
    assert [r.k for r in incremental_slice(rows, mark).collect()] == ["c"]
    again = incremental_slice(rows, mark, lookback=dt.timedelta(days=1))
    assert sorted(r.k for r in again.collect()) == ["b", "c"]
    assert high_water_mark(rows.filter("false")) is None
    assert sorted(r.k for r in incremental_slice(rows, None).collect()) == ["a", "b", "c"]


def test_slice_reaches_the_scan(spark, tmp_path):
    batch(spark, ("a", JAN, 1, T1)).write.parquet(str(tmp_path / "t"))
    df = incremental_slice(spark.read.parquet(str(tmp_path / "t")), 1_704_067_200_000_000)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(source_extracted_at" in plan


def test_reading_only_changed_versions_is_exact(spark):
    schema = f"id string, {EXTRACTED_AT} timestamp, _airbyte_generation_id bigint"
    raw = batch(
        spark,
        ("old", T1, 1),
        ("both", T1, 1),
        ("both", T3, 1),
        ("hidden", None, 1),
        ("hidden", T3, 1),
        ("new", T3, 2),
        schema=schema,
    )
    mark = high_water_mark(raw.filter(F.col(EXTRACTED_AT) == T2), EXTRACTED_AT) or 1_704_153_600_000_000

    def newer(df):
        return sorted(map(tuple, incremental_slice(latest_version(df, "id"), mark, EXTRACTED_AT).collect()))

    assert newer(changed_versions(raw, mark)) == newer(raw) == [("both", T3, 1), ("new", T3, 2)]


def test_scratch_lies_in_the_folder_the_cluster_names(spark):
    assert scratch_path(spark, "/data/fact").startswith(spark.conf.get(CHECKPOINT_DIR))


def _exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    return plan.count("Exchange ")


def test_stored_and_new_rows_meet_and_are_written_in_one_exchange(spark, table):
    m.upsert(spark, table, batch(spark, *[(f"k{i}", JAN if i % 2 else FEB, 1, T1) for i in range(100)], (None, JAN, 1, T1)))
    rows = batch(spark, *[(f"k{i}", FEB, 2, T2) for i in range(0, 100, 5)], (None, JAN, 2, T2))
    split = rows.withColumn(m.BUCKET, m.bucket_of(table, 1)).withColumn(m.MONTH, m.month_of(rows, "day"))
    out = m.rows_of_keys(spark, table, split, []).select("k", m.BUCKET, m.MONTH)
    merged = m._merge_parts(m._stored_rows(spark, table), split, out, table, 3)
    assert _exchanges(merged) == 1
    got = sorted(map(str, merged.select("k", "day", "v").collect()))
    m.upsert(spark, table, rows)
    assert got == sorted(map(str, m.read_table(spark, table).select("k", "day", "v").collect()))
    # Twenty of a hundred keys were replaced; the null key replaces nothing.
    assert len(got) == 102 and sum("v=2" in g for g in got) == 21


def test_no_part_of_a_batch_whose_keys_are_unique_is_shuffled_but_hashes(spark, monkeypatch):
    seen = []
    plain = m.duplicate_keys
    monkeypatch.setattr(m, "duplicate_keys", lambda df, key: seen.append(df.columns) or plain(df, key))
    assert not m._repeats_keys(batch(spark, ("a", JAN, 1, T1), ("b", JAN, 1, T1), (None, JAN, 1, T1)), "k")
    assert seen == [["h"]]
    assert m._repeats_keys(batch(spark, ("a", JAN, 1, T1), ("a", FEB, 1, T1)), "k")


def test_digests_and_any_other_text_come_back_from_their_packed_form(spark):
    texts = ["d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "", "a", "é" * 8, "x" * 16, "x" * 32, "0" * 32, None]
    rows = spark.createDataFrame([(t,) for t in texts], "k string").select("k", packed_digest("k").alias("p"))
    back = rows.select("k", F.col("p").alias("q")).select("k", unpacked_digest("q").alias("b"))
    assert all(r.k == r.b for r in back.collect())
    assert rows.filter("k = '0' or length(p) = 16").count() == 2


def test_key_that_another_column_makes_stays_behind_when_rows_move(spark, tmp_path):
    table = m.MergeTable(str(tmp_path / "fact"), "k", "day", digests=("k",), made_of="i")
    schema = "k string, i string, day date, v int, source_extracted_at timestamp"
    of = {i: surrogate_key_of(spark, i) for i in ("a", "b", "c", None)}
    first = [(of["a"], "a", JAN, 1, T1), (of["b"], "b", JAN, 1, T1), ("x", "c", JAN, 1, T1), (of[None], None, FEB, 1, T1), (None, "d", FEB, 1, T1), ("", "e", FEB, 1, T1)]
    rows = batch(spark, *first, schema=schema)
    moved = m._without_key(rows, table)
    assert [r.k and len(r.k) for r in moved.collect()] == [b"", b"", 18, b"", None, 17]
    assert m._with_key(moved, table).collect() == rows.collect()
    m.upsert(spark, table, rows)
    # A key moves to another month, and one key comes with another id.
    m.upsert(spark, table, batch(spark, (of["a"], "a", MAR, 2, T2), (of["b"], "z", JAN, 2, T2), schema=schema))
    want = {(of["a"], MAR, 2), (of["b"], JAN, 2), ("x", JAN, 1), (of[None], FEB, 1), (None, FEB, 1), ("", FEB, 1)}
    got = [(r.k, r.day, r.v) for r in m.read_table(spark, table).collect()]
    assert len(got) == 6 and set(got) == want


def surrogate_key_of(spark, value):
    return spark.createDataFrame([(value,)], "i string").select(surrogate_key("i")).first()[0]
