"""Whole runs: increments against a full build, reruns, checks, streams."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators.latest import EXTRACTED_AT
from silverlode.operators.merge import read_table
from silverlode.operators.storage import write_and_read
from silverlode.plans.models import FACTS, MARTS, Warehouse
from silverlode.plans.refresh import SNAPSHOT, check, fact_table, load_changes, load_fact, refresh
from silverlode.sources import derived
from silverlode.sources.raw import COLUMNS, ORDER_TABLES, raw_tables, read_raw
from silverlode.streaming.facts import stream_fact
from tests.compare import sorted_rows
from tests.conftest import AS_OF

SF = "/root/testdata/sf0.001"
FIRST_UNTIL = dt.datetime(2024, 1, 30)


@pytest.fixture(scope="module")
def stored_raw(spark, tmp_path_factory):
    """Raw tables on disk, each in a first and a second delivery."""
    root = str(tmp_path_factory.mktemp("raw"))
    for source in COLUMNS:
        df = derived.derive(spark, source, SF).coalesce(1)
        early = F.col(EXTRACTED_AT) <= FIRST_UNTIL
        df.filter(early).write.parquet(f"{root}/{source}/load=1")
        df.filter(~early).write.parquet(f"{root}/{source}/load=2")
    for name in ORDER_TABLES:
        derived.base_table(spark, SF, name).coalesce(1).write.parquet(f"{root}/{name}")
    return root


def raw_until(spark, root, load):
    def raw(source):
        if source in ORDER_TABLES:
            return read_raw(spark, source, root)
        return read_raw(spark, source, root).filter(F.col(EXTRACTED_AT) <= FIRST_UNTIL if load == 1 else F.lit(True))

    return raw


def same(a, b):
    columns = sorted(set(a.columns) - {"dw_loaded_at", "dbt_loaded_at", "load"})
    assert columns == sorted(set(b.columns) - {"dw_loaded_at", "dbt_loaded_at", "load"})
    return sorted_rows(a.select(*columns).collect()) == sorted_rows(b.select(*columns).collect())


def test_all_raw_tables_can_be_read(spark, stored_raw):
    tables = raw_tables(spark, stored_raw)
    assert set(tables) == {*COLUMNS, *ORDER_TABLES}
    assert all(not df.isEmpty() for df in tables.values())


def test_increments_equal_a_full_build_and_reruns_change_nothing(spark, stored_raw, tmp_path):
    root = str(tmp_path / "gold")
    refresh(spark, raw_until(spark, stored_raw, 1), root, AS_OF)
    usage_after_first = read_table(spark, fact_table(root, "fact_usage_snapshot")).count()
    tables = refresh(spark, raw_until(spark, stored_raw, 2), root, AS_OF, with_orders=True)
    whole = Warehouse(spark, raw_until(spark, stored_raw, 2), AS_OF)
    assert tables["fact_usage_snapshot"].count() >= usage_after_first
    # The billing and subscription facts joined tables of the first load; none of their rows is left over here.
    for name in FACTS:
        assert same(tables[name], whole[name]), name
    for name in MARTS:
        assert same(tables[name], whole[name]), name
        assert "dbt_loaded_at" in tables[name].columns
    assert same(tables["order_item"], whole["order_item"])

    failures = {(r.model, r.column_name, r.check_name): r.failures for r in check(tables, with_orders=True).collect()}
    assert len(failures) == 84
    failing = {k for k, n in failures.items() if n}
    # The stand-in tables hold contracts and churn of customers that were filtered out, and payments without a date.
    assert failing == {
        ("int_subscription_clean", "customer_id", "relationships"),
        ("int_churn_clean", "customer_id", "relationships"),
        ("int_r5_ml_features", "observation_date", "not_null"),
    }

    before = {n: sorted_rows(tables[n].drop("dw_loaded_at").collect()) for n in ("fact_billing", SNAPSHOT)}
    again = refresh(spark, raw_until(spark, stored_raw, 2), root, AS_OF)
    assert {n: sorted_rows(again[n].drop("dw_loaded_at").collect()) for n in before} == before


@pytest.mark.parametrize("name", ["fact_billing", "fact_usage_snapshot"])
def test_loading_changes_equals_slicing_silver(spark, stored_raw, tmp_path, name):
    by_changes, by_slices = (fact_table(str(tmp_path / kind), name) for kind in ("changes", "slices"))
    for load in (1, 2):
        raw = raw_until(spark, stored_raw, load)
        load_changes(spark, name, by_changes, raw, AS_OF)
        load_fact(spark, by_slices, Warehouse(spark, raw, AS_OF)[name])
    assert same(read_table(spark, by_changes), read_table(spark, by_slices))


def test_models_are_views(spark, stored_raw):
    Warehouse(spark, raw_until(spark, stored_raw, 2), AS_OF).create_views()
    found = spark.sql(
        "SELECT count(*) FROM int_xref_customer_clean x LEFT ANTI JOIN stg_crm_customers c ON x.customer_id = trim(c.customer_id)"
    ).first()[0]
    assert found == 0


def test_stored_silver_is_read_by_column(spark, tmp_path):
    """A fact takes two columns of the customers, whatever else they have."""
    silver = Warehouse(spark, lambda s: derived.derive(spark, s, SF), AS_OF)
    stored = {
        name: write_and_read(silver[name], str(tmp_path / name)) for name in ("int_network_clean", "int_customer_clean")
    }
    fact = Warehouse(spark, silver.__getitem__, AS_OF, stored)["fact_network_event"]
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<customer_id:string,region:string>" in plan


def test_late_rows_are_passed_over_unless_looked_back_for(spark, tmp_path):
    table = fact_table(str(tmp_path), "fact_macro_monthly")
    columns = "macro_month_key string, month_date_key int, v int, source_extracted_at timestamp"

    def rows(*values):
        return spark.createDataFrame(list(values), columns)

    load_fact(spark, table, rows(("a", 20240101, 1, dt.datetime(2024, 1, 10))))
    late = rows(("b", 20240101, 1, dt.datetime(2024, 1, 9)), ("a", 20240101, 2, dt.datetime(2024, 1, 10)))
    load_fact(spark, table, late)
    assert [r.v for r in read_table(spark, table).collect()] == [1]
    load_fact(spark, table, late, lookback=dt.timedelta(days=2))
    assert {r.macro_month_key: r.v for r in read_table(spark, table).collect()} == {"a": 2, "b": 1}


def test_streamed_files_equal_one_batch(spark, stored_raw, tmp_path):
    landing = tmp_path / "landing"
    table = fact_table(str(tmp_path), "fact_usage_snapshot")
    everything = read_raw(spark, "service_usage", stored_raw).drop("load")

    def arrive(day):
        moment = F.lit(day).cast("timestamp")
        everything.filter(F.col(EXTRACTED_AT) == moment).coalesce(1).write.mode("append").parquet(str(landing))
        stream_fact(
            spark, "fact_usage_snapshot", str(landing), table, str(tmp_path / "progress"), as_of=AS_OF
        ).awaitTermination()

    days = [r[0] for r in everything.select(F.date_format(EXTRACTED_AT, "yyyy-MM-dd")).distinct().orderBy(1).collect()]
    for day in days[-3:]:
        arrive(day)
    recent = everything.filter(F.col(EXTRACTED_AT) >= F.lit(days[-3]).cast("timestamp"))
    want = Warehouse(spark, lambda _: recent, AS_OF)["fact_usage_snapshot"]
    assert same(read_table(spark, table), want)


@pytest.mark.parametrize("files", [1, 4, 50])
def test_a_backlog_of_any_number_of_files_is_one_run(spark, stored_raw, tmp_path, files):
    """Equal timestamps (payments) and mixed ones, dealt over files in any order."""
    rows = read_raw(spark, "payments", stored_raw).drop("load")
    shuffled = F.timestamp_seconds(F.lit(1_706_000_000) + F.abs(F.xxhash64("payment_id")) % 1000)
    rows = rows.withColumn(EXTRACTED_AT, F.when(F.col("amount_due") > 100, F.col(EXTRACTED_AT)).otherwise(shuffled))
    rows.repartition(files, "payment_id").write.parquet(str(tmp_path / "landing"))
    table = fact_table(str(tmp_path), "fact_payment")
    stream_fact(spark, "fact_payment", str(tmp_path / "landing"), table, str(tmp_path / "progress"), as_of=AS_OF).awaitTermination()
    landed = spark.read.parquet(str(tmp_path / "landing"))
    assert same(read_table(spark, table), Warehouse(spark, lambda _: landed, AS_OF)["fact_payment"])


def test_stream_with_joined_tables(spark, stored_raw, tmp_path):
    table = fact_table(str(tmp_path), "fact_network_event")
    whole = Warehouse(spark, raw_until(spark, stored_raw, 2), AS_OF)
    query = stream_fact(
        spark,
        "fact_network_event",
        f"{stored_raw}/network_quality/load=2",
        table,
        str(tmp_path / "progress"),
        stored=lambda: {"int_customer_clean": whole["int_customer_clean"]},
        as_of=AS_OF,
    )
    query.awaitTermination()
    assert same(read_table(spark, table), whole["fact_network_event"])
