"""Upkeep by changes against full builds, under shuffled deliveries, a moving clock, deletions and crashes."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from silverlode.operators import merge
from silverlode.operators.latest import EXTRACTED_AT, GENERATION
from silverlode.plans import upkeep as u
from silverlode.plans.models import Warehouse
from silverlode.plans.refresh import FRICTION, SNAPSHOT
from silverlode.sources import derived
from silverlode.sources.raw import raw_schema, read_raw
from tests.compare import sorted_rows

SF = "/root/testdata/sf0.001"
DAYS = [dt.date(2023, 3, 31), dt.date(2023, 7, 1), dt.date(2024, 2, 1)]
# All sources of the friction and of the snapshot, and the one whose records have two ids.
SOURCES = [*u.DOMAINS.values(), u.CONTRACTS, "crm_customers", "xref_customer_id"]
DELETABLE = ("network_quality", "support_tickets")


@pytest.fixture(scope="module")
def deliveries(spark, tmp_path_factory):
    """Raw rows with further versions (other values, days, customers and invoices, deletions), dealt to three loads at random."""
    root = str(tmp_path_factory.mktemp("raw"))
    days = {"issue_date", "usage_date", "contract_start_date", "contract_end_date", "payment_date"}
    for source in SOURCES:
        df = derived.derive(spark, source, SF)
        kinds = dict(df.dtypes)
        pick = F.abs(F.xxhash64(*df.columns, F.lit(source)))
        again = df.filter(pick % 7 == 0).withColumn(EXTRACTED_AT, F.col(EXTRACTED_AT) + F.expr("interval 3 day"))
        changes = {GENERATION: F.col(GENERATION) + 1}
        for name in days & set(kinds):
            changes[name] = F.when(pick % 3 == 0, F.date_add(name, 45)).otherwise(F.col(name))
        if source in ("billing_invoices", "support_tickets", "subscriptions_contracts"):
            other = F.concat(F.lit("C"), (pick % 150).cast("string"))
            changes["customer_id"] = F.when(pick % 2 == 0, F.coalesce(F.lag("customer_id").over(u_window()), other)).otherwise(F.col("customer_id"))
        if source == "payments":
            changes["invoice_id"] = F.when(pick % 2 == 0, F.lag("invoice_id").over(u_window())).otherwise(F.col("invoice_id"))
            changes["failed_attempts"] = F.col("failed_attempts") + 1
        if "_ab_cdc_deleted_at" in kinds:
            changes["_ab_cdc_deleted_at"] = F.when(pick % 4 == 0, "2024-01-01").otherwise(F.col("_ab_cdc_deleted_at"))
        everything = df.unionByName(again.withColumns(changes).select(*df.columns))
        everything.withColumn("load", (F.abs(F.xxhash64(*df.columns)) % 3).cast("int")).coalesce(1).write.partitionBy("load").parquet(f"{root}/{source}")
    return root


def u_window():
    from pyspark.sql import Window

    return Window.orderBy(EXTRACTED_AT, "customer_id")


def arrived(spark, root, *loads):
    return {s: read_raw(spark, s, root).filter(F.col("load").isin(*loads)).drop("load") for s in SOURCES}


def full(spark, rows, as_of, deletes="restore"):
    """All models over raw rows; sources that are not given are empty."""
    return Warehouse(spark, lambda s: rows[s] if s in rows else spark.createDataFrame([], raw_schema(s)), as_of, deletes=deletes)


def same(a, b):
    columns = sorted(set(a.columns) - {"dw_loaded_at"})
    assert columns == sorted(set(b.columns) - {"dw_loaded_at"})
    assert dict(a.drop("dw_loaded_at").dtypes) == dict(b.drop("dw_loaded_at").dtypes)
    left, right = (sorted_rows(df.select(*columns).collect()) for df in (a, b))
    assert len(left) == len(right)
    assert left == right, [p for p in zip(left, right) if p[0] != p[1]][:2]


@pytest.mark.parametrize("deletes", ["restore", "tombstone"])
def test_loads_in_any_order_equal_a_full_build(spark, deliveries, tmp_path, deletes):
    keeper = u.Upkeep(spark, str(tmp_path), deletes)
    order = [1, 0, 2] if deletes == "restore" else [2, 1]
    # With deletions as tombstones only the sources that know deletions differ.
    sources = [s for s in SOURCES if deletes == "restore" and s != "network_quality" or s in DELETABLE]
    snapshot = {}
    for number, as_of in enumerate(DAYS[: len(order)]):
        rows = arrived(spark, deliveries, order[number])
        keeper.load({s: rows[s] for s in sources}, as_of)
        rows = arrived(spark, deliveries, *order[: number + 1])
        whole = full(spark, {s: rows[s] for s in sources}, as_of, deletes)
        mine = keeper.silver(as_of)
        snapshot |= {r["customer_month_key"]: r for r in whole[SNAPSHOT].collect()}
        same(mine[FRICTION], whole[FRICTION])
        if not snapshot:
            continue
        # Rows that a full run no longer makes stay, as merging by key never deletes.
        stored = mine[SNAPSHOT].drop("dw_loaded_at")
        names = sorted(stored.columns)
        assert sorted_rows(stored.select(*names).collect()) == sorted_rows(tuple(r[c] for c in names) for r in snapshot.values())
    for name in ("int_customer_clean", "int_payment_clean", "int_support_clean", "int_xref_customer_clean"):
        same(mine[name], whole[name])


def files(path):
    return {p for p in path.rglob("*.parquet") if ".state" not in str(p) and "/load/" not in str(p)}


def test_nothing_new_rewrites_no_file_and_a_delivery_again_neither(spark, deliveries, tmp_path):
    keeper = u.Upkeep(spark, str(tmp_path))
    sources = ("billing_invoices", "subscriptions_contracts")
    rows = {s: arrived(spark, deliveries, 1)[s] for s in sources}
    keeper.load(rows, DAYS[-1])
    before = files(tmp_path)
    keeper.load({}, DAYS[-1])
    assert files(tmp_path) == before
    keeper.load(rows, DAYS[-1])
    assert files(tmp_path) == before
    with pytest.raises(ValueError):
        keeper.load({}, DAYS[0])


def test_a_load_rewrites_only_the_months_it_touches(spark, deliveries, tmp_path):
    keeper = u.Upkeep(spark, str(tmp_path))
    usage = derived.derive(spark, "service_usage", SF)
    keeper.load({"service_usage": usage}, DAYS[-1])
    before = files(tmp_path)
    stored = keeper.silver(DAYS[-1])["int_usage_clean"]
    in_may = usage.filter("usage_date >= '2022-05-01' AND usage_date < '2022-06-01'")
    later = in_may.withColumns({EXTRACTED_AT: F.col(EXTRACTED_AT) + F.expr("interval 90 day"), "sms_count": F.col("sms_count") + 1})
    # The months where the records lie so far, and the one they are moved to.
    months = stored.join(in_may.select("usage_id"), "usage_id", "left_semi").select(F.date_format("usage_date", "yyyyMM")).distinct()
    months = {r[0] for r in months.collect()} | {"202205"}
    keeper.load({"service_usage": later}, DAYS[-1])
    rewritten = {p.parent.name for p in before - files(tmp_path)}
    assert rewritten == {f"{merge.MONTH}={m}" for m in months} and len(months) < 20


def test_loads_that_died_are_taken_up_again(spark, deliveries, tmp_path, monkeypatch):
    sources = ("billing_invoices", "payments")

    def die(*_, **__):
        raise RuntimeError("driver lost")

    settle, write, say = u.settle, u.upsert, u.Upkeep._say
    settled = []

    def settle_one(*rest):
        settle(*rest)
        settled.append(rest)
        if len(settled) == 1:
            die()

    def write_one(*rest, **kw):
        write(*rest, **kw)
        die()

    deaths = [
        (u, "settle", settle_one),
        (u, "upsert", write_one),
        (u.Upkeep, "_say", lambda self, stage, *rest: die() if stage == u._DONE else say(self, stage, *rest)),
    ]
    for number, death in enumerate(deaths):
        with monkeypatch.context() as patch:
            patch.setattr(*death)
            with pytest.raises(RuntimeError):
                u.Upkeep(spark, str(tmp_path)).load({s: arrived(spark, deliveries, number)[s] for s in sources}, DAYS[number])
        # What had arrived is on disk.
        keeper = u.Upkeep(spark, str(tmp_path))
        keeper.load({}, DAYS[number])
    rows = {s: arrived(spark, deliveries, 0, 1, 2)[s] for s in sources}
    same(keeper.silver(DAYS[2])[FRICTION], full(spark, rows, DAYS[2])[FRICTION])


def test_no_tables_yet(spark, tmp_path):
    keeper = u.Upkeep(spark, str(tmp_path))
    keeper.load({}, DAYS[0])
    tables = keeper.silver(DAYS[0])
    assert tables[FRICTION].count() == 0 and tables["int_billing_clean"].count() == 0


def test_a_first_load_looks_for_no_further_invoices_and_payments(spark, deliveries, tmp_path, monkeypatch):
    searched = []

    def counted(spark, table, *args, **options):
        searched.append(table.path)
        return merge.rows_of_keys(spark, table, *args, **options)

    monkeypatch.setattr(u, "rows_of_keys", counted)
    keeper = u.Upkeep(spark, str(tmp_path))
    keeper.load({s: df for s, df in arrived(spark, deliveries, 0).items() if s != "payments"}, DAYS[0])
    assert not [p for p in searched if "/versions/" in p]
    # Payments are new now, invoices are not.
    keeper.load({"payments": arrived(spark, deliveries, 0)["payments"]}, DAYS[0])
    assert [p.rsplit("/", 1)[1] for p in searched if "/versions/" in p] == ["billing_invoices"]
    same(keeper.silver(DAYS[0])[FRICTION], full(spark, arrived(spark, deliveries, 0), DAYS[0])[FRICTION])
