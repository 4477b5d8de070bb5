"""Plain forms of four operators against the forms the library uses.

Three of the pairs are checked for the same rows on both sides before timing; one
line per pair is printed. Run as ``python -m benchmarks.pairs``.
"""

from __future__ import annotations

import datetime as dt
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bench import RUNS, SF_DIR, prepare, session
from silverlode.catalog import stored_warehouse
from silverlode.functions import dates
from silverlode.operators.latest import EXTRACTED_AT, latest_per_key
from silverlode.operators.months import months_covered
from silverlode.operators.storage import write_and_read
from silverlode.plans.analytic import MEASURES, friction_measures
from silverlode.plans.models import CALENDAR, Warehouse
from silverlode.plans.refresh import fact_table, load_changes
from silverlode.plans.silver.usage import clean_usage
from silverlode.sources.calendar import FIRST_DAY, last_calendar_day

CONTRACT = ("customer_id", "subscription_id", "plan_name", "contract_start_date", "contract_end_date")
DOMAINS = ("int_billing_clean", "int_payment_clean", "int_usage_clean", "int_network_clean", "int_support_clean")


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object]) -> float:
    action()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 2)


def dedup_twice(raw: DataFrame, as_of: dt.date) -> DataFrame:
    """A second window over keys that are unique already."""
    return latest_per_key(clean_usage(raw, as_of), ["usage_id"], [F.col("source_extracted_at").desc()])


def newest_contract(spine: DataFrame) -> DataFrame:
    newest = [F.col("contract_start_date").desc(), F.col("subscription_id").desc()]
    return latest_per_key(spine.select(*CONTRACT, "month_start"), ["customer_id", "month_start"], newest, total=True)


def snapshot_by_range_join(subscription: DataFrame, calendar: DataFrame, as_of: dt.date) -> DataFrame:
    months = calendar.filter("day_of_month = 1").select("month_start")
    start = dates.month_start(F.col("contract_start_date"))
    end = dates.month_start(F.coalesce(F.col("contract_end_date"), F.lit(as_of)))
    return newest_contract(subscription.join(months, F.col("month_start").between(start, end)))


def snapshot_by_months(subscription: DataFrame, as_of: dt.date) -> DataFrame:
    end = F.coalesce(F.col("contract_end_date"), F.lit(as_of))
    bounds = F.lit(FIRST_DAY), last_calendar_day(as_of)
    return newest_contract(months_covered(subscription, F.col("contract_start_date"), end, *bounds))


def friction_by_joins(billing, payment, usage, network, support) -> DataFrame:
    """Each domain on its own, then a distinct spine and five joins."""
    key = ["customer_id", "month_start"]
    parts = []
    for i, domain in enumerate((billing, payment, usage, network, support)):
        only = [d if i == j else d.filter("false") for j, d in enumerate((billing, payment, usage, network, support))]
        if i == 1:
            only[0] = billing
        mine = friction_measures(*only)
        names = [
            ("billed_amount", "billing_amount_change"),
            ("failed_payment_attempts", "outstanding_balance", "total_days_late"),
            ("total_data_gb", "voice_minutes"),
            ("dropped_connections", "outage_seconds", "avg_latency_ms", "avg_packet_loss_pct"),
            ("ticket_count", "avg_resolution_minutes", "avg_satisfaction_score"),
        ][i]
        parts.append(mine.select(*key, *names))
    spine = parts[0].select(*key)
    for part in parts[1:]:
        spine = spine.union(part.select(*key))
    joined = spine.distinct()
    for part in parts:
        joined = joined.join(part, key, "left")
    return joined.select(*key, *[F.coalesce(n, F.lit(0)).alias(n) for n in MEASURES])


def assert_same(a: DataFrame, b: DataFrame) -> None:
    """The same rows as often on both sides, over the columns that both have."""
    names = [c for c in a.columns if c in b.columns]
    a, b = a.select(*names), b.select(*names)
    assert names and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def pairs(spark: SparkSession, root: str) -> list[tuple[str, Callable[[], object], Callable[[], object]]]:
    tables = stored_warehouse(spark, SF_DIR, root)
    silver = {n: write_and_read(tables[n], f"{root}/silver/{n}") for n in (*DOMAINS, "int_subscription_clean")}
    stored = Warehouse(spark, tables.__getitem__, tables.as_of, silver)
    as_of = tables.as_of
    usage = tables["stg_service_usage"]
    subscription, calendar = stored["int_subscription_clean"], stored[CALENDAR]
    domains = [stored[n] for n in DOMAINS]

    assert_same(dedup_twice(usage, as_of), clean_usage(usage, as_of))
    assert_same(snapshot_by_range_join(subscription, calendar, as_of), snapshot_by_months(subscription, as_of))
    assert_same(friction_by_joins(*domains), friction_measures(*domains))

    newest = F.lit("2024-01-31").cast("timestamp")
    table = fact_table(f"{root}/gold", "fact_usage_snapshot")
    older = usage.filter(F.col(EXTRACTED_AT) < newest)

    def full() -> None:
        rows = Warehouse(spark, lambda _: usage, as_of)["fact_usage_snapshot"]
        rows.write.mode("overwrite").parquet(f"{root}/gold/full")

    load_changes(spark, "fact_usage_snapshot", table, lambda _: older, as_of)

    def increment() -> None:
        load_changes(spark, "fact_usage_snapshot", table, lambda _: usage, as_of)

    full()
    start = time.perf_counter()
    increment()
    print(f"usage fact, merge of the newest day into all months: {time.perf_counter() - start:.2f} s")
    return [
        ("usage, two windows -> one", lambda: drain(dedup_twice(usage, as_of)), lambda: drain(clean_usage(usage, as_of))),
        (
            "monthly snapshot, range join -> months per row",
            lambda: drain(snapshot_by_range_join(subscription, calendar, as_of)),
            lambda: drain(snapshot_by_months(subscription, as_of)),
        ),
        (
            "monthly friction, spine and five joins -> one aggregation",
            lambda: drain(friction_by_joins(*domains)),
            lambda: drain(friction_measures(*domains)),
        ),
        ("usage fact, full build -> run with nothing new", full, increment),
    ]


def main() -> None:
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    for name, plain, used in pairs(spark, prepare(spark)):
        print(f"{name}: {seconds(plain)} s -> {seconds(used)} s", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
