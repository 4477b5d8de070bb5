"""Column functions on edge values."""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverlode.functions import dates, numeric, parsing, text
from silverlode.functions.keys import row_fingerprint, surrogate_key
from silverlode.operators.months import months_covered
from silverlode.plans.silver import customer, payment, subscription, support
from silverlode.sources.calendar import dim_date
from tests.compare import connect

FEW = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def values(spark, rows, kind, expr):
    """The expression over a column ``x`` holding the rows."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(df)).collect()]


def of_text(spark, rows, expr):
    return values(spark, rows, "string", lambda df: expr(F.col("x")))


def test_date_text(spark):
    rows = {
        "2024-03-15": dt.date(2024, 3, 15),
        " 2024-03-15 ": dt.date(2024, 3, 15),
        "2024-03-15 14:30:00": dt.date(2024, 3, 15),
        "2024-03-15T14:30:00": dt.date(2024, 3, 15),
        "03/15/2024": dt.date(2024, 3, 15),
        "31/02/2024": None,
        "17-DEC-1980": dt.date(1980, 12, 17),
        "2024-02-30": None,
        "2024-13-01": None,
        "2024": None,
        "2024-03": None,
        "": None,
        "null": None,
        None: None,
    }
    assert of_text(spark, rows, parsing.text_to_date) == list(rows.values())


def test_dates_that_are_typed_already_are_left_alone(spark):
    day = dt.date(2024, 1, 2)
    assert values(spark, [day, None], "date", lambda df: parsing.safe_date(df, "x")) == [day, None]
    moment = dt.datetime(2024, 1, 2, 3, 4)
    assert values(spark, [moment], "timestamp_ntz", lambda df: parsing.safe_date(df, "x")) == [day]
    assert values(spark, [moment], "timestamp_ntz", lambda df: parsing.safe_timestamp(df, "x")) == [moment]
    assert values(spark, ["2024-01-02"], "string", lambda df: parsing.safe_date(df, "x")) == [day]


def test_timestamp_text(spark):
    rows = {
        "2024-01-15 10:00:00": dt.datetime(2024, 1, 15, 10),
        "2024-01-15": dt.datetime(2024, 1, 15),
        "N/A": None,
        "": None,
        "2024-01-15 25:00:00": None,
    }
    got = values(spark, rows, "string", lambda df: parsing.safe_timestamp(df, "x"))
    assert got == list(rows.values())


def test_boolean_text(spark):
    rows = {"true": True, " ON ": True, "1": True, "no": False, "off": False, "0": False, "N/A": None, "": None, None: None}
    assert values(spark, rows, "string", lambda df: parsing.safe_boolean(df, "x")) == list(rows.values())
    assert values(spark, [True, None], "boolean", lambda df: parsing.safe_boolean(df, "x")) == [True, None]


def test_normalize_boolean(spark):
    rows = ["SI", "sí", " s ", "1", "No", "0", "maybe", None]
    assert of_text(spark, rows, parsing.normalize_boolean) == [True, True, True, True, False, False, False, False]
    undecided = of_text(spark, rows, lambda c: parsing.normalize_boolean(c, None))
    assert undecided == [True, True, True, True, False, False, None, None]


def test_flag(spark):
    assert values(spark, [1, 0, 2, None], "int", lambda df: parsing.flag(F.col("x"))) == [True, False, False, False]


def test_numbers_in_text(spark):
    rows = {"BOB 12.50": "12.50", "$ 1.200 BOB": "1.20", "1,001 BOB": "1001.00", "N/A": None, "": None, "-5": "-5.00", "1-2": None}
    got = of_text(spark, rows, lambda c: parsing.number_in_text(c, 18, 2))
    assert got == [None if v is None else Decimal(v) for v in rows.values()]
    assert of_text(spark, ["12.7", "12.4", "x"], lambda c: parsing.safe_decimal(c, 38, 0)) == [13, 12, None]


def test_month_keys(spark):
    rows = {"2024-03": True, "2024-3": False, "24-03": False, "2024/03": False, "2024-13": False, "2024-03\n": False}
    assert of_text(spark, rows, parsing.is_month_key) == list(rows.values())
    assert of_text(spark, ["2024-03", "2024-13"], parsing.month_key_to_date) == [dt.date(2024, 3, 1), None]


def test_category(spark):
    assert of_text(spark, [" card", "", "  ", None], text.category) == ["CARD", "UNKNOWN", "UNKNOWN", "UNKNOWN"]
    assert of_text(spark, [""], lambda c: text.category(c, "BOB")) == ["BOB"]


def test_title_case(spark):
    rows = ["la-paz", "santa  cruz", "ABC", "o'neill", "a.b/c", ""]
    assert of_text(spark, rows, text.title_case) == ["La-Paz", "Santa  Cruz", "Abc", "O'neill", "A.B/C", ""]


@pytest.mark.parametrize(
    "codes, expected",
    [
        (customer.GENDERS, {"masculino ": "MALE", "M": "MALE", "mujer": "FEMALE", "nb": "NON_BINARY", "": "UNKNOWN"}),
        (customer.MARITAL_STATUSES, {"casada": "MARRIED", "soltero": "SINGLE", "Divorced": "DIVORCED", "viuda": "WIDOWED"}),
        (subscription.STATUSES, {"activo": "ACTIVE", "baja": "CANCELLED", "replaced": "SUPERSEDED", None: "UNKNOWN"}),
        (subscription.CONTRACT_TYPES, {"  mensual ": "MONTH_TO_MONTH", "1 year": "ONE_YEAR", "biennial": "TWO_YEAR"}),
        (payment.STATUSES, {"paid": "COMPLETED", "declined": "FAILED", "PARTIALLY_PAID": "PARTIAL", "processing": "PENDING"}),
        (support.STATUSES, {"cerrado": "CLOSED", "resuelto": "RESOLVED", "abierto": "OPEN", "pendiente": "PENDING"}),
    ],
)
def test_code_maps(spark, codes, expected):
    assert of_text(spark, expected, lambda c: text.map_codes(c, codes)) == list(expected.values())


def test_rounding_and_clamps(spark):
    kind = "decimal(10,4)"
    rows = [Decimal("2.5"), Decimal("-2.5"), Decimal("2.4999"), None]
    assert values(spark, rows, kind, lambda df: numeric.whole(F.col("x"))) == [3, -3, 2, None]
    assert values(spark, rows, kind, lambda df: numeric.not_below_zero(F.col("x"))) == [Decimal("2.5"), 0, Decimal("2.4999"), 0]
    assert values(spark, [48, -1, None, 24], "int", lambda df: numeric.clamp(F.col("x"), 24)) == [24, 0, 0, 24]


def test_ratio(spark):
    kind = "decimal(18,2)"
    got = values(spark, [Decimal("3"), Decimal("0"), None], kind, lambda df: numeric.ratio(F.lit(Decimal("1.00")), F.col("x")))
    assert got == [Decimal("0.3333"), None, None]


@FEW
@given(st.lists(st.tuples(st.integers(0, 10**6), st.integers(0, 10**6)), min_size=1, max_size=30))
def test_percentage_rounds_half_up(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a long, b long").orderBy("i")
    got = [r[0] for r in df.select(numeric.percentage(F.col("a"), F.col("b"))).collect()]
    want = [
        None if b == 0 else (Decimal(100 * a) / b).quantize(Decimal("0.01"), ROUND_HALF_UP) for a, b in pairs
    ]
    assert got == want


@FEW
@given(st.lists(st.tuples(st.integers(0, 10**7), st.integers(0, 10)), min_size=1, max_size=30))
def test_discounted_amount_is_exact(spark, pairs):
    rows = [(i, cents / 100, pct / 100) for i, (cents, pct) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "i int, price double, pct double").orderBy("i")
    got = [r[0] for r in df.select(numeric.discounted_amount(F.col("price"), F.col("pct"))).collect()]
    want = [
        -(Decimal(cents) * pct / 10000).quantize(Decimal("0.01"), ROUND_HALF_UP) for cents, pct in pairs
    ]
    assert got == want


DAYS = st.dates(dt.date(2000, 1, 1), dt.date(2040, 12, 31))


@FEW
@given(st.lists(st.tuples(DAYS, DAYS), min_size=1, max_size=30))
def test_month_boundaries(spark, pairs):
    pairs = [*pairs, (dt.date(2024, 1, 31), dt.date(2024, 2, 1)), (dt.date(2024, 1, 1), dt.date(2024, 1, 31))]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a date, b date").orderBy("i")
    got = df.select(
        dates.months_between(F.col("a"), F.col("b")).alias("m"),
        dates.month_key(F.col("a")).alias("k"),
        dates.date_key(F.col("a")).alias("d"),
    ).collect()
    assert [r.m for r in got] == [(b.year - a.year) * 12 + b.month - a.month for a, b in pairs]
    assert [r.k for r in got] == [a.strftime("%Y-%m") for a, _ in pairs]
    assert [r.d for r in got] == [int(a.strftime("%Y%m%d")) for a, _ in pairs]


def test_minute_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 10, 0, 59), dt.datetime(2024, 1, 1, 10, 1, 0))], "a timestamp_ntz, b timestamp_ntz"
    )
    assert df.select(dates.minutes_between(F.col("a"), F.col("b"))).first()[0] == 1


def test_surrogate_key(spark):
    df = spark.createDataFrame([("a", None), ("a", "_dbt_null_"), ("a\x1f", "b"), (None, None)], "p string, q string")
    keys = [r[0] for r in df.select(surrogate_key("p", "q")).collect()]
    assert keys[0] == keys[1] == hashlib.md5(b"a\x1f_dbt_null_").hexdigest()
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_fingerprint_ignores_column_order(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    one, two = df.select(row_fingerprint(["a", "b"]), row_fingerprint(["b", "a"])).first()
    assert one == two


def test_months_covered(spark):
    rows = [
        ("a", dt.date(2023, 1, 31), dt.date(2023, 3, 1)),
        ("b", dt.date(2014, 6, 1), dt.date(2015, 2, 15)),
        ("c", dt.date(2010, 1, 1), dt.date(2010, 5, 1)),
        ("d", dt.date(2023, 5, 9), dt.date(2023, 5, 9)),
    ]
    df = spark.createDataFrame(rows, "id string, s date, e date")
    got = months_covered(df, F.col("s"), F.col("e"), F.lit(dt.date(2015, 1, 1)), F.lit(dt.date(2034, 12, 31)))
    found = sorted((r.id, r.month_start) for r in got.collect())
    assert found == [
        ("a", dt.date(2023, 1, 1)),
        ("a", dt.date(2023, 2, 1)),
        ("a", dt.date(2023, 3, 1)),
        ("b", dt.date(2015, 1, 1)),
        ("b", dt.date(2015, 2, 1)),
        ("d", dt.date(2023, 5, 1)),
    ]


@pytest.mark.parametrize("as_of, last", [(dt.date(2024, 2, 1), dt.date(2026, 2, 1)), (dt.date(2040, 1, 1), dt.date(2034, 12, 31))])
def test_calendar(spark, as_of, last):
    got = [tuple(r) for r in dim_date(spark, as_of).orderBy("calendar_date").collect()]
    db = connect("/root/testdata/sf0.001")
    want = db.execute(
        f"""SELECT strftime(d, '%Y%m%d')::int, d, year(d), quarter(d), month(d), strftime(d, '%Y-%m'), left(monthname(d), 3),
          weekofyear(d), day(d), isodow(d), left(dayname(d), 3), isodow(d) IN (6, 7), date_trunc('month', d)::date, last_day(d)
        FROM (SELECT unnest(generate_series(DATE '2015-01-01', DATE '{last}', INTERVAL 1 DAY))::date AS d) ORDER BY d"""
    ).fetchall()
    assert got == want
    assert math.isclose(len(got), (last - dt.date(2015, 1, 1)).days + 1)
