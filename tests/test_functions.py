import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from vecindad import functions as V
from vecindad.functions.amounts import truncated_share
from vecindad.functions.dates import month_bounds, previous_period, resolve_period


def evaluate(spark, values, function, kind="string"):
    frame = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r.x for r in frame.orderBy("i").select(function(F.col("v")).alias("x")).collect()]


def test_parse_amount(spark):
    cases = {
        "12,000.0": D("12000.00"),
        "12.000,0": D("12000.00"),
        "12,000,0": D("12000.00"),
        "12.000.0": D("0.00"),
        "1234": D("0.00"),
        "1234.56": D("0.00"),
        "1,5": D("0.00"),
        "1.234.567,895": D("1234567.90"),  # rounded half up
        "-1.234,5": D("-1234.50"),
        "1,2,3,4": None,  # two decimal marks are left
        "a,1.0": None,
        "1e1,0.5": None,
        None: D("0.00"),
    }
    assert evaluate(spark, list(cases), V.parse_amount) == list(cases.values())


def test_clean_money(spark):
    cases = {
        "$ 1.234,50": D("1234.50"),
        " $80.000 ": D("80000.00"),
        "12,345": D("12.35"),
        "": None,
        "abc": None,
        "$ 99.999.999.999,00": None,  # does not fit
        None: None,
    }
    assert evaluate(spark, list(cases), V.clean_money) == list(cases.values())


def test_decimal_comma(spark):
    cases = {"45,50": D("45.50"), "9999,99": D("9999.99"), "10000": None, "x": None, None: None}
    assert evaluate(spark, list(cases), lambda c: V.decimal_comma(c, 6, 2)) == list(cases.values())


def test_identity_numbers(spark):
    cases = {"12.345.678": "12345678", "1234567": "01234567", "123": None, None: None}
    assert evaluate(spark, list(cases), V.pad_id) == list(cases.values())
    assert evaluate(spark, ["a1-2b", None], V.digits_only) == ["12", ""]


def test_flags_and_labels(spark):
    assert evaluate(spark, ["SI", "si ", " SI", "NO", None], V.yes_flag) == [1, 1, 0, 0, 0]
    label = evaluate(spark, ["1", "10", None], lambda c: V.unit_label(c, F.lit("A")))
    assert label == ["1 A", "10A", None]


def test_week_of_year(spark):
    days = ["2025-01-01", "2025-01-04", "2025-01-05", "2024-12-31", "2023-01-01"]
    cast = evaluate(spark, days, lambda c: V.week_of_year(c.cast("date")))
    assert cast == [1, 1, 2, 53, 1]


def test_month_start_by_name(spark):
    date = F.lit(dt.date(2025, 11, 2))
    found = evaluate(spark, ["Abril", "DICIEMBRE ", "foo", None], lambda c: V.month_start_by_name(date, c))
    assert found == [dt.date(2025, 4, 1), dt.date(2025, 12, 1), None, None]


def test_previous_period(spark):
    frame = spark.createDataFrame([(1, 2025), (5, 2025)], "m int, y int")
    rows = frame.select(V.previous_month(F.col("m")), V.previous_year(F.col("m"), F.col("y")))
    assert [tuple(r) for r in rows.collect()] == [(12, 2024), (4, 2025)]
    assert previous_period(2025, 1) == (2024, 12)
    assert resolve_period(None, 3, dt.date(2025, 1, 9)) == (2024, 12)
    assert resolve_period(2020, 2) == (2020, 2)
    assert month_bounds(2024, 2) == (dt.date(2024, 2, 1), dt.date(2024, 2, 29))


def test_dates(spark):
    texts = ["05/04/2025", "5/4/2025", " 05/04/2025 ", "31/02/2025", "2025-04-05", None]
    good = dt.date(2025, 4, 5)
    assert evaluate(spark, texts, V.parse_day_month_year) == [good, good, good, None, None, None]


@pytest.mark.parametrize(
    ("amount", "parts", "want"),
    [("100.00", 3, "33.333333"), ("200.00", 3, "66.666666"), ("-200.00", 3, "-66.666666"),
     ("999999999999.99", 7, "142857142857.141428")],
)
def test_truncated_share(spark, amount, parts, want):
    frame = spark.createDataFrame([(D(amount), parts)], "a decimal(14,2), n smallint")
    assert frame.select(truncated_share(F.col("a"), F.col("n"))).first()[0] == D(want)
