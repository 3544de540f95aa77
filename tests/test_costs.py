import datetime as dt
from decimal import Decimal as D

import pytest
from tests.ledger import EXTRAORDINARY, OLDER_ORDINARY, day, ledger, rows_of

from vecindad.operators.costs import (
    installment_schedule,
    monthly_cost_totals,
    period_cost_totals,
    quota_table_totals,
)


def totals(spark, month, mode, **rows):
    t = ledger(spark, **rows)
    frame = period_cost_totals(
        t["Consorcio"], t["Gasto_Ordinario"], t["Gasto_Extraordinario"], 2025, month, mode
    )
    return {r.consorcioID: r for r in frame.collect()}


@pytest.mark.parametrize(
    ("mode", "month", "want"),
    [
        ("reference", 4, {1: 250000, 2: 150000}),
        ("reference", 5, {2: 150000}),
        ("reference", 6, {}),
        ("strict", 6, {2: 150000}),
        ("strict", 7, {}),
    ],
)
def test_instalments(spark, mode, month, want):
    found = totals(spark, month, mode, Gasto_Extraordinario=EXTRAORDINARY)
    assert {b: r.expExtraordinarias for b, r in found.items() if r.expExtraordinarias} == want
    assert len(found) == 5  # buildings without costs are kept


@pytest.mark.parametrize(("month", "want"), [(9, {1: 80000}), (10, {1: 90000, 2: 50000})])
def test_ordinary(spark, month, want):
    found = totals(spark, month, "reference", Gasto_Ordinario=OLDER_ORDINARY)
    assert {b: r.expOrdinarias for b, r in found.items() if r.expOrdinarias} == want


TRICKY = [
    # last day of a month: the last instalment is charged
    (1, None, 1, "a", day("2025-01-31"), D("100.00"), "CUOTAS", 3),
    # the shifted date is clamped to the end of February
    (2, None, 1, "b", day("2024-12-30"), D("200.00"), "CUOTAS", 3),
    # a one-off cost with several instalments
    (3, None, 2, "c", day("2025-02-10"), D("50.00"), "TOTAL", 4),
    (4, None, 2, "d", day("2025-02-01"), D("70.00"), "CUOTAS", 1),
    (5, None, 3, "e", day("2023-05-15"), D("1000.00"), "CUOTAS", 200),
    (6, None, None, "f", day("2025-02-01"), D("9.00"), "TOTAL", 1),  # no building
    (7, None, 4, "g", day("2025-02-01"), D("9.00"), "OTRO", 1),  # no known kind
]


@pytest.mark.parametrize("mode", ["reference", "strict"])
def test_span_equals_single_months(spark, mode):
    t = ledger(spark, Gasto_Extraordinario=TRICKY, Gasto_Ordinario=OLDER_ORDINARY)
    args = (t["Consorcio"], t["Gasto_Ordinario"], t["Gasto_Extraordinario"])
    span = monthly_cost_totals(*args, (2024, 12), (2025, 9), mode)
    columns = span.columns
    single = []
    for index in range(2024 * 12 + 11, 2025 * 12 + 9):
        year, month = index // 12, index % 12 + 1
        single += rows_of(period_cost_totals(*args, year, month, mode), *columns)
    assert rows_of(span, *columns) == sorted(single, key=repr)


def active_by_rule(date: dt.date, parts: int, year: int, month: int) -> bool:
    """The rule of the single month, spelled out."""
    first = dt.date(year, month, 1)
    last = dt.date(year + month // 12, month % 12 + 1, 1) - dt.timedelta(days=1)
    index = date.year * 12 + date.month - 1 + parts - 1
    y, m = index // 12, index % 12 + 1
    end = dt.date(y + m // 12, m % 12 + 1, 1) - dt.timedelta(days=1)
    shifted = min(dt.date(y, m, 1) + dt.timedelta(days=date.day - 1), end)
    return (date.year, date.month) == (year, month) or (first >= date and shifted >= last)


def test_schedule_follows_the_rule(spark):
    t = ledger(spark, Gasto_Extraordinario=TRICKY)
    found = rows_of(
        installment_schedule(t["Gasto_Extraordinario"]), "gastoExtraordinarioID", "anio", "mes"
    )
    want = [
        (row[0], year, month)
        for row in TRICKY
        for year in range(2023, 2043)
        for month in range(1, 13)
        if active_by_rule(row[4], row[7], year, month)
    ]
    assert found == sorted(want, key=repr)


def test_strict_charges_each_instalment_once(spark):
    t = ledger(spark, Gasto_Extraordinario=TRICKY)
    rows = installment_schedule(t["Gasto_Extraordinario"], "strict").collect()
    counts = {}
    for r in rows:
        counts[r.gastoExtraordinarioID] = counts.get(r.gastoExtraordinarioID, 0) + 1
    assert counts == {1: 3, 2: 3, 3: 1, 4: 1, 5: 200, 6: 1, 7: 1}


def test_quota_table(spark):
    costs = spark.createDataFrame(
        [
            (1, 1, day("2025-08-06"), D("600.00"), "CUOTAS"),
            (2, 1, day("2025-08-10"), D("10.00"), "construccion"),
        ],
        "gastoExtraordinarioID long, consorcioID long, fecha date, importeTotal decimal(14,2),"
        " tipoGasto string",
    )
    quotas = spark.createDataFrame(
        [(1, 1, D("50.00")), (1, 2, D("50.00"))],
        "gastoExtraordinarioID long, nroCuota int, importeCuota decimal(14,2)",
    )
    found = rows_of(quota_table_totals(costs, quotas), "consorcioID", "anio", "mes", "importeTotal")
    assert found == [
        (1, 2025, 10, D("50.00")),
        (1, 2025, 8, D("110.00")),  # both instalments in the month of the cost
        (1, 2025, 9, D("50.00")),
    ]
