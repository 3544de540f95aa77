import datetime as dt
import random
import re
from decimal import Decimal as D

import pytest
from tests.ledger import (
    ACCOUNT,
    BUILDINGS,
    EXTRAORDINARY,
    UNITS,
    day,
    detail_row,
    ledger,
    rows_of,
)

from vecindad.plans.charges import (
    charge_history,
    generate_documents,
    link_costs,
    run_period,
    store_months,
    unit_statement,
)
from vecindad.sinks.tables import append
from vecindad.sources.tables import read_stored, table_from_rows

RUN = dt.date(2025, 7, 1)


def month_of(spark, year, month, detail, accounts=(), positions=(), mode="reference", policy="partial_payment"):
    """One run with documents 1 and 2 of building 2 for two months in place."""
    documents = [
        (1, 2, 4, 2025, RUN, RUN, "Mail", True, False),
        (2, 2, 5, 2025, RUN, RUN, "Mail", True, False),
    ]
    ordinary = [(1, None, 2, day("2025-05-20"), D("80000.00"))]
    tables = ledger(
        spark, Expensas=documents, Gasto_Ordinario=ordinary, Detalle_CSV=detail,
        Estado_Cuentas=list(accounts), Estado_Financiero=list(positions),
    )
    return run_period(tables, year, month, mode=mode, policy=policy, run_date=RUN)


PREVIOUS = [(1, 21, D(0), D(0), D(0), D(0), D(0), D(0), D("1000.00"))]


@pytest.mark.parametrize(
    ("payments", "interest", "total", "balance"),
    [
        ([], "70.00", "3070.00", "-1000.00"),
        ([("2025-04-12", "600.00")], "40.00", "2440.00", "-400.00"),
        ([("2025-04-08", "1000.00")], "0.00", "2000.00", "0.00"),
        ([("2025-04-10", "500.00"), ("2025-04-15", "500.00")], "10.00", "2010.00", "0.00"),
        ([("2025-03-31", "1000.00"), ("2025-05-01", "1000.00")], "70.00", "3070.00", "-1000.00"),
        ([("2025-04-01", "1500.00")], "0.00", "1500.00", "500.00"),
    ],
)
def test_unit_account(spark, payments, interest, total, balance):
    detail = [detail_row(21, date, amount) for date, amount in payments]
    row = month_of(spark, 2025, 5, detail, PREVIOUS)["Estado_Cuentas"].collect()
    (row,) = [r for r in row if r.unidadFuncionalID == 21]
    assert (row.InteresesPorMora, row.totalPagar, row.saldo) == (D(interest), D(total), D(balance))
    assert row.expensasOrdinarias == D("2000.00")


def test_last_payment_policy(spark):
    """Interest goes by the day of the last payment; the total is never negative."""
    detail = [detail_row(21, "2025-04-12", "600.00")]
    rows = month_of(spark, 2025, 5, detail, PREVIOUS, policy="last_payment")["Estado_Cuentas"]
    (row,) = [r for r in rows.collect() if r.unidadFuncionalID == 21]
    assert (row.InteresesPorMora, row.totalPagar, row.saldo) == (D("20.00"), D("2400.00"), D("400.00"))
    detail = [detail_row(21, "2025-04-02", "90000.00")]
    rows = month_of(spark, 2025, 5, detail, PREVIOUS, policy="last_payment")["Estado_Cuentas"]
    (row,) = [r for r in rows.collect() if r.unidadFuncionalID == 21]
    assert row.totalPagar == 0


def test_matching_by_account_and_by_unit(spark):
    """The paid amount goes by account, the due days by unit; strict uses the unit."""
    detail = [detail_row(11, "2025-04-05", "1000.00", account=ACCOUNT[21])]
    found = {}
    for mode in ("reference", "strict"):
        rows = month_of(spark, 2025, 5, detail, PREVIOUS, mode=mode)["Estado_Cuentas"].collect()
        (row,) = [r for r in rows if r.unidadFuncionalID == 21]
        found[mode] = (row.pagosRecibidos, row.InteresesPorMora)
    assert found == {"reference": (D("1000.00"), D("70.00")), "strict": (D(0), D("70.00"))}


def test_income_on_day_ten(spark):
    detail = [detail_row(21, "2025-04-10", "500.00")]
    for mode, overdue in (("reference", D(500)), ("strict", D(0))):
        rows = month_of(spark, 2025, 5, detail, mode=mode)["Estado_Financiero"].collect()
        (row,) = [r for r in rows if r.consorcioID == 2]
        assert (row.ingresosEnTermino, row.ingresosAdeudados) == (D(500), overdue)
        assert row.saldoFinal == D("-79500.00")


def test_documents_and_links(spark):
    t = ledger(spark, Gasto_Extraordinario=EXTRAORDINARY)
    first = generate_documents(t["Consorcio"], t["Expensas"], [(2025, 4)], RUN)
    assert first.count() == 5
    stored = t["Expensas"].unionByName(first)
    assert generate_documents(t["Consorcio"], stored, [(2025, 4)], RUN).count() == 0
    again = generate_documents(t["Consorcio"], stored, [(2025, 4), (2025, 5)], RUN)
    assert {(r.anio, r.mes) for r in again.collect()} == {(2025, 5)}
    linked = link_costs(t["Gasto_Extraordinario"], stored)
    by_building = {r.consorcioID: r.documentoID for r in stored.collect()}
    assert rows_of(linked, "consorcioID", "documentoID") == sorted(
        ((b, by_building[b]) for b in (1, 2)), key=repr
    )
    # A document that is already set stays, and a second document adds no row.
    preset = table_from_rows(spark, "Gasto_Extraordinario", [(9, 77, *EXTRAORDINARY[0][2:])])
    assert [r.documentoID for r in link_costs(preset, stored.unionByName(stored)).collect()] == [77]


def random_ledger(spark, seed=7):
    rng = random.Random(seed)
    dates = [dt.date(2024, 11, 1) + dt.timedelta(days=i) for i in range(240)]
    money = lambda: D(rng.randint(1, 9_999_999)) / 100
    ordinary = [(i, None, rng.randint(1, 3), rng.choice(dates), money()) for i in range(60)]
    extra = [
        (i, None, rng.randint(1, 3), "x", rng.choice(dates), money(),
         rng.choice(["TOTAL", "CUOTAS"]), rng.randint(1, 6))
        for i in range(60)
    ]
    detail = [
        detail_row(rng.choice([11, 12, 21]), str(rng.choice(dates)), str(money()), rng.randint(1, 2))
        for _ in range(150)
    ]
    return ledger(spark, Gasto_Ordinario=ordinary, Gasto_Extraordinario=extra, Detalle_CSV=detail)


@pytest.mark.parametrize(
    ("mode", "policy"),
    [
        ("reference", "partial_payment"),
        ("strict", "partial_payment"),
        ("reference", "last_payment"),
        ("reference", "flat"),
    ],
)
def test_history_equals_month_by_month(spark, tmp_path, mode, policy):
    tables = random_ledger(spark)
    root = str(tmp_path / "store")
    for name in ("Consorcio", "Unidad_Funcional", "Propietario", "Gasto_Ordinario", "Gasto_Extraordinario"):
        append(tables[name], f"{root}/{name}")
    append(tables["Detalle_CSV"], f"{root}/Detalle_CSV/lote=a")
    months = [(2024, 12), (2025, 1), (2025, 2), (2025, 3)]
    store_months(spark, root, months, mode=mode, policy=policy, run_date=RUN)
    history = charge_history(tables, months[0], months[-1], mode=mode, policy=policy, run_date=RUN)
    for name in ("Estado_Cuentas", "Estado_Financiero"):
        columns = [c for c in history[name].columns if c != "consorcioID"]
        found = rows_of(history[name], *columns)
        assert found == rows_of(read_stored(spark, root, name), *columns)
        assert len(found) == (16 if name == "Estado_Cuentas" else 20)


@pytest.mark.parametrize("policy", ["partial_payment", "last_payment", "flat"])
def test_history_continues_stored_balances(spark, tmp_path, policy):
    """Two months stored one by one and two in one pass equal four months one by one; again adds nothing."""
    from vecindad.plans.charges import store_history

    months = [(2024, 12), (2025, 1), (2025, 2), (2025, 3)]
    roots = [str(tmp_path / n) for n in ("single", "both")]
    for root in roots:
        _store(spark, random_ledger(spark), root)
    store_months(spark, roots[0], months, policy=policy, run_date=RUN)
    store_months(spark, roots[1], months[:2], policy=policy, run_date=RUN)
    for _ in range(2):
        store_history(spark, roots[1], months[1], months[3], policy=policy, run_date=RUN)
    for name in ("Expensas", "Estado_Financiero", "Estado_Cuentas"):
        columns = read_stored(spark, roots[0], name).columns
        found = rows_of(read_stored(spark, roots[1], name), *columns)
        assert found == rows_of(read_stored(spark, roots[0], name), *columns)


def test_history_leaves_done_documents_to_their_units(spark, tmp_path):
    from vecindad.plans.charges import store_history

    root = str(tmp_path / "store")
    _store(spark, random_ledger(spark), root)
    store_months(spark, root, [(2025, 1)], run_date=RUN)
    late = (13, 1, "3", "C", D("50"), 1, 0, None, D("10.00"))
    append(table_from_rows(spark, "Unidad_Funcional", [late]), f"{root}/Unidad_Funcional")
    store_history(spark, root, (2025, 1), (2025, 2), run_date=RUN)
    rows = read_stored(spark, root, "Estado_Cuentas").where("unidadFuncionalID = 13").collect()
    assert [(r.anio, r.mes, r.saldoAnterior) for r in rows] == [(2025, 2, D(0))]


def test_folded_history_has_no_python_and_one_shuffle_by_unit(spark):
    tables = random_ledger(spark)
    plan = charge_history(tables, (2024, 12), (2025, 3), run_date=RUN)["Estado_Cuentas"]
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "InArrow" not in text
    assert text.count("REPARTITION_BY_COL") == 1


def test_months_of_a_building_are_joined_after_the_shuffle_by_unit(spark):
    """No row per unit and month is shuffled; a unit whose rows name two buildings has the months of both."""
    from vecindad.operators.history import account_history
    from vecindad.operators.payments import collected, paid_by_account, paid_by_unit

    documents = spark.createDataFrame(
        [(1, 24300, 71, D("100.00")), (1, 24301, 72, D("100.00")), (2, 24301, 81, D("1000.00")), (2, 24302, 82, D("1000.00"))],
        "consorcioID long, periodo int, documentoID long, expOrdinarias decimal(18,2)",
    ).selectExpr("*", "cast(0 as decimal(18,2)) as expExtraordinarias")
    units = spark.createDataFrame(
        [(1, 1, D("10.00")), (1, 2, D("20.00")), (2, 1, D("50.00")), (2, 1, D("40.00")), (3, None, D("1.00")), (None, 2, D("5.00"))],
        "unidadFuncionalID long, consorcioID long, coeficiente decimal(4,2)",
    ).selectExpr("*", "cast(null as string) as CBU_CVU")
    lines = collected(ledger(spark)["Detalle_CSV"]).where("false")
    rows = account_history(units, documents, paid_by_account(lines), paid_by_unit(lines))
    found = {(r.unidadFuncionalID, r.mes): (r.consorcioID, r.documentoID, r.expensasOrdinarias) for r in rows.collect()}
    assert found == {
        (1, 1): (1, 71, D("10.00")), (1, 2): (2, 81, D("200.00")), (1, 3): (2, 82, D("200.00")),
        (2, 1): (1, 71, D("50.00")), (2, 2): (1, 72, D("50.00")),
        (None, 2): (2, 81, D("50.00")), (None, 3): (2, 82, D("50.00")),
    }
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("RepartitionByExpression")


def test_fold_state_is_the_total_alone(spark):
    """What is known before the fold is not spelled out by month; payments are looked up by month."""
    from vecindad.operators import history

    kinds = []
    folded = history.folded

    def seen(months, step, kind):
        kinds.append(kind)
        return folded(months, step, kind)

    history.folded = seen
    try:
        accounts = charge_history(random_ledger(spark), (2025, 1), (2025, 3), run_date=RUN)["Estado_Cuentas"]
    finally:
        history.folded = folded
    plan = accounts._jdf.queryExecution().optimizedPlan().toString()
    assert "bigint" in kinds
    assert "_pagado" in plan and "resto" not in plan
    assert accounts.count() > 0


def test_fold_goes_over_blocks(spark):
    """Forty months in blocks of twelve: each result is the one before and the month's own."""
    from pyspark.sql import functions as F

    from vecindad.operators.history import folded

    frame = spark.createDataFrame([([(k, k * k) for k in range(n)],) for n in (1, 11, 12, 13, 24, 40)], "m array<struct<periodo:bigint,x:bigint>>")
    step = lambda m, last: F.struct(m["periodo"], F.coalesce(last["sum"], F.lit(0)) + m["x"])
    for row in frame.select("m", folded(F.col("m"), step, "struct<periodo:bigint,sum:bigint>").alias("r")).collect():
        assert [r["sum"] for r in row.r] == [sum(j * j for j in range(k + 1)) for k in range(len(row.m))]


def test_default_period_is_the_session_date(spark):
    from vecindad.functions.dates import previous_period, session_date

    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        days = []
        for name in ("Pacific/Kiritimati", "Etc/GMT+12"):
            spark.conf.set("spark.sql.session.timeZone", name)
            days.append(session_date(spark))
        assert (days[0] - days[1]).days in (1, 2)
        result = run_period(ledger(spark))
        documents = result["Expensas"].collect()
        assert {(r.anio, r.mes) for r in documents} == {previous_period(days[1].year, days[1].month)}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_history_starts_afresh_after_a_gap(spark):
    tables = random_ledger(spark)
    documents = [
        (month, 1, month, 2025, RUN, RUN, "Mail", True, False) for month in (1, 2, 4)
    ]
    from vecindad.operators.history import account_history
    from vecindad.operators.payments import collected, paid_by_account, paid_by_unit

    lines = collected(tables["Detalle_CSV"])
    frame = spark.createDataFrame(
        [(1, d[0], 2025 * 12 + d[2] - 1, D("1000.00"), D("0.00")) for d in documents],
        "consorcioID long, documentoID long, periodo int, expOrdinarias decimal(18,2),"
        " expExtraordinarias decimal(18,2)",
    )
    rows = account_history(
        tables["Unidad_Funcional"], frame, paid_by_account(lines), paid_by_unit(lines)
    ).collect()
    before = {(r.unidadFuncionalID, r.mes): r for r in rows}
    assert len(rows) == 6
    assert before[11, 2].saldoAnterior == before[11, 1].totalPagar != 0
    assert before[11, 4].saldoAnterior == 0


def test_shares_add_up(spark):
    """Units of building 1 have 60 % and 40 %."""
    t = ledger(spark, Gasto_Ordinario=[(1, None, 1, day("2025-05-20"), D("80000.01"))])
    rows = run_period(t, 2025, 5, run_date=RUN)["Estado_Cuentas"].collect()
    assert sum(r.expensasOrdinarias for r in rows) == D("80000.01")


def test_rerun_adds_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    tables = random_ledger(spark)
    for name in ("Consorcio", "Unidad_Funcional", "Propietario", "Gasto_Ordinario", "Gasto_Extraordinario"):
        append(tables[name], f"{root}/{name}")
    append(tables["Detalle_CSV"], f"{root}/Detalle_CSV/lote=a")
    out = str(tmp_path / "xml")
    store_months(spark, root, [(2025, 1)] * 2, mode="strict", xml_root=out)
    counts = {n: read_stored(spark, root, n).count() for n in ("Expensas", "Estado_Cuentas", "Estado_Financiero")}
    assert counts == {"Expensas": len(BUILDINGS), "Estado_Cuentas": len(UNITS), "Estado_Financiero": 5}
    parts = list((tmp_path / "xml" / "ArchivoExpensas_20251.xml").glob("part-*"))
    text = "".join(p.read_text() for p in parts)
    assert text.count("<Expensa>") == 3 and "<Propietario>Paz Ana</Propietario>" in text
    assert all(p.read_text().startswith("<Expensas>") for p in parts if p.stat().st_size)
    back = spark.read.option("rowTag", "Expensa").xml(f"{out}/ArchivoExpensas_20251.xml")
    assert {r.PisoDepto for r in back.select("PisoDepto").collect()} == {"1 -A", "10-B"}


def test_statement_owners(spark):
    t = ledger(spark, Gasto_Extraordinario=EXTRAORDINARY)
    result = run_period(t, 2025, 4, run_date=RUN)
    statement = unit_statement(
        result["Expensas"], result["Estado_Cuentas"], t["Unidad_Funcional"], t["Propietario"], 2025, 4
    )
    assert rows_of(statement, "uf", "Propietario", "ExpensasExtraordinarias") == [
        (11, "Paz Ana", D("150000.00")),
        (12, "Gil Eva", D("100000.00")),
        (12, "Gil Luis", D("100000.00")),
    ]


def _store(spark, tables, root):
    for name in ("Consorcio", "Unidad_Funcional", "Propietario", "Gasto_Ordinario", "Gasto_Extraordinario"):
        append(tables[name], f"{root}/{name}")
    append(tables["Detalle_CSV"], f"{root}/Detalle_CSV/lote=a")


def test_very_large_amounts_are_exact(spark):
    """Twenty costs of the declared maximum in one building and month, and a rest of a cent."""
    top = "999999999999.99"
    costs = [(k, None, 1, day("2025-05-20"), D(top)) for k in range(20)] + [(20, None, 1, day("2025-05-21"), D("0.21"))]
    t = ledger(spark, Gasto_Ordinario=costs)
    rows = run_period(t, 2025, 5, run_date=RUN)["Estado_Cuentas"].collect()
    history = charge_history(t, (2025, 5), (2025, 5), run_date=RUN)
    total = 20 * D(top) + D("0.21")
    assert sum(r.expensasOrdinarias for r in rows) == total
    assert sorted(r.totalPagar for r in rows) == sorted(r.totalPagar for r in history["Estado_Cuentas"].collect())
    position = [r.saldoFinal for r in history["Estado_Financiero"].collect() if r.egresosTotales]
    assert position == [-total]


def test_restart_equals_a_clean_run_and_again_adds_positions(spark, tmp_path, monkeypatch):
    from vecindad.plans import charges

    tables, clean, cut = random_ledger(spark), str(tmp_path / "clean"), str(tmp_path / "cut")
    for root in (clean, cut):
        _store(spark, tables, root)
    store_months(spark, clean, [(2025, 1), (2025, 2)], run_date=RUN)

    def stops(frame, path, *rest):
        if path.endswith("Estado_Cuentas"):
            raise RuntimeError("lost")
        append(frame, path, *rest)

    monkeypatch.setattr(charges, "append", stops)
    with pytest.raises(RuntimeError):
        store_months(spark, cut, [(2025, 1)], run_date=RUN)
    monkeypatch.undo()
    store_months(spark, cut, [(2025, 1), (2025, 2)], run_date=RUN)
    for name in ("Expensas", "Estado_Financiero", "Estado_Cuentas"):
        columns = [c for c in read_stored(spark, clean, name).columns]
        assert rows_of(read_stored(spark, cut, name), *columns) == rows_of(read_stored(spark, clean, name), *columns)
    charges.store_period(spark, cut, 2025, 2, run_date=RUN, again=True)
    assert read_stored(spark, cut, "Estado_Financiero").count() == 15


def test_stored_weekly_report_has_linked_costs(spark, tmp_path):
    from vecindad.plans.charges import stored_weekly_cash_flow

    root = str(tmp_path / "store")
    _store(spark, random_ledger(spark), root)
    before = stored_weekly_cash_flow(spark, root, all_years=True).agg({"TotalExtraordinarios": "sum"}).first()[0]
    assert not before
    store_months(spark, root, [(2025, 1), (2025, 2)], run_date=RUN)
    report = stored_weekly_cash_flow(spark, root, all_years=True)
    assert report.agg({"TotalExtraordinarios": "sum"}).first()[0] > 0


def test_statement_reads_one_month(spark, tmp_path):
    from vecindad.plans.charges import unit_statement

    root = str(tmp_path / "store")
    _store(spark, random_ledger(spark), root)
    store_months(spark, root, [(2025, 1), (2025, 2)], run_date=RUN)
    names = ("Expensas", "Estado_Cuentas", "Unidad_Funcional", "Propietario")
    plan = unit_statement(*[read_stored(spark, root, n) for n in names], 2025, 2)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(anio" in plan and "documentoID" not in plan.split("Scan")[0]
    assert f"{root}/Expensas" not in plan


@pytest.mark.parametrize("policy", ["partial_payment", "last_payment", "flat"])
def test_small_totals_are_those_computed_in_parts(spark, policy):
    """The limit itself, halves of a cent, balances below 0, months without payment."""
    from pyspark.sql import functions as F

    from vecindad.operators.interest import SMALL, account_total, small_total

    rng = random.Random(7)
    ends = [0, 1, -1, 49, 50, -50, 150, 5000, -5000, 12345, SMALL, -SMALL]

    def pick():
        return rng.choice(ends) if rng.random() < 0.5 else rng.randint(-(10 ** rng.randint(1, 14)), 10 ** rng.randint(1, 14))

    kept = (None, dt.date(2025, 3, 3))
    rows = [
        (pick(), pick(), *[rng.choice([None, pick()]) for _ in range(3)], rng.choice(kept), pick() // 2, pick() // 2,
         rng.choice([None, 0, 1, 25, 3333, 9999, -9999]))
        for _ in range(600)
    ]
    names = "previo saldoPrevio pagos hasta10 hasta15 ultimo ordinario extra coeficiente".split()
    frame = spark.createDataFrame(rows, ", ".join(f"{n} {'date' if n == 'ultimo' else 'long'}" for n in names))
    both = F.col("ordinario") + F.col("extra")
    none = frame.withColumns({n: F.lit(None).cast("date" if n == "ultimo" else "long") for n in names[2:6]})
    for rows_of_kind, paid in ((frame, True), (none, False), (none, True)):
        found = rows_of_kind.select(
            account_total(F.col, policy).alias("exact"), small_total(F.col, both, policy, paid).alias("small")
        ).collect()
        assert [r.small for r in found] == [r.exact for r in found]


@pytest.mark.parametrize("policy", ["partial_payment", "flat"])
def test_history_is_exact_on_both_sides_of_the_limit(spark, policy):
    """Months that are small, just within the limit, and beyond it by charge or by balance."""
    from fractions import Fraction

    from vecindad.operators.history import account_history
    from vecindad.operators.interest import SMALL
    from vecindad.operators.payments import collected, paid_by_account, paid_by_unit

    cents = [101, SMALL - 1, SMALL, SMALL + 1, 77 * SMALL + 13, 99, 0, 3]
    documents = spark.createDataFrame(
        [(1, 24300 + i, 70 + i, D(c) / 100, D(0)) for i, c in enumerate(cents)],
        "consorcioID long, periodo int, documentoID long, expOrdinarias decimal(18,2), expExtraordinarias decimal(18,2)",
    )
    shares = {1: 3333, 2: 1, 3: 9999}
    units = spark.createDataFrame(
        [(k, 1, D(v) / 100) for k, v in shares.items()], "unidadFuncionalID long, consorcioID long, coeficiente decimal(4,2)"
    ).selectExpr("*", "cast(null as string) as CBU_CVU")
    lines = collected(ledger(spark)["Detalle_CSV"]).where("false")
    rows = account_history(units, documents, paid_by_account(lines), paid_by_unit(lines), policy).collect()
    found = {(r.unidadFuncionalID, r.documentoID): int(r.totalPagar * 100) for r in rows}
    expected = {}
    for unit, percent in shares.items():
        total = balance = 0
        for i, c in enumerate(cents):
            if policy == "flat":
                whole = total + c + Fraction(2 * total + 5 * balance, 100)
            else:
                whole = total + Fraction(c * percent, 10_000) + Fraction(7 * total, 100)
            balance, total = total, int(whole + Fraction(1, 2))
            expected[unit, 70 + i] = total
    assert found == expected


def test_continued_months_are_put_together_once(spark):
    """A condition on the months had them sorted a second time."""
    from vecindad.operators.history import account_history
    from vecindad.operators.payments import collected, paid_by_account, paid_by_unit

    documents = spark.createDataFrame(
        [(1, 24300, 71, D("100.00"), D(0)), (1, 24301, 72, D("100.00"), D(0))],
        "consorcioID long, periodo int, documentoID long, expOrdinarias decimal(18,2), expExtraordinarias decimal(18,2)",
    )
    units = spark.createDataFrame(
        [(1, 1, D("10.00")), (2, None, D("20.00")), (3, 9, D("20.00"))],
        "unidadFuncionalID long, consorcioID long, coeficiente decimal(4,2)",
    ).selectExpr("*", "cast(null as string) as CBU_CVU")
    stored = spark.createDataFrame(
        [(1, 24299, D("50.00"), D(0)), (2, 24299, D("7.00"), D(0))],
        "unidadFuncionalID long, periodo int, totalPagar decimal(18,2), saldo decimal(18,2)",
    )
    lines = collected(ledger(spark)["Detalle_CSV"]).where("false")
    rows = account_history(units, documents, paid_by_account(lines), paid_by_unit(lines), stored=stored)
    assert sorted((r.unidadFuncionalID, r.mes, r.totalPagar) for r in rows.collect()) == [
        (1, 1, D("63.50")), (1, 2, D("77.95")),
    ]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    steps = [line.lstrip(" :+-") for line in plan.splitlines()]
    assert not [step for step in steps if step.startswith("Filter") and "sort_array" in step]


def test_months_of_a_history_from_nothing_hold_no_stored_balances(spark):
    """Rows gathered by unit are no wider than their policy needs."""
    accounts = charge_history({k: v for k, v in random_ledger(spark).items() if k != "Estado_Cuentas"}, (2025, 1), (2025, 3), policy="flat", run_date=RUN)["Estado_Cuentas"]
    plan = accounts._jdf.queryExecution().optimizedPlan().toString()
    assert "_pagado" in plan and "fijo" not in plan
    assert accounts.count() > 0


def test_ordinary_costs_are_summed_in_cents(spark, tmp_path):
    """Sums as of decimals (rounded by row, NULL without an amount), in a buffer of one number."""
    from vecindad.sources import star_schema as star

    noon = dt.datetime(1997, 5, 3, 12)
    lines = [(1, 1, 0.125, noon), (2, 1, 2.345, dt.datetime(1997, 5, 3)), (3, 1, -1.005, noon), (4, 2, None, noon), (5, 3, 1.0, None),
             (6, 3, 99999999999.99, None), (7, 9, 5.0, noon), (8, None, 5.0, noon)]
    spark.createDataFrame(
        lines, "l_orderkey long, l_suppkey long, l_extendedprice double, l_shipdate timestamp_ntz"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(
        [(1, 4), (2, 4), (3, None)], "s_suppkey long, s_nationkey int"
    ).write.parquet(f"{tmp_path}/supplier.parquet")
    costs = star.ordinary_costs(spark, str(tmp_path))
    assert sorted(map(tuple, costs.collect()), key=str) == [
        (1, 4, dt.date(1997, 5, 3), D("1.47")), (2, 4, dt.date(1997, 5, 3), None), (3, None, None, D("100000000000.99")),
    ]
    assert costs.schema["importeTotal"].dataType.simpleString() == "decimal(18,2)"
    plan = costs._jdf.queryExecution().optimizedPlan().toString()
    sums = [line for line in plan.splitlines() if "Aggregate" in line]
    assert len(sums) == 1 and re.search(r"sum\(.*l_extendedprice.* as bigint\)\)", sums[0])
