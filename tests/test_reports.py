from decimal import Decimal as D

import pytest
from tests.ledger import OLDER_ORDINARY, day, detail_row, ledger, rows_of

from vecindad.operators.payments import collected, payment_lines
from vecindad.plans.charges import generate_documents, link_costs
from vecindad.plans.reports import monthly_collection_pivot, top_months, weekly_cash_flow
from vecindad.sinks.xml import WEEK_ROW, element, weekly_layout, write_weekly_xml
from vecindad.sources.tables import table_from_rows
from tests.ledger import OLDER_EXTRAORDINARY

DETAIL = [
    detail_row(11, "2025-01-10", "100.00"),
    detail_row(11, "2025-01-20", "50.00", copies=2),
    detail_row(12, "2025-12-31", "10.00"),
    detail_row(21, "2024-12-31", "7.00"),
    (None, 1, None, "9" * 22, day("2025-02-01"), D("5.00"), 1),  # no unit
]


@pytest.fixture()
def costs(spark):
    t = ledger(
        spark, Gasto_Ordinario=OLDER_ORDINARY, Gasto_Extraordinario=OLDER_EXTRAORDINARY,
        Detalle_CSV=DETAIL,
    )
    months = [(2025, m) for m in (8, 9, 10)]
    documents = generate_documents(t["Consorcio"], t["Expensas"], months)
    # The cost of August stays without a document and is left out of the report.
    linked = link_costs(t["Gasto_Extraordinario"], documents.where("mes <> 8"))
    return {**t, "Gasto_Extraordinario": linked, "Expensas": documents}


def flow(costs, **options):
    return weekly_cash_flow(
        costs["Gasto_Ordinario"], costs["Gasto_Extraordinario"], costs["Expensas"],
        costs["Consorcio"], **options,
    )


COLUMNS = ("Consorcio", "Semana", "TotalOrdinarios", "TotalExtraordinarios", "TotalGeneral", "Acumulado")


def test_weekly_cash_flow(costs):
    assert rows_of(flow(costs, year=2025), *COLUMNS) == [
        ("Alberdi", 34, D(70000), D(0), D(70000), D(70000)),
        ("Alzaga", 38, D(0), D(120000), D(120000), D(120000)),
        ("Alzaga", 41, D(50000), D(150000), D(200000), D(320000)),
        ("Azcuenaga", 38, D(80000), D(0), D(80000), D(80000)),
        ("Azcuenaga", 41, D(90000), D(100000), D(190000), D(270000)),
    ]
    assert flow(costs, year=2024).count() == 0


def test_running_total_starts_at_first_shown_week(costs):
    found = rows_of(flow(costs, year=2025, building_id=2, first_week=40, last_week=45), *COLUMNS)
    assert found == [("Alzaga", 41, D(50000), D(150000), D(200000), D(200000))]


def test_weekly_xml(costs, tmp_path, spark):
    report = flow(costs, year=2025, building_id=1)
    layout = weekly_layout(report)
    texts = [r.x for r in layout.select(element(layout, WEEK_ROW).alias("x")).collect()]
    assert texts[0].split() == (
        '<Semana Anio="2025" Semana="38" Consorcio="Azcuenaga"> <Totales>'
        " <Ordinarios>80000.00</Ordinarios> <Extraordinarios>0.00</Extraordinarios>"
        " <General>80000.00</General> <Acumulado>80000.00</Acumulado> </Totales> </Semana>"
    ).split()
    write_weekly_xml(report, str(tmp_path / "xml"))
    back = spark.read.option("rowTag", "Semana").xml(str(tmp_path / "xml"))
    assert rows_of(back.select("_Semana", "Totales.Acumulado"), "_Semana", "Acumulado") == [
        (38, 80000.0), (41, 270000.0),
    ]


def test_collection_pivot(costs):
    report = monthly_collection_pivot(
        collected(costs["Detalle_CSV"]), costs["Unidad_Funcional"], costs["Consorcio"], year=2025
    )
    rows = {(r.Consorcio, r.UnidadFuncional): r for r in report.collect()}
    assert set(rows) == {("Azcuenaga", "1 A"), ("Azcuenaga", "10B")}
    first = rows["Azcuenaga", "1 A"]
    assert (first.Enero, first.Febrero, first.Diciembre, first.TotalAnual) == (200, 0, 0, 200)
    assert report.columns[:3] == ["Consorcio", "UnidadFuncional", "Enero"]
    every_year = monthly_collection_pivot(
        collected(costs["Detalle_CSV"]), costs["Unidad_Funcional"], costs["Consorcio"]
    )
    assert ("Alzaga", "1 A", 2024) in rows_of(every_year, "Consorcio", "UnidadFuncional", "Anio")
    only = monthly_collection_pivot(
        collected(costs["Detalle_CSV"]), costs["Unidad_Funcional"], costs["Consorcio"],
        year=2025, building_id=2,
    )
    assert only.count() == 0


def test_top_months(costs):
    def top(**options):
        frame = top_months(
            costs["Gasto_Ordinario"], costs["Gasto_Extraordinario"],
            collected(costs["Detalle_CSV"]), costs["Unidad_Funcional"], costs["Consorcio"],
            **options,
        )
        return [(r.Tipo, r.Anio, r.Mes, int(r.Monto)) for r in frame.collect()]

    assert top(first_year=2025, last_year=2025) == [
        ("Gasto", 2025, 10, 390000),
        ("Gasto", 2025, 8, 270000),
        ("Gasto", 2025, 9, 200000),
        ("Ingreso", 2025, 1, 200),
        ("Ingreso", 2025, 12, 10),
    ]
    assert top(building_id=2, n=1) == [("Gasto", 2025, 10, 200000), ("Ingreso", 2024, 12, 7)]


def test_separately_stored_payments(spark):
    """Detail and payments joined by payment give the same sums as detail with units."""
    detail = table_from_rows(
        spark, "Detalle_CSV",
        [("p1", 1, None, "a", day("2025-01-10"), D("100.00"), 1),
         ("p1", 1, None, "a", day("2025-01-10"), D("100.00"), 1),
         ("p2", 1, None, "b", day("2025-01-11"), D("5.00"), 1)],
    )
    payments = table_from_rows(
        spark, "Pago", [("p1", 11, "a", D("100.00"), True), ("p2", None, "b", D("5.00"), False)]
    )
    assert rows_of(payment_lines(detail, payments), "unidadFuncionalID", "importe", "monto") == [
        (11, D("200.00"), D("200.00")), (None, D("5.00"), D("5.00")),
    ]


def test_year_reaches_the_file_scan(spark, tmp_path, costs):
    path = str(tmp_path / "costs")
    costs["Gasto_Ordinario"].write.parquet(path)
    stored = spark.read.schema(costs["Gasto_Ordinario"].schema).parquet(path)
    report = flow({**costs, "Gasto_Ordinario": stored}, year=2025)
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(fecha,2025-01-01), LessThan(fecha,2026-01-01)" in plan
    assert "ReadSchema: struct<consorcioID:bigint,fecha:date,importeTotal:decimal(14,2)>" in plan
