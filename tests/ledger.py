"""A small ledger used by several tests."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from vecindad.sources.tables import empty_table, table_from_rows

D = Decimal


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


BUILDINGS = [
    (1, "Azcuenaga", "Belgrano 3344", D("1281")),
    (2, "Alzaga", "Callao 1122", D("914")),
    (3, "Alberdi", "Santa Fe 910", D("784")),
    (4, "Unzue", "Corrientes 5678", D("1316")),
    (5, "Pereyra Iraola", "Rivadavia 1234", D("1691")),
]

ACCOUNT = {unit: f"{unit:022d}" for unit in range(11, 33)}

UNITS = [
    (11, 1, "1", "A", D("50"), 1, 0, ACCOUNT[11], D("60.00")),
    (12, 1, "10", "B", D("60"), 0, 0, ACCOUNT[12], D("40.00")),
    (21, 2, "1", "A", D("70"), 0, 1, ACCOUNT[21], D("2.50")),
    (31, 3, "2", "C", D("80"), 0, 0, None, D("99.99")),
]

OWNERS = [
    (1, "20111111", 11, "Ana", "Paz", None, None, "Mail", None),
    (2, "20222222", 12, "Luis", "Gil", None, None, "Mail", None),
    (3, "20333333", 12, "Eva", "Gil", None, None, "Mail", None),
    (4, "20444444", None, "Nadie", "Sin Unidad", None, None, "Mail", None),
]

# The two literal rows of the final batch.
EXTRAORDINARY = [
    (1, None, 1, "Reparación ascensor", day("2025-04-05"), D("250000.00"), "TOTAL", 1),
    (2, None, 2, "Cambio cañerías", day("2025-04-12"), D("450000.00"), "CUOTAS", 3),
]

# The literal rows of the older batch (with the number of instalments added).
OLDER_EXTRAORDINARY = [
    (1, None, 1, "Pintura fachada", day("2025-10-08"), D("100000.00"), "TOTAL", 1),
    (2, None, 2, "Cambio ascensor", day("2025-10-09"), D("150000.00"), "CUOTAS", 3),
    (3, None, 2, "Reparación caldera", day("2025-09-15"), D("120000.00"), "TOTAL", 1),
    (4, None, 3, "Impermeabilización techo", day("2025-08-10"), D("200000.00"), "CUOTAS", 4),
]
OLDER_ORDINARY = [
    (1, None, 1, day("2025-09-15"), D("80000.00")),
    (2, None, 1, day("2025-10-05"), D("90000.00")),
    (3, None, 2, day("2025-10-10"), D("50000.00")),
    (4, None, 3, day("2025-08-20"), D("70000.00")),
]


def detail_row(unit: int | None, date: str, amount: str, copies: int = 1, account: str | None = None):
    return (None, 1, unit, account or ACCOUNT[unit], day(date), D(amount), copies)


def ledger(spark: SparkSession, **rows) -> dict[str, DataFrame]:
    """Tables by name; the given rows replace the defaults."""
    content = {
        "Consorcio": BUILDINGS,
        "Unidad_Funcional": UNITS,
        "Propietario": OWNERS,
        "Expensas": [],
        "Gasto_Ordinario": [],
        "Gasto_Extraordinario": [],
        "Detalle_CSV": [],
        "Estado_Financiero": [],
        "Estado_Cuentas": [],
        **rows,
    }
    return {
        name: table_from_rows(spark, name, table) if table else empty_table(spark, name)
        for name, table in content.items()
    }


def rows_of(frame: DataFrame, *columns: str) -> list[tuple]:
    return sorted(map(tuple, frame.select(*columns).collect()), key=repr)
