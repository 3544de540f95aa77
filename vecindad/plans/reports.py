"""Management reports.

Arguments left at ``None`` add no filter.  Year limits become date ranges on
the stored column, so they reach the file scan.  Facts are summed by their own
key and period before any join; the joins then see one row per key and period.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecindad.functions.dates import MONTH_NAMES, week_of_year
from vecindad.functions.text import unit_label
from vecindad.schemas import MONEY, TOTAL


def _years(date: str, first: int | None, last: int | None) -> Column:
    """Range condition for whole years, open where a limit is missing."""
    condition = F.lit(True)
    if first is not None:
        condition = condition & (F.col(date) >= F.lit(dt.date(first, 1, 1)))
    if last is not None:
        condition = condition & (F.col(date) < F.lit(dt.date(last + 1, 1, 1)))
    return condition


def weekly_cash_flow(
    ordinary: DataFrame,
    extraordinary: DataFrame,
    documents: DataFrame,
    buildings: DataFrame,
    year: int | None = None,
    building_id: int | None = None,
    first_week: int | None = None,
    last_week: int | None = None,
    all_years: bool = False,
) -> DataFrame:
    """Cost per building and week with a running total over the year.

    Without ``year`` the current one is reported, or every year if
    ``all_years`` is set.  The running total starts at the first reported week.
    Extraordinary costs count for the building of their document; those without
    a document are left out.
    """
    if year is None and not all_years:
        year = dt.date.today().year
    in_year = _years("fecha", year, year)
    period = [F.year("fecha").alias("Anio"), week_of_year(F.col("fecha")).alias("Semana")]

    if building_id is not None:
        ordinary = ordinary.where(F.col("consorcioID") == building_id)
        documents = documents.where(F.col("consorcioID") == building_id)

    def in_weeks(frame: DataFrame) -> DataFrame:
        """Before the join, where it reaches the scan; the total starts at the first week reported."""
        week = week_of_year(F.col("fecha"))
        if first_week is not None:
            frame = frame.where(week >= first_week)
        return frame if last_week is None else frame.where(week <= last_week)

    by_week = (
        in_weeks(ordinary.where(in_year))
        .groupBy("consorcioID", *period)
        .agg(F.sum("importeTotal").cast(TOTAL).alias("TotalOrdinarios"))
    )
    by_document = (
        in_weeks(extraordinary.where(in_year))
        .groupBy("documentoID", *period)
        .agg(F.sum("importeTotal").cast(TOTAL).alias("importe"))
    )
    extra_by_week = (
        by_document.join(documents.select("documentoID", "consorcioID"), "documentoID")
        .groupBy("consorcioID", "Anio", "Semana")
        .agg(F.sum("importe").cast(TOTAL).alias("TotalExtraordinarios"))
    )
    zero = F.lit(0).cast(TOTAL)
    both = by_week.join(extra_by_week, ["consorcioID", "Anio", "Semana"], "full").select(
        "consorcioID",
        "Anio",
        "Semana",
        F.coalesce("TotalOrdinarios", zero).alias("TotalOrdinarios"),
        F.coalesce("TotalExtraordinarios", zero).alias("TotalExtraordinarios"),
    )
    named = both.join(
        buildings.select("consorcioID", F.col("nombre").alias("Consorcio")), "consorcioID"
    )
    so_far = (
        W.partitionBy("consorcioID", "Anio")
        .orderBy("Semana")
        .rowsBetween(W.unboundedPreceding, W.currentRow)
    )
    total = (F.col("TotalOrdinarios") + F.col("TotalExtraordinarios")).cast(TOTAL)
    return (
        named.withColumn("TotalGeneral", total)
        .withColumn("Acumulado", F.sum("TotalGeneral").over(so_far).cast(TOTAL))
        .select(
            "Anio",
            "Semana",
            "consorcioID",
            "Consorcio",
            "TotalOrdinarios",
            "TotalExtraordinarios",
            "TotalGeneral",
            "Acumulado",
        )
        .orderBy("Consorcio", "Anio", "Semana")
    )


def monthly_collection_pivot(
    lines: DataFrame,
    units: DataFrame,
    buildings: DataFrame,
    year: int | None = None,
    building_id: int | None = None,
) -> DataFrame:
    """Collected amount per unit with a column for each month and a row total.

    ``lines`` as given by ``operators.payments.collected``.  Units are shown by
    building name and unit label; ``year=None`` reports every year, one row each.
    The twelve months are summed side by side, so the pivot needs no shuffle of
    its own.
    """
    names = [n.capitalize() for n in MONTH_NAMES]
    month = F.month("fechaPago")
    by_unit = (
        lines.where(_years("fechaPago", year, year) & F.col("unidadFuncionalID").isNotNull())
        .groupBy("unidadFuncionalID", F.year("fechaPago").alias("Anio"))
        .agg(
            *[
                F.sum(F.when(month == i, F.col("importe"))).cast(MONEY).alias(n)
                for i, n in enumerate(names, start=1)
            ]
        )
    )
    if building_id is not None:
        units = units.where(F.col("consorcioID") == building_id)
    label = unit_label(F.col("piso"), F.col("departamento"))
    placed = (
        by_unit.join(
            units.select("unidadFuncionalID", "consorcioID", label.alias("UnidadFuncional")),
            "unidadFuncionalID",
        )
        .join(buildings.select("consorcioID", F.col("nombre").alias("Consorcio")), "consorcioID")
        .groupBy("Consorcio", "UnidadFuncional", "Anio")
        .agg(*[F.coalesce(F.sum(n), F.lit(0)).cast(MONEY).alias(n) for n in names])
    )
    whole_year = reduce(Column.__add__, [F.col(n) for n in names])
    keys = ["Consorcio", "UnidadFuncional"] + ([] if year is not None else ["Anio"])
    return placed.select(*keys, *names, whole_year.cast(MONEY).alias("TotalAnual")).orderBy(*keys)


def top_months(
    ordinary: DataFrame,
    extraordinary: DataFrame,
    lines: DataFrame,
    units: DataFrame,
    buildings: DataFrame,
    first_year: int | None = None,
    last_year: int | None = None,
    building_id: int | None = None,
    n: int = 5,
) -> DataFrame:
    """The ``n`` months with most cost and the ``n`` months with most income.

    Equal amounts are ordered by year and month.
    """

    def months(frame: DataFrame, date: str, amount: str) -> DataFrame:
        return frame.groupBy(F.year(date).alias("Anio"), F.month(date).alias("Mes")).agg(
            F.sum(amount).cast(TOTAL).alias("Monto")
        )

    def top(frame: DataFrame, kind: str) -> DataFrame:
        order = [F.desc("Monto"), "Anio", "Mes"]
        return frame.orderBy(*order).limit(n).withColumn("Tipo", F.lit(kind))

    in_years = _years("fecha", first_year, last_year)
    if building_id is not None:
        in_years = in_years & (F.col("consorcioID") == building_id)
        buildings = buildings.where(F.col("consorcioID") == building_id)
    cost = (
        months(ordinary.where(in_years), "fecha", "importeTotal")
        .unionByName(months(extraordinary.where(in_years), "fecha", "importeTotal"))
        .groupBy("Anio", "Mes")
        .agg(F.sum("Monto").cast(TOTAL).alias("Monto"))
    )
    by_unit = (
        lines.where(_years("fechaPago", first_year, last_year))
        .where(F.col("unidadFuncionalID").isNotNull())
        .groupBy(
            "unidadFuncionalID", F.year("fechaPago").alias("Anio"), F.month("fechaPago").alias("Mes")
        )
        .agg(F.sum("importe").cast(TOTAL).alias("Monto"))
    )
    income = (
        by_unit.join(units.select("unidadFuncionalID", "consorcioID"), "unidadFuncionalID")
        .join(buildings.select("consorcioID"), "consorcioID")
        .groupBy("Anio", "Mes")
        .agg(F.sum("Monto").cast(TOTAL).alias("Monto"))
    )
    return top(cost, "Gasto").unionByName(top(income, "Ingreso")).orderBy(
        "Tipo", F.desc("Monto"), "Anio", "Mes"
    )
