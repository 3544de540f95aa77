"""Ordinary and extraordinary costs by building and month.

An extraordinary cost charges its amount in every month in which it is active.
The active months of a cost always form one run, so instead of repeating the
row for each of them the totals work with two marks per cost -- plus the
charge at the first month, minus the charge after the last -- that are summed
by building and month and then accumulated.  Work per cost is constant, and the
marks combine before they are shuffled.

``mode="reference"`` keeps two habits of the original rules: the last
instalment is charged only if the cost was dated on the last day of a month
(or its shifted date falls on one), and a one-off cost with several instalments
is charged in full in each of them.  ``mode="strict"`` charges every instalment
exactly once and one-off costs in their own month only.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vecindad.functions.amounts import truncated_share
from vecindad.functions.dates import (
    index_month,
    index_year,
    month_bounds,
    month_index,
    within,
)
from vecindad.schemas import MONEY

MODES = ("reference", "strict")


def check_mode(mode: str) -> None:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode!r}")


def charge_per_month() -> Column:
    """Amount one extraordinary cost adds to each of its active months."""
    amount = F.col("importeTotal").cast("decimal(14,2)")
    return (
        F.when(F.col("formaPago") == "TOTAL", amount.cast("decimal(18,6)"))
        .when(
            F.col("formaPago") == "CUOTAS",
            F.coalesce(truncated_share(amount, F.col("nroCuota")), F.lit(0).cast("decimal(18,6)")),
        )
        .otherwise(F.lit(0).cast("decimal(18,6)"))
    )


def last_active_month(mode: str) -> Column:
    """Month index of the last month the cost is charged in."""
    own, parts = month_index(F.col("fecha")), F.col("nroCuota").cast("int")
    if mode == "strict":
        last = F.when(F.col("formaPago") == "CUOTAS", own + parts - 1)
    else:
        shifted = F.add_months(F.col("fecha"), parts - 1)
        last = F.when(
            shifted == F.last_day(shifted), month_index(shifted)
        ).otherwise(month_index(shifted) - 1)
    return F.greatest(own, F.coalesce(last, own))


def charge_marks(costs: DataFrame, mode: str) -> DataFrame:
    """(consorcioID, periodo, cambio): the two marks of every extraordinary cost."""
    starts = F.struct(
        month_index(F.col("fecha")).alias("periodo"), charge_per_month().alias("cambio")
    )
    ends = F.struct(
        (last_active_month(mode) + 1).alias("periodo"), (-charge_per_month()).alias("cambio")
    )
    return costs.select("consorcioID", F.inline(F.array(starts, ends)))


def installment_schedule(costs: DataFrame, mode: str = "reference") -> DataFrame:
    """One row per extraordinary cost and month in which it is charged."""
    check_mode(mode)
    months = F.sequence(month_index(F.col("fecha")), last_active_month(mode))
    listed = costs.select(
        "gastoExtraordinarioID",
        "consorcioID",
        charge_per_month().alias("cuota"),
        F.explode(months).alias("periodo"),
    )
    return listed.select(
        "gastoExtraordinarioID",
        "consorcioID",
        index_year(F.col("periodo")).alias("anio"),
        index_month(F.col("periodo")).alias("mes"),
        "cuota",
    )


def monthly_cost_totals(
    buildings: DataFrame,
    ordinary: DataFrame,
    extraordinary: DataFrame,
    first: tuple[int, int],
    last: tuple[int, int],
    mode: str = "reference",
) -> DataFrame:
    """Cost totals of every building for each month from ``first`` to ``last``.

    Months without any cost are kept with zeros.  Periods are (year, month).
    """
    check_mode(mode)
    lo, hi = first[0] * 12 + first[1] - 1, last[0] * 12 + last[1] - 1
    first_day, last_day = month_bounds(*first)[0], month_bounds(*last)[1]
    none, no_change = F.lit(0).cast(MONEY), F.lit(0).cast("decimal(19,6)")

    running = ordinary.where(within(F.col("fecha"), first_day, last_day)).select(
        "consorcioID",
        month_index(F.col("fecha")).alias("periodo"),
        F.col("importeTotal").cast(MONEY).alias("ordinario"),
        no_change.alias("cambio"),
        F.lit(0).alias("propio"),
    )
    # Marks from before the span add up to the state it begins with.
    marks = charge_marks(extraordinary.where(F.col("fecha") <= F.lit(last_day)), mode).select(
        "consorcioID",
        F.greatest(F.col("periodo"), F.lit(lo)).alias("periodo"),
        none.alias("ordinario"),
        F.col("cambio").cast("decimal(19,6)").alias("cambio"),
        F.lit(0).alias("propio"),
    )
    grid = buildings.select(
        "consorcioID",
        F.explode(F.sequence(F.lit(lo), F.lit(hi))).alias("periodo"),
        none.alias("ordinario"),
        no_change.alias("cambio"),
        F.lit(1).alias("propio"),
    )
    cells = (
        running.unionByName(marks.where(F.col("periodo") <= hi))
        .unionByName(grid)
        .groupBy("consorcioID", "periodo")
        .agg(
            F.sum("ordinario").cast(MONEY).alias("expOrdinarias"),
            F.sum("cambio").cast("decimal(26,6)").alias("cambio"),
            F.max("propio").alias("propio"),
        )
    )
    so_far = W.partitionBy("consorcioID").orderBy("periodo").rowsBetween(W.unboundedPreceding, 0)
    return (
        cells.withColumn("expExtraordinarias", F.sum("cambio").over(so_far).cast(MONEY))
        .where(F.col("propio") == 1)  # else the cost of an unknown building
        .join(buildings.select("consorcioID", F.col("nombre").alias("consorcio")), "consorcioID")
        .select(
            "consorcioID",
            "consorcio",
            index_month(F.col("periodo")).alias("mes"),
            index_year(F.col("periodo")).alias("anio"),
            "expOrdinarias",
            "expExtraordinarias",
            (F.col("expOrdinarias") + F.col("expExtraordinarias")).cast(MONEY).alias("totalGeneral"),
        )
    )


def period_cost_totals(
    buildings: DataFrame,
    ordinary: DataFrame,
    extraordinary: DataFrame,
    year: int,
    month: int,
    mode: str = "reference",
) -> DataFrame:
    """The totals of a single month: two filtered sums joined to the buildings."""
    check_mode(mode)
    first_day, last_day = month_bounds(year, month)
    here = year * 12 + month - 1
    running = ordinary.where(within(F.col("fecha"), first_day, last_day))
    active = extraordinary.where(
        (F.col("fecha") < F.lit(last_day + dt.timedelta(days=1)))
        & (last_active_month(mode) >= here)
    )
    zero = F.lit(0).cast(MONEY)
    return (
        buildings.select("consorcioID", F.col("nombre").alias("consorcio"))
        .join(
            running.groupBy("consorcioID").agg(F.sum("importeTotal").cast(MONEY).alias("ord")),
            "consorcioID",
            "left",
        )
        .join(
            active.groupBy("consorcioID").agg(F.sum(charge_per_month()).cast(MONEY).alias("ext")),
            "consorcioID",
            "left",
        )
        .select(
            "consorcioID",
            "consorcio",
            F.lit(month).alias("mes"),
            F.lit(year).alias("anio"),
            F.coalesce("ord", zero).alias("expOrdinarias"),
            F.coalesce("ext", zero).alias("expExtraordinarias"),
            (F.coalesce("ord", zero) + F.coalesce("ext", zero)).cast(MONEY).alias("totalGeneral"),
        )
    )


def quota_table_totals(
    costs: DataFrame, quotas: DataFrame, kind: str = "tipoGasto"
) -> DataFrame:
    """Extraordinary totals of all months under the older layout, in which the
    instalments are listed in a table of their own.

    A cost whose ``kind`` is CUOTAS adds its listed instalments, any other its
    amount once per listed instalment (once if it has none).  Each counts in the
    month of the cost and in the month reached by moving the cost's date on by
    the instalment number.  Equal instalments are summed before the join.
    """
    plan = quotas.groupBy(
        "gastoExtraordinarioID", F.col("nroCuota").cast("int").alias("nroCuota")
    ).agg(F.sum("importeCuota").cast(MONEY).alias("cuotas"), F.count("*").alias("filas"))
    listed = costs.select(
        "gastoExtraordinarioID", "consorcioID", "fecha", "importeTotal", F.col(kind).alias("clase")
    ).join(plan, "gastoExtraordinarioID", "left")
    own = month_index(F.col("fecha"))
    due = month_index(F.add_months(F.col("fecha"), F.col("nroCuota")))
    charge = F.when(F.col("clase") == "CUOTAS", F.col("cuotas")).otherwise(
        (F.col("importeTotal") * F.coalesce("filas", F.lit(1))).cast(MONEY)
    )
    charged = listed.select(
        "consorcioID",
        charge.alias("importe"),
        F.explode(F.array_distinct(F.array_compact(F.array(own, due)))).alias("periodo"),
    )
    totals = charged.groupBy("consorcioID", "periodo").agg(
        F.sum("importe").cast(MONEY).alias("importeTotal")
    )
    return totals.select(
        "consorcioID",
        index_year(F.col("periodo")).alias("anio"),
        index_month(F.col("periodo")).alias("mes"),
        "importeTotal",
    )
