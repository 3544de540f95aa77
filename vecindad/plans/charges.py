"""The monthly charge run.

``run_period`` computes one month from the stored tables; ``charge_history``
computes a whole span of months in one pass.  Both give the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.functions.dates import (
    index_month,
    index_year,
    month_bounds,
    month_index,
    month_indexes,
    month_number,
    previous_period,
    resolve_period,
    session_date,
    within,
)
from vecindad.functions.text import comparable, joined, surrogate
from vecindad.operators.changes import insert_if_missing, update_from_join
from vecindad.operators.costs import check_mode, monthly_cost_totals, period_cost_totals
from vecindad.operators.history import account_history, position_history
from vecindad.operators.interest import account_amounts, as_money, position_amounts, to_cents
from vecindad.operators.joins import lookup_join
from vecindad.operators.payments import (
    collected,
    paid_by_account,
    paid_by_building,
    paid_by_unit,
)
from vecindad.schemas import DELIVERY, TABLES
from vecindad.plans.reports import weekly_cash_flow
from vecindad.sinks.tables import append
from vecindad.sinks.xml import write_statement_xml
from vecindad.sources.tables import read_stored

PERIOD = ("anio", "mes")


def _in_order(frame: DataFrame, table: str) -> DataFrame:
    return frame.select(*TABLES[table].fieldNames())


def generate_documents(
    buildings: DataFrame,
    documents: DataFrame,
    periods: Sequence[tuple[int, int]],
    run_date: dt.date | None = None,
) -> DataFrame:
    """New charge documents: one per building and period, where none exists."""
    day = F.lit(run_date) if run_date else F.current_date()
    wanted = buildings.select("consorcioID", F.explode(month_indexes(periods)).alias("_periodo")).select(
        "consorcioID", index_year(F.col("_periodo")).alias("anio"), index_month(F.col("_periodo")).alias("mes")
    )
    missing = insert_if_missing(wanted, documents, ["consorcioID", "anio", "mes"])
    return missing.select(
        surrogate(F.col("consorcioID"), F.col("anio"), F.col("mes")).alias("documentoID"),
        "consorcioID",
        "mes",
        "anio",
        day.alias("fechaGenerado"),
        day.alias("fechaEnvio"),
        F.lit(DELIVERY[0]).alias("medioEnvio"),
        F.lit(True).alias("aPropietario"),
        F.lit(False).alias("aInquilino"),
    )


def link_costs(costs: DataFrame, documents: DataFrame) -> DataFrame:
    """Costs without a document get the one of their building and month."""
    dated = costs.withColumn("anio", F.year("fecha")).withColumn("mes", F.month("fecha"))
    linked = update_from_join(
        dated,
        documents.select("consorcioID", "anio", "mes", F.col("documentoID").alias("_doc")),
        ["consorcioID", "anio", "mes"],
        {"documentoID": "_doc"},
        only_when=F.col("documentoID").isNull(),
    )
    return linked.select(*costs.columns)


def financial_position(
    documents: DataFrame,
    totals: DataFrame,
    positions: DataFrame,
    by_building: DataFrame,
    year: int,
    month: int,
    mode: str = "reference",
) -> DataFrame:
    """Cash position of every building with a document in the period.

    ``documents`` and ``positions`` hold the earlier months as well.  Strict
    mode leaves out documents that have a position already.
    """
    check_mode(mode)
    before = _previous_rows(documents, positions, year, month).select(
        "consorcioID",
        to_cents(F.col("saldoFinal")).alias("saldoPrevio"),
        to_cents(F.col("egresosTotales")).alias("egresosPrevios"),
    )
    current = _of_period(documents, year, month)
    if mode == "strict":
        done = _of_period(positions, year, month).select("documentoID")
        current = current.join(done, "documentoID", "left_anti")
    sums = ("hasta10", "hasta15", "desde10", "desde11")
    paid = by_building.where(F.col("periodo") == year * 12 + month - 2).select(
        "consorcioID", *[to_cents(F.col(c)).alias(c) for c in sums]
    )
    joined_rows = (
        current.select("documentoID", "consorcioID")
        .join(before, "consorcioID", "left")
        .join(paid, "consorcioID", "left")
        .join(_totals_for_join(totals), "consorcioID", "left")
    )
    amounts = as_money(position_amounts(F.col, mode))
    return joined_rows.select("documentoID", "consorcioID", *amounts)


def unit_accounts(
    documents: DataFrame,
    units: DataFrame,
    totals: DataFrame,
    accounts: DataFrame,
    by_account: DataFrame,
    by_unit: DataFrame,
    year: int,
    month: int,
    policy: str = "partial_payment",
    mode: str = "reference",
) -> DataFrame:
    """Account rows of the period for documents that have none yet."""
    check_mode(mode)
    previous = year * 12 + month - 2
    before = _previous_rows(documents, accounts, year, month).select(
        "unidadFuncionalID",
        to_cents(F.col("totalPagar")).alias("previo"),
        to_cents(F.col("saldo")).alias("saldoPrevio"),
    )
    due = by_unit.where(F.col("periodo") == previous).select(
        "unidadFuncionalID",
        to_cents(F.col("hasta10")).alias("hasta10"),
        to_cents(F.col("hasta15")).alias("hasta15"),
        to_cents(F.col("pagado")).alias("_pagado"),
        F.col("ultimo").alias("_ultimo"),
    )
    done = _of_period(accounts, year, month).groupBy("documentoID").agg(F.lit(1).alias("_done"))
    current = _of_period(documents, year, month).join(done, "documentoID", "left_anti")
    charged = current.select("documentoID", "consorcioID").join(
        _totals_for_join(totals), "consorcioID", "left"
    )
    rows = (
        lookup_join(
            units.withColumn("_cuenta", comparable(F.col("CBU_CVU"))), charged, ["consorcioID"]
        )
        .join(before, "unidadFuncionalID", "left")
        .join(due, "unidadFuncionalID", "left")
    )
    if mode == "reference":
        paid = by_account.where(F.col("periodo") == previous).select(
            "_cuenta", to_cents(F.col("pagos")).alias("pagos"), F.col("ultimoPago").alias("ultimo")
        )
        rows = rows.join(paid, "_cuenta", "left")
    else:
        rows = rows.withColumn("pagos", F.col("_pagado")).withColumn("ultimo", F.col("_ultimo"))
    amounts = as_money(account_amounts(F.col, policy))
    return rows.withColumn(
        "coeficiente", (F.col("coeficiente").cast("decimal(4,2)") * 100).cast("bigint")
    ).select("documentoID", "unidadFuncionalID", *amounts)


def _of_period(frame: DataFrame, year: int, month: int) -> DataFrame:
    """Rows of one period, if the table carries it (stored tables do)."""
    if not set(PERIOD) <= set(frame.columns):
        return frame
    return frame.where((F.col("anio") == year) & (F.col("mes") == month))


def _previous_rows(documents: DataFrame, rows: DataFrame, year: int, month: int) -> DataFrame:
    """Rows that belong to the documents of the month before."""
    before = previous_period(year, month)
    earlier = _of_period(documents, *before).select("documentoID", "consorcioID")
    return _of_period(rows, *before).drop("consorcioID", *PERIOD).join(earlier, "documentoID")


def _totals_for_join(totals: DataFrame) -> DataFrame:
    return totals.select(
        "consorcioID",
        to_cents(F.col("expOrdinarias")).alias("ordinario"),
        to_cents(F.col("expExtraordinarias")).alias("extra"),
    )


def unit_statement(
    documents: DataFrame,
    accounts: DataFrame,
    units: DataFrame,
    owners: DataFrame,
    year: int | None = None,
    month: int | None = None,
) -> DataFrame:
    """Statement lines of the period (of all periods without one).

    Accounts that carry their period need no documents.

    A unit without owner is left out, one with several owners is repeated.
    """
    if not set(PERIOD) <= set(accounts.columns):
        accounts = accounts.join(documents.select("documentoID", *PERIOD), "documentoID")
    # On the accounts themselves: their partitions are months.
    if year is not None:
        accounts = accounts.where(F.col("anio") == year)
    if month is not None:
        accounts = accounts.where(F.col("mes") == month)
    owner = owners.where(F.col("unidadFuncionalID").isNotNull()).select(
        "unidadFuncionalID",
        joined(" ", F.col("apellido"), F.col("nombre")).alias("Propietario"),
    )
    place = units.select(
        "unidadFuncionalID",
        "coeficiente",
        "cochera",
        joined("-", F.rpad("piso", 2, " "), F.col("departamento")).alias("PisoDepto"),
    )
    rows = (
        accounts.drop("consorcioID")
        .join(place, "unidadFuncionalID")
        .join(owner, "unidadFuncionalID")
    )
    period = [] if year is not None and month is not None else list(PERIOD)
    return rows.select(
        *period,
        F.col("unidadFuncionalID").alias("uf"),
        F.col("coeficiente").alias("Porcentaje"),
        "PisoDepto",
        "Propietario",
        F.col("saldoAnterior").alias("SaldoAnterior"),
        F.col("pagosRecibidos").alias("PagosRecibidos"),
        F.col("saldo").alias("SaldoAFavor"),
        F.col("InteresesPorMora").alias("InteresMora"),
        F.col("expensasOrdinarias").alias("ExpensasOrdinarias"),
        F.col("cochera").alias("Cocheras"),
        F.col("expensasExtraordinarias").alias("ExpensasExtraordinarias"),
        F.col("totalPagar").alias("TotalPagar"),
    )


def run_period(
    tables: Mapping[str, DataFrame],
    year: int | None = None,
    month: int | None = None,
    *,
    mode: str = "reference",
    policy: str = "partial_payment",
    run_date: dt.date | None = None,
) -> dict[str, DataFrame]:
    """All results of one monthly run, as plans; nothing is executed here.

    ``tables`` holds the stored tables by name.  New rows are returned for
    documents, positions and accounts, whole tables for the two cost tables
    (with documents filled in).  Without a period the month before today is run, by the session's time zone.
    """
    year, month = resolve_period(year, month, run_date or session_date(tables["Consorcio"].sparkSession))
    buildings, units = tables["Consorcio"], tables["Unidad_Funcional"]
    new_documents = generate_documents(buildings, tables["Expensas"], [(year, month)], run_date)
    documents = tables["Expensas"].unionByName(new_documents)
    totals = period_cost_totals(
        buildings, tables["Gasto_Ordinario"], tables["Gasto_Extraordinario"], year, month, mode
    )
    lines = _lines_of_month(tables["Detalle_CSV"], *previous_period(year, month))
    return {
        "Expensas": _in_order(new_documents, "Expensas"),
        "TotalesGastos": totals,
        "Estado_Financiero": financial_position(
            documents,
            totals,
            tables["Estado_Financiero"],
            paid_by_building(lines, units),
            year,
            month,
            mode,
        ),
        "Gasto_Ordinario": link_costs(tables["Gasto_Ordinario"], documents),
        "Gasto_Extraordinario": link_costs(tables["Gasto_Extraordinario"], documents),
        "Estado_Cuentas": unit_accounts(
            documents,
            units,
            totals,
            tables["Estado_Cuentas"],
            paid_by_account(lines),
            paid_by_unit(lines),
            year,
            month,
            policy,
            mode,
        ),
    }


def _lines_of_month(detail: DataFrame, year: int, month: int) -> DataFrame:
    return collected(detail.where(within(F.col("fechaPago"), *month_bounds(year, month))))


def charge_history(
    tables: Mapping[str, DataFrame],
    first: tuple[int, int],
    last: tuple[int, int],
    *,
    mode: str = "reference",
    policy: str = "partial_payment",
    run_date: dt.date | None = None,
) -> dict[str, DataFrame]:
    """Documents, totals, positions and accounts for every month of a span.

    Equal to running the months one after the other: balances stored for the month before
    the span are continued, and months of the span that have their positions or
    accounts already keep them and are not given again.
    """
    buildings, units = tables["Consorcio"], tables["Unidad_Funcional"]
    months = [
        (index // 12, index % 12 + 1)
        for index in range(first[0] * 12 + first[1] - 1, last[0] * 12 + last[1])
    ]
    new_documents = generate_documents(buildings, tables["Expensas"], months, run_date)
    totals = monthly_cost_totals(
        buildings, tables["Gasto_Ordinario"], tables["Gasto_Extraordinario"], first, last, mode
    )
    documents = tables["Expensas"].unionByName(new_documents)
    charged = documents_with_totals(documents, totals)
    # Payments count in the month after.
    start = previous_period(*first)
    span = within(F.col("fechaPago"), month_bounds(*start)[0], month_bounds(*last)[1])
    lines = collected(tables["Detalle_CSV"].where(span))
    accounts = _balances(tables, "Estado_Cuentas", start, last, ["unidadFuncionalID", "documentoID", "totalPagar", "saldo"])
    open_documents = charged
    if accounts is not None:
        # As in a monthly run: a document with any account is done.
        open_documents = charged.join(accounts.select("documentoID").distinct(), "documentoID", "left_anti")
    return {
        "Expensas": _in_order(new_documents, "Expensas"),
        "TotalesGastos": totals,
        "Estado_Financiero": position_history(
            charged,
            paid_by_building(lines, units),
            mode,
            _balances(tables, "Estado_Financiero", start, last, ["consorcioID", "saldoFinal", "egresosTotales"]),
        ),
        "Estado_Cuentas": account_history(
            units,
            open_documents,
            paid_by_account(lines),
            paid_by_unit(lines),
            policy,
            mode,
            accounts,
        ),
    }


def _balances(
    tables: Mapping[str, DataFrame], name: str, first: tuple[int, int], last: tuple[int, int], columns: list[str]
) -> DataFrame | None:
    """(columns, periodo) of the stored rows from one month to another; only those months are read."""
    if name not in tables:
        return None
    rows = tables[name]
    if not set(PERIOD) <= set(rows.columns):
        rows = rows.join(tables["Expensas"].select("documentoID", *PERIOD), "documentoID")
    low, high = (year * 12 + month - 1 for year, month in (first, last))
    index = F.col("anio") * 12 + F.col("mes") - 1
    chosen = rows.where(F.col("anio").between(first[0], last[0]) & index.between(low, high))
    return chosen.select(*columns, index.alias("periodo"))


def documents_with_totals(documents: DataFrame, totals: DataFrame) -> DataFrame:
    """Documents of the months in ``totals``, with their building's totals.

    Lists of months are exploded on both sides, which size estimates do not see;
    so neither is left to be broadcast on the strength of an estimate.
    """
    charged = documents.select("documentoID", "consorcioID", "anio", "mes")
    return charged.hint("merge").join(
        totals.select("consorcioID", "anio", "mes", "expOrdinarias", "expExtraordinarias"),
        ["consorcioID", "anio", "mes"],
    ).select(
        "consorcioID",
        "documentoID",
        month_index(F.make_date("anio", "mes", F.lit(1))).alias("periodo"),
        "expOrdinarias",
        "expExtraordinarias",
    )


RUN_TABLES = (
    "Consorcio",
    "Unidad_Funcional",
    "Expensas",
    "Gasto_Ordinario",
    "Gasto_Extraordinario",
    "Detalle_CSV",
    "Estado_Financiero",
    "Estado_Cuentas",
)


def store_period(
    spark: SparkSession,
    root: str,
    year: int | None = None,
    month: int | None = None,
    *,
    mode: str = "reference",
    policy: str = "partial_payment",
    run_date: dt.date | None = None,
    xml_root: str | None = None,
    again: bool = False,
) -> None:
    """Runs a month on the tables stored under ``root`` and appends its rows.

    New documents are stored first and read back, so positions and accounts
    refer to stored rows; months are partitions, so a run reads only its own
    and the one before.  A run that was cut short can be started again: it adds
    the documents, positions and accounts that are still missing.  In reference mode
    ``again`` asks for the positions once more, as running a month again does there.
    Costs stay as stored; :func:`stored_costs` reads them with their documents.
    """
    year, month = resolve_period(year, month, run_date or session_date(spark))

    def stored(name: str) -> DataFrame:
        # Payments count in the month after; only that month's folders are listed.
        paid = month_number(*previous_period(year, month))
        return read_stored(spark, root, name, [paid] if name == "Detalle_CSV" else None)

    def add(frame: DataFrame, name: str) -> None:
        placed = frame.withColumns({"anio": F.lit(year), "mes": F.lit(month)})
        append(placed, f"{root}/{name}", PERIOD)

    add(generate_documents(stored("Consorcio"), stored("Expensas"), [(year, month)], run_date),
        "Expensas")
    results = run_period(
        {name: stored(name) for name in RUN_TABLES}, year, month, mode=mode, policy=policy
    )
    positions = results["Estado_Financiero"]
    if not again:
        done = _of_period(stored("Estado_Financiero"), year, month).select("documentoID")
        positions = positions.join(done, "documentoID", "left_anti")
    add(positions.select(*results["Estado_Financiero"].columns), "Estado_Financiero")
    add(results["Estado_Cuentas"], "Estado_Cuentas")
    if xml_root is not None:
        statement = unit_statement(
            stored("Expensas"),
            stored("Estado_Cuentas"),
            stored("Unidad_Funcional"),
            stored("Propietario"),
            year,
            month,
        )
        write_statement_xml(statement, xml_root, year, month)


def store_history(
    spark: SparkSession,
    root: str,
    first: tuple[int, int],
    last: tuple[int, int],
    *,
    mode: str = "reference",
    policy: str = "partial_payment",
    run_date: dt.date | None = None,
) -> None:
    """Runs all months of a span in one pass on the tables stored under ``root``.

    Continues what is stored.  Documents are stored first, then positions and accounts;
    a run that was cut short can be started again and adds what is missing.
    """

    paid = range(month_number(*previous_period(*first)), month_number(*last) + 1)

    def tables() -> dict[str, DataFrame]:
        return {name: read_stored(spark, root, name, paid if name == "Detalle_CSV" else None) for name in RUN_TABLES}

    options = {"mode": mode, "policy": policy, "run_date": run_date}
    append(charge_history(tables(), first, last, **options)["Expensas"], f"{root}/Expensas", PERIOD)
    for name, key in (("Estado_Financiero", "consorcioID"), ("Estado_Cuentas", "unidadFuncionalID")):
        rows = charge_history(tables(), first, last, **options)[name]
        # A month's rows in few files.
        append(_of_table(rows, name).repartition(*PERIOD, F.xxhash64(key) % 16), f"{root}/{name}", PERIOD)


def _of_table(frame: DataFrame, name: str) -> DataFrame:
    names = TABLES[name].fieldNames()
    return frame.select(*names, *[c for c in PERIOD if c not in names])


def stored_costs(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored cost table with the documents of its buildings and months filled in."""
    return link_costs(read_stored(spark, root, name), read_stored(spark, root, "Expensas"))


def stored_weekly_cash_flow(spark: SparkSession, root: str, **options) -> DataFrame:
    """The weekly report on the tables stored under ``root``."""
    return weekly_cash_flow(
        stored_costs(spark, root, "Gasto_Ordinario"),
        stored_costs(spark, root, "Gasto_Extraordinario"),
        read_stored(spark, root, "Expensas"),
        read_stored(spark, root, "Consorcio"),
        **options,
    )


def store_months(
    spark: SparkSession, root: str, periods: Sequence[tuple[int, int]], **options
) -> None:
    """Runs several months in the given order; each reads what the last stored."""
    for year, month in periods:
        store_period(spark, root, year, month, **options)
