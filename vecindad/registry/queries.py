"""Registered queries: one per operator or job, each over whole tables.

Every query takes a session and the folder of the shared test tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.functions import (
    clean_money,
    decimal_comma,
    digits_only,
    month_start_by_name,
    pad_id,
    parse_amount,
    parse_day_month_year,
    previous_month,
    previous_year,
    week_of_year,
    yes_flag,
)
from vecindad.functions.dates import MONTH_NAMES
from vecindad.operators import costs, quality
from vecindad.operators.changes import insert_if_missing, update_from_join
from vecindad.operators.history import account_history, position_history
from vecindad.operators.payments import paid_by_account, paid_by_building, paid_by_unit
from vecindad.plans import charges, imports, reports
from vecindad import schemas
from vecindad.schemas import MONEY
from vecindad.sinks.xml import STATEMENT_ROW, WEEK_ROW, element, weekly_layout
from vecindad.sources import star_schema as star
from vecindad.sources.files import LINE, with_fields

Query = Callable[[SparkSession, str], DataFrame]


# --- reports --------------------------------------------------------------------
def weekly_cash_flow(spark: SparkSession, folder: str) -> DataFrame:
    return reports.weekly_cash_flow(
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        star.documents(spark, folder, *star.month_span(spark, folder)),
        star.buildings(spark, folder),
        all_years=True,
    )


def weekly_cash_flow_xml(spark: SparkSession, folder: str) -> DataFrame:
    layout = weekly_layout(weekly_cash_flow(spark, folder))
    return layout.select(
        F.col("_Anio").alias("Anio"),
        F.col("_Semana").alias("Semana"),
        F.col("_Consorcio").alias("Consorcio"),
        element(layout, WEEK_ROW).alias("xml"),
    )


def monthly_collection_pivot(spark: SparkSession, folder: str) -> DataFrame:
    return reports.monthly_collection_pivot(
        star.collected_orders(spark, folder),
        star.units(spark, folder),
        star.buildings(spark, folder),
    )


def top_months(spark: SparkSession, folder: str) -> DataFrame:
    return reports.top_months(
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        star.collected_orders(spark, folder),
        star.units(spark, folder),
        star.buildings(spark, folder),
    )


def monthly_collection_pivot_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """One year of one building."""
    return reports.monthly_collection_pivot(
        star.collected_orders(spark, folder),
        star.units(spark, folder),
        star.buildings(spark, folder),
        year=1997,
        building_id=7,
    )


def top_months_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """Three years of one building."""
    return reports.top_months(
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        star.collected_orders(spark, folder),
        star.units(spark, folder),
        star.buildings(spark, folder),
        first_year=1996,
        last_year=1998,
        building_id=7,
    )


# --- costs ----------------------------------------------------------------------
def _cost_totals(spark: SparkSession, folder: str, mode: str, span) -> DataFrame:
    return costs.monthly_cost_totals(
        star.buildings(spark, folder),
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        *span,
        mode,
    )


def monthly_cost_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _cost_totals(spark, folder, "reference", star.month_span(spark, folder))


def monthly_cost_totals_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _cost_totals(spark, folder, "strict", star.month_span(spark, folder))


def _one_month(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    return costs.period_cost_totals(
        star.buildings(spark, folder),
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        1997,
        6,
        mode,
    )


def period_cost_totals(spark: SparkSession, folder: str) -> DataFrame:
    return _one_month(spark, folder, "reference")


def period_cost_totals_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _one_month(spark, folder, "strict")


def installment_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return costs.installment_schedule(star.extraordinary_costs(spark, folder), "reference")


def installment_schedule_strict(spark: SparkSession, folder: str) -> DataFrame:
    return costs.installment_schedule(star.extraordinary_costs(spark, folder), "strict")


def quota_table_totals(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as costs, their line items as the listed instalments."""
    quotas = star.table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("gastoExtraordinarioID"),
        F.col("l_linenumber").alias("nroCuota"),
        star.amount("l_extendedprice").alias("importeCuota"),
    )
    return costs.quota_table_totals(
        star.extraordinary_costs(spark, folder), quotas, kind="formaPago"
    )


# --- monthly charges --------------------------------------------------------------
def generate_documents(spark: SparkSession, folder: str) -> DataFrame:
    (y0, m0), (y1, m1) = star.month_span(spark, folder)
    months = [(i // 12, i % 12 + 1) for i in range(y0 * 12 + m0 - 1, y1 * 12 + m1)]
    new = charges.generate_documents(
        star.buildings(spark, folder), star.early_documents(spark, folder), months
    )
    return new.select("consorcioID", "mes", "anio", "medioEnvio", "aPropietario", "aInquilino")


def link_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Finished orders carry a document already (-1), the others get theirs."""
    unlinked = star.extraordinary_costs(spark, folder).withColumn(
        "documentoID", F.when(F.col("estado") == "F", F.lit(-1).cast("bigint"))
    )
    linked = charges.link_costs(unlinked, star.early_documents(spark, folder))
    return linked.select("gastoExtraordinarioID", "documentoID", "consorcioID", "fecha")


def _charged_documents(spark: SparkSession, folder: str, span, mode: str = "reference") -> DataFrame:
    return charges.documents_with_totals(
        star.documents(spark, folder, *span), _cost_totals(spark, folder, mode, span)
    )


def _position(spark: SparkSession, folder: str, mode: str) -> DataFrame:
    paid = paid_by_building(star.collected_orders(spark, folder), star.units(spark, folder))
    span = star.month_span(spark, folder)
    return position_history(_charged_documents(spark, folder, span, mode), paid, mode)


def financial_position(spark: SparkSession, folder: str) -> DataFrame:
    return _position(spark, folder, "reference")


def financial_position_strict(spark: SparkSession, folder: str) -> DataFrame:
    return _position(spark, folder, "strict")


def _accounts(spark: SparkSession, folder: str, policy: str, mode: str = "reference") -> DataFrame:
    lines = star.collected_orders(spark, folder)
    span = star.month_span(spark, folder)
    return account_history(
        star.units(spark, folder),
        _charged_documents(spark, folder, span),
        paid_by_account(lines),
        paid_by_unit(lines),
        policy,
        mode,
    )


def unit_accounts_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Paid amounts by unit; every unit has an account of its own here, so the rows are the same."""
    return _accounts(spark, folder, "partial_payment", "strict")


def unit_accounts_continued(spark: SparkSession, folder: str) -> DataFrame:
    """A history of the months before 1998, and one that continues its balances."""
    lines, units = star.collected_orders(spark, folder), star.units(spark, folder)
    charged = _charged_documents(spark, folder, star.month_span(spark, folder))
    cut = 1998 * 12
    paid = paid_by_account(lines), paid_by_unit(lines)
    early = account_history(units, charged.where(F.col("periodo") < cut), *paid)
    stored = early.where("anio = 1997 and mes = 12").select("unidadFuncionalID", F.lit(cut - 1).alias("periodo"), "totalPagar", "saldo")
    late = account_history(units, charged.where(F.col("periodo") >= cut), *paid, stored=stored)
    return early.unionByName(late)


def unit_accounts(spark: SparkSession, folder: str) -> DataFrame:
    return _accounts(spark, folder, "partial_payment")


def unit_accounts_last_payment(spark: SparkSession, folder: str) -> DataFrame:
    return _accounts(spark, folder, "last_payment")


def unit_accounts_flat(spark: SparkSession, folder: str) -> DataFrame:
    return _accounts(spark, folder, "flat")


def unit_statement(spark: SparkSession, folder: str) -> DataFrame:
    return charges.unit_statement(
        star.documents(spark, folder, *star.month_span(spark, folder)),
        unit_accounts(spark, folder),
        star.units(spark, folder),
        star.owners(spark, folder),
    )


def unit_statement_xml(spark: SparkSession, folder: str) -> DataFrame:
    statement = unit_statement(spark, folder)
    content = statement.drop("anio", "mes")
    return statement.select(
        "anio", "mes", "uf", "Propietario", element(content, STATEMENT_ROW).alias("xml")
    )


# --- imports ----------------------------------------------------------------------
def _payments(spark: SparkSession, folder: str, mode: str) -> dict[str, DataFrame]:
    return imports.import_payments(
        star.staged_payments(spark, folder),
        star.known_accounts(spark, folder),
        star.imported_files(spark, folder),
        mode=mode,
    )


def payment_match(spark: SparkSession, folder: str) -> DataFrame:
    return _payments(spark, folder, "reference")["Pago"].drop("pagoID")


def payment_detail_fanout(spark: SparkSession, folder: str) -> DataFrame:
    detail = _payments(spark, folder, "reference")["Detalle_CSV"]
    return detail.drop("pagoID", "importacionID")


def payment_detail_strict(spark: SparkSession, folder: str) -> DataFrame:
    detail = _payments(spark, folder, "strict")["Detalle_CSV"]
    return detail.drop("pagoID", "importacionID")


def payments_rejected(spark: SparkSession, folder: str) -> DataFrame:
    return _payments(spark, folder, "reference")["rechazados"].drop("importacionID")


def units_import(spark: SparkSession, folder: str) -> DataFrame:
    """Units of customers in debt are stored already, all others are new."""
    staged = star.staged_units(spark, folder)
    stored = (
        star.table(spark, folder, "customer")
        .where(F.col("c_acctbal") < 0)
        .select(F.col("c_custkey").alias("unidadFuncionalID"))
    )
    known = star.units(spark, folder).join(stored, "unidadFuncionalID", "left_semi")
    new = imports.import_units(staged, star.buildings(spark, folder), known)
    return new.drop("unidadFuncionalID", "CBU_CVU")


def accounts_update(spark: SparkSession, folder: str) -> DataFrame:
    """Account numbers for units without one, from lines that may repeat a unit."""
    staged = star.staged_units(spark, folder).select(
        "CBU_CVU",
        F.trim("NombreConsorcio").alias("NombreConsorcio"),
        "nroUnidadFuncional",
        F.col("Piso").alias("piso"),
        F.lower("Departamento").alias("departamento"),
    )
    units = star.units(spark, folder).withColumn("CBU_CVU", F.lit(None).cast("string"))
    changed = imports.update_accounts(units, staged, star.buildings(spark, folder))
    return changed.select("unidadFuncionalID", "consorcioID", "piso", "departamento", "CBU_CVU")


def _known_persons(spark: SparkSession, folder: str) -> DataFrame:
    """Persons in debt are stored already."""
    staged = star.staged_persons(spark, folder).where(F.col("c_acctbal") < 0)
    return staged.select(pad_id(F.col("DNI")).alias("DNI")).where(F.col("DNI").isNotNull())


def owners_import(spark: SparkSession, folder: str) -> DataFrame:
    new = imports.import_owners(
        star.staged_persons(spark, folder),
        star.units(spark, folder),
        _known_persons(spark, folder),
    )
    return new.drop("IDPropietario")


def tenants_import(spark: SparkSession, folder: str) -> DataFrame:
    return imports.import_tenants(
        star.staged_persons(spark, folder),
        star.units(spark, folder),
        _known_persons(spark, folder),
    )


def buildings_import(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers as lines of a building list."""
    staged = star.table(spark, folder, "supplier").select(
        F.lit("C").alias("Consorcio"),
        F.col("s_name").alias("Nombre del consorcio"),
        F.concat(F.lit("Calle "), F.col("s_suppkey").cast("string")).alias("Domicilio"),
        F.lit(10).alias("Cant unidades funcionales"),
        F.abs(star.amount("s_acctbal")).cast("decimal(10,2)").alias("m2 totales"),
    )
    return imports.import_buildings(staged).drop("consorcioID")


def insert_missing(spark: SparkSession, folder: str) -> DataFrame:
    """Open line items whose supplier and part never came back."""
    items = star.table(spark, folder, "lineitem")
    columns = ["l_suppkey", "l_partkey", "l_orderkey", "l_linenumber"]
    new = items.where(F.col("l_linestatus") == "O").select(*columns)
    known = items.where(F.col("l_returnflag") == "R")
    return insert_if_missing(new, known, ["l_suppkey", "l_partkey"])


def update_from_matches(spark: SparkSession, folder: str) -> DataFrame:
    """Customers not in debt get the number of their latest order in place of the balance."""
    target = star.table(spark, folder, "customer").select(
        "c_custkey", F.lit(None).cast("bigint").alias("ultimo_pedido"), "c_acctbal"
    )
    source = star.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("c_custkey"), "o_orderkey"
    )
    changed = update_from_join(
        target,
        source,
        ["c_custkey"],
        {"ultimo_pedido": "o_orderkey"},
        only_when=F.col("c_acctbal") >= 0,
    )
    return changed.select("c_custkey", "ultimo_pedido")


# --- column functions ----------------------------------------------------------------
def amounts_parsed(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.written_amounts(spark, folder)
    return rows.select(
        "l_orderkey", "l_linenumber", "texto", parse_amount(F.col("texto")).alias("monto")
    )


def money_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.written_amounts(spark, folder)
    text = F.concat(F.lit(" $"), F.col("texto"), F.lit(" "))
    return rows.select("l_orderkey", "l_linenumber", clean_money(text).alias("monto"))


def decimal_commas(spark: SparkSession, folder: str) -> DataFrame:
    price = star.cents("p_retailprice")
    text = F.concat(
        F.floor(price / 100).cast("string"), F.lit(","), F.lpad((price % 100).cast("string"), 2, "0")
    )
    return star.table(spark, folder, "part").select(
        "p_partkey", text.alias("texto"), decimal_comma(text, 5, 2).alias("valor")
    )


def yes_flags(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.staged_units(spark, folder)
    return rows.select(
        "nroUnidadFuncional", "Cochera", yes_flag(F.col("Cochera")).cast("int").alias("cochera_si")
    )


def ids_padded(spark: SparkSession, folder: str) -> DataFrame:
    rows = star.staged_persons(spark, folder)
    return rows.select("c_custkey", "DNI", pad_id(F.col("DNI")).alias("documento"))


def digits_kept(spark: SparkSession, folder: str) -> DataFrame:
    return star.table(spark, folder, "events").select(
        "event_id", digits_only(F.col("props")).alias("digitos")
    )


def month_starts(spark: SparkSession, folder: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in (*MONTH_NAMES, "nunca")])
    name = F.element_at(names, (F.col("o_orderkey") % 13 + 1).cast("int"))
    shown = F.when(F.col("o_orderkey") % 2 == 0, F.upper(name)).otherwise(name)
    day = F.col("o_orderdate").cast("date")
    return star.table(spark, folder, "orders").select(
        "o_orderkey", shown.alias("nombre"), month_start_by_name(day, shown).alias("inicio")
    )


def previous_periods(spark: SparkSession, folder: str) -> DataFrame:
    month, year = F.month("o_orderdate"), F.year("o_orderdate")
    return star.table(spark, folder, "orders").select(
        "o_orderkey",
        previous_month(month).alias("mes_anterior"),
        previous_year(month, year).alias("anio_anterior"),
    )


def week_numbers(spark: SparkSession, folder: str) -> DataFrame:
    return star.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        week_of_year(F.col("l_shipdate").cast("date")).alias("semana"),
    )


def dates_parsed(spark: SparkSession, folder: str) -> DataFrame:
    """Order dates as day/month/year; every seventh with day and month exchanged."""
    day, month, year = (f("o_orderdate").cast("string") for f in (F.dayofmonth, F.month, F.year))
    slash = F.lit("/")
    text = F.when(
        F.col("o_orderkey") % 7 == 0, F.concat(month, slash, day, slash, year)
    ).otherwise(F.concat(F.lit(" "), F.lpad(day, 2, "0"), slash, month, slash, year))
    return star.table(spark, folder, "orders").select(
        "o_orderkey", text.alias("texto"), parse_day_month_year(text).alias("fecha")
    )


# --- data quality ----------------------------------------------------------------------
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    items = star.table(spark, folder, "lineitem")
    return quality.unique_key(items, ["l_orderkey", "l_linenumber"])


def dq_unique_account(spark: SparkSession, folder: str) -> DataFrame:
    """Accounts shared by several units; here each customer's account is that of its market segment and nation."""
    shared = star.units(spark, folder).join(
        star.table(spark, folder, "customer").select(
            F.col("c_custkey").alias("unidadFuncionalID"),
            F.when(F.col("c_acctbal") >= 0, F.concat_ws("/", "c_mktsegment", "c_nationkey")).alias("_cuenta"),
        ),
        "unidadFuncionalID",
    )
    return quality.unique_key(
        shared.withColumn("CBU_CVU", F.col("_cuenta")).dropna(subset=["CBU_CVU"]), schemas.RULES["Unidad_Funcional"].unique[0]
    )


def file_lines_of_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as payment lines, amounts with a decimal comma bare or quoted, and read back."""
    whole, cents = F.floor("o_totalprice").cast("bigint"), F.floor(F.col("o_totalprice") * 100).cast("bigint") % 100
    amount = F.concat(F.lit("$ "), whole.cast("string"), F.lit(","), F.lpad(cents.cast("string"), 2, "0"))
    key = F.col("o_orderkey")
    quoted = F.when(key % 3 == 0, F.concat(F.lit('"'), amount, F.lit('"'))).otherwise(amount)
    line = F.concat_ws(",", key, F.date_format("o_orderdate", "dd/MM/yyyy"), F.lpad(F.col("o_custkey").cast("string"), 22, "0"), quoted)
    lines = star.table(spark, folder, "orders").select(F.when(key % 5 == 0, F.concat(line, F.lit("\r"))).otherwise(line).alias(LINE))
    fields = with_fields(lines, "payments")
    return fields.select("IdPago", "Fecha", "CVU_CBU", clean_money(F.col("Valor")).alias("importe"))


def file_lines_of_persons(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as person lines, some with a stray quote, and read back."""
    key = F.col("c_custkey").cast("string")
    name = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit('"'), F.col("c_name"))).otherwise(F.col("c_name"))
    line = F.concat_ws(";", name, F.col("c_mktsegment"), F.lpad(key, 8, "1"), F.lit(""), key, F.lpad(key, 22, "0"), F.lit("0"))
    fields = with_fields(star.table(spark, folder, "customer").select(line.alias(LINE)), "persons")
    return fields.select("Nombre", "Apellido", "DNI", "Email", "Telefono", "CBU_CVU", "EsInquilino")


def file_lines_of_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Customers written as account lines, some without a number, and read back."""
    key = F.col("c_custkey").cast("string")
    account = F.when(F.col("c_custkey") % 7 == 0, F.lit("")).otherwise(F.lpad(key, 22, "0"))
    line = F.concat_ws("|", account, F.col("c_mktsegment"), key, F.lit("1"), F.lit("B\r"))
    fields = with_fields(star.table(spark, folder, "customer").select(line.alias(LINE)), "unit_accounts")
    return fields.select("CBU_CVU", "NombreConsorcio", "nroUnidadFuncional", "piso", "departamento")


def file_lines_of_buildings(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers written as building lines with quoted addresses, and read back."""
    key = F.col("s_suppkey").cast("string")
    address = F.concat(F.lit('"Calle, '), key, F.lit('"'))
    line = F.concat_ws(",", F.lit("C"), F.col("s_name"), address, key, F.concat(key, F.lit(".50")))
    fields = with_fields(star.table(spark, folder, "supplier").select(line.alias(LINE)), "buildings")
    return fields.select(
        F.col("Nombre del consorcio").alias("nombre"),
        F.col("Domicilio").alias("direccion"),
        F.col("Cant unidades funcionales").alias("unidades"),
        F.col("m2 totales").alias("m2"),
    )


def file_lines_of_units(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers written as unit lines with decimal commas, and read back."""
    key = F.col("s_suppkey").cast("string")
    line = F.concat_ws(
        "\t", F.concat(F.lit('"'), F.col("s_name")), key, F.lit("1"), F.lit("A"), F.concat(key, F.lit(",50")),
        F.lit("45,75"), F.lit("SI"), F.lit("NO"), F.lit(""), F.lit("0"),
    )
    fields = with_fields(star.table(spark, folder, "supplier").select(line.alias(LINE)), "units")
    return fields.select("NombreConsorcio", "nroUnidadFuncional", "Piso", "Coeficiente", "Bauleras", "m2_baulera", "m2_cochera")


def weekly_cash_flow_filtered(spark: SparkSession, folder: str) -> DataFrame:
    """One year, one building and some weeks of the weekly report."""
    return reports.weekly_cash_flow(
        star.ordinary_costs(spark, folder),
        star.extraordinary_costs(spark, folder),
        star.documents(spark, folder, *star.month_span(spark, folder)),
        star.buildings(spark, folder),
        year=1996,
        building_id=7,
        first_week=5,
        last_week=40,
    )


def dq_fk(spark: SparkSession, folder: str) -> DataFrame:
    return quality.foreign_key(
        star.table(spark, folder, "orders"),
        "o_custkey",
        star.table(spark, folder, "events"),
        "user_id",
    )


def _rows_checked(frame: DataFrame, *checks) -> DataFrame:
    return quality.row_checks(frame, list(checks))


def dq_domain(spark: SparkSession, folder: str) -> DataFrame:
    column = "o_orderpriority"
    failing = quality.not_allowed(column, ["1-URGENT", "2-HIGH", "3-MEDIUM"])
    return _rows_checked(star.table(spark, folder, "orders"), ("domain", column, failing))


def dq_range(spark: SparkSession, folder: str) -> DataFrame:
    months = star.table(spark, folder, "lineitem").select(F.month("l_shipdate").alias("mes"))
    return _rows_checked(months, ("range", "mes", quality.out_of_range("mes", 2, 11)))


def dq_digits(spark: SparkSession, folder: str) -> DataFrame:
    persons = star.staged_persons(spark, folder).select("DNI")
    return _rows_checked(persons, ("digits", "DNI", quality.not_digits("DNI")))


def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    units = star.staged_units(spark, folder).select("Cochera")
    return _rows_checked(units, ("not_null", "Cochera", quality.is_missing("Cochera")))


def dq_length(spark: SparkSession, folder: str) -> DataFrame:
    parts = star.table(spark, folder, "part").select("p_name")
    return _rows_checked(parts, ("length", "p_name", quality.too_long("p_name", 9)))


def dq_decimal_fit(spark: SparkSession, folder: str) -> DataFrame:
    orders = star.table(spark, folder, "orders").select(
        star.amount("o_totalprice").alias("o_totalprice")
    )
    check = ("decimal_fit", "o_totalprice", quality.does_not_fit("o_totalprice", 7, 2))
    return _rows_checked(orders, check)


def dq_default(spark: SparkSession, folder: str) -> DataFrame:
    """Missing flags replaced by their default."""
    rows = star.staged_units(spark, folder).select("nroUnidadFuncional", "Cochera")
    return quality.with_default(rows, "Cochera", "0")


# --- sums behind the charges -------------------------------------------------------------
def paid_within_month(spark: SparkSession, folder: str) -> DataFrame:
    """Per unit and month: paid in all, by day 10, by day 15, and the last day."""
    paid = paid_by_unit(star.collected_orders(spark, folder))
    zero = F.lit(0).cast(MONEY)
    return paid.select(
        "unidadFuncionalID",
        "periodo",
        "pagado",
        F.coalesce("hasta10", zero).alias("hasta10"),
        F.coalesce("hasta15", zero).alias("hasta15"),
        "ultimo",
    )


QUERIES: dict[str, Query] = {
    "weekly_cash_flow": weekly_cash_flow,
    "weekly_cash_flow_filtered": weekly_cash_flow_filtered,
    "file_lines_payments": file_lines_of_payments,
    "file_lines_persons": file_lines_of_persons,
    "file_lines_units": file_lines_of_units,
    "file_lines_accounts": file_lines_of_accounts,
    "file_lines_buildings": file_lines_of_buildings,
    "weekly_cash_flow_xml": weekly_cash_flow_xml,
    "monthly_collection_pivot": monthly_collection_pivot,
    "top_months": top_months,
    "monthly_collection_pivot_filtered": monthly_collection_pivot_filtered,
    "top_months_filtered": top_months_filtered,
    "period_cost_totals": period_cost_totals,
    "period_cost_totals_strict": period_cost_totals_strict,
    "monthly_cost_totals": monthly_cost_totals,
    "monthly_cost_totals_strict": monthly_cost_totals_strict,
    "installment_schedule": installment_schedule,
    "installment_schedule_strict": installment_schedule_strict,
    "quota_table_totals": quota_table_totals,
    "generate_documents": generate_documents,
    "link_costs": link_costs,
    "financial_position": financial_position,
    "financial_position_strict": financial_position_strict,
    "unit_accounts": unit_accounts,
    "unit_accounts_last_payment": unit_accounts_last_payment,
    "unit_accounts_flat": unit_accounts_flat,
    "unit_accounts_strict": unit_accounts_strict,
    "unit_accounts_continued": unit_accounts_continued,
    "unit_statement": unit_statement,
    "unit_statement_xml": unit_statement_xml,
    "paid_within_month": paid_within_month,
    "payment_match": payment_match,
    "payment_detail_fanout": payment_detail_fanout,
    "payment_detail_strict": payment_detail_strict,
    "payments_rejected": payments_rejected,
    "buildings_import": buildings_import,
    "units_import": units_import,
    "accounts_update": accounts_update,
    "owners_import": owners_import,
    "tenants_import": tenants_import,
    "insert_if_missing": insert_missing,
    "update_from_join": update_from_matches,
    "parse_amount": amounts_parsed,
    "clean_money": money_cleaned,
    "decimal_comma": decimal_commas,
    "yes_flag": yes_flags,
    "pad_id": ids_padded,
    "digits_only": digits_kept,
    "month_start_by_name": month_starts,
    "prev_period": previous_periods,
    "week_of_year": week_numbers,
    "parse_date": dates_parsed,
    "dq_unique": dq_unique,
    "dq_unique_account": dq_unique_account,
    "dq_fk": dq_fk,
    "dq_domain": dq_domain,
    "dq_range": dq_range,
    "dq_digits": dq_digits,
    "dq_not_null": dq_not_null,
    "dq_length": dq_length,
    "dq_decimal_fit": dq_decimal_fit,
    "dq_default": dq_default,
}
