"""The shared test tables read as tables of the charge ledger.

Nations stand for buildings, customers for their units, line items for running
costs, orders for one-off costs and for payments, events for the lines of a
payment file.  Only the columns needed are selected, amounts become decimals
and times become dates before anything else is done with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType, TimestampNTZType

from vecindad.functions.dates import index_month, index_year, month_index
from vecindad.operators.interest import from_cents, to_cents
from vecindad.schemas import INT, LONG, MONEY, TEXT

REAL, TIME = DoubleType(), TimestampNTZType()

# A unit pays between 0.25 and 4.00 percent of its building's costs.
SHARE_STEPS = 16


# Columns of the test tables that are used here.
COLUMNS = {
    "nation": {"n_nationkey": INT, "n_name": TEXT},
    "customer": {
        "c_custkey": LONG, "c_name": TEXT, "c_nationkey": INT, "c_acctbal": REAL,
        "c_mktsegment": TEXT,
    },
    "supplier": {"s_suppkey": LONG, "s_name": TEXT, "s_nationkey": INT, "s_acctbal": REAL},
    "part": {"p_partkey": LONG, "p_name": TEXT, "p_retailprice": REAL},
    "orders": {
        "o_orderkey": LONG, "o_custkey": LONG, "o_orderstatus": TEXT, "o_totalprice": REAL,
        "o_orderdate": TIME, "o_orderpriority": TEXT,
    },
    "lineitem": {
        "l_orderkey": LONG, "l_partkey": LONG, "l_suppkey": LONG, "l_linenumber": INT,
        "l_extendedprice": REAL, "l_returnflag": TEXT, "l_linestatus": TEXT, "l_shipdate": TIME,
    },
    "events": {
        "event_id": LONG, "ts": TIME, "user_id": LONG, "event_type": TEXT, "value": REAL,
        "props": TEXT,
    },
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    schema = StructType([StructField(c, kind) for c, kind in COLUMNS[name].items()])
    return spark.read.schema(schema).parquet(f"{folder}/{name}.parquet")


def amount(column: str) -> Column:
    return F.col(column).cast("decimal(14,2)")


def account_number(key: str) -> Column:
    return F.lpad(F.col(key).cast("string"), 22, "0")


def document_number(building: Column, date: Column) -> Column:
    return building.cast("bigint") * 100_000 + month_index(date)


def buildings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "nation").select(
        F.col("n_nationkey").cast("bigint").alias("consorcioID"), F.col("n_name").alias("nombre")
    )


def units(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        key.alias("unidadFuncionalID"),
        F.col("c_nationkey").cast("bigint").alias("consorcioID"),
        (key % 40).cast("string").alias("piso"),
        F.substring(F.lit("ABCDEF"), ((key % 240) / 40).cast("int") + 1, F.lit(1)).alias(
            "departamento"
        ),
        F.when(F.col("c_acctbal") >= 5000, 1).otherwise(0).cast("smallint").alias("cochera"),
        account_number("c_custkey").alias("CBU_CVU"),
        ((key % SHARE_STEPS + 1) * F.lit(0.25).cast("decimal(3,2)"))
        .cast("decimal(4,2)")
        .alias("coeficiente"),
    )


def owners(spark: SparkSession, folder: str) -> DataFrame:
    """Owners of the units: none in one market segment, two in another."""
    people = table(spark, folder, "customer").where(F.col("c_mktsegment") != "FURNITURE")
    copies = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.array(F.lit("Titular"), F.lit("Socio")))
    return people.select(
        F.col("c_custkey").alias("unidadFuncionalID"),
        F.col("c_name").alias("apellido"),
        F.explode(copies.otherwise(F.array(F.lit("Titular")))).alias("nombre"),
    )


def ordinary_costs(spark: SparkSession, folder: str) -> DataFrame:
    """Running costs: what one supplier delivered on one day.

    Line items are summed by supplier and day before they meet the suppliers,
    so a supplier with very many lines is small by then.  Sums are of whole cents: most
    suppliers have a line or two a day, and a sum of decimals is more than twice as wide.
    """
    delivered = (
        table(spark, folder, "lineitem")
        .groupBy("l_suppkey", F.col("l_shipdate").cast("date").alias("fecha"))
        .agg(from_cents(F.sum(to_cents(amount("l_extendedprice")))).alias("importeTotal"))
    )
    placed = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").cast("bigint").alias("consorcioID")
    )
    return delivered.join(placed, "l_suppkey").select(
        F.col("l_suppkey").alias("proveedor"), "consorcioID", "fecha", "importeTotal"
    )


def extraordinary_costs(spark: SparkSession, folder: str) -> DataFrame:
    """One-off costs: one per order, urgent and high ones in instalments."""
    priority = F.substring("o_orderpriority", 1, 1)
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("gastoExtraordinarioID"),
        F.col("o_custkey").alias("_unidad"),
        F.col("o_orderdate").cast("date").alias("fecha"),
        amount("o_totalprice").alias("importeTotal"),
        F.when(priority.isin("1", "2"), "CUOTAS").otherwise("TOTAL").alias("formaPago"),
        (F.col("o_orderkey") % 6 + 1).cast("smallint").alias("nroCuota"),
        F.col("o_orderstatus").alias("estado"),
    )
    placed = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("_unidad"), F.col("c_nationkey").cast("bigint").alias("consorcioID")
    )
    return (
        orders.join(placed, "_unidad")
        .drop("_unidad")
        .withColumn("documentoID", document_number(F.col("consorcioID"), F.col("fecha")))
    )


def collected_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Payments spread over years: one per order, by the ordering customer."""
    return table(spark, folder, "orders").select(
        F.col("o_custkey").alias("unidadFuncionalID"),
        account_number("o_custkey").alias("cuentaOrigen"),
        F.col("o_orderdate").cast("date").alias("fechaPago"),
        amount("o_totalprice").cast(MONEY).alias("importe"),
        amount("o_totalprice").cast(MONEY).alias("monto"),
    )


def known_accounts(spark: SparkSession, folder: str) -> DataFrame:
    """Units of which those in debt have no account on record."""
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("unidadFuncionalID"),
        F.when(F.col("c_acctbal") >= 0, account_number("c_custkey")).alias("CBU_CVU"),
    )


def month_span(spark: SparkSession, folder: str) -> tuple[tuple[int, int], tuple[int, int]]:
    """First and last month with a cost: one row from one pass over two columns."""
    dates = (
        table(spark, folder, "lineitem")
        .select(F.col("l_shipdate").alias("fecha"))
        .unionByName(table(spark, folder, "orders").select(F.col("o_orderdate").alias("fecha")))
    )
    low, high = dates.agg(F.min("fecha"), F.max("fecha")).first()
    return (low.year, low.month), (high.year, high.month)


def documents(
    spark: SparkSession, folder: str, first: tuple[int, int], last: tuple[int, int]
) -> DataFrame:
    """A charge document for every building and month from ``first`` to ``last``.

    The hint keeps it from being broadcast: its estimated size leaves out that
    the months are exploded.
    """
    span = F.sequence(F.lit(first[0] * 12 + first[1] - 1), F.lit(last[0] * 12 + last[1] - 1))
    rows = buildings(spark, folder).select("consorcioID", F.explode(span).alias("periodo"))
    return rows.select(
        (F.col("consorcioID") * 100_000 + F.col("periodo")).alias("documentoID"),
        "consorcioID",
        index_year(F.col("periodo")).alias("anio"),
        index_month(F.col("periodo")).alias("mes"),
    ).hint("merge")


def early_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that exist already: months in which a finished order is paid in parts."""
    costs = extraordinary_costs(spark, folder).where(
        (F.col("formaPago") == "CUOTAS") & (F.col("estado") == "F")
    )
    return costs.groupBy("documentoID", "consorcioID").agg(
        F.year(F.min("fecha")).alias("anio"), F.month(F.min("fecha")).alias("mes")
    )


# --- rows of input files, written the way the files write them ------------------
def _with_marks(cents: Column, thousands: str, decimal: str) -> Column:
    whole = F.floor(cents / 100)
    return F.concat(
        F.floor(whole / 1000).cast("string"),
        F.lit(thousands),
        F.lpad((whole % 1000).cast("string"), 3, "0"),
        F.lit(decimal),
        F.lpad((cents % 100).cast("string"), 2, "0"),
    )


def cents(column: str) -> Column:
    return (amount(column) * 100).cast("bigint")


def written_amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Line item prices in six spellings, by line number."""
    price, style = cents("l_extendedprice"), F.col("l_linenumber") % 6
    text = (
        F.when(style == 0, _with_marks(price, ",", "."))
        .when(style == 1, _with_marks(price, ".", ","))
        .when(style == 2, _with_marks(price, ",", ","))
        .when(style == 3, _with_marks(price, ".", "."))
        .when(style == 4, F.floor(price / 100).cast("string"))
        .otherwise(F.concat(F.lit("x"), _with_marks(price, ",", ".")))
    )
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", price.alias("_centavos"), text.alias("texto")
    )


def staged_payments(spark: SparkSession, folder: str) -> DataFrame:
    """Events as text lines of payment files, one file per event type.

    Very small values have no amount text, very large ones an unreadable text.
    """
    value = cents("value")
    text = (
        F.when(F.col("value") < 1, " ")
        .when(F.col("value") >= 200, "sin dato")
        .otherwise(F.concat(F.lit("$ "), _with_marks(value, ".", ",")))
    )
    return table(spark, folder, "events").select(
        F.col("event_id").alias("IdPago"),
        F.date_format("ts", "d/M/yyyy").alias("Fecha"),
        account_number("user_id").alias("CVU_CBU"),
        text.alias("Valor"),
        F.concat(F.lit("pagos_"), F.col("event_type"), F.lit(".csv")).alias("nombreArchivo"),
    )


def imported_files(spark: SparkSession, folder: str) -> DataFrame:
    """Registry of earlier imports: the files of one event type, in capitals."""
    names = staged_payments(spark, folder).groupBy("nombreArchivo").agg(F.lit(1).alias("_uno"))
    return names.select(F.upper("nombreArchivo").alias("nombreArchivo")).where(
        F.col("nombreArchivo") == "PAGOS_ERROR.CSV"
    )


def staged_units(spark: SparkSession, folder: str) -> DataFrame:
    """Units as lines of a unit file; names in the wrong case and with blanks."""
    nations = table(spark, folder, "nation").select(
        F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("_nombre")
    )
    surface = F.abs(cents("c_acctbal"))
    flag = (
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "SI")
        .when(F.col("c_mktsegment") == "FURNITURE", "si ")
        .when(F.col("c_mktsegment") == "MACHINERY", "NO")
    )
    key = F.col("c_custkey")
    return (
        table(spark, folder, "customer")
        .join(nations, "c_nationkey")
        .select(
            F.concat(F.lit(" "), F.lower("_nombre"), F.lit(" ")).alias("NombreConsorcio"),
            key.cast("int").alias("nroUnidadFuncional"),
            (key % 40).cast("string").alias("Piso"),
            F.substring(F.lit("ABCDEF"), ((key % 240) / 40).cast("int") + 1, F.lit(1)).alias(
                "Departamento"
            ),
            F.concat(F.floor(key % 4).cast("string"), F.lit(",25")).alias("Coeficiente"),
            F.concat(
                F.floor(surface / 100).cast("string"),
                F.lit(","),
                F.lpad((surface % 100).cast("string"), 2, "0"),
            ).alias("m2_unidad_funcional"),
            flag.alias("Bauleras"),
            flag.alias("Cochera"),
            account_number("c_custkey").alias("CBU_CVU"),
            "c_acctbal",
            "c_mktsegment",
        )
    )


def staged_persons(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as lines of a person file, some with an unusable identity number."""
    key = F.col("c_custkey")
    number = F.lpad((key * 7).cast("string"), 6, "0")
    identity = (
        F.when(key % 3 == 0, F.concat(F.lit("21."), F.substring(number, 1, 3), F.lit("."),
                                      F.substring(number, 4, 3)))
        .when(key % 3 == 1, F.concat(F.lit("9 "), number))
        .otherwise(F.concat(F.lit("DNI-"), (key % 1000).cast("string")))
    )
    return table(spark, folder, "customer").select(
        F.concat(F.lit(" "), F.col("c_name")).alias("Nombre"),
        F.concat(F.col("c_mktsegment"), F.lit(" ")).alias("Apellido"),
        identity.alias("DNI"),
        F.lit("a@b.c").alias("Email"),
        key.cast("string").alias("Telefono"),
        account_number("c_custkey").alias("CBU_CVU"),
        F.when(key % 2 == 0, "1").otherwise("0").alias("EsInquilino"),
        "c_custkey",
        "c_acctbal",
    )
