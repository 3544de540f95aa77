"""Weekly cash flow and unit statements read back from their XML documents.

Documents are read part by part with the declared schema.  An element that cannot be read
with it, or that lacks a required value, is no row: ``rejected_xml`` returns it with
its text, where it could be kept, and its file.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.sinks.xml import STATEMENT_ROW, WEEK_ROW

_MONEY = "decimal(24,2)"
WEEK = (
    "_Anio int, _Semana int, _Consorcio string, "
    f"Totales struct<Ordinarios: {_MONEY}, Extraordinarios: {_MONEY}, General: {_MONEY}, Acumulado: {_MONEY}>"
)
STATEMENT = (
    "uf long, Porcentaje decimal(4,2), PisoDepto string, Propietario string, SaldoAnterior decimal(18,2), "
    "PagosRecibidos decimal(18,2), SaldoAFavor decimal(18,2), InteresMora decimal(18,2), "
    "ExpensasOrdinarias decimal(18,2), Cocheras smallint, ExpensasExtraordinarias decimal(18,2), TotalPagar decimal(18,2)"
)
#: Schema and required columns of each kind of element.
KINDS = {
    WEEK_ROW: (WEEK, ("_Anio", "_Semana", "_Consorcio", "Totales")),
    STATEMENT_ROW: (STATEMENT, ("uf", "TotalPagar")),
}
_TEXT, _FILE = "_texto_ilegible", "_archivo"


def _elements(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    schema, _ = KINDS[row_tag]
    reader = spark.read.schema(f"{schema}, {_TEXT} string").option("rowTag", row_tag)
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _TEXT)
    return reader.xml(path).withColumn(_FILE, F.col("_metadata.file_path"))


def _unread(required: Sequence[str]) -> Column:
    missing = F.array_contains(F.array(*[F.col(c).isNull() for c in required]), True)
    return F.col(_TEXT).isNotNull() | missing


def weekly_rows(elements: DataFrame) -> DataFrame:
    """The columns of the report from those of its elements."""
    return elements.select(
        F.col("_Anio").alias("Anio"),
        F.col("_Semana").alias("Semana"),
        F.col("_Consorcio").alias("Consorcio"),
        F.col("Totales.Ordinarios").alias("TotalOrdinarios"),
        F.col("Totales.Extraordinarios").alias("TotalExtraordinarios"),
        F.col("Totales.General").alias("TotalGeneral"),
        F.col("Totales.Acumulado").alias("Acumulado"),
    )


def read_weekly_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of written weekly documents."""
    return weekly_rows(_elements(spark, path, WEEK_ROW).where(~_unread(KINDS[WEEK_ROW][1])))


def read_statement_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Rows of written statement documents."""
    schema, required = KINDS[STATEMENT_ROW]
    return _elements(spark, path, STATEMENT_ROW).where(~_unread(required)).drop(_TEXT, _FILE)


def rejected_xml(spark: SparkSession, path: str | list[str], row_tag: str) -> DataFrame:
    """(archivo, texto) of elements that gave no row; an element that lacks a value is written out again."""
    found = _elements(spark, path, row_tag).where(_unread(KINDS[row_tag][1]))
    parts = F.struct(*[F.col(c) for c in found.columns if c not in (_TEXT, _FILE)])
    return found.select(
        F.col(_FILE).alias("archivo"), F.coalesce(F.col(_TEXT), F.to_xml(parts, {"rowTag": row_tag})).alias("texto")
    )


def parsed_element(xml: Column, row_tag: str) -> Column:
    """One element's text as a struct of its declared columns."""
    return F.from_xml(xml, KINDS[row_tag][0], {"rowTag": row_tag})
