"""XML output of the weekly cash flow and the unit statements.

``*_element`` turns each row into one XML element (a string column), which
stays distributed.  ``write_xml`` writes documents: one per part file, each a
complete document with the root element.  Rows keep their order across part
files when the frame was sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Element names.
WEEK_ROW, WEEK_ROOT = "Semana", "FlujoCajaSemanal"
STATEMENT_ROW, STATEMENT_ROOT = "Expensa", "Expensas"


def weekly_layout(cash_flow: DataFrame) -> DataFrame:
    """Attributes carry the leading underscore the XML writer looks for."""
    return cash_flow.select(
        F.col("Anio").alias("_Anio"),
        F.col("Semana").alias("_Semana"),
        F.col("Consorcio").alias("_Consorcio"),
        F.struct(
            F.col("TotalOrdinarios").alias("Ordinarios"),
            F.col("TotalExtraordinarios").alias("Extraordinarios"),
            F.col("TotalGeneral").alias("General"),
            F.col("Acumulado"),
        ).alias("Totales"),
    )


def element(frame: DataFrame, row_tag: str) -> Column:
    """One XML element per row, built from all columns of ``frame``."""
    return F.to_xml(F.struct(*[F.col(c) for c in frame.columns]), {"rowTag": row_tag})


def write_xml(frame: DataFrame, path: str, row_tag: str, root_tag: str) -> None:
    writer = frame.write.mode("overwrite").option("rowTag", row_tag).option("rootTag", root_tag)
    writer.option("declaration", "").xml(path)


def write_weekly_xml(cash_flow: DataFrame, path: str) -> None:
    write_xml(weekly_layout(cash_flow), path, WEEK_ROW, WEEK_ROOT)


def statement_folder(root: str, year: int, month: int) -> str:
    """Folder of one month's statements; the month has no leading zero."""
    return f"{root}/ArchivoExpensas_{year}{month}.xml"


def write_statement_xml(statement: DataFrame, root: str, year: int, month: int) -> str:
    path = statement_folder(root, year, month)
    write_xml(statement, path, STATEMENT_ROW, STATEMENT_ROOT)
    return path
