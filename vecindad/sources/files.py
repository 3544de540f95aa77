"""Readers for the five kinds of input file.

Every reader takes whole lines, skips the header line and cuts each line with the
column function of its kind, the same for batch and streaming.  Amounts and dates
stay text for the import jobs to convert.  A quote is a character like any other,
but in the building list (a spreadsheet page saved as CSV) and around an amount.
The last column of a line runs to its end, so an amount keeps its decimal comma.
A path may be a file, a folder or a pattern; one that matches nothing fails when
the reader is called.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.schemas import FILES

# Field separators of the files.
SEPARATORS = {
    "buildings": ",",
    "units": "\t",
    "unit_accounts": "|",
    "persons": ";",
    "payments": ",",
}


#: The whole line, kept beside what was read from it.
LINE = "linea"
_NEVER = "\x01"


def line_options() -> dict[str, str]:
    """CSV options that give whole lines and skip each file's header."""
    return {
        "sep": _NEVER,
        "quote": "",
        "header": "true",
        "enforceSchema": "true",
        "encoding": "UTF-8",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }


def parsed_line(kind: str, line: Column) -> Column:
    """The fields of one line as a struct; a field that is missing or no number is NULL."""
    fields = FILES[kind].fields
    line = F.regexp_replace(line, r"\r$", "")
    if kind == "buildings":
        return F.from_csv(line, _ddl(kind))
    parts = F.split(line, f"[{SEPARATORS[kind]}]", len(fields))
    columns = []
    for k, field in enumerate(fields):
        value = F.get(parts, k)
        if kind == "payments" and k == len(fields) - 1:
            value = F.regexp_replace(value, r'^\s*"(.*)"\s*$', "$1")
        if field.dataType.simpleString() != "string":
            value = F.trim(value).try_cast(field.dataType)
        else:
            value = F.when(value != "", value)
        columns.append(value.alias(field.name))
    return F.struct(*columns)


def _ddl(kind: str) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in FILES[kind].fields)


def with_fields(lines: DataFrame, kind: str) -> DataFrame:
    """``lines`` with the fields in place of the line, which stays as ``linea``."""
    others = [c for c in lines.columns if c != LINE]
    return lines.withColumn("_campos", parsed_line(kind, F.col(LINE))).select("_campos.*", *others, LINE)


def read_file(spark: SparkSession, kind: str, path: str | list[str]) -> DataFrame:
    lines = spark.read.schema(f"{LINE} string").options(**line_options()).csv(path)
    return with_fields(lines, kind).drop(LINE)


def read_buildings(spark: SparkSession, path: str) -> DataFrame:
    """Building list (a spreadsheet page saved as CSV)."""
    return read_file(spark, "buildings", path)


def read_units(spark: SparkSession, path: str) -> DataFrame:
    return read_file(spark, "units", path)


def read_unit_accounts(spark: SparkSession, path: str) -> DataFrame:
    return read_file(spark, "unit_accounts", path)


def read_persons(spark: SparkSession, path: str) -> DataFrame:
    return read_file(spark, "persons", path)


def payment_lines(lines: DataFrame) -> DataFrame:
    """Fields of payment lines, with the line itself and the name of its file as the registry keeps it."""
    return with_fields(lines.withColumn("nombreArchivo", F.col("_metadata.file_name")), "payments")


def read_payments(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return payment_lines(spark.read.schema(f"{LINE} string").options(**line_options()).csv(path))
