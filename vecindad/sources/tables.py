"""Stored tables: Parquet folders under one root, or rows given in code."""

from __future__ import annotations

from collections.abc import Collection, Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from vecindad.schemas import TABLES
from vecindad.sinks.batches import BATCH, MONTH, children
from vecindad.sinks.versions import VERSIONED, published, read_version

# Partition columns of stored tables; they are part of what is read back.
_PERIOD = (StructField("anio", IntegerType()), StructField("mes", IntegerType()))
_BATCH = (StructField(BATCH, StringType()),)
_MONTH = (StructField(MONTH, IntegerType()), *_BATCH)
PARTITIONS = {
    "Expensas": _PERIOD,
    "Estado_Financiero": _PERIOD,
    "Estado_Cuentas": _PERIOD,
    "Pago": _BATCH,
    "Detalle_CSV": _MONTH,
    "CSV_Importado": _BATCH,
}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Stored table with its declared schema; nothing is inferred."""
    return spark.read.schema(TABLES[name]).parquet(f"{root}/{name}")


def read_stored(spark: SparkSession, root: str, name: str, months: Collection[int] | None = None) -> DataFrame:
    """Stored table (its last published version), or an empty one if it was never written.

    Of a table laid out by month only the folders of ``months`` (month indexes) are listed
    and read, if these are given; rows stored outside such folders are always read.
    """
    declared = TABLES[name]
    extra = [f for f in PARTITIONS.get(name, ()) if f.name not in declared.fieldNames()]
    schema = StructType([*declared.fields, *extra])
    version = published(spark, root, name) if name in VERSIONED else None
    if version is not None:
        return read_version(spark, version, schema, root)
    if PARTITIONS.get(name) is _MONTH:
        return _read_months(spark, f"{root}/{name}", schema, months)
    try:
        return spark.read.schema(schema).parquet(f"{root}/{name}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _read_months(
    spark: SparkSession, path: str, schema: StructType, months: Collection[int] | None
) -> DataFrame:
    placed, others = [], []
    for name in children(spark, path):
        key, _, value = name.partition("=")
        if key != MONTH:
            others.append(f"{path}/{name}")
        elif months is None or (value.isdigit() and int(value) in months):
            placed.append(f"{path}/{name}")
    # Folders of the batch alone have no month: read apart, as their levels differ.
    parts = [
        spark.read.schema(schema).option("basePath", path).parquet(*some) for some in (placed, others) if some
    ]
    if not parts:
        return spark.createDataFrame([], schema)
    return parts[0].unionByName(parts[1]) if len(parts) > 1 else parts[0]


def table_from_rows(spark: SparkSession, name: str, rows: Iterable[Sequence]) -> DataFrame:
    """Literal rows in declared column order."""
    return spark.createDataFrame(list(rows), TABLES[name])


def empty_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[name])
