"""Changing stored Parquet tables: buckets of a new version, published by one file.

A table that is changed in place is kept in buckets of its key.  A change writes the
buckets it touches to a folder of its own and then publishes a list of the folders
that now make up the table, as the next numbered file; readers take the last list that is
whole.  A run that is cut short leaves files that no list names, and the version before
stays as it is.  Two writers cannot publish the same number: the later one fails and can
be repeated on what the other one stored.

Until its first change a table is its plain folder.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables kept in versions, with the key their buckets go by.
VERSIONED = {"Unidad_Funcional": "unidadFuncionalID"}
BUCKETS = 64
_BUCKET = "cubo"
_END = "\nfin\n"


class Version(NamedTuple):
    """Number of a published list, and the folders of each bucket."""

    number: int
    folders: dict[str, list[str]]


def file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def _lists(root: str, name: str) -> str:
    return f"{root}/_versiones/{name}"


def _numbers(spark: SparkSession, root: str, name: str) -> list[int]:
    files, folder = file_system(spark, _lists(root, name))
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder)]
    return sorted(int(n) for n in names if n.isdigit())


def published(spark: SparkSession, root: str, name: str) -> Version | None:
    """The last version whose list is whole; None for a table that was never changed."""
    for number in reversed(_numbers(spark, root, name)):
        files, file = file_system(spark, f"{_lists(root, name)}/{number:08d}")
        stream = files.open(file)
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        stream.close()
        if text.endswith(_END):
            return Version(number, json.loads(text.removesuffix(_END)))
    return None


def publish(spark: SparkSession, root: str, name: str, number: int, folders: dict[str, list[str]]) -> None:
    """Makes ``folders`` the table; fails if the number has been taken."""
    files, file = file_system(spark, f"{_lists(root, name)}/{number:08d}")
    stream = files.create(file, False)
    stream.write(bytearray((json.dumps(folders) + _END).encode()))
    stream.close()


def read_version(spark: SparkSession, version: Version, schema, root: str) -> DataFrame:
    paths = [f"{root}/{folder}" for some in version.folders.values() for folder in some]
    return spark.read.schema(schema).parquet(*paths)


def bucket(name: str) -> Column:
    return F.pmod(F.xxhash64(VERSIONED[name]), F.lit(BUCKETS)).cast("int")


def _stage(rows: DataFrame, root: str, name: str) -> str:
    """Writes rows by bucket to a new folder, whose name it returns."""
    folder = f"_versiones/{name}-{uuid.uuid4().hex}"
    rows.withColumn(_BUCKET, bucket(name)).repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{root}/{folder}")
    return folder


def _taken(spark: SparkSession, root: str, name: str) -> int:
    return max(_numbers(spark, root, name), default=0) + 1


def add_rows(spark: SparkSession, root: str, name: str, rows: DataFrame) -> None:
    """Appends rows: to the plain folder, or to the buckets of a changed table as a new version."""
    before = published(spark, root, name)
    if before is None:
        rows.write.mode("append").parquet(f"{root}/{name}")
        return
    number = _taken(spark, root, name)
    folder = _stage(rows, root, name)
    more = {str(b): [*before.folders.get(str(b), []), f"{folder}/{_BUCKET}={b}"] for b in _held(spark, root, folder)}
    publish(spark, root, name, number, {**before.folders, **more})


def _held(spark: SparkSession, root: str, folder: str) -> list[int]:
    """The buckets of a staged folder, from its names."""
    files, where = file_system(spark, f"{root}/{folder}")
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{_BUCKET}="))


def change_rows(
    spark: SparkSession, root: str, name: str, changed: DataFrame, columns: Sequence[str], before: Version | None
) -> int:
    """Stores ``changed``: every row of the table as read from ``before``, with ``_cambio`` where a row is another
    one now.  Only buckets with such rows are written; their number is returned (0: nothing is published)."""
    dirty = changed.where("_cambio").select(bucket(name).alias("b")).distinct()
    touched = sorted(r.b for r in dirty.collect())  # at most BUCKETS
    if not touched:
        return 0
    number = _taken(spark, root, name)
    if before is None:
        rows, kept = changed, {}
    else:
        rows = changed.where(bucket(name).isin(touched))
        kept = {b: some for b, some in before.folders.items() if int(b) not in touched}
    folder = _stage(rows.select(*columns), root, name)
    publish(spark, root, name, number, {**kept, **{str(b): [f"{folder}/{_BUCKET}={b}"] for b in _held(spark, root, folder)}})
    return len(touched)
