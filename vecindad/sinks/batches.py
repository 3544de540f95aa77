"""Import batches: lines staged once, and tables laid out by month and batch.

A batch is read from its files once, into a staged folder; every table of the batch is
derived from there, and the folder goes when the batch is registered.  A repeated batch
overwrites what the run before left.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.sinks.versions import file_system

MONTH, BATCH = "periodo", "lote"
# Characters that Spark escapes in the folder name of a partition.
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")


def folder_name(batch: str) -> str:
    return _ESCAPED.sub(lambda m: f"%{ord(m[0]):02X}", batch)


def _staged(root: str, batch: str) -> str:
    return f"{root}/_lotes/lote-{folder_name(batch)}"


def stage(spark: SparkSession, root: str, batch: str, name: str, rows: DataFrame) -> DataFrame:
    """Writes rows of a batch and reads them back."""
    path = f"{_staged(root, batch)}/{name}"
    rows.write.mode("overwrite").parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def release(spark: SparkSession, root: str, batch: str) -> None:
    """Removes what was staged for a batch."""
    files, folder = file_system(spark, _staged(root, batch))
    files.delete(folder, True)


def replace_batch(spark: SparkSession, rows: DataFrame, path: str, month: Column, batch: str) -> None:
    """Stores the rows of a batch under ``periodo=<month>/lote=<batch>``.

    The months of the batch are overwritten one folder each, other batches are left alone,
    and months of an earlier run that the batch no longer has are removed last.
    """
    before = _of_batch(spark, path, batch)
    placed = rows.withColumns({MONTH: month, BATCH: F.lit(batch)})
    # Files of a sensible size for each month, a large month in several.
    writer = placed.hint("rebalance", F.col(MONTH)).write.mode("overwrite").partitionBy(MONTH, BATCH)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)
    after = _of_batch(spark, path, batch)
    for folder, names in before.items():
        if names & after.get(folder, set()):
            files, where = file_system(spark, folder)
            files.delete(where, True)


def _of_batch(spark: SparkSession, path: str, batch: str) -> dict[str, set[str]]:
    """Names of the data files of a batch in each month that has it; one look per month."""
    found = {}
    for name in children(spark, path):
        if name.startswith(f"{MONTH}="):
            folder = f"{path}/{name}/{BATCH}={folder_name(batch)}"
            names = children(spark, folder)
            if names:
                found[folder] = set(names)
    return found


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, without hidden ones; none if there is no such folder."""
    files, where = file_system(spark, path)
    if not files.exists(where):
        return []
    names = [status.getPath().getName() for status in files.listStatus(where)]
    return sorted(n for n in names if n[0] not in "._")
