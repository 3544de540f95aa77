"""Writing stored tables.

Parquet has no update in place: changed tables are written to a new folder.
Monthly tables are partitioned by period and a month is replaced as a whole,
so a run that was cut short can simply be run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def append(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    _writer(frame, "append", partition_by).parquet(path)


def replace_partitions(frame: DataFrame, path: str, partition_by: tuple[str, ...]) -> None:
    """Overwrites only the partitions that occur in ``frame``."""
    writer = _writer(frame, "overwrite", partition_by)
    writer.option("partitionOverwriteMode", "dynamic").parquet(path)


def write_new(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Writes to a folder that must not exist yet."""
    _writer(frame, "errorifexists", partition_by).parquet(path)


def _writer(frame: DataFrame, mode: str, partition_by: tuple[str, ...]):
    writer = frame.write.mode(mode)
    return writer.partitionBy(*partition_by) if partition_by else writer
