"""Reading the corpus tables and cutting lineage in the shared folder."""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecindad.session import shared_dir

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(frame: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back: no lineage, no recomputation.

    Lost executors cost nothing of what is stored; nothing is left on their disks.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/vecindad-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def own_names(step: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """For a step that gives back the columns of ``docs``: those that begin with an underscore,
    as the names that steps use inside do, have other names while it runs."""

    @functools.wraps(step)
    def run(docs: DataFrame, *args, **options) -> DataFrame:
        apart = {c: f"caller {k} {c}" for k, c in enumerate(docs.columns) if c.startswith("_")}
        if not apart:
            return step(docs, *args, **options)
        back = {other: c for c, other in apart.items()}
        return step(docs.withColumnsRenamed(apart), *args, **options).withColumnsRenamed(back)

    return run


def fold(key: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as an empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def row_key(doc_id: Column, text: Column) -> Column:
    """A join key that is never null.  Rows may share it: what is joined by it depends on content only."""
    return F.coalesce(doc_id.cast("long"), F.xxhash64(text))
