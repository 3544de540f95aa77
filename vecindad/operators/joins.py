"""Joining many rows with a lookup of one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup_join(
    rows: DataFrame, lookup: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """``rows`` joined with ``lookup`` on ``keys``; any key may hold most of the rows.

    A small lookup is broadcast if the optimizer finds it small.  Otherwise both
    sides are shuffled, and adaptive execution splits the partitions of hot keys.
    It can do so only if both inputs come straight from a shuffle made for the
    join; a lookup that was grouped by the same keys would be taken as it lies.
    Joining on a hash of the keys as well makes it shuffle the (small) lookup
    once more and keeps the split possible.
    """
    marked = [frame.withColumn("_hash", F.xxhash64(*keys)) for frame in (rows, lookup)]
    return marked[0].join(marked[1], [*keys, "_hash"], how).drop("_hash")
