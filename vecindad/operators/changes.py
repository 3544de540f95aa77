"""Insert-if-missing and update-from-join on DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecindad.operators.joins import lookup_join


def insert_if_missing(new: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``new`` whose key does not occur in ``existing``.

    The existing side is reduced to its key columns before the join.  Keys
    with a NULL match nothing, so such rows count as new.
    """
    return new.join(existing.select(*keys), list(keys), "left_anti").select(*new.columns)


def one_row_per_key(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keeps the largest row of each key: the same choice on every run.

    A grouped maximum combines on the map side, so a key with very many
    copies costs no more than any other.
    """
    rest = [c for c in frame.columns if c not in keys]
    if not rest:
        return frame.groupBy(*keys).agg(F.lit(1).alias("_one")).select(*frame.columns)
    if len(rest) == 1:  # one fixed-width value is combined by hashing, without a sort
        return frame.groupBy(*keys).agg(F.max(rest[0]).alias(rest[0])).select(*frame.columns)
    picked = frame.groupBy(*keys).agg(F.max(F.struct(*rest)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*frame.columns)


def update_from_join(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    assign: Mapping[str, str],
    only_when: Column | None = None,
) -> DataFrame:
    """``target`` with columns replaced from the matching ``source`` row.

    ``assign`` maps target columns to source columns; ``only_when`` is a
    condition on the target row.  Where several source rows match, the largest
    is taken, so no target row is ever repeated or lost.
    """
    picked = one_row_per_key(source.select(*keys, *dict.fromkeys(assign.values())), keys)
    renamed = picked.select(
        *keys,
        F.lit(True).alias("_found"),
        *[F.col(c).alias(f"_new_{c}") for c in dict.fromkeys(assign.values())],
    )
    joined = lookup_join(target, renamed, keys, "left")
    hit = F.col("_found").isNotNull()
    if only_when is not None:
        hit = hit & only_when
    return joined.select(
        *[
            F.when(hit, F.col(f"_new_{assign[c]}")).otherwise(F.col(c)).alias(c)
            if c in assign
            else F.col(c)
            for c in target.columns
        ]
    )
