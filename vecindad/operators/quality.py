"""Checks for the rules declared with the tables.

Every check returns (regla, clave, detalle, filas): the rule, the offending
key or value, a description and the number of rows concerned.  Offending rows
are counted per value, so a value that fails very often is one row of output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vecindad.functions.text import joined
from vecindad.schemas import RULES, Rules


def _as_text(columns: Sequence[str]) -> Column:
    return joined("|", *[F.col(c).cast("string") for c in columns])


def unique_key(frame: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once; keys are compared as a whole."""
    return (
        frame.groupBy(*key)
        .agg(F.count("*").alias("filas"))
        .where(F.col("filas") > 1)
        .select(
            F.lit("unique").alias("regla"),
            _as_text(key).alias("clave"),
            F.lit("+".join(key)).alias("detalle"),
            "filas",
        )
    )


def foreign_key(frame: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Values without a parent row.  Children are counted per value first."""
    used = (
        frame.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("_valor"))
        .agg(F.count("*").alias("filas"))
    )
    known = parent.select(F.col(parent_key).alias("_valor"))
    return used.join(known, "_valor", "left_anti").select(
        F.lit("foreign_key").alias("regla"),
        F.col("_valor").cast("string").alias("clave"),
        F.lit(column).alias("detalle"),
        "filas",
    )


# Row-level rules: (rule, column, failing condition).  A NULL value fails only
# ``not_null``.
def not_allowed(column: str, values: Sequence[str]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(*values)


def out_of_range(column: str, low: int, high: int) -> Column:
    return ~F.col(column).between(low, high)


def not_digits(column: str) -> Column:
    return F.col(column).rlike("[^0-9]")


def is_missing(column: str) -> Column:
    return F.col(column).isNull()


def too_long(column: str, limit: int) -> Column:
    return F.length(F.rtrim(column)) > limit


def does_not_fit(column: str, precision: int, scale: int) -> Column:
    return F.col(column).isNotNull() & F.col(column).try_cast(
        f"decimal({precision},{scale})"
    ).isNull()


def row_checks(frame: DataFrame, checks: Sequence[tuple[str, str, Column]]) -> DataFrame:
    """All row-level rules in a single pass over the table.

    Each row lists the rules it fails; only those are exploded and counted by
    rule, column and value.
    """
    failed = F.filter(
        F.array(
            *[
                F.when(
                    condition,
                    F.struct(
                        F.lit(rule).alias("regla"),
                        F.col(column).cast("string").alias("clave"),
                        F.lit(column).alias("detalle"),
                    ),
                )
                for rule, column, condition in checks
            ]
        ),
        lambda e: e.isNotNull(),
    )
    return (
        frame.select(F.inline(failed))
        .groupBy("regla", "clave", "detalle")
        .agg(F.count("*").alias("filas"))
    )


def checks_of(rules: Rules) -> list[tuple[str, str, Column]]:
    checks: list[tuple[str, str, Column]] = []
    checks += [("not_null", c, is_missing(c)) for c in rules.required]
    checks += [("domain", c, not_allowed(c, v)) for c, v in rules.allowed.items()]
    checks += [("range", c, out_of_range(c, *v)) for c, v in rules.between.items()]
    checks += [("digits", c, not_digits(c)) for c in rules.digits]
    checks += [("length", c, too_long(c, n)) for c, n in rules.max_length.items()]
    checks += [("decimal_fit", c, does_not_fit(c, *p)) for c, p in rules.fits.items()]
    return checks


def check_table(name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """All declared rules of one table; parents not in ``tables`` are left out."""
    rules, frame = RULES[name], tables[name]
    parts = []
    if checks_of(rules):
        parts.append(row_checks(frame, checks_of(rules)))
    if rules.key:
        parts.append(unique_key(frame, rules.key))
    parts += [unique_key(frame.dropna(subset=list(key)), key) for key in rules.unique]
    for column, (parent, parent_key) in rules.parents.items():
        if parent in tables:
            parts.append(foreign_key(frame, column, tables[parent], parent_key))
    return reduce(DataFrame.unionByName, parts)


def with_default(frame: DataFrame, column: str, value) -> DataFrame:
    """NULLs of a column replaced by its declared default."""
    return frame.withColumn(column, F.coalesce(F.col(column), F.lit(value)))
