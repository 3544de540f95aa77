"""Text comparison and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def comparable(text: Column) -> Column:
    """Form in which two texts are equal when case and trailing blanks differ."""
    return F.upper(F.rtrim(text))


def digits_only(text: Column) -> Column:
    return F.coalesce(F.regexp_replace(text, "[^0-9]", ""), F.lit(""))


def pad_id(text: Column) -> Column:
    """Eight-digit identity number; NULL unless seven or eight digits are left."""
    digits = digits_only(text)
    return F.when(F.length(digits).between(7, 8), F.lpad(digits, 8, "0"))


def yes_flag(text: Column) -> Column:
    """1 for ``SI`` in any case, else 0 (also for NULL)."""
    return F.when(comparable(text) == "SI", 1).otherwise(0).cast("smallint")


def unit_label(floor: Column, letter: Column) -> Column:
    """Fixed-width floor followed by the letter: floor 1, unit A -> ``1 A``."""
    return F.concat(F.rpad(floor, 2, " "), F.rpad(letter, 1, " "))


def joined(separator: str, *parts: Column) -> Column:
    """Concatenation that reads NULL as empty text."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(separator), F.coalesce(part, F.lit(""))]
    return F.concat(*pieces[1:])


def surrogate(*key: Column) -> Column:
    """64-bit id from a natural key: equal on every run and every retry."""
    return F.xxhash64(*key)


def wide_surrogate(*key: Column) -> Column:
    """128-bit id for row counts at which 64 bits would collide."""
    return F.md5(F.concat_ws("\x1f", *[F.coalesce(k.cast("string"), F.lit("\x00")) for k in key]))
