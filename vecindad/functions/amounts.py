"""Amounts written as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def try_decimal(text: Column, precision: int, scale: int) -> Column:
    """Decimal value of ``text`` or NULL; exponent notation is no amount."""
    return F.translate(text, "eE", "xx").try_cast(f"decimal({precision},{scale})")


def parse_amount(text: Column) -> Column:
    """Amount whose thousands and decimal marks may be either way round.

    The later mark is the decimal one.  With several commas the first is
    noise, dots are grouping and the remaining comma is the decimal mark.
    Text with only one kind of mark, or none, counts as 0, and so does NULL.
    """
    first_comma, first_dot = F.instr(text, ","), F.instr(text, ".")
    commas = F.length(F.rtrim(text)) - F.length(F.rtrim(F.translate(text, ",", "")))
    comma_decimal = F.translate(text, ",.", ".")
    dot_decimal = F.translate(text, ",", "")
    number = (
        F.when(commas > 1, F.translate(F.regexp_replace(text, "^([^,]*),", "$1"), ",.", "."))
        .when((first_dot > 0) & (first_dot < first_comma), comma_decimal)
        .when((first_comma > 0) & (first_comma < first_dot), dot_decimal)
        .otherwise("0")
    )
    return try_decimal(number, 18, 2)


def clean_money(text: Column) -> Column:
    """``$ 1.234,50`` -> 1234.50: dots group, the comma is the decimal mark."""
    return try_decimal(F.trim(F.translate(text, ",.$", ".")), 12, 2)


def decimal_comma(text: Column, precision: int, scale: int) -> Column:
    """Number with a comma as decimal mark; NULL when it does not fit."""
    return try_decimal(F.translate(text, ",", "."), precision, scale)


def truncated_share(amount: Column, parts: Column) -> Column:
    """``amount / parts`` cut (not rounded) after six decimals."""
    micros = F.call_function(
        "div", (amount * F.lit(1_000_000)).cast("decimal(28,2)"), parts.cast("decimal(5,0)")
    )
    return (micros.cast("decimal(18,0)") * F.lit("0.000001").cast("decimal(6,6)")).cast(
        "decimal(18,6)"
    )
