"""Column functions; all of them are compositions of Spark built-ins."""

from vecindad.functions.amounts import clean_money, decimal_comma, parse_amount
from vecindad.functions.dates import (
    month_start_by_name,
    parse_day_month_year,
    previous_month,
    previous_year,
    week_of_year,
)
from vecindad.functions.text import comparable, digits_only, pad_id, unit_label, yes_flag

__all__ = [
    "clean_money",
    "comparable",
    "decimal_comma",
    "digits_only",
    "month_start_by_name",
    "pad_id",
    "parse_amount",
    "parse_day_month_year",
    "previous_month",
    "previous_year",
    "unit_label",
    "week_of_year",
    "yes_flag",
]
