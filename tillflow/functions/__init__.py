"""Column helpers: exact money, time, nested fields."""

from tillflow.functions.money import exact_sum, mean_of, off_scale, quotient, ratio, sum_of, total_of
from tillflow.functions.nested import each_item, item_rows, parse_json
from tillflow.functions.times import from_micros, in_year, in_years, month_of, seconds_between

__all__ = [
    "each_item",
    "exact_sum",
    "from_micros",
    "in_year",
    "in_years",
    "item_rows",
    "mean_of",
    "month_of",
    "off_scale",
    "parse_json",
    "quotient",
    "ratio",
    "seconds_between",
    "sum_of",
    "total_of",
]
