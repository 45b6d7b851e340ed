"""Column expressions shared by every layer; all stay inside the JVM."""

from lakeward.functions.codes import REGION_CODES, expand_code, first_of, swap_misfiled
from lakeward.functions.numbers import first_number, null_safe_sum, to_double, to_int, to_long
from lakeward.functions.text import (
    blank_to_null,
    fill_template,
    letters_only,
    title,
    unless_placeholder,
    yes_no,
)
from lakeward.functions.times import days_between, parse_date, parse_timestamp, repair_timestamp

__all__ = [
    "REGION_CODES",
    "blank_to_null",
    "days_between",
    "expand_code",
    "fill_template",
    "first_number",
    "first_of",
    "letters_only",
    "null_safe_sum",
    "parse_date",
    "parse_timestamp",
    "repair_timestamp",
    "swap_misfiled",
    "title",
    "to_double",
    "to_int",
    "to_long",
    "unless_placeholder",
    "yes_no",
]
