"""Numeric parsing that yields null instead of raising under ANSI mode."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(c: Column) -> Column:
    return F.trim(c).try_cast("double")


def to_int(c: Column) -> Column:
    """Whole part of a number in text; ``12.5`` gives 12 and ``abc`` gives null."""
    return to_double(c).try_cast("int")


def to_long(c: Column) -> Column:
    """Like :func:`to_int` for 64-bit values, through a decimal so no digit is lost."""
    return F.trim(c).try_cast("decimal(38,6)").try_cast("bigint")


def first_number(c: Column, dtype: str = "double") -> Column:
    """First number inside free text such as ``18.9 kmpl`` or ``1197 CC``."""
    pattern = r"\d+" if dtype in ("int", "bigint") else r"\d+\.?\d*"
    return F.regexp_extract(c, pattern, 0).try_cast(dtype)


def null_safe_sum(*columns: Column) -> Column:
    """Sum in which a null part counts as zero."""
    return reduce(add, [F.coalesce(c, F.lit(0.0)) for c in columns])
