"""Timestamp repair and parsing; unparseable text becomes null."""

from __future__ import annotations

import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Input formats.
POLICY_DATE_FORMAT = "yyyy-MM-dd"
SALES_TIME_FORMAT = "dd-MM-yyyy HH:mm"


def repair_timestamp(c: Column) -> Column:
    """Parse a timestamp whose seconds may carry a stray ``.0`` (``14:30:00.0``)."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(c), r":00\.0$", ":00"))


def parse_timestamp(c: Column, fmt: str = SALES_TIME_FORMAT) -> Column:
    return F.try_to_timestamp(F.trim(c), F.lit(fmt))


def parse_date(c: Column, fmt: str = POLICY_DATE_FORMAT) -> Column:
    return F.try_to_timestamp(F.trim(c), F.lit(fmt)).cast("date")


def days_between(end: Column, start: Column) -> Column:
    return F.datediff(end, start)


def as_of_date(as_of: datetime.date | str) -> Column:
    """A fixed reporting date, so that ages never depend on the clock."""
    return F.lit(str(as_of)).cast("date")
