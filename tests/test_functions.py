import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeward import functions as fn


def one(spark, value, build, dtype="string"):
    df = spark.createDataFrame([(value,)], f"v {dtype}")
    return df.select(build(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize(
    ("build", "raw", "expected"),
    [
        (fn.blank_to_null, "  C1 ", "C1"),
        (fn.blank_to_null, "  ", None),
        (fn.title, " new YORK ", "New York"),
        (fn.letters_only, " New-York123", "Newyork"),
        (fn.letters_only, None, None),
        (fn.yes_no, " y", "YES"),
        (fn.yes_no, "NO", "NO"),
        (fn.yes_no, "x", "UNKNOWN"),
        (fn.yes_no, None, "UNKNOWN"),
        (fn.expand_code, " w", "West"),
        (fn.expand_code, "south", "South"),
        (fn.expand_code, "north east", "North East"),
        (fn.to_int, "12.5", 12),
        (fn.to_int, "abc", None),
        (fn.to_int, "", None),
        (fn.to_long, "9007199254740993", 9007199254740993),
        (fn.to_double, "-0.5 ", -0.5),
        (fn.first_number, "18.9 kmpl", 18.9),
        (fn.first_number, "", None),
        (fn.first_number, None, None),
        (fn.repair_timestamp, "2021-01-15 14:30:00.0", dt.datetime(2021, 1, 15, 14, 30)),
        (fn.repair_timestamp, "2021-01-15 14:30:00", dt.datetime(2021, 1, 15, 14, 30)),
        (fn.repair_timestamp, "-", None),
        (fn.parse_timestamp, "15-01-2021 14:30", dt.datetime(2021, 1, 15, 14, 30)),
        (fn.parse_timestamp, "2021-01-15", None),
        (fn.parse_date, "2021-01-15", dt.date(2021, 1, 15)),
        (fn.parse_date, "15/01/2021", None),
    ],
)
def test_column_function(spark, build, raw, expected):
    assert one(spark, raw, build) == expected


def test_first_number_as_int(spark):
    assert one(spark, "1197 CC", lambda c: fn.first_number(c, "int")) == 1197


def test_placeholder(spark):
    assert one(spark, " ? ", lambda c: fn.unless_placeholder(c, F.upper(c))) == "UNKNOWN"
    assert one(spark, "ca", lambda c: fn.unless_placeholder(c, F.upper(c))) == "CA"


def test_fill_template_prints_none_for_null(spark):
    made = one(spark, None, lambda c: fn.fill_template("a {v} b{v}", {"v": c}))
    assert made == "a None bNone"


MARITAL = ["Single", "Married", "Divorced", "Na"]
EDUCATION = ["Primary", "Secondary", "Tertiary", "Terto", "Na"]


@pytest.mark.parametrize(
    ("before", "after"),
    [
        (("Secondary", "Married"), ("Married", "Secondary")),
        (("Na", "Primary"), ("Na", "Primary")),
        (("Married", "Na"), ("Married", "Na")),
        (("Primary", "Primary"), ("Primary", "Primary")),
        (("Primary", None), ("Primary", None)),
    ],
)
def test_swap_only_when_both_sides_are_misfiled(spark, before, after):
    df = spark.createDataFrame([before], "m string, e string")
    assert tuple(fn.swap_misfiled(df, "m", "e", MARITAL, EDUCATION).first()) == after


def test_first_of_skips_absent_aliases(spark):
    df = spark.createDataFrame([(None, "b")], "x string, y string")
    assert df.select(fn.first_of(df, "x", "z", "y")).first()[0] == "b"
    assert df.select(fn.first_of(df, "q")).first()[0] is None
