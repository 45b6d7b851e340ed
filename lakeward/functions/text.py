"""Text cleaning expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# How missing entries are marked in the input and in the output.
PLACEHOLDER = "?"
UNKNOWN = "UNKNOWN"
MISSING_IN_TEMPLATE = "None"


def blank_to_null(c: Column) -> Column:
    """Trimmed text; an empty string counts as missing (also for required keys)."""
    return F.nullif(F.trim(c), F.lit(""))


def title(c: Column) -> Column:
    """Trimmed text with every blank-separated word capitalised."""
    return F.initcap(F.trim(c))


def letters_only(c: Column) -> Column:
    """Title case of what is left after dropping everything but letters and blanks.

    Characters are removed, not replaced: ``New-York123`` becomes ``Newyork``.
    """
    return F.initcap(F.regexp_replace(F.trim(c), "[^a-zA-Z ]", ""))


def unless_placeholder(c: Column, cleaned: Column) -> Column:
    """``UNKNOWN`` where the raw text is the placeholder mark, else the cleaned text."""
    return F.when(F.trim(c) == PLACEHOLDER, F.lit(UNKNOWN)).otherwise(cleaned)


def yes_no(c: Column) -> Column:
    """YES / NO / UNKNOWN from one-letter or spelled-out flags.

    Differs from the one-letter-only mapping it replaces: YES and NO are kept.
    """
    flag = F.upper(F.trim(c))
    return (
        F.when(flag.isin("Y", "YES"), F.lit("YES"))
        .when(flag.isin("N", "NO"), F.lit("NO"))
        .otherwise(F.lit(UNKNOWN))
    )


def fill_template(template: str, values: dict[str, Column]) -> Column:
    """Concatenate a ``{name}`` template with per-row values; nulls print as ``None``."""
    parts = []
    for index, piece in enumerate(re.split(r"\{(\w+)\}", template)):
        if index % 2:
            parts.append(F.coalesce(values[piece].cast("string"), F.lit(MISSING_IN_TEMPLATE)))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts)
