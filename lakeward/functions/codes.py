"""Code expansion, aliased source columns and misfiled values."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One-letter region codes.
REGION_CODES = {"W": "West", "C": "Central", "E": "East", "S": "South"}


def expand_code(c: Column, codes: dict[str, str] = REGION_CODES) -> Column:
    """Replace a known code (any case, padded) by its name; title-case everything else."""
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(codes.items())])
    return F.coalesce(table[F.upper(F.trim(c))], F.initcap(F.trim(c)))


def first_of(df: DataFrame, *names: str) -> Column:
    """First non-null value among the aliases that this input actually has."""
    present = [F.col(f"`{n}`") for n in names if n in df.columns]
    if not present:
        return F.lit(None).cast("string")
    return F.coalesce(*present)


def swap_misfiled(
    df: DataFrame, left: str, right: str, left_domain: list[str], right_domain: list[str]
) -> DataFrame:
    """Exchange two columns on rows where each holds a value of the other's domain.

    Both new values come from the original row, and a value that lies in both
    domains never triggers the exchange, so no valid value is overwritten.
    """
    only_left = [v for v in left_domain if v not in right_domain]
    only_right = [v for v in right_domain if v not in left_domain]
    crossed = F.coalesce(
        F.col(left).isin(only_right) & F.col(right).isin(only_left), F.lit(False)
    )
    return df.withColumns(
        {
            left: F.when(crossed, F.col(right)).otherwise(F.col(left)),
            right: F.when(crossed, F.col(left)).otherwise(F.col(right)),
        }
    )
