"""Reference checks and lookups between tables.

Lookups have one row per key, so no join here can fan out.  Spark broadcasts a lookup
by itself when its estimated size is under ``spark.sql.autoBroadcastJoinThreshold``;
larger ones are shuffled, and there a key that holds a large share of the rows would
land in one task.  :func:`lookup_join` splits such keys explicitly, because adaptive
execution cannot do it when a lookup is itself the outcome of an aggregate or a window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeward.operators.dedup import one_per_key

# A key is hot from HOT_ROWS rows on.  Only the MAX_HOT_KEYS largest are treated so: that
# bounds the broadcast whatever the table size, and any other key holds less than one part
# in MAX_HOT_KEYS of the rows.
HOT_ROWS = 1_000_000
MAX_HOT_KEYS = 10_000
HOT_SALTS = 4096


def key_rows(df: DataFrame, key: str) -> DataFrame:
    """(key, _rows): rows per non-null key; reads one column and combines before the shuffle."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))


def hottest(counts: DataFrame, hot_rows: int = HOT_ROWS, limit: int = MAX_HOT_KEYS) -> DataFrame:
    """The rows of ``counts`` (one per key, with ``_rows``) that belong to hot keys."""
    return counts.where(F.col("_rows") >= hot_rows).orderBy(F.desc("_rows")).limit(limit)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own size estimate of ``df`` lets it broadcast the frame by itself."""
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def lookup_join(
    df: DataFrame,
    lookup: DataFrame,
    key: str,
    lookup_key: str,
    columns: list[str],
    spread_by: list[str] | None = None,
    hot: DataFrame | None = None,
    hot_rows: int = HOT_ROWS,
    salts: int = HOT_SALTS,
    *,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join to a lookup with one row per key, safe for hot and null keys.

    The lookup rows of hot keys (at most ``MAX_HOT_KEYS``) are broadcast, and the rows
    of df with a hot or null key are spread over ``salts`` partitions by the hash of the
    ``spread_by`` columns (default: all); all other keys go through an ordinary join.
    Every row of df is kept exactly once.  ``hot`` hands in lookup rows known to be hot.
    Keys are counted in ``counted`` (default: df), which decides where rows go but not what
    they find.  A stream cannot be counted ahead: there ``counted`` is the stored input of the
    run, and without it only null keys are spread.
    A lookup that Spark broadcasts anyway needs neither the count nor the salt.
    """
    slim = lookup.select(F.col(lookup_key).alias("_key"), F.struct(*columns).alias("_found"))
    own = [F.col(f"`{c}`") for c in df.columns]
    if hot is None and fits_broadcast(slim):
        joined = df.join(slim, F.col(key) == F.col("_key"), "left")
        return joined.select(*own, *[F.col("_found").getField(c).alias(c) for c in columns])
    if counted is None and not df.isStreaming:
        counted = df
    if hot is None and counted is None:
        none = slim.where(F.lit(False))
        hot = none.select(F.col("_key").alias("_hot_key"), F.col("_found").alias("_hot_found"))
    elif hot is None:
        keys = hottest(key_rows(counted, key), hot_rows).select(F.col(key).alias("_hot_key"))
        known = keys.join(slim, F.col("_hot_key") == F.col("_key"), "left")
        hot = known.select("_hot_key", F.col("_found").alias("_hot_found"))
    else:
        hot = hot.select(
            F.col(lookup_key).alias("_hot_key"), F.struct(*columns).alias("_hot_found")
        )
    spread = 1 + F.pmod(F.xxhash64(*(spread_by or _hashable(df))), F.lit(salts))
    salted = df.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_salt",
        F.when(F.col("_hot_key").isNotNull() | F.col(key).isNull(), spread).otherwise(
            F.lit(0).cast("bigint")
        ),
    )
    # Always 0, but no constant: the optimizer would fold a literal away and join on the
    # key alone, which puts hot rows back together.
    zero = F.xxhash64("_key").bitwiseAND(F.lit(0))
    cold = slim.withColumn("_cold_salt", zero)
    joined = salted.join(
        cold, (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_cold_salt")), "left"
    )
    found = F.coalesce("_hot_found", "_found")
    return joined.select(*own, *[found.getField(c).alias(c) for c in columns])


def _hashable(df: DataFrame) -> list[Column]:
    return [F.col(f"`{n}`") for n, t in df.dtypes if not t.startswith(("map", "variant"))]


def require_fk(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows whose key exists in ``ref``; repeats in ``ref`` do not matter, hot keys are split."""
    found = flag_orphans(df.where(F.col(key).isNotNull()), ref, key, "_known", ref_key)
    return found.where("_known").drop("_known")


def orphans(df: DataFrame, ref: DataFrame, key: str, ref_key: str | None = None) -> DataFrame:
    """Rows whose key is null or absent from ``ref``; hot and null keys are split."""
    return flag_orphans(df, ref, key, "_known", ref_key).where("NOT _known").drop("_known")


def flag_orphans(
    df: DataFrame,
    ref: DataFrame,
    key: str,
    flag: str,
    ref_key: str | None = None,
    unique: bool = False,
    split_hot: bool = True,
    spread_by: list[str] | None = None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Keep every row and add ``flag`` (true when the key exists in ``ref``).

    ``unique=True`` skips the distinct step when ``ref`` already has one row per key;
    ``split_hot=False`` leaves hot keys to Spark.  ``counted`` as for :func:`lookup_join`.
    """
    lookup = ref.select(F.col(ref_key or key).alias("_ref_key"))
    lookup = lookup.where(F.col("_ref_key").isNotNull())
    if not unique:
        lookup = lookup.distinct()
    if not split_hot:
        joined = df.join(lookup, F.col(key) == F.col("_ref_key"), "left")
        return joined.withColumn(flag, F.col("_ref_key").isNotNull()).drop("_ref_key")
    marked = lookup.withColumn("_present", F.lit(True))
    joined = lookup_join(df, marked, key, "_ref_key", ["_present"], spread_by, counted=counted)
    return joined.withColumn(flag, F.coalesce("_present", F.lit(False))).drop("_present")


def enrich(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    columns: list[str],
    lookup_key: str | None = None,
    order_by: list[Column] | None = None,
    split_hot: bool = True,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Left join a fact to a lookup at one row per key, so the fact keeps its grain.

    ``order_by`` picks the row when a key repeats; leave it out only for a lookup
    that is unique by construction.  ``split_hot=False`` suits a fact that is already
    summed per key.  ``counted`` as for :func:`lookup_join`.
    """
    lookup_key = lookup_key or key
    if order_by is not None:
        lookup = one_per_key(lookup, lookup_key, order_by)
    if split_hot:
        return lookup_join(fact, lookup, key, lookup_key, columns, counted=counted)
    slim = lookup.select(F.col(lookup_key).alias("_lookup_key"), *columns)
    return fact.join(slim, F.col(key) == F.col("_lookup_key"), "left").drop("_lookup_key")


def star_join(
    per_key: DataFrame, dims: list[tuple[DataFrame, str, str, list[str]]]
) -> DataFrame:
    """Left join dimensions given as (frame, fact key, dimension key, columns).

    For facts already summed per key.  A key of one dimension may still be shared by very many
    keys of another, as a customer by policies: such keys are split.
    """
    for dim, fact_key, dim_key, columns in dims:
        per_key = enrich(per_key, dim, fact_key, columns, lookup_key=dim_key)
    return per_key


def attach_group_count(
    df: DataFrame,
    key: str,
    counted: str,
    out: str,
    spread_by: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add the number of non-null ``counted`` values that share the row's ``key``.

    Equal to a count over an unordered window, but no task ever holds all rows of one
    key: counts are combined before the shuffle and joined back by :func:`lookup_join`.
    """
    counts = df.groupBy(key).agg(F.count(counted).alias("_n"), F.count(F.lit(1)).alias("_rows"))
    of_null = counts.where(F.col(key).isNull()).select("_n")
    lookup = counts.where(F.col(key).isNotNull())
    # Both columns are carried on both sides, so the two uses share one shuffle.
    joined = lookup_join(
        df,
        lookup,
        key,
        key,
        ["_n", "_rows"],
        spread_by or [counted],
        hot=hottest(lookup, hot_rows),
    )
    null_rows = F.when(F.col(key).isNull(), of_null.scalar())
    return joined.withColumn(out, F.coalesce("_n", null_rows, F.lit(0))).drop("_n", "_rows")
