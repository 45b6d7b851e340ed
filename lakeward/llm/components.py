"""Connected components of a table of links, without collecting neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeward.llm.scratch import in_tasks, stored


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b); component is the smallest id reached.

    Links are rewired in turns until each id points straight at its smallest: every id hangs its
    larger neighbours, then its smaller ones, under the smallest it knows.  Minima combine before
    the shuffle and joins are between stored tables, so an id with very many links is split like
    any hot key.  Nulls and links of an id with itself are ignored.
    """
    pairs = stored(
        links.where("a <> b").select(F.greatest("a", "b").alias("v"), F.least("a", "b").alias("u")),
        "links",
    )
    rows = 2 * pairs.count()
    edges = stored(in_tasks(pairs.distinct(), rows), "links")
    while True:
        both = edges.select("v", "u").unionAll(
            edges.select(F.col("u").alias("v"), F.col("v").alias("u"))
        )
        lowest = both.groupBy("v").agg(F.least(F.min("u"), F.col("v")).alias("low"))
        lowest = stored(in_tasks(lowest, rows), "lowest")
        # Larger neighbours hang under the smallest id near v ...
        large = both.join(lowest, "v").where("u > v").select(F.col("u").alias("v"), F.col("low").alias("u"))
        large = in_tasks(large.where("v <> u"), rows).distinct()
        large = stored(in_tasks(large, rows), "links")
        # ... and then v and its smaller neighbours under the smallest of these.
        least = stored(in_tasks(large.groupBy("v").agg(F.min("u").alias("low")), rows), "lowest")
        down = large.join(least, "v").select(F.col("u").alias("v"), F.col("low").alias("u"))
        down = down.unionAll(least.select("v", F.col("low").alias("u"))).where("v <> u")
        small = stored(in_tasks(in_tasks(down, rows).distinct(), rows), "links")
        ends = small.select(F.col("v").alias("id"), F.lit(1).alias("hangs"), F.lit(0).alias("holds"))
        ends = ends.unionAll(small.select("u", F.lit(0), F.lit(1)))
        roles = ends.groupBy("id").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
        # Done when nothing hangs twice, and nothing that hangs holds others.
        if in_tasks(roles, rows).where("hangs > 1 OR (hangs > 0 AND holds > 0)").isEmpty():
            break
        edges = small
    members = small.select(F.col("v").alias("id"), F.col("u").alias("component"))
    roots = small.select(F.col("u").alias("id"), F.col("u").alias("component")).distinct()
    return members.unionAll(roots)
