"""Connected components of a link table, by alternating star contraction.

Each round hangs every node's larger neighbours on its smallest one, then its smaller neighbours likewise, until
the links are stars around the smallest id of each component. Rounds grow with the logarithm of the size. The
smallest neighbour is a combined aggregate, so a hub with a third of the links is no single group; links are
stored between rounds, never gathered.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import store


def components(links: DataFrame) -> DataFrame:
    """(id, root) for every id of ``links`` (a, b); root is the smallest id connected with it.

    Self-links and links with a null end join nothing; an empty table gives an empty table; repeated links and
    either direction are alike.
    """
    a, b = F.col("a").cast("long"), F.col("b").cast("long")
    e = store(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    seen = _mark(e)
    while seen[0]:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        m = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.where("v > u").join(m, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        m = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(m.select("u", F.col("m").alias("v")))
        e = store(small.distinct(), "links")
        now = _mark(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("u").alias("id"), F.col("v").alias("root")).union(e.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())


def _mark(e: DataFrame) -> tuple:
    return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
