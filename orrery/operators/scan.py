"""Ordered scans per entity that never put a whole entity into one task.

A window partitioned by the entity alone sorts every row of that entity in one
task, which fails when one entity owns a large share of the data. All scans here
work in two levels instead:

* rows are partitioned by (entity, bucket), where the bucket is any monotone
  function of the sort key (a time slot, a value cell);
* one summary row per (entity, bucket) is built with a map-side combined
  aggregate, scanned per entity, and joined back as the carry-in of the bucket.

The summary has at most span/width rows per entity, whatever the row count. The
join back uses the partitioning the window already needed, so the wide rows are
shuffled once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US


def slot(t_us: Column | str, width_us: int) -> Column:
    """Time slot of an epoch given in integer microseconds."""
    col = F.col(t_us) if isinstance(t_us, str) else t_us
    return F.floor(col / F.lit(width_us)).cast("bigint")


def _fold(fn: str, a: Column, b: Column) -> Column:
    if fn == "sum":
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))
    return F.greatest(a, b) if fn == "max" else F.least(a, b)


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def prefix_scan(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    aggs: dict[str, tuple[str, Column]],
    *,
    inclusive: bool = True,
    descending: bool = False,
) -> DataFrame:
    """Running ``sum`` / ``max`` / ``min`` per entity in ``order``.

    ``aggs`` maps the new column to (function, input). ``descending`` scans from
    the far end, giving suffix aggregates.
    """
    way = (lambda c: F.col(c).desc()) if descending else (lambda c: F.col(c).asc())
    b = df.withColumn("_b", bucket)
    for name, (_, col) in aggs.items():
        b = b.withColumn(f"_in_{name}", col)
    upto = Window.currentRow if inclusive else -1
    local = Window.partitionBy(*by, "_b").orderBy(*[way(c) for c in order]).rowsBetween(Window.unboundedPreceding, upto)
    earlier = Window.partitionBy(*by).orderBy(way("_b")).rowsBetween(Window.unboundedPreceding, -1)
    totals = b.groupBy(*by, "_b").agg(*[_AGG[fn](f"_in_{n}").alias(f"_t_{n}") for n, (fn, _) in aggs.items()])
    carry = totals.select(*by, "_b", *[_AGG[fn](f"_t_{n}").over(earlier).alias(f"_c_{n}") for n, (fn, _) in aggs.items()])
    out = b.select("*", *[_AGG[fn](f"_in_{n}").over(local).alias(f"_l_{n}") for n, (fn, _) in aggs.items()])
    out = out.join(carry, [*by, "_b"], "left") if by else out.join(carry, ["_b"], "left")
    keep = [c for c in df.columns if c not in aggs]
    return out.select(*keep, *[_fold(fn, F.col(f"_l_{n}"), F.col(f"_c_{n}")).alias(n) for n, (fn, _) in aggs.items()])


def row_index(df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, name: str = "row_no") -> DataFrame:
    """1-based position of each row of an entity."""
    return prefix_scan(df, by, order, bucket, {name: ("sum", F.lit(1).cast("bigint"))})


def neighbour(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str],
    bucket: Column,
    payload: Sequence[str],
    *,
    name: str = "prev",
    ahead: bool = False,
) -> DataFrame:
    """Attach the previous (or next) row of the entity as struct ``name``; NULL at the end."""
    b = df.withColumn("_b", bucket)
    pay = F.struct(*payload)
    pick = F.min_by if ahead else F.max_by
    if len(order) == 1:
        # plain columns keep the edge aggregate in the hash path; all of them take the same row
        edges = [pick(c, order[0]).alias(f"_e{i}") for i, c in enumerate(payload)]
        ends = b.groupBy(*by, "_b").agg(*edges).select(*by, "_b", F.struct(*[F.col(f"_e{i}").alias(c) for i, c in enumerate(payload)]).alias("_edge"))
    else:
        ends = b.groupBy(*by, "_b").agg(pick(pay, F.struct(*order)).alias("_edge"))
    across = Window.partitionBy(*by).orderBy("_b")
    local = Window.partitionBy(*by, "_b").orderBy(*order)
    step = F.lead if ahead else F.lag
    carry = ends.select(*by, "_b", step("_edge").over(across).alias("_carry"))
    out = b.withColumn("_near", step(pay).over(local)).join(carry, [*by, "_b"], "left")
    return out.select(*df.columns, F.coalesce("_near", "_carry").alias(name))


def fill_forward(
    df: DataFrame, by: Sequence[str], order: Sequence[str], bucket: Column, cols: dict[str, Column]
) -> DataFrame:
    """``last(x, ignorenulls)`` up to and including the current row, per entity."""
    b = df.withColumn("_b", bucket)
    for n, c in cols.items():
        b = b.withColumn(f"_in_{n}", c)
    key = F.struct(*order)
    local = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    across = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    last = b.groupBy(*by, "_b").agg(
        *[F.max_by(f"_in_{n}", F.when(F.col(f"_in_{n}").isNotNull(), key)).alias(f"_t_{n}") for n in cols]
    )
    carry = last.select(*by, "_b", *[F.last(f"_t_{n}", ignorenulls=True).over(across).alias(f"_c_{n}") for n in cols])
    out = b.select("*", *[F.last(f"_in_{n}", ignorenulls=True).over(local).alias(f"_l_{n}") for n in cols])
    out = out.join(carry, [*by, "_b"], "left")
    keep = [c for c in df.columns if c not in cols]
    return out.select(*keep, *[F.coalesce(f"_l_{n}", f"_c_{n}").alias(n) for n in cols])
