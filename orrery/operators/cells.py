"""Scan cells that follow the data: no cell of an ordered scan outgrows a task, wherever the rows crowd.

Fixed slots and value cells (``scan.slot``) suit evenly spread keys. Where one day holds nearly all rows of an entity,
or values crowd at one end, cells are the partitions of a range partitioning by group and key instead. A partition that a
repeated key fills beyond the bound is cut at quantiles of the key, found by a mergeable sketch.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.session import cut

ROWS = 100_000
SPLITS = 255
SALTS = 64


def _split(x: DataFrame, keys: list[str], wide: DataFrame) -> DataFrame:
    """Cut the cells named in ``wide`` at sketched quantiles; rows of one cell spread over ``SALTS`` tasks meanwhile."""
    shares = F.array(*[F.lit(i / (SPLITS + 1)) for i in range(1, SPLITS + 1)])
    copies = wide.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    x = x.withColumn("_s", F.pmod(F.xxhash64("_v", F.monotonically_increasing_id()), F.lit(SALTS)).cast("int"))
    sketch = x.join(copies, [*keys, "_s"]).groupBy(*keys, "_s").agg(F.percentile_approx("_v", shares, F.lit(8 * SPLITS)).alias("_p"))
    # the salts share a cell evenly, so quantiles of their quantiles are quantiles of the cell
    merged = sketch.select(*keys, F.explode("_p").alias("_x")).groupBy(*keys).agg(F.percentile_approx("_x", shares, F.lit(8 * SPLITS)).alias("_p"))
    # written, so that a task run again after a loss sees the same splitters; one row for each cell to cut
    merged = cut(merged).withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # a splitter's own value lies between two cells, so a value that fills a cell is parted from its neighbours
    place = F.size(F.filter("_p", lambda s: s <= F.col("_v"))) + F.size(F.filter("_p", lambda s: s < F.col("_v")))
    x = x.join(merged, [*keys, "_s"], "left").withColumn("_cell", F.col("_cell") * (2 * SPLITS + 1) + F.when(F.col("_p").isNull(), 0).otherwise(place))
    return x.drop("_p", "_s")


def even_cells(df: DataFrame, by: Sequence[str], key: Column, name: str, *, rows: int = ROWS) -> DataFrame:
    """``df`` with ``name``: a number that never falls as ``key`` rises within a group, shared by at most ``rows`` rows of it.

    Only rows of one single key may share a cell beyond that; NULL keys come first, with the lowest keys. Where no group
    has more than ``rows`` rows, found by one count, each is one cell. Otherwise rows are dealt by range of group and key
    to partitions of half as many; one that is still too large is cut up to ``2 * SPLITS + 1`` ways a pass. An empty table
    has no cells.
    """
    # a struct of NULL keys equals itself, so rows without a group are cut like any other group
    group = F.struct(*by) if by else F.lit(0)
    x, keys = df.withColumns({"_v": key, "_group": group, "_cell": F.lit(0).cast("bigint")}), ["_group", "_cell"]
    dealt = False
    while True:
        size = x.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        wide = size.where((F.col("_n") > rows) & (F.col("_lo") < F.col("_hi"))).select(*keys)
        if wide.isEmpty():
            return x.withColumn(name, F.col("_cell")).drop("_v", "_group", "_cell")
        if dealt:
            x = cut(_split(x, keys, cut(wide)))
        else:
            # written, for the range bounds come from a sample
            parts = ceil(2 * size.agg(F.sum("_n")).first()[0] / rows)
            order = [F.asc_nulls_first(c) for c in (*by, "_v")]
            x, dealt = cut(x.repartitionByRange(parts, *order).withColumn("_cell", F.spark_partition_id().cast("bigint"))), True
