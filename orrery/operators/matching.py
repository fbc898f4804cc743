"""One-to-one greedy matching of two event lists per entity, in a number of rounds that grows with the logarithm of the data.

Pairs are taken by (|dt|, query, reference) while both sides are free. The points of an entity, in order of time, form
runs of one side. As long as no free pair of an island is nearer than ``d``, pairs under ``3 d`` join neighbouring
runs only, from the border outwards: the k-th point left of a border with the k-th point right of it. Each point
then has at most one partner on either side, so the possible pairs form paths:

* a pair shorter than both neighbours on its path is taken;
* a pair with one shorter neighbour is taken if that one is not: a chain, solved by pointer doubling;
* a pair with two shorter neighbours is taken if neither is, and no other pair depends on it.

A round takes these pairs in all islands at once, each with its own ``d``. The next ``d`` is at least three times
larger, so tolerances of days end within two dozen rounds, whatever the data, and a chain of n pairs takes log2(n) jumps.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.cells import even_cells
from orrery.operators.scan import neighbour, prefix_scan, row_index
from orrery.session import cut

CELL = 50_000
JUMPS = 2
PAIR = "entity_id bigint, query_seq bigint, reference_seq bigint, offset_us bigint"


def islands(points: DataFrame, gap_us: int, bucket: Column) -> DataFrame:
    """Number runs of rows of an entity whose neighbours are at most ``gap_us`` apart."""
    order = ["t", "side", "seq"]
    near = neighbour(points, ["entity_id"], order, bucket, ["t"])
    fresh = F.when(F.col("prev").isNull() | (F.col("t") - F.col("prev.t") > gap_us), 1).otherwise(0).cast("bigint")
    return prefix_scan(near, ["entity_id"], order, bucket, {"island": ("sum", fresh)}).drop("prev")


def _runs(free: DataFrame, cell: int) -> DataFrame:
    """Position ``p`` of each free point of its entity, and the first (``lo``) and last (``hi``) position of its run of one side."""
    x = free.withColumn("_b", F.floor(F.col("row_no") / cell))
    local = Window.partitionBy("entity_id", "_b").orderBy("row_no")
    upto, after = local.rowsBetween(Window.unboundedPreceding, 0), local.rowsBetween(1, Window.unboundedFollowing)
    x = x.withColumn("_n", F.row_number().over(local)).withColumn("_turn", F.lag("side").over(local) != F.col("side"))
    x = x.select("*", F.max(F.when(F.col("_turn"), F.col("_n"))).over(upto).alias("_lo"), F.min(F.when(F.col("_turn"), F.col("_n"))).over(after).alias("_next"))
    cells = x.groupBy("entity_id", "_b").agg(
        F.count(F.lit(1)).alias("_rows"), F.min_by("side", "row_no").alias("_first"), F.max_by("side", "row_no").alias("_last"),
        F.max(F.when(F.col("_turn"), F.col("_n"))).alias("_tail"), F.min(F.when(F.col("_turn"), F.col("_n"))).alias("_head"),
    )
    across = Window.partitionBy("entity_id").orderBy("_b")
    back, ahead = across.rowsBetween(Window.unboundedPreceding, -1), across.rowsBetween(1, Window.unboundedFollowing)
    cells = cells.select("*", F.coalesce(F.sum("_rows").over(back), F.lit(0)).alias("_off"), F.coalesce(F.lag("_last").over(across) != F.col("_first"), F.lit(True)).alias("_opens"))
    starts = F.col("_off") + F.coalesce("_tail", F.when(F.col("_opens"), 1))
    heads = F.col("_off") + F.when(F.col("_opens"), 1).otherwise(F.col("_head"))
    whole = Window.partitionBy("entity_id")
    cells = cells.select(
        "entity_id", "_b", "_off",
        F.when(F.col("_opens"), F.col("_off") + 1).otherwise(F.last(starts, ignorenulls=True).over(back)).alias("_lo_c"),
        F.coalesce(F.first(heads, ignorenulls=True).over(ahead), F.sum("_rows").over(whole) + 1).alias("_next_c"),
    )
    x = x.join(cells, ["entity_id", "_b"])
    return x.select(
        *free.columns, (F.col("_off") + F.col("_n")).alias("p"),
        F.coalesce(F.col("_off") + F.col("_lo"), "_lo_c").alias("lo"), (F.coalesce(F.col("_off") + F.col("_next"), "_next_c") - 1).alias("hi"),
    )


def _edges(free: DataFrame, tolerance_us: int, cell: int) -> DataFrame:
    """Possible pairs: ``e`` and ``f`` are the positions of their left and right points, ``o`` their order."""
    pts = _runs(free, cell)
    left = pts.select("entity_id", "island", F.col("p").alias("e"), "hi", (2 * F.col("hi") - F.col("p") + 1).alias("f"), F.struct("side", "t", "seq").alias("a"))
    right = pts.select("entity_id", F.col("p").alias("f"), F.col("lo"), F.struct("side", "t", "seq").alias("b"))
    x = left.join(right, ["entity_id", "f"]).where((F.col("lo") == F.col("hi") + 1) & (F.col("b.t") - F.col("a.t") <= tolerance_us))
    swap = F.col("a.side") == 1
    x = x.withColumn("q", F.when(swap, F.col("b")).otherwise(F.col("a"))).withColumn("r", F.when(swap, F.col("a")).otherwise(F.col("b")))
    return x.select("entity_id", "island", "e", "f", "q", "r", F.struct((F.col("b.t") - F.col("a.t")).alias("d"), F.col("q.t").alias("qt"), F.col("r.t").alias("rt")).alias("o"))


def _take(edges: DataFrame) -> DataFrame:
    """Pairs of this round: of lengths under three times the island's shortest, decided along their paths."""
    least = edges.groupBy("entity_id", "island").agg(F.min("o.d").alias("_d"))
    near = edges.join(least, ["entity_id", "island"]).where((F.col("o.d") == F.col("_d")) | (F.col("o.d") < 3 * F.col("_d"))).drop("_d")
    before = near.select("entity_id", F.col("f").alias("e"), F.col("e").alias("e0"), F.col("o").alias("o0"))
    behind = near.select("entity_id", F.col("e").alias("f"), F.col("e").alias("e1"), F.col("o").alias("o1"))
    x = near.join(before, ["entity_id", "e"], "left").join(behind, ["entity_id", "f"], "left")
    x = x.withColumn("e0", F.when(F.col("o0") < F.col("o"), F.col("e0"))).withColumn("e1", F.when(F.col("o1") < F.col("o"), F.col("e1"))).drop("o0", "o1")
    x = cut(x)
    chain = x.where("e0 is null or e1 is null").select("entity_id", "e", F.coalesce("e0", "e1", "e").alias("to"), F.coalesce("e0", "e1").isNull().alias("ends"), F.coalesce("e0", "e1").isNotNull().alias("odd"))
    while True:
        for _ in range(JUMPS):
            there = chain.select("entity_id", F.col("e").alias("to"), F.col("to").alias("to2"), F.col("ends").alias("ends2"), F.col("odd").alias("odd2"))
            # a solved row looks at itself, so that no position is asked for by more than a few rows
            chain = chain.join(there, ["entity_id", "to"]).select(
                "entity_id", "e", F.when(F.col("ends") | F.col("ends2"), F.col("e")).otherwise(F.col("to2")).alias("to"),
                (F.col("ends") | F.col("ends2")).alias("ends"), F.when(F.col("ends"), F.col("odd")).otherwise(F.col("odd") != F.col("odd2")).alias("odd"),
            )
        chain = cut(chain)  # written, for its plan doubles with every jump
        if chain.where("not ends").isEmpty():
            break
    known = chain.select("entity_id", "e", (~F.col("odd")).alias("taken"))
    one = x.where("e0 is null or e1 is null").join(known.where("taken"), ["entity_id", "e"], "left_semi")
    both = x.where("e0 is not null and e1 is not null")
    for side in ("e0", "e1"):
        both = both.join(known.where("not taken").select("entity_id", F.col("e").alias(side)), ["entity_id", side], "left_semi")
    return one.unionByName(both).select("entity_id", "island", "q", "r", "o")


def _numbers(taken: DataFrame, points: DataFrame, end: str, side: int) -> DataFrame:
    """Points of one side at one time are alike until taken: the lowest number goes first."""
    same = Window.partitionBy("entity_id", f"{end}.t")
    x = taken.withColumn("_k", F.row_number().over(same.orderBy("o", "q.seq")))
    at = Window.partitionBy("entity_id", "t").orderBy("seq")
    y = points.where(F.col("side") == side).select("entity_id", F.col("t").alias(f"_t{side}"), F.row_number().over(at).alias("_k"), F.col("seq").alias(f"{end}_seq"))
    return x.withColumn(f"_t{side}", F.col(f"{end}.t")).join(y, ["entity_id", f"_t{side}", "_k"]).drop("_k", f"_t{side}")


def greedy_match(query: DataFrame, reference: DataFrame, q_t: str, r_t: str, tolerance_us: int, *, cell: int = CELL) -> DataFrame:
    """Bijective match within a tolerance, smallest |dt| first, ties by query then reference order.

    ``seq`` numbers both sides per entity in order of time. Rows without entity or time match nothing. ``cell`` is
    the rows of a scan's cell and does not change the result.
    Returns entity_id, query_seq, reference_seq, offset_us.
    """
    def side(df: DataFrame, t: str, n: int) -> DataFrame:
        return df.select("entity_id", F.lit(n).alias("side"), F.col("seq").cast("bigint").alias("seq"), F.col(t).alias("t")).dropna()

    pts = even_cells(side(query, q_t, 0).unionByName(side(reference, r_t, 1)), ["entity_id"], F.col("t"), "_even", rows=cell)
    pts = islands(pts, tolerance_us, F.col("_even"))
    mixed = pts.groupBy("entity_id", "island").agg(F.min("side").alias("_a"), F.max("side").alias("_z")).where("_a < _z")
    pts = pts.join(mixed.select("entity_id", "island"), ["entity_id", "island"], "left_semi")
    pts = cut(row_index(pts, ["entity_id"], ["t", "side", "seq"], F.col("_even")).drop("_even"))
    free, done = pts, []
    while True:
        edges = cut(_edges(free, tolerance_us, cell))
        if edges.isEmpty():
            break
        taken = cut(_take(edges))
        done.append(taken)
        # an island without a possible pair is finished
        used = taken.select("entity_id", F.lit(0).alias("side"), F.col("q.seq").alias("seq")).unionByName(taken.select("entity_id", F.lit(1).alias("side"), F.col("r.seq").alias("seq")))
        free = cut(free.join(edges.select("entity_id", "island").distinct(), ["entity_id", "island"], "left_semi").join(used, ["entity_id", "side", "seq"], "left_anti"))
    if not done:
        return query.sparkSession.createDataFrame([], PAIR)
    taken = reduce(DataFrame.unionByName, done)
    taken = _numbers(_numbers(taken, pts, "q", 0), pts, "r", 1)
    return taken.select("entity_id", F.col("q_seq").alias("query_seq"), F.col("r_seq").alias("reference_seq"), (F.col("r.t") - F.col("q.t")).alias("offset_us"))
