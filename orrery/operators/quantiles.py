"""Exact linear-interpolated quantiles without gathering a large group in one task.

Groups of at most ``BOUND`` rows, found by one combined count, are shuffled by group and put in order there: one sorted
list for each measure. Of the larger groups, which are few, only values near a wanted rank are kept:

1. A mergeable sketch brackets each wanted rank, 1/``FAN`` of the rows to either side; no value is shuffled for it.
2. Brackets, one row for each group of more than ``BOUND`` rows, are broadcast. One combined aggregate counts the rows by
   place between the brackets' ends and, inside a bracket, by value. A rank outside its bracket widens all brackets.
3. A kept place of more than ``BOUND`` distinct values gets ``FAN`` - 1 splitters from a sketch; they are copied
   ``SALTS`` times and joined on (group, salt), values are counted by (group, cell), and only cells that hold a wanted
   rank keep their values, by a join on (group, cell). Splitters follow the values' own distribution, so tails cost nothing.
4. This repeats on the kept cells until the largest has at most ``BOUND`` values, checked by an aggregate; only
   then are values put in order, within a cell.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import cut

BOUND = 100_000
SIDE = 32
FAN = SIDE * SIDE
SALTS = 64


def _salted(groups: DataFrame) -> DataFrame:
    return groups.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _assign(values: DataFrame, keys: list[str], bound: int) -> DataFrame:
    """values with ``_c``: the cell within the group, 0 where the group has at most ``bound`` distinct values."""
    values = values.withColumn("_s", F.pmod(F.xxhash64("_v"), F.lit(SALTS)).cast("int"))
    large = values.groupBy(*keys).agg(F.count(F.lit(1)).alias("_d")).where(F.col("_d") > bound).select(*keys)
    shares = F.array(*[F.lit(i / FAN) for i in range(1, FAN)])
    inside = values.join(_salted(large), [*keys, "_s"])
    splits = inside.groupBy(*keys, "_s").agg(F.count(F.lit(1)).alias("_d"), F.percentile_approx("_v", shares, F.lit(8 * FAN)).alias("_p"))
    # the sketches of the salts, one row each, are merged by taking quantiles of their quantiles' union
    splits = splits.select(*keys, F.explode("_p").alias("_x")).groupBy(*keys).agg(F.percentile_approx("_x", shares, F.lit(8 * FAN)).alias("_splits"))
    coarse = F.transform(F.sequence(F.lit(1), F.lit(SIDE - 1)), lambda i: F.get(F.col("_splits"), i * SIDE - 1))
    values = values.join(_salted(splits.withColumn("_coarse", coarse)), [*keys, "_s"], "left")
    row = F.size(F.filter("_coarse", lambda x: x <= F.col("_v")))
    fine = F.slice(F.col("_splits"), row * SIDE + 1, F.lit(SIDE))
    cell = row * SIDE + F.size(F.filter(fine, lambda x: x <= F.col("_v")))
    return values.withColumn("_c", F.when(F.col("_splits").isNull(), 0).otherwise(cell)).drop("_s", "_splits", "_coarse")


def _keep(values: DataFrame, keys: list[str]) -> DataFrame:
    """The values of cells that hold one of the ranks ``_ks``, with the rows of the group below the cell."""
    cells = values.groupBy(*keys, "_c").agg(F.sum("_n").alias("_rows"), F.count(F.lit(1)).alias("_d"), F.first("_ks").alias("_ks"), F.first("_below").alias("_from"))
    upto = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # FAN rows at most
    cells = cells.withColumn("_cum", F.col("_from") + F.sum("_rows").over(upto))
    hit = cells.withColumn("_ks", F.expr("filter(_ks, k -> k <= _cum and k > _cum - _rows)")).where(F.size("_ks") > 0)
    hit = hit.select(*keys, "_c", (F.col("_cum") - F.col("_rows")).alias("_below"), "_ks", "_d")
    return values.drop("_below", "_ks").join(hit, [*keys, "_c"])


def _bracketed(df: DataFrame, by: list[str], columns: list[Column], ps: list[float], reach: float) -> tuple[DataFrame, DataFrame]:
    """(by, _m, _total), and the rows counted by (by, _m, _c): ``_c`` is the place between bracket ends, ``_v`` the value inside a bracket."""
    shares = sorted({min(max(p + s * reach, 0.0), 1.0) for p in ps for s in (-1, 1)})
    grid = F.array(*[F.lit(s) for s in shares])
    sketch = df.groupBy(*by).agg(*[f for i, c in enumerate(columns) for f in (F.count(c).alias(f"_n{i}"), F.percentile_approx(c, grid, F.lit(8 * FAN)).alias(f"_e{i}"))])
    sketch = cut(sketch)  # so that a task run again after a loss sees the same brackets
    packed = []
    for i, c in enumerate(columns):
        ends = [F.get(F.col(f"_e{i}"), F.lit(k)) for k in range(len(shares))]
        # an end's own value lies between two places, so a value that fills a place is parted from its neighbours
        place = sum((F.when(e <= c, 1).otherwise(0) + F.when(e < c, 1).otherwise(0) for e in ends), F.lit(0))
        inside = F.lit(False)
        for p in ps:
            lo, hi = (ends[shares.index(min(max(p + s * reach, 0.0), 1.0))] for s in (-1, 1))
            inside = inside | ((c >= lo) & (c <= hi))
        packed.append(F.when(c.isNotNull(), F.struct(F.lit(i).alias("m"), place.alias("c"), F.when(inside, c).alias("v"))))
    long = df.join(F.broadcast(sketch), by).select(*by, F.explode(F.filter(F.array(*packed), lambda x: x.isNotNull())).alias("_p"))
    counts = long.groupBy(*by, F.col("_p.m").alias("_m"), F.col("_p.c").alias("_c"), F.col("_p.v").alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    totals = sketch.select(*by, F.explode(F.array(*[F.struct(F.lit(i).alias("m"), F.col(f"_n{i}").alias("n")) for i in range(len(columns))])).alias("_p"))
    return totals.select(*by, F.col("_p.m").alias("_m"), F.col("_p.n").alias("_total")).where("_total > 0"), cut(counts)


def _between(pos: Column, at: Callable[[Column], Column]) -> Column:
    """Value at position ``pos`` from 0, linear between the neighbours ``at`` it."""
    lo, hi = at(F.floor(pos).cast("bigint")), at(F.ceil(pos).cast("bigint"))
    return F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos)))


def _narrowed(df: DataFrame, by: list[str], columns: list[Column], ps: list[float], bound: int) -> DataFrame:
    """(by, _m, _q): for each group and measure the quantiles ``ps``."""
    keys, reach = [*by, "_m"], 1.0 / FAN
    while True:
        totals, counts = _bracketed(df, by, columns, ps, reach)
        ranks = F.array_distinct(F.array(*[f(F.lit(p) * (F.col("_total") - 1)).cast("bigint") + 1 for p in ps for f in (F.floor, F.ceil)]))
        cells = counts.groupBy(*keys, "_c").agg(F.sum("_n").alias("_rows"), F.count("_v").alias("_d"))
        upto = Window.partitionBy(*keys).orderBy("_c").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # a few rows for each p
        cells = cells.withColumn("_cum", F.sum("_rows").over(upto)).join(totals.withColumn("_ks", ranks), keys)
        hit = cells.withColumn("_ks", F.expr("filter(_ks, k -> k <= _cum and k > _cum - _rows)")).where(F.size("_ks") > 0)
        # a sketch's error is an eighth of the reach, and a reach of 1 keeps every value
        if hit.where("_d = 0").isEmpty():
            break
        reach *= 16
    kept = counts.join(hit.select(*keys, "_c", (F.col("_cum") - F.col("_rows")).alias("_below"), "_ks", "_d"), [*keys, "_c"])
    path = [*keys, "_c"]
    while (kept.agg(F.max("_d")).first()[0] or 0) > bound:
        cell = f"_c{len(path)}"
        kept, path = kept.withColumnRenamed("_c", cell), [*path[:-1], cell]
        kept = cut(_keep(_assign(kept.drop("_d"), path, bound), path))
        path = [*path, "_c"]
    ordered = Window.partitionBy(*path).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = kept.withColumn("_cum", F.col("_below") + F.sum("_n").over(ordered)).withColumn("_k", F.explode(F.expr("filter(_ks, k -> k <= _cum and k > _cum - _n)")))
    table = at.groupBy(*keys).agg(F.map_from_entries(F.collect_set(F.struct("_k", "_v"))).alias("_at")).join(totals, keys)  # two ranks for each p
    return table.select(*keys, F.array(*[_between(F.lit(p) * (F.col("_total") - 1), lambda k: F.col("_at")[k + 1]) for p in ps]).alias("_q"))


def _sorted(df: DataFrame, by: list[str], measures: int) -> DataFrame:
    """(by, _s0, _s1, ...): the values of each measure in order. Rows move once, so that no list is built or moved in parts."""
    lists = df.repartition(*by).groupBy(*by).agg(*[F.sort_array(F.collect_list(f"_v{i}")).alias(f"_s{i}") for i in range(measures)])
    return lists.where(reduce(Column.__or__, [F.size(f"_s{i}") > 0 for i in range(measures)]))


def exact_quantiles(df: DataFrame, by: Sequence[str], outputs: dict[str, tuple[Column, float]], *, bound: int = BOUND) -> DataFrame:
    """One row per group with each output = the ``p`` quantile of its non-null input.

    ``outputs`` maps alias -> (input column, p). Groups whose inputs are all NULL
    are absent: left-join the result to the group list where that matters.
    """
    whole = not by
    if whole:
        df, by = df.withColumn("_g", F.lit(1)), ["_g"]
    by = list(by)
    measures: list[Column] = []
    where: dict[str, int] = {}
    for alias, (col, _) in outputs.items():
        hit = next((i for i, m in enumerate(measures) if str(m) == str(col)), None)
        if hit is None:
            measures.append(col)
            hit = len(measures) - 1
        where[alias] = hit
    df = df.select(*by, *[F.when(~F.isnan(c.cast("double")), c.cast("double")).alias(f"_v{i}") for i, c in enumerate(measures)])
    columns = [F.col(f"_v{i}") for i in range(len(measures))]
    ps = sorted({p for _, p in outputs.values()})
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows"))
    least, most = sizes.agg(F.min("_rows"), F.max("_rows")).first()
    parts = []
    large = small = df
    if (least or 0) <= bound < (most or 0):
        # one row for each more than ``bound`` rows of input; groups without a key are met by the struct
        group = F.struct(*by)
        named = F.broadcast(cut(sizes.where(F.col("_rows") > bound).select(group.alias("_group"))))
        large, small = (df.withColumn("_group", group).join(named, "_group", how).drop("_group") for how in ("left_semi", "left_anti"))
    if (least or 0) <= bound:
        def listed(a: str, p: float) -> Column:
            s = F.col(f"_s{where[a]}")
            return _between(F.lit(p) * (F.size(s) - 1), lambda k: F.get(s, k.cast("int")))

        parts.append(_sorted(small, by, len(columns)).select(*by, *[listed(a, p).alias(a) for a, (_, p) in outputs.items()]))
    if (most or 0) > bound:
        q = _narrowed(large, by, columns, ps, bound)
        parts.append(q.groupBy(*by).agg(*[F.max(F.when(F.col("_m") == where[a], F.get("_q", F.lit(ps.index(p))))).alias(a) for a, (_, p) in outputs.items()]))
    out = reduce(DataFrame.unionByName, parts)
    return out.drop("_g") if whole else out


def with_quantiles(df: DataFrame, by: Sequence[str], aggs: list[Column], outputs: dict[str, tuple[Column, float]]) -> DataFrame:
    """``groupBy(by).agg(aggs)`` plus exact quantile columns, one row per group."""
    if not by:
        return df.agg(*aggs).withColumn("_one", F.lit(1)).join(
            exact_quantiles(df, [], outputs).withColumn("_one", F.lit(1)), "_one", "left"
        ).drop("_one")
    return df.groupBy(*by).agg(*aggs).join(exact_quantiles(df, by, outputs), list(by), "left")
