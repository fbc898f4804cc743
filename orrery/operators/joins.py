"""As-of, nearest, interval and range-count joins.

None of them plans a nested loop or a per-entity product. Time is integer
microseconds. Left sides are windows or events, right sides the large evidence.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.operators.scan import DAY_US, slot


@dataclass(frozen=True)
class Probe:
    """One lookup per left row: its time column, direction, and whether equal times are excluded."""

    t: str
    forward: bool = False
    strict: bool = False


def _asked(left: DataFrame, key: Sequence[str], by: Sequence[str], probes: dict[str, Probe], width_us: int) -> DataFrame:
    """One row per (left row, probe). Tags order it against right rows (tag 1) of equal time."""
    items = F.array(*[
        F.struct(F.lit(i).alias("_probe"), F.col(p.t).alias("_t"), F.lit(0 if p.strict else 2).alias("_tag"))
        for i, p in enumerate(probes.values())
    ])
    cols = list(dict.fromkeys([*key, *by]))
    return left.select(*cols, F.explode(items).alias("_p")).select(*cols, "_p.*").withColumn("_b", slot("_t", width_us))


def _edge_carries(rhs: DataFrame, slots_asked: DataFrame, by: Sequence[str], back: bool, fore: bool) -> DataFrame:
    """For each asked (entity, slot) the last right payload of earlier slots (``_carry_b``) and the first of later ones (``_carry_f``)."""
    edge_cols, carries = [], {}
    if back:
        past = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        edge_cols.append(F.max_by("_pay", "_kb").alias("_last"))
        carries["_carry_b"] = F.last("_last", ignorenulls=True).over(past)
    if fore:
        later = Window.partitionBy(*by).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
        edge_cols.append(F.min_by("_pay", "_kf").alias("_first"))
        carries["_carry_f"] = F.last("_first", ignorenulls=True).over(later)
    edges = rhs.groupBy(*by, "_b").agg(*edge_cols)
    slots = edges.join(slots_asked.withColumn("_ask", F.lit(True)), [*by, "_b"], "full_outer")
    return slots.withColumns(carries).where("_ask").select(*by, "_b", *carries)


def _asof_rows(left: DataFrame, rhs: DataFrame, by: Sequence[str], probes: dict[str, Probe], width_us: int) -> DataFrame:
    """As-of lookups at one time column: whole left rows stand among the right rows of their (entity, slot)."""
    t = next(iter(probes.values())).t
    lhs = left.select(F.struct(*left.columns).alias("_row"), *by, F.col(t).alias("_t")).withColumn("_b", slot("_t", width_us))
    slots_asked = lhs.select(*by, "_b").distinct()
    both = rhs.join(slots_asked, [*by, "_b"], "left_semi").unionByName(lhs, allowMissingColumns=True)
    kinds = {(p.forward, p.strict) for p in probes.values()}
    hits = {}
    for forward, strict in sorted(kinds):
        # at equal times a strict probe stands before the right rows, any other after them, in either direction
        tag = F.when(F.col("_row").isNull(), 1).otherwise(0 if strict else 2)
        order = (F.col("_t").desc(), tag, F.col("_kf").desc()) if forward else (F.col("_t"), tag, F.col("_kb"))
        upto = Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        hits[f"_hit_{int(forward)}{int(strict)}"] = F.last("_pay", ignorenulls=True).over(upto)
    local = both.withColumns(hits).where(F.col("_row").isNotNull()).select("_row", *by, "_b", *hits)
    carry = _edge_carries(rhs, slots_asked, by, any(not f for f, _ in kinds), any(f for f, _ in kinds))
    found = local.join(carry, [*by, "_b"], "left")
    picks = [F.coalesce(f"_hit_{int(p.forward)}{int(p.strict)}", f"_carry_{'f' if p.forward else 'b'}").alias(n) for n, p in probes.items()]
    return found.select("_row.*", *picks)


def asof_probes(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    by: Sequence[str],
    right_t: str,
    payload: Sequence[str],
    probes: dict[str, Probe],
    *,
    tie: Sequence[str] = (),
    tie_forward: Sequence[str] | None = None,
    width_us: int = DAY_US,
) -> DataFrame:
    """Attach, per probe, the last right row at or before its time (first at or after if ``forward``).

    ``key`` identifies a left row. All left rows are kept; each probe adds a struct
    column of ``payload`` (NULL if nothing is found). Right rows are shuffled only
    for (entity, slot) pairs that hold a probe; every other slot contributes one
    map-side combined edge row, so no task sees a whole entity. Several probes
    share one pass. Where all probes have one time column, the left row itself travels
    through the windows, so a large left side is shuffled once and never joined back.
    """
    key, by = list(key), list(by)
    fkey = F.struct(right_t, *(tie if tie_forward is None else tie_forward))
    rhs = (
        right.where(F.col(right_t).isNotNull())
        .select(*by, F.col(right_t).alias("_t"), F.struct(*payload).alias("_pay"), F.struct(right_t, *tie).alias("_kb"), fkey.alias("_kf"))
        .withColumn("_b", slot("_t", width_us))
    )
    if len({p.t for p in probes.values()}) == 1:
        return _asof_rows(left, rhs, by, probes, width_us)
    asked = _asked(left, key, by, probes, width_us)
    slots_asked = asked.select(*by, "_b").distinct()
    near = rhs.join(slots_asked, [*by, "_b"], "left_semi").withColumn("_tag", F.lit(1))
    both = near.unionByName(asked, allowMissingColumns=True)
    back = [p for p in probes.values() if not p.forward]
    fore = [p for p in probes.values() if p.forward]
    frame = lambda *order: Window.partitionBy(*by, "_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hits = {}
    if back:
        hits["_hit_b"] = F.last("_pay", ignorenulls=True).over(frame("_t", "_tag", "_kb"))
    if fore:
        hits["_hit_f"] = F.last("_pay", ignorenulls=True).over(frame(F.col("_t").desc(), "_tag", F.col("_kf").desc()))
    local = both.withColumns(hits).where(F.col("_probe").isNotNull())

    carry = _edge_carries(rhs, slots_asked, by, bool(back), bool(fore))
    found = local.join(carry, [*by, "_b"], "left")
    picks = []
    for i, (name, p) in enumerate(probes.items()):
        side = "f" if p.forward else "b"
        picks.append(F.max(F.when(F.col("_probe") == i, F.coalesce(f"_hit_{side}", f"_carry_{side}"))).alias(name))
    return left.join(found.groupBy(*key).agg(*picks), key, "left")


def bracket_join(
    windows: DataFrame, series: DataFrame, key: Sequence[str], by: Sequence[str], start: str, end: str, t: str, payload: Sequence[str], **kw
) -> DataFrame:
    """Structs ``before`` (last at or before start) and ``after`` (first at or after end)."""
    return asof_probes(windows, series, key, by, t, payload, {"before": Probe(start), "after": Probe(end, forward=True)}, **kw)


def nearest_join(
    left: DataFrame,
    right: DataFrame,
    key: Sequence[str],
    by: Sequence[str],
    left_t: str,
    right_t: str,
    payload: Sequence[str],
    *,
    name: str = "nearest",
    tie_later: bool = False,
    tolerance_us: int | None = None,
    **kw,
) -> DataFrame:
    """Closest right row in time; equal distances keep the earlier row unless ``tie_later``."""
    pay = list(dict.fromkeys([right_t, *payload]))
    out = asof_probes(left, right, key, by, right_t, pay, {"_lo": Probe(left_t), "_hi": Probe(left_t, forward=True)}, **kw)
    back = F.col(left_t) - F.col(f"_lo.{right_t}")
    fwd = F.col(f"_hi.{right_t}") - F.col(left_t)
    prefer_hi = (fwd <= back) if tie_later else (fwd < back)
    pick = F.when(F.col("_lo").isNull(), F.col("_hi")).when(F.col("_hi").isNull(), F.col("_lo")).when(prefer_hi, F.col("_hi")).otherwise(F.col("_lo"))
    out = out.withColumn(name, pick).drop("_lo", "_hi")
    if tolerance_us is not None:
        near = F.abs(F.col(f"{name}.{right_t}") - F.col(left_t)) <= tolerance_us
        out = out.withColumn(name, F.when(near, F.col(name)))
    return out


def probe_counts(
    left: DataFrame,
    points: DataFrame,
    key: Sequence[str],
    by: Sequence[str],
    point_t: str,
    probes: dict[str, Probe],
    *,
    width_us: int = DAY_US,
) -> DataFrame:
    """Per key and probe the number of points at or before its time (before it if ``strict``; at or after it if ``forward``).

    One row per key of ``left``, with one column per probe. Differences of such counts give the points in any interval and the spans that
    overlap any window in linear work: no (point, window) pair is formed.
    """
    key, by = list(key), list(by)
    # points at or after x = all points less those strictly before x
    turned = {n: Probe(p.t, strict=not p.strict) if p.forward else p for n, p in probes.items()}
    asked = _asked(left, key, by, turned, width_us)
    rhs = points.where(F.col(point_t).isNotNull()).select(*by, F.col(point_t).alias("_t")).withColumn("_b", slot("_t", width_us))
    slots_asked = asked.select(*by, "_b").distinct()
    near = rhs.join(slots_asked, [*by, "_b"], "left_semi").groupBy(*by, "_b", "_t").agg(F.count(F.lit(1)).alias("_n")).withColumn("_tag", F.lit(1))
    both = near.unionByName(asked, allowMissingColumns=True)
    seen = Window.partitionBy(*by, "_b").orderBy("_t", "_tag").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = both.withColumn("_local", F.coalesce(F.sum("_n").over(seen), F.lit(0))).where(F.col("_probe").isNotNull())
    totals = rhs.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    slots = totals.join(slots_asked.withColumn("_ask", F.lit(True)), [*by, "_b"], "full_outer")
    past = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = slots.select(*by, "_b", "_ask", F.sum("_n").over(past).alias("_carry"), F.sum("_n").over(Window.partitionBy(*by)).alias("_all")).where("_ask")
    found = local.join(carry.drop("_ask"), [*by, "_b"], "left")
    below = F.col("_local") + F.coalesce("_carry", F.lit(0))
    picks = []
    for i, (name, p) in enumerate(probes.items()):
        value = F.coalesce("_all", F.lit(0)) - below if p.forward else below
        picks.append(F.max(F.when(F.col("_probe") == i, value)).alias(name))
    return found.groupBy(*key).agg(*picks)


def count_probes(left: DataFrame, points: DataFrame, key: Sequence[str], by: Sequence[str], point_t: str, probes: dict[str, Probe], **kw) -> DataFrame:
    """``left`` with the counts of :func:`probe_counts`."""
    return left.join(probe_counts(left, points, key, by, point_t, probes, **kw), list(key), "left")


def count_within(
    windows: DataFrame, points: DataFrame, key: Sequence[str], by: Sequence[str], lo: str, hi: str, t: str, *, name: str = "n",
    open_lo: bool = False, open_hi: bool = False, width_us: int = DAY_US,
) -> DataFrame:
    """Points with lo <= t <= hi per window (ends optionally open), as a difference of two counts."""
    probes = {"_n_hi": Probe(hi, strict=open_hi), "_n_lo": Probe(lo, strict=not open_lo)}
    out = count_probes(windows, points, key, by, t, probes, width_us=width_us)
    return out.withColumn(name, F.greatest(F.col("_n_hi") - F.col("_n_lo"), F.lit(0))).drop("_n_hi", "_n_lo")


def count_overlaps(
    windows: DataFrame, spans: DataFrame, key: Sequence[str], by: Sequence[str], lo: str, hi: str, s: str, e: str, *, name: str = "n_spans",
    width_us: int = DAY_US,
) -> DataFrame:
    """Spans with s < hi and e > lo per window: those begun before hi less those ended by lo.

    Exact for windows with lo < hi and spans with s <= e.
    """
    w = windows.select(*dict.fromkeys([*key, *by, lo, hi]))
    begun = probe_counts(w, spans, key, by, s, {"_begun": Probe(hi, strict=True)}, width_us=width_us)
    ended = probe_counts(w, spans, key, by, e, {"_ended": Probe(lo)}, width_us=width_us)
    n = begun.join(ended, list(key)).select(*key, (F.col("_begun") - F.col("_ended")).alias(name))
    return windows.join(n, list(key), "left")


def _slots_of(lo: Column, hi: Column, width_us: int) -> Column:
    return F.sequence(slot(lo, width_us), slot(hi, width_us))


def points_in_windows(
    points: DataFrame, windows: DataFrame, by: Sequence[str], t: str, lo: str, hi: str, *, width_us: int = DAY_US
) -> DataFrame:
    """Inner pairs (point, window) with lo <= t <= hi, for metrics that need the samples.

    Windows are cut into time slots and equi-joined on (entity, slot); the optimizer
    broadcasts the window side when its measured size allows, and AQE splits a hot
    (entity, slot) on the point side otherwise. Column names must not clash.
    """
    by = list(by)
    cut = windows.withColumn("_b", F.explode(_slots_of(F.col(lo), F.col(hi), width_us)))
    pts = points.withColumn("_b", slot(t, width_us))
    return pts.join(cut, [*by, "_b"]).where((F.col(t) >= F.col(lo)) & (F.col(t) <= F.col(hi))).drop("_b")


def spans_over_windows(
    spans: DataFrame, windows: DataFrame, by: Sequence[str], s: str, e: str, lo: str, hi: str, *, width_us: int = DAY_US
) -> DataFrame:
    """Inner pairs with s < hi and e > lo. Each pair is emitted once, in the later of the two first slots."""
    by = list(by)
    a = spans.withColumn("_b", F.explode(_slots_of(F.col(s), F.col(e), width_us))).withColumn("_s0", slot(s, width_us))
    w = windows.withColumn("_b", F.explode(_slots_of(F.col(lo), F.col(hi), width_us))).withColumn("_w0", slot(lo, width_us))
    return (
        a.join(w, [*by, "_b"])
        .where((F.col(s) < F.col(hi)) & (F.col(e) > F.col(lo)) & (F.col("_b") == F.greatest("_s0", "_w0")))
        .drop("_b", "_s0", "_w0")
    )


def overlaps_merged(
    windows: DataFrame, merged: DataFrame, key: Sequence[str], by: Sequence[str], lo: str, hi: str, s: str, e: str, *, name: str = "overlaps"
) -> DataFrame:
    """Flag windows that overlap any of a set of disjoint spans: only the last span begun before hi can."""
    out = asof_probes(windows, merged, key, by, s, [e], {"_last": Probe(hi, strict=True)})
    return out.withColumn(name, F.coalesce(F.col(f"_last.{e}") > F.col(lo), F.lit(False))).drop("_last")
