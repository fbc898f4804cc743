"""Window generation: merged spans, candidate grids, even selection, quiet windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.ids import quiet_id
from orrery.functions.time import iso_milli_form
from orrery.operators.coverage import span_coverage
from orrery.operators.joins import overlaps_merged, points_in_windows
from orrery.operators.cells import ROWS, even_cells
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, prefix_scan, row_index, slot
from orrery.session import cut

PRE_US, POST_US = 6 * HOUR_US, 24 * HOUR_US
WINDOW_US = PRE_US + POST_US
BUFFER_US = 24 * HOUR_US


def event_windows(annotations: DataFrame, t: str = "event_t") -> DataFrame:
    """-6 h .. +24 h around each reported event, labelled ``event`` with the default tier."""
    return annotations.withColumns({"ws": F.col(t) - PRE_US, "we": F.col(t) + POST_US, "event_label": F.lit("event"), "confidence_tier": F.lit("C")})


def merge_spans(spans: DataFrame, by: Sequence[str], s: str, e: str, *, rows: int = ROWS) -> DataFrame:
    """Union of overlapping or touching spans: one row per merged span with its member count.

    The running maximum of earlier ends and the running island number are two-level
    scans in cells of at most ``rows`` spans, so an entity with very many spans stays spread, also where most start in one hour.
    """
    by = list(by)
    plain = spans.groupBy(*by, s, e).agg(F.count(F.lit(1)).alias("_n"))
    order, b = [s, e], F.col("_even")
    plain = even_cells(plain, by, F.col(s), "_even", rows=rows)
    seen = prefix_scan(plain, by, order, b, {"_reach": ("max", F.col(e))}, inclusive=False)
    fresh = F.when(F.col("_reach").isNull() | (F.col(s) > F.col("_reach")), 1).otherwise(0).cast("bigint")
    numbered = prefix_scan(seen, by, order, b, {"_island": ("sum", fresh)})
    return numbered.groupBy(*by, "_island").agg(F.min(s).alias(s), F.max(e).alias(e), F.sum("_n").alias("members")).drop("_island")


def grid_candidates(mission: DataFrame, start: str, end: str, width_us: int = WINDOW_US) -> DataFrame:
    """Back-to-back windows from the mission start while they end inside the mission."""
    steps = F.floor((F.col(end) - F.col(start)) / width_us)
    return mission.where(steps >= 1).withColumn("_i", F.explode(F.sequence(F.lit(0).cast("bigint"), steps - 1))).withColumns(
        {"ws": F.col(start) + F.col("_i") * width_us, "we": F.col(start) + (F.col("_i") + 1) * width_us}
    ).drop("_i")


def pick_evenly(candidates: DataFrame, quota: DataFrame, by: Sequence[str]) -> DataFrame:
    """Evenly spaced picks per (entity, year), ``max(1, quota)`` of them at most.

    Positions are round-half-even(i*(n-1)/(take-1)); one pick takes the middle. The
    candidates of a (entity, year) are bounded by year length / window length.
    """
    by = list(by)
    w = Window.partitionBy(*by).orderBy("ws")
    c = candidates.withColumns({"_pos": F.row_number().over(w) - 1, "_n": F.count(F.lit(1)).over(Window.partitionBy(*by))})
    c = c.join(quota.select(*by, F.col("quota").alias("_q")), by, "left")
    c = c.withColumn("_take", F.least(F.greatest(F.lit(1), F.coalesce("_q", F.lit(0))), F.col("_n")).cast("int"))
    even = F.transform(F.sequence(F.lit(0), F.col("_take") - 1), lambda i: F.bround(i * (F.col("_n") - 1) / (F.col("_take") - 1)).cast("int"))
    keep = (
        F.when(F.col("_take") == F.col("_n"), F.lit(True))
        .when(F.col("_take") == 1, F.col("_pos") == F.floor((F.col("_n") - 1) / 2))
        .otherwise(F.array_contains(even, F.col("_pos")))
    )
    return c.where(keep).drop("_pos", "_n", "_q", "_take")


def year_of(t: str):
    return F.year(F.timestamp_micros(t))


def quiet_windows(events: DataFrame, elements: DataFrame, ranging_spans: DataFrame, orbit_spans: DataFrame) -> DataFrame:
    """No-event windows: grid over the element coverage, away from buffered events, even per year, with coverage."""
    mission = elements.groupBy("entity_id").agg(F.min("t").alias("m0"), F.max("t").alias("m1"))
    blocked = merge_spans(
        events.select("entity_id", (F.col("ws") - BUFFER_US).alias("xs"), (F.col("we") + BUFFER_US).alias("xe")), ["entity_id"], "xs", "xe"
    )
    grid = grid_candidates(mission, "m0", "m1").select("entity_id", "ws", "we")
    free = overlaps_merged(grid, blocked, ["entity_id", "ws"], ["entity_id"], "ws", "we", "xs", "xe").where(~F.col("overlaps")).drop("overlaps").withColumn("year", year_of("ws"))
    quota = events.groupBy("entity_id", year_of("ws").alias("year")).agg(F.count(F.lit(1)).alias("quota"))
    picked = pick_evenly(free, quota, ["entity_id", "year"])
    ident = quiet_id(F.col("entity_id"), iso_milli_form(F.timestamp_micros("ws")), iso_milli_form(F.timestamp_micros("we")))
    picked = cut(picked.withColumns({"annotation_id": ident, "event_label": F.lit("no_event")}))
    return span_coverage(picked, elements, ranging_spans, orbit_spans)


def quiet_window_summary(quiet: DataFrame, events: DataFrame, elements: DataFrame) -> DataFrame:
    """Per entity: mission, requested and found windows, coverage counts, whether the quota was out of reach."""
    mission = elements.groupBy("entity_id").agg(F.min("t").alias("m0"), F.max("t").alias("m1"))
    years = mission.withColumn("year", F.explode(F.sequence(year_of("m0"), year_of("m1"))))
    per_year = events.groupBy("entity_id", year_of("ws").alias("year")).agg(F.count(F.lit(1)).alias("quota"))
    asked = years.join(per_year, ["entity_id", "year"], "left").groupBy("entity_id", "m0", "m1").agg(
        F.count(F.lit(1)).alias("mission_years"), F.sum(F.greatest(F.lit(1), F.coalesce("quota", F.lit(0)))).alias("requested")
    )
    found = quiet.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("found"), F.count_if("aligned").alias("aligned"),
        *[F.count_if(F.col(f"{x}_status") == "covered").alias(f"{x}_covered") for x in ("tle", "slr", "orbit")],
        *[F.count_if(F.col("coverage_tier") == x).alias(f"tier_{x}") for x in "ABC"],
    )
    reported = events.groupBy("entity_id").agg(F.count(F.lit(1)).alias("events"))
    out = asked.join(found, "entity_id", "left").join(reported, "entity_id", "left").na.fill(0)
    return out.withColumn("constrained", F.col("found") < F.col("requested")).withColumn(
        "notes", F.when(F.col("constrained"), "quota_limited_by_event_exclusions").otherwise("")
    )


def tail_windows(windows: DataFrame, by: Sequence[str], end: str, days: int, as_of_us: int | None = None) -> DataFrame:
    """Windows ending in the last ``days`` of each entity's latest window end."""
    w = windows if as_of_us is None else windows.where(F.col(end) <= as_of_us)
    last = w.groupBy(*by).agg((F.max(end) - days * DAY_US).alias("cutoff"))
    return w.join(last, list(by)).where(F.col(end) >= F.col("cutoff"))


def coverage_matched(controls: DataFrame, events: DataFrame, ident: Sequence[str], seed: int) -> DataFrame:
    """Down-sample controls per entity so their share of tier A follows the events' share.

    ``tier`` is 'A' or anything else. The pick takes the smallest hash ranks of each
    (entity, pool); ranks are two-level scans over hash bands, so a huge pool is spread.
    """
    share = events.groupBy("entity_id").agg((F.count_if(F.col("tier") == "A") / F.count(F.lit(1))).alias("_frac"))
    n = controls.groupBy("entity_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("tier") == "A").alias("_na"))
    plan = n.join(share, "entity_id").where("_frac > 0 and _na > 0")
    plan = plan.withColumn("_total", F.least(F.col("_n"), F.floor(F.col("_na") / F.col("_frac"))))
    plan = plan.withColumn("_want_a", F.least(F.col("_na"), F.bround(F.col("_frac") * F.col("_total")).cast("bigint")))
    plan = plan.withColumn("_want_o", F.least(F.col("_n") - F.col("_na"), F.col("_total") - F.col("_want_a")))
    h = F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in ident[:2]]))
    pool = controls.join(plan.select("entity_id", "_want_a", "_want_o"), "entity_id").withColumns({"_pool": F.col("tier") == "A", "_h": h})
    band = F.conv(F.substring("_h", 1, 2), 16, 10).cast("bigint")
    ranked = row_index(pool, ["entity_id", "_pool"], ["_h", *ident], band, "_rank")
    return ranked.where(F.col("_rank") <= F.when(F.col("_pool"), F.col("_want_a")).otherwise(F.col("_want_o"))).drop("_pool", "_h", "_rank", "_want_a", "_want_o")


def quiet_arcs(states: DataFrame, events: DataFrame, arc_us: int, max_gap_us: int) -> DataFrame:
    """Per entity the first and last state in the central arc of the longest stretch between event windows whose
    central arc is continuous and clean.

    ``states`` has entity_id, t and a boolean ``bad``. Returns entity_id, the stretch (lo, hi) and the arc (a0, a1).
    """
    edge = states.groupBy("entity_id").agg(F.min("t").alias("_a"), F.max("t").alias("_z"))
    w = events.select("entity_id", "ws", "we").join(edge, "entity_id", "left_semi")
    nxt = neighbour(w, ["entity_id"], ["ws", "we"], slot("ws", DAY_US), ["ws"], name="_n", ahead=True)
    between = nxt.join(edge, "entity_id").select("entity_id", F.col("we").alias("lo"), F.coalesce(F.col("_n.ws"), F.col("_z")).alias("hi"))
    head = edge.join(w.groupBy("entity_id").agg(F.min("ws").alias("_f")), "entity_id", "left").select("entity_id", F.col("_a").alias("lo"), F.coalesce("_f", "_z").alias("hi"))
    mid = F.floor((F.col("lo") + F.col("hi")) / 2).cast("bigint")
    gaps = between.unionByName(head).where(F.col("hi") - F.col("lo") >= arc_us).withColumns({"c0": mid - arc_us // 2, "c1": mid + arc_us // 2})
    pts = neighbour(states.select("entity_id", "t", "bad"), ["entity_id"], ["t"], slot("t", DAY_US), ["t"])
    inside = points_in_windows(pts, gaps, ["entity_id"], "t", "c0", "c1")
    facts = inside.groupBy("entity_id", "lo", "hi").agg(
        F.max("bad").alias("_bad"), F.count(F.lit(1)).alias("_n"), F.min("t").alias("a0"), F.max("t").alias("a1"), F.max(F.when(F.col("prev.t") >= F.col("c0"), F.col("t") - F.col("prev.t"))).alias("_gap")
    )
    good = facts.where(~F.col("_bad") & (F.col("_n") > 1) & (F.col("_gap") <= max_gap_us))
    return good.groupBy("entity_id").agg(F.max_by(F.struct("lo", "hi", "a0", "a1"), F.struct(F.col("hi") - F.col("lo"), -F.col("lo"))).alias("_w")).select("entity_id", "_w.*")
