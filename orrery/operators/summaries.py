"""Roll-ups and distribution summaries on exact quantiles."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.orbit import altitude_km, norm3
from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.cells import ROWS, even_cells
from orrery.operators.scan import DAY_US, neighbour, slot
from orrery.session import cut


def with_all(df: DataFrame, cols: Sequence[str], sets: Sequence[Sequence[str]] | None = None) -> DataFrame:
    """Repeat rows so that grouping by ``cols`` yields the groups plus ``ALL`` roll-ups.

    ``sets`` lists the kept columns of each grouping set; the default is the full cube.
    """
    if sets is None:
        sets = [[c for c, keep in zip(cols, mask) if keep] for mask in product([True, False], repeat=len(cols))]
    rows = F.array(*[F.struct(*[(F.col(c).cast("string") if c in s else F.lit("ALL")).alias(c) for c in cols]) for s in sets])
    rest = [c for c in df.columns if c not in cols]
    return df.select(*rest, F.explode(rows).alias("_g")).select("_g.*", *rest)


def response_summary(per_window: DataFrame, tier: str = "coverage_tier") -> DataFrame:
    """Counts of computed responses and magnitudes per (entity, tier) with roll-ups."""
    x = with_all(per_window, ["entity_id", tier])
    counts = [F.count(F.lit(1)).alias("window_count")] + [F.count_if(F.col(c) == "computed").alias(n) for c, n in (
        ("tle_response", "tle_computed_count"), ("orbit_response", "orbit_computed_count"), ("slr_response", "slr_computed_count"))]
    a = F.abs
    outs = {
        "median_abs_delta_mean_motion": (a(F.col("delta_mean_motion")), 0.5), "median_abs_delta_sma_km": (a(F.col("delta_sma_km")), 0.5),
        "p25_abs_delta_sma_km": (a(F.col("delta_sma_km")), 0.25), "p75_abs_delta_sma_km": (a(F.col("delta_sma_km")), 0.75),
        "median_abs_delta_eccentricity": (a(F.col("delta_eccentricity")), 0.5), "median_abs_delta_inclination": (a(F.col("delta_inclination")), 0.5),
        "median_abs_orbit_radius_shift_m": (a(F.col("orbit_radius_shift_m")), 0.5), "median_abs_orbit_sma_shift_m": (a(F.col("orbit_sma_shift_m")), 0.5),
        "median_slr_bias_shift_m": (a(F.col("slr_bias_shift_m")), 0.5), "median_slr_rms_before_m": (F.col("slr_rms_before_m"), 0.5), "median_slr_rms_after_m": (F.col("slr_rms_after_m"), 0.5),
    }
    return with_quantiles(x, ["entity_id", tier], counts, outs)


def coverage_fields(points: DataFrame, by: Sequence[str], t: str = "t", width_us: int = 30 * DAY_US) -> DataFrame:
    """First/last epoch, distinct years, median cadence (h) and largest gap (d) per group."""
    by = list(by)
    near = neighbour(points.select(*by, t), by, [t], slot(t, width_us), [t])
    gap_days = (F.col(t) - F.col(f"prev.{t}")) / 1e6 / 86400.0
    aggs = [
        F.min(t).alias("first_t"), F.max(t).alias("last_t"), F.countDistinct(F.year(F.timestamp_micros(t))).alias("years_covered"),
        F.max(gap_days).alias("max_gap_days"),
    ]
    return with_quantiles(near, by, aggs, {"median_gap_days": (gap_days, 0.5)}).withColumn("cadence_median_hours", F.col("median_gap_days") * 24.0).drop("median_gap_days")


def element_distribution(elements: DataFrame) -> DataFrame:
    deg, alt, e = F.degrees("inclination"), altitude_km(F.col("mean_motion")), F.col("eccentricity")
    outs = {f"{n}_{s}": (c, p) for n, c in (("inc", deg), ("ecc", e), ("alt", alt)) for s, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75))}
    q = with_quantiles(elements, ["entity_id"], [F.count(F.lit(1)).alias("epoch_count")], outs)
    return q.join(coverage_fields(elements, ["entity_id"]), "entity_id")


def state_distribution(states: DataFrame) -> DataFrame:
    r = norm3(F.col("x"), F.col("y"), F.col("z")) / 1000.0
    q = with_quantiles(states, ["entity_id"], [F.count(F.lit(1)).alias("state_count"), F.min(r).alias("radius_min_km"), F.max(r).alias("radius_max_km")], {"radius_median_km": (r, 0.5)})
    return q.join(coverage_fields(states, ["entity_id"]), "entity_id")


def ranging_distribution(ranging: DataFrame) -> DataFrame:
    """Accepted rows only; flagged rows are counted."""
    ok = F.col("qc_status") == "ok"
    mm, good = F.col("sigma_m") * 1000.0, lambda c: F.when(ok, c)
    aggs = [F.count_if(ok).alias("normal_point_count"), F.count_if(~ok).alias("qc_flagged_rows"), F.countDistinct(good(F.col("station_id"))).alias("station_count")]
    outs = {"sigma_p25": (good(mm), 0.25), "sigma_median_mm": (good(mm), 0.5), "sigma_p75": (good(mm), 0.75), "num_returns_median": (good(F.col("num_returns")), 0.5)}
    q = with_quantiles(ranging, ["entity_id"], aggs, outs)
    return q.withColumn("sigma_iqr_mm", F.col("sigma_p75") - F.col("sigma_p25"))


def latest_elements(elements: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Newest non-NULL value of each column per entity."""
    return elements.groupBy("entity_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.struct("t", "event_id"))).alias(c) for c in cols], F.count(F.lit(1)).alias("epochs"))


def significant_bins(df: DataFrame, by: Sequence[str], bin_no: Column) -> DataFrame:
    """Number of bins per group that hold at least half of its fullest bin."""
    n = df.where(bin_no.isNotNull()).groupBy(*by, bin_no.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    top = F.max("_n").over(Window.partitionBy(*by))
    return n.withColumn("_top", top).groupBy(*by).agg(F.count_if(F.col("_n") >= F.greatest(F.lit(1.0), F.col("_top") * 0.5)).alias("significant_bins"))


def ecdf(df: DataFrame, by: Sequence[str], value: Column, *, rows: int = ROWS) -> DataFrame:
    """Distinct values with their cumulative share per group, in cells of at most ``rows`` values."""
    by = list(by)
    n = cut(df.where(value.isNotNull()).groupBy(*by, value.alias("value")).agg(F.count(F.lit(1)).alias("n")))
    n = even_cells(n, by, F.col("value"), "_even", rows=rows)
    whole = Window.partitionBy(*by)
    earlier = whole.orderBy("_even").rowsBetween(Window.unboundedPreceding, -1)
    cells = n.groupBy(*by, "_even").agg(F.sum("n").alias("_n"))
    cells = cells.select(*by, "_even", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_from"), F.sum("_n").over(whole).alias("total"))
    upto = Window.partitionBy(*by, "_even").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # joined by cell, as the window is dealt, so the values move once and never by group alone
    run = n.withColumn("cum", F.sum("n").over(upto)).join(cells, [*by, "_even"])
    return run.select(*by, "value", "n", (F.col("_from") + F.col("cum")).alias("cum"), "total", ((F.col("_from") + F.col("cum")) / F.col("total")).alias("ecdf"))


def right_closed_bin(x: Column, edges: Sequence[float]) -> Column:
    """Index of the bin (lo, hi] that holds x; NULL outside."""
    out = F.lit(None).cast("int")
    for i in range(len(edges) - 2, -1, -1):
        hi = F.lit(True) if edges[i + 1] == float("inf") else x <= edges[i + 1]
        out = F.when((x > edges[i]) & hi, i).otherwise(out)
    return out


def side_statistics(samples: DataFrame, by: Sequence[str], side: str, value: str, clip: float, min_side: int) -> DataFrame:
    """Before/after statistics after removing values farther than ``clip`` from their side's median."""
    by = list(by)
    med = exact_quantiles(samples, [*by, side], {"_center": (F.col(value), 0.5)})
    kept = cut(samples.join(med, [*by, side]).where(F.abs(F.col(value) - F.col("_center")) <= clip))
    val = lambda s: F.when(F.col(side) == s, F.col(value))
    aggs = [F.count(val(s)).alias(f"n_{s}") for s in ("before", "after")] + [F.sqrt(F.avg(val(s) * val(s))).alias(f"rms_{s}") for s in ("before", "after")]
    out = with_quantiles(kept, by, aggs, {f"median_{s}": (val(s), 0.5) for s in ("before", "after")})
    return out.withColumn("shift", F.when((F.col("n_before") >= min_side) & (F.col("n_after") >= min_side), F.col("median_after") - F.col("median_before")))
