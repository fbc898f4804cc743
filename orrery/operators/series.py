"""Series operators: steps, rolling means, arcs, detrending, injected responses."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.orbit import MU
from orrery.operators.cells import ROWS, even_cells
from orrery.operators.names import ramp
from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.scan import DAY_US, neighbour, prefix_scan, row_index, slot
from orrery.session import cut

CHUNK_ROWS = 4_096


def steps(series: DataFrame, by: Sequence[str], order: Sequence[str], value: str, width_us: int = DAY_US) -> DataFrame:
    """Change of ``value`` against the previous row, with that row's epoch."""
    near = neighbour(series, by, order, slot(order[0], width_us), [order[0], value])
    return near.withColumns({"delta": F.col(value) - F.col(f"prev.{value}"), "prev_t": F.col(f"prev.{order[0]}")}).drop("prev")


def median_step_s(series: DataFrame, by: Sequence[str], bucket: Column | None = None) -> DataFrame:
    b = slot("t", DAY_US) if bucket is None else bucket
    near = neighbour(series.select(*by, "t", b.alias("_slot")), by, ["t"], F.col("_slot"), ["t"])
    return exact_quantiles(near, by, {"step_s": ((F.col("t") - F.col("prev.t")) / 1e6, 0.5)})


def chunked(series: DataFrame, by: Sequence[str], order: Sequence[str], width: Column, bucket: Column) -> DataFrame:
    """Cut each series into row chunks with halos of half a window on both sides.

    Adds ``_chunk`` and ``_core``. Only rows near a chunk edge are repeated, so no task
    holds more than one chunk and its halos whatever the length of the series.
    """
    size = F.greatest(F.lit(CHUNK_ROWS), width * 4).cast("bigint")
    x = row_index(series, by, order, bucket, "_pos").withColumn("_p", F.col("_pos") - 1).withColumn("_c0", F.floor(F.col("_p") / size).cast("bigint"))
    half = F.floor(width / 2).cast("bigint") + 1
    inside = F.col("_p") - F.col("_c0") * size
    homes = F.array_compact(F.array(F.col("_c0"), F.when((inside < half) & (F.col("_c0") > 0), F.col("_c0") - 1), F.when(inside >= size - half, F.col("_c0") + 1)))
    out = x.withColumn("_chunk", F.explode(homes))
    return out.withColumn("_core", F.col("_chunk") == F.col("_c0")).drop("_p", "_c0")


def period_mean(series: DataFrame, by: Sequence[str], order: Sequence[str], value: str, *, period_s: Column | None = None, rows: int = ROWS, name: str = "period_mean") -> DataFrame:
    """Centred mean over one period of rows; NULL with too few values, or fewer than 8 rows in the series.

    The window is max(2, round(period / median step)) rows and needs half of it
    filled; an even window reaches one row further back than ahead. A window's sum is
    the difference of two running sums, found by row number. Sums run in cells of at most ``rows`` rows, however
    unevenly a series is sampled.
    """
    return period_means(series, by, order, {name: F.col(value)}, period_s=period_s, rows=rows)


def period_means(series: DataFrame, by: Sequence[str], order: Sequence[str], values: dict[str, Column], *, period_s: Column | None = None, rows: int = ROWS, wanted: Column | None = None) -> DataFrame:
    """:func:`period_mean` of several values of the same rows, side by side in one pass.

    ``wanted`` rows only are returned; all others count in the windows and steps, but are looked up by none.
    """
    by, n_of = list(by), range(len(values))
    wanted = F.lit(True) if wanted is None else wanted
    marked = even_cells(series, by, F.col(order[0]), "_even", rows=rows)
    step = median_step_s(marked, by, F.col("_even"))
    per = [F.count(F.lit(1)).alias("_rows"), *[F.count(c).alias(f"_valid{i}") for i, c in enumerate(values.values())]]
    if period_s is None:
        plan = with_quantiles(series, by, per, {f"_a{i}": (c, 0.5) for i, c in enumerate(values.values())})
        periods = [2 * math.pi * F.sqrt(F.pow(f"_a{i}", F.lit(3.0)) / MU) for i in n_of]
    else:  # any middle of the values will do
        plan, periods = series.groupBy(*by).agg(*per, *[F.avg(c).alias(f"_a{i}") for i, c in enumerate(values.values())]), [period_s]
    widths = [F.greatest(F.lit(2), F.bround(p / F.col("step_s"))).cast("bigint").alias(f"_w{j}") for j, p in enumerate(periods)]
    most = F.greatest(*[F.col(f"_valid{i}") for i in n_of]) if len(values) > 1 else F.col("_valid0")
    plan = cut(plan.join(step, by).where((F.col("step_s") > 0) & (most >= 8)).select(*by, "_rows", *[f"_{k}{i}" for i in n_of for k in ("a", "valid")], *widths))
    # running sums around the middle: small numbers, so differences of sums keep their digits
    sums = {"_pos": ("sum", F.lit(1).cast("bigint"))}
    for i, c in enumerate(values.values()):
        sums |= {f"_s{i}": ("sum", F.coalesce(c - F.col(f"_a{i}"), F.lit(0.0))), f"_n{i}": ("sum", c.isNotNull().cast("bigint"))}
    x = prefix_scan(marked.join(plan, by), by, order, F.col("_even"), sums)
    for j in range(len(widths)):
        half = F.floor(F.col(f"_w{j}") / 2)
        x = x.withColumns({f"_lo{j}": F.col("_pos") - half - 1, f"_hi{j}": F.least(F.col("_rows"), F.col("_pos") + F.col(f"_w{j}") - 1 - half)})
    x = cut(x)
    asked = x.where(wanted)
    reach = asked.groupBy(*by).agg(*[f(f"_{e}{j}").alias(f"_{e}_{j}") for j in range(len(widths)) for f, e in ((F.min, "lo"), (F.max, "hi"))])
    inside = [F.col("_pos").between(F.col(f"_lo_{j}"), F.col(f"_hi_{j}")) for j in range(len(widths))]
    near, both = x.join(reach, by), asked
    for j in range(len(widths)):
        mine = [j] if period_s is None else list(n_of)
        at = lambda tag: near.where(inside[j]).select(*by, F.col("_pos").alias(f"_{tag}{j}"), *[F.col(f"_{k}{i}").alias(f"_{k}{tag}{i}") for i in mine for k in "sn"])  # noqa: B023, E731
        both = both.join(at("hi"), [*by, f"_hi{j}"], "left").join(at("lo"), [*by, f"_lo{j}"], "left")
    means = []
    for i, name in enumerate(values):
        n = F.coalesce(f"_nhi{i}", F.lit(0)) - F.coalesce(f"_nlo{i}", F.lit(0))
        enough = (F.col(f"_valid{i}") >= 8) & (n >= F.greatest(F.lit(2), F.floor(F.col(f"_w{i if period_s is None else 0}") / 2)))
        means.append(F.when(enough, F.col(f"_a{i}") + (F.col(f"_shi{i}") - F.coalesce(f"_slo{i}", F.lit(0.0))) / n).alias(name))
    short = series.where(wanted).join(plan, by, "left_anti").select(*series.columns, *[F.lit(None).cast("double").alias(n) for n in values])
    return both.select(*series.columns, *means).unionByName(short)


def backward_mean(series: DataFrame, by: Sequence[str], t: str, value: str, span_us: int, name: str = "backward_mean") -> DataFrame:
    """Mean over [t - span, t]. Slots are one span wide and hold a copy of the slot before."""
    own = slot(t, span_us)
    both = series.withColumn("_own", own).withColumn("_b", F.explode(F.array(F.col("_own"), F.col("_own") + 1)))
    w = Window.partitionBy(*by, "_b").orderBy(t).rangeBetween(-span_us, 0)
    return both.withColumn(name, F.avg(value).over(w)).where(F.col("_b") == F.col("_own")).drop("_own", "_b")


def arcs(series: DataFrame, by: Sequence[str], *, gap_min_us: int = 300_000_000, factor: float = 10.0, min_rows: int = 4, width_us: int = DAY_US) -> DataFrame:
    """Contiguous arcs: a new one after a hole over max(minimum, factor x median step); short arcs are left out."""
    by = list(by)
    near = neighbour(series, by, ["t"], slot("t", width_us), ["t"]).withColumn("_gap", F.col("t") - F.col("prev.t")).drop("prev")
    med = exact_quantiles(near, by, {"_med": (F.when(F.col("_gap") > 0, F.col("_gap")), 0.5)})
    x = near.join(med, by, "left")
    limit = F.greatest(F.lit(float(gap_min_us)), factor * F.coalesce("_med", F.lit(float(gap_min_us))))
    fresh = F.when(F.col("_gap") > limit, 1).otherwise(0).cast("bigint")
    x = prefix_scan(x, by, ["t"], slot("t", width_us), {"arc": ("sum", fresh)}).drop("_gap", "_med")
    size = x.groupBy(*by, "arc").agg(F.count(F.lit(1)).alias("arc_rows"))
    return x.join(size, [*by, "arc"]).where(F.col("arc_rows") >= min_rows)


def detrend(series: DataFrame, by: Sequence[str], t: str, value: str, name: str = "detrended") -> DataFrame:
    """Subtract the fitted line, keep the mean."""
    by = list(by)
    t0 = series.groupBy(*by).agg(F.min(t).alias("_t0"))
    x = series.join(t0, by).withColumn("_s", (F.col(t) - F.col("_t0")) / 1e6)
    y = F.when(F.col(value).isNotNull(), F.col("_s"))
    fit = x.groupBy(*by).agg(F.regr_slope(value, y).alias("_k"), F.avg(value).alias("_my"), F.avg(y).alias("_mx"))
    return x.join(fit, by).withColumn(name, F.col(value) - F.col("_k") * (F.col("_s") - F.col("_mx"))).drop("_t0", "_s", "_k", "_my", "_mx")


def injected_responses(
    series: DataFrame, by: Sequence[str], value: str, *, amounts: Sequence[float], spacings_h: Sequence[float], hour_us: int, ramp_h: float,
    pre_h: float = 6.0, post_h: float = 24.0, band_h: float = 12.0, fit_h: float = 24.0, period_s: Column | None = None,
) -> DataFrame:
    """Two estimators of a known change injected at mid-series, less their value without it.

    The orbit estimator is the difference of band medians around the window, the catalogue
    estimator the difference of backward means at the bracket epochs. ``hour_us`` sets the
    time unit. Amount 0 is the baseline; the grid is a fixed list, a column to each amount.
    """
    by, levels = list(by), (0.0, *map(float, amounts))
    mid = series.groupBy(*by).agg(((F.min("t") + F.max("t")) / 2).alias("_t0"))
    hh = (F.col("t") - F.col("_t0")) / hour_us
    bands = {"_b": (hh >= -pre_h - band_h) & (hh < -pre_h), "_a": (hh > post_h) & (hh <= post_h + band_h)}
    for i, spacing in enumerate(spacings_h):
        slack = max(0.0, (spacing - pre_h - post_h) / 2)
        q0, q1 = -(pre_h + slack), post_h + slack
        bands |= {f"_q{i}": (hh >= q0 - fit_h) & (hh <= q0), f"_r{i}": (hh >= q1 - fit_h) & (hh <= q1)}
    # the injected copies differ in value only, so they are columns of a row, and means are looked up in the bands alone
    x = cut(series.join(mid, by).select(*by, "t", "_t0", value))
    injected = {f"_m{k}": F.col(value) + a * ramp(hh, F.lit(ramp_h)) for k, a in enumerate(levels)}
    p = cut(period_means(x, by, ["t"], injected, period_s=period_s, wanted=reduce(Column.__or__, bands.values())).select(*by, "t", "_t0", *injected))
    orbit = exact_quantiles(p, by, {f"{b}{k}": (F.when(bands[b], F.col(f"_m{k}")), 0.5) for b in ("_b", "_a") for k in range(len(levels))})
    mean = lambda b, k: F.avg(F.when(bands[b], F.col(f"_m{k}")))
    catalog = p.groupBy(*by).agg(*[(mean(f"_r{i}", k) - mean(f"_q{i}", k)).alias(f"_c{i}_{k}") for i in range(len(spacings_h)) for k in range(len(levels))])
    est = mid.select(*by).join(catalog, by, "left").join(orbit, by, "left")
    change = lambda k: F.col(f"_a{k}") - F.col(f"_b{k}")
    rows = [
        F.struct(F.lit(a).alias("amount"), F.lit(float(s)).alias("spacing_h"), (change(k) - change(0)).alias("orbit_estimate"), (F.col(f"_c{i}_{k}") - F.col(f"_c{i}_0")).alias("catalog_estimate"))
        for k, a in enumerate(levels) if k for i, s in enumerate(spacings_h)
    ]
    return est.select(*by, F.explode(F.array(*rows)).alias("_r")).select(*by, "_r.*")
