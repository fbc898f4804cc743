"""Record quality control: rows are marked and counted, never silently dropped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.orbit import LIGHT, RADIUS_MAX_M, RADIUS_MIN_M, RANGE_MAX_M, RANGE_MIN_M, inertial_velocity, norm3, vis_viva_sma
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.scan import DAY_US, neighbour, slot

# Fixed value: target names known to be foreign to a provider file.
FOREIGN_TARGETS = ("compassi6b",)
TOF_TOLERANCE_M = 1.0
CLOCK_SENTINEL = 999999.999999


def ranging_violations(mission_start: Column | None = None, mission_end: Column | None = None) -> dict[str, Column]:
    """Named row checks. A NULL gap or epoch violates, a NULL range is not out of band, open bounds do not apply."""
    gap = F.abs(F.col("tof_s") / 2.0 * LIGHT - F.col("range_m"))
    outside = F.lit(False)
    if mission_start is not None:
        outside = outside | F.coalesce(F.col("t") < mission_start, F.lit(False))
    if mission_end is not None:
        outside = outside | F.coalesce(F.col("t") > mission_end, F.lit(False))
    return {
        "slr_tof_range_identity": gap.isNull() | (gap > TOF_TOLERANCE_M),
        "slr_range_in_band": F.coalesce((F.col("range_m") < RANGE_MIN_M) | (F.col("range_m") > RANGE_MAX_M), F.lit(False)),
        "slr_epoch_present": F.col("t").isNull(),
        "slr_epoch_in_mission_span": outside,
    }


def any_of(checks: dict[str, Column]) -> Column:
    out = F.lit(False)
    for c in checks.values():
        out = out | c
    return out


def qc_status(rejected: Column) -> Column:
    """Most specific diagnosis: foreign target, implausible range, other rejection, ok."""
    band = F.coalesce((F.col("range_m") < RANGE_MIN_M) | (F.col("range_m") > RANGE_MAX_M), F.lit(False))
    return F.when(F.lower(F.trim("target_name")).isin(*FOREIGN_TARGETS), "cross_target").when(band, "range_implausible").when(rejected, "qc_rejected").otherwise("ok")


def with_qc_status(ranging: DataFrame) -> DataFrame:
    return ranging.withColumn("qc_status", qc_status(any_of(ranging_violations())))


def source_zero_fields() -> Column:
    s, n = F.coalesce(F.col("sigma_m") == 0, F.lit(False)), F.coalesce(F.col("num_returns") == 0, F.lit(False))
    return F.when(s & n, "sigma+num_returns").when(s, "sigma").when(n, "num_returns").otherwise("")


def enforce(df: DataFrame, checks: dict[str, Column], keep: str) -> DataFrame:
    """Strict mode: the job fails at the first violating row with the name of the check."""
    guard = F.lit(None).cast("string")
    for name, bad in checks.items():
        guard = F.coalesce(guard, F.assert_true(~bad, f"physical violation: {name}").cast("string"))
    return df.withColumn(keep, F.coalesce(guard.cast(df.schema[keep].dataType), F.col(keep)))


def state_violations(states: DataFrame, by: Sequence[str], *, rotating: bool = True, width_us: int = DAY_US) -> DataFrame:
    """Add one boolean per orbit check, plus radius and semi-major axis."""
    pos, vel = tuple(map(F.col, ("x", "y", "z"))), tuple(map(F.col, ("vx", "vy", "vz")))
    r = norm3(*pos)
    v = inertial_velocity(pos, vel) if rotating else vel
    sma = vis_viva_sma(pos, v)
    has_v = vel[0].isNotNull() & vel[1].isNotNull() & vel[2].isNotNull()
    near = neighbour(states, by, ["t", "event_id"], slot("t", width_us), ["t"])
    band = lambda c: c.isNull() | (c < RADIUS_MIN_M) | (c > RADIUS_MAX_M)
    return near.withColumns({
        "radius_m": r, "sma_m": F.when(has_v, sma),
        "bad_epoch_present": F.col("t").isNull(), "bad_epoch_increasing": F.coalesce(F.col("t") <= F.col("prev.t"), F.lit(False)),
        "bad_radius": band(r), "bad_sma": has_v & band(sma),
    }).drop("prev")


STATE_CHECKS = {"epoch_present": "bad_epoch_present", "epoch_strictly_increasing": "bad_epoch_increasing", "radius_in_leo_band": "bad_radius", "vis_viva_sma_in_leo_band": "bad_sma"}


def state_ledger(checked: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per entity or file: counts per check, radius and axis statistics, span."""
    aggs = [F.count(F.lit(1)).alias("n_records"), *[F.count_if(c).alias(f"{n}_violations") for n, c in STATE_CHECKS.items()],
            F.min("radius_m").alias("radius_min_m"), F.max("radius_m").alias("radius_max_m"), ((F.max("t") - F.min("t")) / 1e6).alias("epoch_span_s"),
            F.count_if(F.abs(F.col("clock") - CLOCK_SENTINEL) <= 1e-8 + 1e-5 * CLOCK_SENTINEL).alias("clock_sentinel_rows")]
    q = exact_quantiles(checked, by, {"radius_median_m": (F.col("radius_m"), 0.5), "sma_median_m": (F.col("sma_m"), 0.5)})
    return checked.groupBy(*by).agg(*aggs).join(q, list(by), "left")


def reject_files(checked: DataFrame, by: Sequence[str]) -> DataFrame:
    """First violation of each file (check, row, value): that file is refused as a whole and counted."""
    first = F.array_compact(F.array(*[F.when(F.col(c), F.struct(F.lit(i).alias("o"), F.col("event_id").alias("row"), F.lit(n).alias("assertion"))) for i, (n, c) in enumerate(STATE_CHECKS.items())]))
    hits = checked.select(*by, F.explode(first).alias("v"))
    return hits.groupBy(*by).agg(F.min("v").alias("v"), F.count(F.lit(1)).alias("violations")).select(*by, F.col("v.assertion").alias("assertion"), F.col("v.row").alias("row"), "violations")


def sentinel_to_null(col: Column, sentinel: float, scale: float = 1.0, offset: float = 0.0) -> Column:
    return F.nullif(col, F.lit(sentinel)) * scale + offset


def source_audit(points: DataFrame, by: Sequence[str], state_cols: Sequence[str], width_us: int = DAY_US) -> DataFrame:
    """Span, median cadence, gaps over twice the cadence, rows with a NULL state value."""
    by = list(by)
    near = neighbour(points, by, ["t"], slot("t", width_us), ["t"]).withColumn("_gap", (F.col("t") - F.col("prev.t")) / 1e6)
    cad = exact_quantiles(near, by, {"cadence_s": (F.col("_gap"), 0.5)})
    null_row = F.lit(False)
    for c in state_cols:
        null_row = null_row | F.col(c).isNull()
    joined = near.join(cad, by, "left")
    big = F.col("_gap") > 2 * F.col("cadence_s")
    return joined.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"), ((F.max("t") - F.min("t")) / 3600e6).alias("span_hours"), F.first("cadence_s").alias("cadence_s"),
        F.count_if(big).alias("gap_count"), F.max(F.when(big, F.col("_gap"))).alias("max_gap_s"), F.count_if(null_row).alias("null_state_rows"),
    )


def major_gaps(points: DataFrame, by: Sequence[str], max_gap_us: Column, width_us: int = DAY_US) -> DataFrame:
    """Holes longer than the limit as spans (gap_lo, gap_hi)."""
    d = points.select(*by, "t").distinct()
    near = neighbour(d, by, ["t"], slot("t", width_us), ["t"])
    return near.where(F.col("t") - F.col("prev.t") > max_gap_us).select(*by, F.col("prev.t").alias("gap_lo"), F.col("t").alias("gap_hi"))
