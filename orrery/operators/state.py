"""State estimates around an event and their fusion."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.orbit import norm3
from orrery.operators.joins import Probe, asof_probes, points_in_windows
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.scan import HOUR_US

PRECISE_SIGMA_M = 0.1


def fuse(predicted: Sequence[Column], precise: Sequence[Column], sigma_predicted: Column, has_predicted: Column, has_precise: Column, sigma_precise: Column | None = None) -> dict[str, Column]:
    """Inverse-variance fusion with its status and sigma (m)."""
    sp = F.lit(PRECISE_SIGMA_M) if sigma_precise is None else sigma_precise
    w1, w2 = 1.0 / (sigma_predicted * sigma_predicted), 1.0 / (sp * sp)
    both, one, two = has_predicted & has_precise, has_predicted & ~has_precise, has_precise & ~has_predicted
    out = {"fusion_status": F.when(both, "fused").when(one, "tle_only").when(two, "pod_only").otherwise("no_sources")}
    for axis, p, q in zip("xyz", predicted, precise):
        out[f"fused_{axis}_m"] = F.when(both, (w1 * p + w2 * q) / (w1 + w2)).when(one, p).when(two, q)
    out["fused_sigma_m"] = F.when(both, F.sqrt(1.0 / (w1 + w2))).when(one, sigma_predicted).when(two, sp)
    return out


def fusion_errors(df: DataFrame, *, predicted: Sequence[str], second: Sequence[str], truth: Sequence[str], sigma_predicted: str, sigma_second: str) -> DataFrame:
    """Error (km) of the prediction, of a second series and of their fusion against the truth."""
    cols = lambda ns: tuple(F.col(n) for n in ns)
    t = cols(truth)
    fused = fuse(cols(predicted), cols(second), F.col(sigma_predicted), F.lit(True), F.lit(True), F.col(sigma_second))
    err = lambda p: norm3(*[a - b for a, b in zip(p, t)]) / 1000.0
    f = tuple(fused[f"fused_{a}_m"] for a in "xyz")
    return df.withColumns({"predicted_km": err(cols(predicted)), "second_km": err(cols(second)), "fused_km": err(f)})


def ranging_state(events: DataFrame, ranging: DataFrame, margin_us: int = 24 * HOUR_US) -> DataFrame:
    """Seconds to the previous and next pass, and median / RMS of the metric in the band around each event."""
    probes = {"_p": Probe("event_t"), "_n": Probe("event_t", forward=True, strict=True)}
    near = asof_probes(events.select("annotation_id", "entity_id", "event_t"), ranging, ["annotation_id"], ["entity_id"], "t", ["t"], probes)
    w = events.select("annotation_id", "entity_id", (F.col("event_t") - margin_us).alias("_lo"), (F.col("event_t") + margin_us).alias("_hi"))
    band = points_in_windows(ranging.select("entity_id", "t", "metric"), w, ["entity_id"], "t", "_lo", "_hi")
    stats = band.groupBy("annotation_id").agg(F.count(F.lit(1)).alias("band_points"), F.sqrt(F.avg(F.col("metric") * F.col("metric"))).alias("band_rms_m"))
    out = near.join(stats, "annotation_id", "left").join(exact_quantiles(band, ["annotation_id"], {"band_median_m": (F.col("metric"), 0.5)}), "annotation_id", "left")
    out = out.withColumn("band_points", F.coalesce("band_points", F.lit(0)))
    lacking = F.col("_p").isNull() | F.col("_n").isNull() | (F.col("band_points") == 0)
    return out.withColumns({
        "before_s": (F.col("event_t") - F.col("_p.t")) / 1e6, "after_s": (F.col("_n.t") - F.col("event_t")) / 1e6,
        "slr_state_status": F.when(lacking, "insufficient_coverage").otherwise("computed"),
    }).drop("_p", "_n")
