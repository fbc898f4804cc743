"""How each source moves across a window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.orbit import angle_delta, norm3, sma_from_mean_motion, vis_viva_sma, inertial_velocity
from orrery.operators.dedup import keep_one
from orrery.operators.joins import bracket_join, points_in_windows
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.scan import HOUR_US
from orrery.session import cut

BAND_US = 12 * HOUR_US
MIN_BAND = 2


def band_samples(points: DataFrame, windows: DataFrame, margin_us: int = BAND_US) -> DataFrame:
    """Samples near each window tagged before [ws-m, ws), during [ws, we], after (we, we+m]."""
    w = windows.select("annotation_id", "entity_id", "ws", "we", (F.col("ws") - margin_us).alias("_lo"), (F.col("we") + margin_us).alias("_hi"))
    band = F.when(F.col("t") < F.col("ws"), "before").when(F.col("t") <= F.col("we"), "during").otherwise("after")
    return points_in_windows(points, w, ["entity_id"], "t", "_lo", "_hi").withColumn("band", band).drop("_lo", "_hi")


def element_response(windows: DataFrame, elements: DataFrame) -> DataFrame:
    """Element differences between the epochs that bracket each window."""
    b = bracket_join(windows, elements, ["annotation_id"], ["entity_id"], "ws", "we", "t", ["t", "mean_motion", "inclination", "eccentricity", "bstar"])
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    a0, a1 = sma_from_mean_motion(F.col("before.mean_motion")) / 1000.0, sma_from_mean_motion(F.col("after.mean_motion")) / 1000.0
    cols = {
        "tle_status": F.when(both, "computed").otherwise("insufficient_coverage"),
        "before_t": F.when(both, F.col("before.t")), "after_t": F.when(both, F.col("after.t")),
        "delta_mean_motion": F.col("after.mean_motion") - F.col("before.mean_motion"),
        "delta_eccentricity": F.col("after.eccentricity") - F.col("before.eccentricity"),
        "delta_bstar": F.col("after.bstar") - F.col("before.bstar"),
        "delta_inclination": angle_delta(F.col("after.inclination"), F.col("before.inclination"))[0],
        "tle_sma_before_km": F.when(both, a0), "tle_sma_after_km": F.when(both, a1), "delta_sma_km": a1 - a0,
    }
    return b.select(*windows.columns, *[c.alias(n) for n, c in cols.items()])


def product_ledger(selected: DataFrame, refused: DataFrame) -> DataFrame:
    """Files chosen for each window: how many, how many were refused, the first refusal, and whether the rest turn with the Earth.

    ``selected`` has annotation_id, path, source_type and rotating (one row a file), ``refused`` path, assertion and row. Usable
    files of a window must agree on the frame: their rows are analysed together, so a mixed window stops the query.
    """
    marked = selected.join(refused.select("path", F.struct("path", "assertion", "row").alias("refusal")), "path", "left")
    usable = F.col("refusal").isNull()
    turning = lambda f: f(F.when(usable, F.col("rotating")))
    g = marked.groupBy("annotation_id").agg(
        F.count(F.lit(1)).alias("orbit_file_count"), F.count("refusal").alias("orbit_parse_failure_count"), F.min("refusal").alias("first"),
        F.min_by("source_type", "path").alias("orbit_source"), turning(F.min).alias("_lo"), turning(F.max).alias("_hi"),
    )
    mixed = F.raise_error(F.concat(F.lit("mixed_frame_orbit_products: files of a window disagree on the rotating frame: "), F.col("annotation_id").cast("string")))
    return g.select(
        "annotation_id", "orbit_file_count", "orbit_parse_failure_count", F.concat_ws(":", "first.path", "first.assertion", "first.row").alias("orbit_first_failure"),
        "orbit_source", F.when(F.col("_lo") != F.col("_hi"), mixed.cast("boolean")).otherwise(F.col("_lo")).alias("rotating"),
    )


def product_response(windows: DataFrame, states: DataFrame, selected: DataFrame, refused: DataFrame, margin_us: int = BAND_US) -> DataFrame:
    """Orbit response of each window from the usable files chosen for it, with the counts of ``product_ledger``.

    ``states`` name their file in ``path``. Equal epochs of a window count once, from the first path. A window whose files are all
    refused is ``parse_unavailable``.
    """
    ledger = cut(product_ledger(selected, refused))
    chosen = selected.select("annotation_id", "path").join(refused.select("path"), "path", "left_anti").join(ledger.select("annotation_id", "rotating"), "annotation_id")
    out = orbit_response(windows, states, margin_us, chosen)
    files = F.coalesce(F.col("orbit_file_count"), F.lit(0))
    failed = F.coalesce(F.col("orbit_parse_failure_count"), F.lit(0))
    status = F.when((files > 0) & (files == failed), "parse_unavailable").otherwise(F.coalesce("orbit_status_response", F.lit("insufficient_coverage")))
    return out.join(ledger.drop("rotating"), "annotation_id", "left").withColumns({"orbit_status_response": status, "orbit_file_count": files, "orbit_parse_failure_count": failed})


def orbit_response(windows: DataFrame, states: DataFrame, margin_us: int = BAND_US, chosen: DataFrame | None = None) -> DataFrame:
    """Median radius and vis-viva semi-major axis before and after each window.

    States are Earth-fixed, unless ``chosen`` (annotation_id, path, rotating) says which files of a window count and in what frame.
    """
    pos, vel = tuple(map(F.col, ("x", "y", "z"))), tuple(map(F.col, ("vx", "vy", "vz")))
    radius, fixed = norm3(*pos).alias("radius"), vis_viva_sma(pos, inertial_velocity(pos, vel))
    if chosen is None:
        samples = band_samples(states.select("entity_id", "t", radius, fixed.alias("sma")), windows, margin_us)
    else:
        pts = states.select("entity_id", "t", "path", radius, fixed.alias("sma_fixed"), vis_viva_sma(pos, vel).alias("sma_inertial"))
        samples = band_samples(pts, windows, margin_us).join(chosen, ["annotation_id", "path"]).withColumn("sma", F.when(F.col("rotating"), F.col("sma_fixed")).otherwise(F.col("sma_inertial")))
        samples = keep_one(samples, ["annotation_id", "t"], ["path"])
    b = cut(samples.where("band <> 'during'").select("annotation_id", "band", "radius", "sma"))
    n = b.groupBy("annotation_id").agg(
        *[F.count_if(F.col("band") == x).alias(f"orbit_samples_{x}") for x in ("before", "after")],
        *[F.count_if((F.col("band") == x) & F.col("sma").isNotNull()).alias(f"_n_{x}") for x in ("before", "after")],
    )
    wanted = {f"_{m}_{x}": (F.when(F.col("band") == x, F.col(m)), 0.5) for m in ("radius", "sma") for x in ("before", "after")}
    n = n.join(exact_quantiles(b, ["annotation_id"], wanted), "annotation_id", "left")
    ok = (F.col("orbit_samples_before") >= MIN_BAND) & (F.col("orbit_samples_after") >= MIN_BAND)
    sma_ok = ok & (F.col("_n_before") >= MIN_BAND) & (F.col("_n_after") >= MIN_BAND)
    metrics = []
    for m, good in (("radius", ok), ("sma", sma_ok)):
        metrics += [F.when(good, F.col(f"_{m}_{x}")).alias(f"orbit_{m}_{x}_m") for x in ("before", "after")]
        metrics.append(F.when(good, F.col(f"_{m}_after") - F.col(f"_{m}_before")).alias(f"orbit_{m}_shift_m"))
    status = F.when(ok, "computed").otherwise("insufficient_coverage").alias("orbit_status_response")
    return windows.join(n.select("annotation_id", "orbit_samples_before", "orbit_samples_after", status, *metrics), "annotation_id", "left")


def ranging_response(windows: DataFrame, ranging: DataFrame, margin_us: int = BAND_US) -> DataFrame:
    """RMS of the ranging metric in the three bands and the absolute bias shift; rejected rows are left out."""
    b = band_samples(ranging.select("entity_id", "t", "metric"), windows, margin_us)
    def band(x):
        return F.when(F.col("band") == x, F.col("metric"))
    n = b.groupBy("annotation_id").agg(
        *[F.count_if(F.col("band") == x).alias(f"slr_obs_{x}") for x in ("before", "during", "after")],
        *[F.count(band(x)).alias(f"_n_{x}") for x in ("before", "during", "after")],
        *[F.avg(band(x)).alias(f"_avg_{x}") for x in ("before", "after")],
        *[F.sqrt(F.avg(band(x) * band(x))).alias(f"_rms_{x}") for x in ("before", "during", "after")],
    )
    ok = (F.col("_n_before") >= MIN_BAND) & (F.col("_n_after") >= MIN_BAND)
    return windows.join(
        n.select(
            "annotation_id", "slr_obs_before", "slr_obs_during", "slr_obs_after", F.when(ok, "computed").otherwise("insufficient_coverage").alias("slr_status_response"),
            *[F.when(ok, F.col(f"_rms_{x}")).alias(f"slr_rms_{x}_m") for x in ("before", "during", "after")],
            F.when(ok, F.abs(F.col("_avg_after") - F.col("_avg_before"))).alias("slr_bias_shift_m"),
        ), "annotation_id", "left",
    )
