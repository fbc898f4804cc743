"""Window coverage by source, coverage tiers, and their audit against stored labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.flags import coverage_tier, covered, missing_flags, missing_sources
from orrery.operators.joins import Probe, count_overlaps, probe_counts
from orrery.operators.scan import HOUR_US


def _ms(df: DataFrame, t: str = "t") -> DataFrame:
    return df.select("entity_id", (F.floor(F.col(t) / 1000) * 1000).cast("bigint").alias("t"))


def _counts(windows: DataFrame, points: DataFrame, t: str, probes: dict[str, Probe]) -> DataFrame:
    cols = ["annotation_id", "entity_id", *dict.fromkeys(p.t for p in probes.values())]
    return probe_counts(windows.select(*dict.fromkeys(cols)), points, ["annotation_id"], ["entity_id"], t, probes)


def presence_coverage(windows: DataFrame, elements: DataFrame, states: DataFrame, ranging: DataFrame, margin_us: int = 24 * HOUR_US) -> DataFrame:
    """Counts and statuses per window (``ws``, ``we``): bounds inclusive, sample epochs floored to ms."""
    w = windows.withColumn("_ws_m", F.col("ws") - margin_us).withColumn("_we_m", F.col("we") + margin_us)
    inside = lambda lo, hi: {"_hi": Probe(hi), "_lo": Probe(lo, strict=True)}
    diff = F.greatest(F.col("_hi") - F.col("_lo"), F.lit(0))
    orbit = _counts(w, _ms(states), "t", inside("ws", "we")).select("annotation_id", diff.alias("orbit_sample_count"))
    slr = _counts(w, _ms(ranging), "t", inside("_ws_m", "_we_m")).select("annotation_id", diff.alias("slr_np_count"))
    tle = _counts(w, _ms(elements), "t", {"tle_epochs_before": Probe("ws"), "tle_epochs_after": Probe("we", forward=True)})
    out = windows.join(orbit, "annotation_id").join(slr, "annotation_id").join(tle, "annotation_id")
    return with_statuses(
        out, (F.col("tle_epochs_before") > 0) & (F.col("tle_epochs_after") > 0), F.col("slr_np_count") > 0, F.col("orbit_sample_count") > 0,
    )


def span_coverage(windows: DataFrame, elements: DataFrame, ranging_spans: DataFrame, orbit_spans: DataFrame, margin_us: int = 24 * HOUR_US) -> DataFrame:
    """Statuses from product spans: elements must bracket the window, spans must overlap it."""
    w = windows.withColumn("_ws_m", F.col("ws") - margin_us).withColumn("_we_m", F.col("we") + margin_us)
    key, by = ["annotation_id"], ["entity_id"]
    tle = _counts(w, elements, "t", {"_before": Probe("ws"), "_after": Probe("we", forward=True)})
    slr = count_overlaps(w.select(*key, *by, "_ws_m", "_we_m"), ranging_spans, key, by, "_ws_m", "_we_m", "s", "e", name="slr_file_count")
    orb = count_overlaps(w.select(*key, *by, "ws", "we"), orbit_spans, key, by, "ws", "we", "s", "e", name="orbit_file_count")
    out = windows.join(tle, key).join(slr.select(*key, "slr_file_count"), key).join(orb.select(*key, "orbit_file_count"), key)
    out = with_statuses(out, (F.col("_before") > 0) & (F.col("_after") > 0), F.col("slr_file_count") > 0, F.col("orbit_file_count") > 0)
    return out.drop("_before", "_after")


def with_statuses(df: DataFrame, tle, slr, orbit) -> DataFrame:
    """Add statuses, tier, missing list, aligned flag and quality flags."""
    out = df.withColumns({"tle_status": covered(tle), "slr_status": covered(slr), "orbit_status": covered(orbit)})
    three = (F.col("tle_status"), F.col("slr_status"), F.col("orbit_status"))
    out = out.withColumn("missing_sources", missing_sources(*three))
    return out.withColumns({
        "coverage_tier": coverage_tier(*three), "aligned": F.col("missing_sources") == "", "quality_flags": missing_flags(F.col("missing_sources")),
    })


def status_diff(shipped: DataFrame, recomputed: DataFrame, pending: list[int] | None = None) -> DataFrame:
    """Field-level differences between stored and recomputed labels, with category and kind.

    A lost orbit or ranging status is a known change of meaning (or, for entities listed
    in ``pending``, awaited data); every gain and every lost element status is unexpected.
    """
    fields = ["tle_status", "slr_status", "orbit_status", "coverage_tier"]
    joined = shipped.select("annotation_id", "entity_id", *[F.col(f).alias(f"old_{f}") for f in fields]).join(
        recomputed.select("annotation_id", *[F.col(f).alias(f"new_{f}") for f in fields]), "annotation_id"
    )
    pairs = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"old_{f}").alias("old"), F.col(f"new_{f}").alias("new")) for f in fields])
    long = joined.select("annotation_id", "entity_id", F.explode(pairs).alias("p")).select("annotation_id", "entity_id", "p.*").where(~F.col("old").eqNullSafe(F.col("new")))
    down = (F.col("old") == "covered") & (F.col("new") == "missing")
    valid = F.col("old").isin("covered", "missing") & F.col("new").isin("covered", "missing")
    waits = F.col("entity_id").isin(pending or [])
    category = (
        F.when(F.col("field") == "coverage_tier", "tier_follows_status")
        .when(~valid, "unexpected")
        .when(down & (F.col("field") == "orbit_status") & waits, "backfill_pending")
        .when(down & (F.col("field") == "orbit_status"), "semantics_flip_orbit")
        .when(down & (F.col("field") == "slr_status"), "semantics_flip_slr")
        .otherwise("unexpected")
    )
    kind = (
        F.when(F.col("field") == "coverage_tier", "tier_change")
        .when(~valid, "invalid_status")
        .when(down & (F.col("field") == "tle_status"), "tle_downgrade")
        .when(down, "status_downgrade")
        .otherwise("status_upgrade")
    )
    return long.withColumns({"category": category, "kind": kind})
