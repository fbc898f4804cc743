"""Labels: evidence classification, candidate labelling, gates and exports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.flags import add_flag
from orrery.functions.ids import stable_id

MAX_EVIDENCE_IDS = 20

# Reported manoeuvre type -> (event family, orbital effect).
FAMILIES = {
    "orbit_raise": ("orbit_raise", "semi_major_axis"),
    "orbit_lower": ("orbit_lower", "semi_major_axis"),
    "plane_change": ("plane_change", "inclination"),
    "phasing": ("unknown_maneuver", "mean_longitude"),
    "station_keeping": ("station_keeping", "multi_axis"),
}
EVENT_LABELS = ("event", "no_event", "ignore")


def top_k(df: DataFrame, by: Sequence[str], order: Sequence, k: int, name: str = "rank") -> DataFrame:
    """First k rows per group. The rank filter is planned as a group limit before the shuffle, so at most k rows per group leave a task."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(name) <= k)


def classify_event(tle: Column, pod: Column, precise: Column, slr: Column) -> dict[str, Column]:
    """Label, tier, conflict status and flags of a reported event from its response statuses."""
    named = (("tle", tle), ("pod", pod), ("precise_orbit", precise), ("slr", slr))
    conflicts = [F.when(c == "conflict", F.lit(f"{n}_conflict")) for n, c in named]
    conflict = F.lit(False)
    for _, c in named:
        conflict = conflict | (c == "conflict")
    no_precise = precise.isin("missing_source", "not_available")
    gaps = [
        F.when(tle == "missing_source", "missing_tle").when(tle == "insufficient_coverage", "tle_insufficient_coverage"),
        F.when((pod == "missing_source") & no_precise, "missing_pod").when((pod == "insufficient_coverage") & no_precise, "pod_insufficient_coverage"),
    ]
    slr_gap = F.when(slr == "insufficient_coverage", "slr_insufficient_coverage")
    flags = F.array_compact(F.array(*conflicts, slr_gap, *[F.when(~conflict, g) for g in gaps]))
    responds = tle.isin("response_detected", "coverage_only") & ((pod == "response_detected") | (precise == "response_detected"))
    return {
        "event_label": F.when(conflict, "ignore").otherwise("event"),
        "response_tier": F.when(conflict, "audit_only").when(responds & (slr == "support_available"), "A").when(responds, "B").otherwise("C"),
        "source_conflict_status": F.when(conflict, "source_conflict").when(responds, "none").otherwise("coverage_insufficient"),
        "quality_flags": F.array_join(F.array_sort(flags), ","),
    }


def source_summary(evidence: DataFrame) -> DataFrame:
    """Per candidate and source: best supporting and opposing score, row count."""
    yes = F.col("supports_event")
    return evidence.groupBy("candidate_id", "source").agg(
        F.greatest(F.coalesce(F.max(F.when(yes, F.col("score"))), F.lit(0.0)), F.lit(0.0)).alias("positive_score"),
        F.greatest(F.coalesce(F.max(F.when(~yes, F.col("score"))), F.lit(0.0)), F.lit(0.0)).alias("negative_score"),
        F.count(F.lit(1)).alias("n"),
    )


def label_candidates(
    candidates: DataFrame, evidence: DataFrame, required: Sequence[str], support: Sequence[str], min_score: float, quality: DataFrame | None = None
) -> DataFrame:
    """Event / ignore decision per candidate, with reason, sources, gates and a bounded evidence list.

    Evidence needs ``seq`` (its order), ``source``, ``score``, ``supports_event``, ``details`` and
    ``maneuver_type``. Per-source facts are combinable aggregates; only the first 20 ids of a
    candidate are collected, selected by a group limit. ``quality`` has candidate_id, ok, reason.
    """
    per = source_summary(evidence)
    srcs = sorted({"pod", "tle", "slr", *required, *support})
    best = per.groupBy("candidate_id").agg(
        *[F.coalesce(F.max(F.when(F.col("source") == s, F.col("positive_score"))), F.lit(0.0)).alias(f"_s_{s}") for s in srcs],
        F.coalesce(F.sum(F.when(~F.col("source").isin(srcs), F.col("positive_score"))), F.lit(0.0)).alias("_s_more"),
        F.array_join(F.array_sort(F.collect_set(F.when(F.col("positive_score") > 0, F.col("source")))), ",").alias("evidence_sources"),
    )
    mapped = F.col("maneuver_type").isin(*FAMILIES)
    facts = evidence.groupBy("candidate_id").agg(
        F.max((F.col("source") == "tle") & ~F.col("supports_event")).alias("_tle_conflict"),
        F.max((F.col("source") == "slr") & ~F.col("supports_event")).alias("_slr_conflict"),
        F.max((F.col("source") == "slr") & (F.col("details") == "insufficient_slr_coverage")).alias("_slr_thin"),
        F.min_by(F.when(mapped, F.col("maneuver_type")), F.when(mapped, F.col("seq"))).alias("_type"),
        F.count(F.lit(1)).alias("_n"),
    )
    kept = top_k(evidence.select("candidate_id", "seq", "evidence_id"), ["candidate_id"], ["seq"], MAX_EVIDENCE_IDS)
    ids = kept.groupBy("candidate_id").agg(F.array_join(F.array_sort(F.collect_set("evidence_id")), ",").alias("evidence_ids"))
    c = candidates.join(best, "candidate_id", "left").join(facts, "candidate_id", "left").join(ids, "candidate_id", "left")
    scores = [f"_s_{s}" for s in srcs] + ["_s_more"]
    c = c.na.fill(0.0, scores).na.fill("", ["evidence_ids", "evidence_sources"]).na.fill(False, ["_tle_conflict", "_slr_conflict", "_slr_thin"]).na.fill(0, ["_n"])
    # a fixed order of addition, so that a sum on the threshold does not depend on row order
    combined = F.col(scores[0])
    for s in scores[1:]:
        combined = combined + F.col(s)
    c = c.withColumn("combined_score", combined)
    if quality is None:
        c = c.withColumns({"_ok": F.lit(True), "_why": F.lit("")})
    else:
        c = c.join(quality.select("candidate_id", F.col("ok").alias("_ok"), F.col("reason").alias("_why")), "candidate_id", "left").na.fill(True, ["_ok"]).na.fill("", ["_why"])
    has = {s: F.col(f"_s_{s}") > 0 for s in srcs}
    all_required, any_support = F.lit(True), F.lit(not support)
    for s in required:
        all_required = all_required & has[s]
    for s in support:
        any_support = any_support | has[s]
    first_missing = F.lit("")
    for s in reversed([*[x for x in ("pod", "tle", "slr") if x in required], *sorted(set(required) - {"pod", "tle", "slr"})]):
        first_missing = F.when(~has[s], f"missing_{s}").otherwise(first_missing)
    reason = (
        F.when(F.col("_tle_conflict"), "tle_conflict")
        .when(F.col("_slr_conflict") & F.col("_slr_thin"), "slr_insufficient_coverage")
        .when(F.col("_slr_conflict"), "slr_conflict")
        .when(~F.col("_ok"), F.col("_why"))
        .when(~all_required, first_missing)
        .when(~(any_support & (F.col("combined_score") >= min_score)), "combined_score_below_threshold")
        .otherwise("")
    )
    label = F.when(reason == "", "event").otherwise("ignore")
    gate = F.create_map(
        F.lit("pod"), F.when(has["pod"], "pass").otherwise("missing"),
        F.lit("slr"), F.when(~F.col("_tle_conflict") & F.col("_slr_conflict"), F.when(F.col("_slr_thin"), "insufficient").otherwise("conflict")).when(has["slr"], "pass").otherwise("missing"),
        F.lit("tle"), F.when(F.col("_tle_conflict"), "conflict").when(has["tle"], "pass").otherwise("missing"),
    )
    fam = F.create_map(*[x for k, (f, _) in FAMILIES.items() for x in (F.lit(k), F.lit(f))])
    eff = F.create_map(*[x for k, (_, e) in FAMILIES.items() for x in (F.lit(k), F.lit(e))])
    cut = F.greatest(F.col("_n") - MAX_EVIDENCE_IDS, F.lit(0))
    return c.select(
        *candidates.columns, label.alias("event_label"), reason.alias("ignore_reason"), "evidence_sources", "evidence_ids",
        F.when(label == "event", F.coalesce(fam[F.col("_type")], F.lit("unknown_maneuver"))).otherwise("none").alias("event_family"),
        F.when(label == "event", F.coalesce(eff[F.col("_type")], F.lit("multi_axis"))).otherwise("none").alias("orbital_effect"),
        F.to_json(gate).alias("gate_status_json"), F.when(label == "event", "needs_review").otherwise("excluded").alias("review_status"),
        F.concat(F.format_string("combined_score=%.3f", "combined_score"), F.when(cut > 0, F.concat(F.lit(";evidence_ids_truncated="), cut.cast("string"))).otherwise("")).alias("notes"),
        "combined_score",
    )


def event_rows(df: DataFrame, *, track: str, tracks: Sequence[str] = ("validated", "operational")) -> DataFrame:
    """Checked label rows with their hash id; an unsupported label stops the job at that row."""
    if track not in tracks:
        raise ValueError(f"unsupported track: {track}")
    ok = F.assert_true(F.col("event_label").isin(*EVENT_LABELS), F.concat(F.lit("unsupported event label: "), F.coalesce("event_label", F.lit("NULL"))))
    srcs = F.array_join(F.array_sort(F.array_distinct(F.split("evidence_sources", ","))), ",")
    checked = F.coalesce(ok.cast("string"), F.col("event_label"))
    return df.withColumns({"track": F.lit(track), "event_label": checked, "evidence_sources": srcs}).withColumn(
        "event_id", stable_id("evt", F.col("entity_id"), F.col("track"), F.col("event_label"), F.col("t_start"), F.col("t_end"), F.col("evidence_sources"))
    )


def gate_attrition(labels: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts of gate outcomes and labels per target."""
    gate = lambda s: F.get_json_object("gate_status_json", f"$.{s}")
    lab = F.col("event_label")
    return labels.groupBy(*by).agg(
        F.count(F.lit(1)).alias("pod_candidate_count"), F.count_if(gate("tle") == "pass").alias("tle_consistent_count"), F.count_if(gate("tle") == "conflict").alias("tle_conflict_count"),
        F.count_if(gate("slr") == "pass").alias("slr_supportive_count"), F.count_if(gate("slr") == "insufficient").alias("slr_insufficient_count"),
        F.count_if(lab.isin("event", "no_event")).alias("quality_pass_count"), *[F.count_if(lab == x).alias(f"{x}_count") for x in EVENT_LABELS],
    )


def flag_tail(windows: DataFrame, response: DataFrame, threshold_m: float = 20.0, flag: str = "suspect_unreported_maneuver") -> DataFrame:
    """No-event windows whose element shift exceeds the threshold get one flag; none is dropped."""
    hit = response.where(F.abs(F.col("delta_sma_km")) * 1000.0 > threshold_m).select("annotation_id").distinct().withColumn("_hit", F.lit(True))
    return windows.join(hit, "annotation_id", "left").withColumn("quality_flags", F.when(F.col("_hit"), add_flag(F.col("quality_flags"), flag)).otherwise(F.col("quality_flags"))).drop("_hit")


def operational_flags(alignment: DataFrame) -> DataFrame:
    """One to four flag rows per entity from its alignment booleans."""
    rows = F.array_compact(F.array(
        F.when(~F.col("has_full_window"), "ephemeris_window_incomplete"), F.when(~F.col("has_elements"), "missing_tle_in_window"),
        F.when(F.col("elements_ge5"), "tle_rows_ge5").otherwise("tle_rows_lt5"), F.when(F.col("eligible"), "eligible_operational_subset"),
    ))
    return alignment.select("entity_id", F.explode(rows).alias("quality_flag"))
