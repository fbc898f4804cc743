"""Summary tables: responses, distributions, agreement, coverage, figure-ready tables."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions import orbit
from orrery.functions.time import iso
from orrery.operators import joins, matching, names, qc, response, summaries
from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, slot
from orrery.plans.joins import BRACKET_CTE, GREEDY_CTE, NEAREST_CTE, PRESENCE_CTE, SMA_SQL, STATUS_CTE, covered_windows, match_lists
from orrery.plans.registry import query
from orrery.plans.scalars import SHELL_SQL, W
from orrery.plans.windows import LAB, labelled, quiet
from orrery.roles import iso_sql, oracle, rnd, rnd_span, rsql
from orrery.session import cut

ONE = "*"
B = 12 * HOUR_US
DSMA = f"(({SMA_SQL.format('an')})/1000.0 - ({SMA_SQL.format('bn')})/1000.0)"
INV = f"(2.0/sqrt(x*x+y*y+z*z) - (pow(vx-{W}*y,2)+pow(vy+{W}*x,2)+vz*vz)/3.986004418e14::DOUBLE)"
RESP_CTES = [BRACKET_CTE, f"""orb AS (SELECT annotation_id, count(*) FILTER (b) AS nb, count(*) FILTER (NOT b) AS na, median(r) FILTER (b) AS rb, median(r) FILTER (NOT b) AS ra, count(sma) FILTER (b) AS sb_n, count(sma) FILTER (NOT b) AS sa_n, median(sma) FILTER (b) AS sb, median(sma) FILTER (NOT b) AS sa
 FROM (SELECT a.annotation_id, s.t<a.ws AS b, sqrt(x*x+y*y+z*z) AS r, CASE WHEN {INV}>0 THEN 1.0/{INV} END AS sma FROM annotations a JOIN states s ON s.entity_id=a.entity_id AND ((s.t>=a.ws-{B} AND s.t<a.ws) OR (s.t>a.we AND s.t<=a.we+{B}))) GROUP BY 1)""",
    f"""rng AS (SELECT annotation_id, count(*) FILTER (s.t<a.ws) AS nb, count(*) FILTER (s.t>a.we) AS na, avg(sigma_m) FILTER (s.t<a.ws) AS mb, avg(sigma_m) FILTER (s.t>a.we) AS ma, sqrt(avg(sigma_m*sigma_m) FILTER (s.t<a.ws)) AS qb, sqrt(avg(sigma_m*sigma_m) FILTER (s.t>a.we)) AS qa
 FROM annotations a JOIN ranging s ON s.entity_id=a.entity_id AND s.t BETWEEN a.ws-{B} AND a.we+{B} GROUP BY 1)""",
    f"""resp AS (SELECT c.annotation_id, c.entity_id, c.coverage_tier, CASE WHEN bt IS NULL OR at_ IS NULL THEN 'insufficient_coverage' ELSE 'computed' END AS tle_response, CASE WHEN o.nb>=2 AND o.na>=2 THEN 'computed' ELSE 'insufficient_coverage' END AS orbit_response, CASE WHEN r.nb>=2 AND r.na>=2 THEN 'computed' ELSE 'insufficient_coverage' END AS slr_response,
 an-bn AS delta_mean_motion, {DSMA} AS delta_sma_km, ae-be AS delta_eccentricity, CASE WHEN o.nb>=2 AND o.na>=2 THEN ra-rb END AS orbit_radius_shift_m, CASE WHEN o.nb>=2 AND o.na>=2 AND sb_n>=2 AND sa_n>=2 THEN sa-sb END AS orbit_sma_shift_m,
 CASE WHEN r.nb>=2 AND r.na>=2 THEN abs(ma-mb) END AS slr_bias_shift_m, CASE WHEN r.nb>=2 AND r.na>=2 THEN qb END AS slr_rms_before_m, CASE WHEN r.nb>=2 AND r.na>=2 THEN qa END AS slr_rms_after_m
 FROM cov c JOIN br ON br.annotation_id=c.annotation_id LEFT JOIN orb o ON o.annotation_id=c.annotation_id LEFT JOIN rng r ON r.annotation_id=c.annotation_id)"""]
RESP = [PRESENCE_CTE, STATUS_CTE, *RESP_CTES]


def responses(spark, d):
    """Per-window response of the three sources with the coverage tier: one written row per window."""
    w = R.annotations(spark, d).select("annotation_id", "entity_id", "ws", "we")
    key = "annotation_id"
    el = response.element_response(w, R.elements(spark, d)).drop("entity_id", "ws", "we").withColumnRenamed("tle_status", "tle_response")
    ob = response.orbit_response(w, R.states(spark, d)).drop("entity_id", "ws", "we")
    sl = response.ranging_response(w, R.ranging(spark, d).withColumn("metric", F.col("sigma_m"))).drop("entity_id", "ws", "we")
    tiers = covered_windows(spark, d).select(key, "entity_id", "ws", "we", "coverage_tier")
    out = tiers.join(el, key).join(ob, key).join(sl, key)
    lack = lambda c, n: F.coalesce(F.col(c), F.lit("insufficient_coverage")).alias(n)
    return cut(out.select("*", lack("orbit_status_response", "orbit_response"), lack("slr_status_response", "slr_response")))


Q3 = lambda e, s: f"{rsql(f'quantile_cont(abs({e}),0.5)', s)}"


@query("a01_response_summary_rollups", oracle(f"""SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, coalesce(coverage_tier,'ALL') AS coverage_tier, count(*) AS window_count, count(*) FILTER (tle_response='computed') AS tle_computed_count, count(*) FILTER (orbit_response='computed') AS orbit_computed_count, count(*) FILTER (slr_response='computed') AS slr_computed_count,
 {rsql('quantile_cont(abs(delta_sma_km),0.25)')} AS p25_abs_delta_sma_km, {rsql('quantile_cont(abs(delta_sma_km),0.5)')} AS median_abs_delta_sma_km, {rsql('quantile_cont(abs(delta_sma_km),0.75)')} AS p75_abs_delta_sma_km, {rsql('quantile_cont(abs(orbit_radius_shift_m),0.5)', 3)} AS median_abs_orbit_radius_shift_m,
 {rsql('quantile_cont(abs(orbit_sma_shift_m),0.5)', 2)} AS median_abs_orbit_sma_shift_m, {rsql('quantile_cont(slr_bias_shift_m,0.5)')} AS median_slr_bias_shift_m, {rsql('quantile_cont(slr_rms_before_m,0.5)')} AS median_slr_rms_before_m FROM resp GROUP BY CUBE (entity_id, coverage_tier)""", *RESP))
def a01(spark, d):
    """Response counts and magnitudes per entity and tier with ALL roll-ups."""
    s = summaries.response_summary(responses(spark, d))
    return s.select("entity_id", "coverage_tier", "window_count", "tle_computed_count", "orbit_computed_count", "slr_computed_count", *[rnd(c, k).alias(c) for c, k in (
        ("p25_abs_delta_sma_km", 6), ("median_abs_delta_sma_km", 6), ("p75_abs_delta_sma_km", 6), ("median_abs_orbit_radius_shift_m", 3), ("median_abs_orbit_sma_shift_m", 2), ("median_slr_bias_shift_m", 6), ("median_slr_rms_before_m", 6))])


def annotated(spark, d):
    return covered_windows(spark, d).join(R.targets(spark, d).select("entity_id", "batch"), "entity_id", "left")


ANN_CTE = "ann AS (SELECT c.*, t.batch FROM cov c LEFT JOIN targets t ON t.entity_id=c.entity_id)"
SUMC = ", ".join(f"count(*) FILTER ({s}_status='covered') AS {s}_covered_count" for s in ("tle", "slr", "orbit")) + ", " + ", ".join(f"count(*) FILTER (coverage_tier='{t}') AS tier_{t.lower()}_count" for t in "ABC")


@query("a02_alignment_summary", oracle(f"SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, string_agg(DISTINCT batch, ',' ORDER BY batch) AS batch, count(DISTINCT entity_id) AS target_count, count(*) AS window_count, count(*) FILTER (aligned) AS aligned_count, {SUMC}, {iso_sql('min(ws)')} AS first_window_utc, {iso_sql('max(we)')} AS last_window_utc FROM ann GROUP BY ROLLUP(entity_id)", PRESENCE_CTE, STATUS_CTE, ANN_CTE))
def a02(spark, d):
    """Alignment counts per target plus ALL."""
    x = summaries.with_all(annotated(spark, d).withColumn("e", F.col("entity_id")), ["entity_id"])
    return x.groupBy("entity_id").agg(
        F.array_join(F.array_sort(F.collect_set("batch")), ",").alias("batch"), F.countDistinct("e").alias("target_count"), F.count(ONE).alias("window_count"), F.count_if("aligned").alias("aligned_count"),
        *[F.count_if(F.col(f"{s}_status") == "covered").alias(f"{s}_covered_count") for s in ("tle", "slr", "orbit")], *[F.count_if(F.col("coverage_tier") == t).alias(f"tier_{t.lower()}_count") for t in "ABC"],
        iso(F.min("ws")).alias("first_window_utc"), iso(F.max("we")).alias("last_window_utc"),
    )


@query("a03_tier_decision_table", oracle(f"""SELECT g.entity_id, x.tier AS coverage_tier, CAST(CASE x.tier WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c ELSE 0 END AS BIGINT) AS event_count, {rsql("CASE x.tier WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c ELSE 0 END/n::DOUBLE")} AS event_fraction, gap AS local_slr_gap_count FROM (
 SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, count(*) AS n, count(*) FILTER (coverage_tier='A') AS a, count(*) FILTER (coverage_tier='B') AS b, count(*) FILTER (coverage_tier='C') AS c, count(*) FILTER (tle_status='covered' AND orbit_status='covered' AND slr_status<>'covered') AS gap FROM cov GROUP BY ROLLUP(entity_id)) g, (VALUES ('A'),('B'),('C'),('audit_only')) x(tier)""", PRESENCE_CTE, STATUS_CTE))
def a03(spark, d):
    """All four tiers per target and ALL, also those without events."""
    x = summaries.with_all(covered_windows(spark, d), ["entity_id"])
    gap = (F.col("tle_status") == "covered") & (F.col("orbit_status") == "covered") & (F.col("slr_status") != "covered")
    n = x.groupBy("entity_id").agg(F.count(ONE).alias("n"), *[F.count_if(F.col("coverage_tier") == t).alias(t) for t in ("A", "B", "C", "audit_only")], F.count_if(gap).alias("local_slr_gap_count"))
    long = n.unpivot(["entity_id", "n", "local_slr_gap_count"], ["A", "B", "C", "audit_only"], "coverage_tier", "event_count")
    return long.select("entity_id", "coverage_tier", "event_count", rnd(F.col("event_count") / F.col("n")).alias("event_fraction"), "local_slr_gap_count")


AGREE = "count(*) FILTER (hp) AS pod_positive_count, count(*) FILTER (ht) AS tle_positive_count, count(*) FILTER (hs) AS slr_positive_count, count(*) FILTER (hp AND ht AND hs) AS all_agree_count, count(*) FILTER (tc) AS tle_conflict_count, count(*) FILTER (NOT hp) AS missing_pod_count, count(*) FILTER (event_label='event') AS event_count, count(*) FILTER (event_label='ignore') AS ignore_count"


@query("a04_label_and_agreement_summary", oracle(f"SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, {AGREE} FROM labx GROUP BY ROLLUP(entity_id)", *LAB))
def a04(spark, d):
    """Label counts and source agreement per target plus ALL."""
    x = summaries.with_all(labelled(spark, d), ["entity_id"])
    src = F.split("evidence_sources", ",")
    has = {s: F.array_contains(src, s) for s in ("pod", "tle", "slr")}
    gate = lambda s: F.get_json_object("gate_status_json", f"$.{s}")
    return x.groupBy("entity_id").agg(
        *[F.count_if(has[s]).alias(f"{s}_positive_count") for s in has], F.count_if(has["pod"] & has["tle"] & has["slr"]).alias("all_agree_count"), F.count_if(gate("tle") == "conflict").alias("tle_conflict_count"),
        F.count_if(gate("pod") == "missing").alias("missing_pod_count"), F.count_if(F.col("event_label") == "event").alias("event_count"), F.count_if(F.col("event_label") == "ignore").alias("ignore_count"),
    )


ALT = f"({SMA_SQL.format('mean_motion')}/1000.0-6371.0)"
GAPS = "(SELECT entity_id, median(g)*24.0 AS cad, max(g) AS mx FROM (SELECT entity_id, (t-lag(t) OVER (PARTITION BY entity_id ORDER BY t))/1e6/86400.0 AS g FROM {0}) GROUP BY 1)"


@query("a05_element_distribution", oracle(f"SELECT e.entity_id, count(*) AS epoch_count, {rsql('median(degrees(inclination))', 4)} AS inclination_median_deg, {rsql('quantile_cont(degrees(inclination),0.75)-quantile_cont(degrees(inclination),0.25)', 4)} AS inclination_iqr_deg, {rsql('median(eccentricity)')} AS eccentricity_median, {rsql(f'median({ALT})', 3)} AS altitude_median_km, {rsql(f'quantile_cont({ALT},0.75)-quantile_cont({ALT},0.25)', 3)} AS altitude_iqr_km, {rsql('any_value(cad)', 3)} AS cadence_median_hours, {rsql('any_value(mx)', 3)} AS max_gap_days FROM elements e JOIN {GAPS.format('elements')} g ON g.entity_id=e.entity_id GROUP BY 1"))
def a05(spark, d):
    """Element medians and spreads per target with coverage."""
    x = summaries.element_distribution(R.elements(spark, d))
    return x.select("entity_id", "epoch_count", rnd("inc_p50", 4).alias("inclination_median_deg"), rnd(F.col("inc_p75") - F.col("inc_p25"), 4).alias("inclination_iqr_deg"), rnd("ecc_p50").alias("eccentricity_median"), rnd("alt_p50", 3).alias("altitude_median_km"), rnd(F.col("alt_p75") - F.col("alt_p25"), 3).alias("altitude_iqr_km"), rnd("cadence_median_hours", 3).alias("cadence_median_hours"), rnd("max_gap_days", 3).alias("max_gap_days"))


@query("a06_state_distribution", oracle(f"SELECT s.entity_id, count(*) AS state_count, {rsql('median(sqrt(x*x+y*y+z*z)/1000.0)', 3)} AS radius_median_km, {rsql('min(sqrt(x*x+y*y+z*z)/1000.0)', 3)} AS radius_min_km, {rsql('max(sqrt(x*x+y*y+z*z)/1000.0)', 3)} AS radius_max_km, {rsql('any_value(cad)', 3)} AS cadence_median_hours FROM states s JOIN {GAPS.format('states')} g ON g.entity_id=s.entity_id GROUP BY 1"))
def a06(spark, d):
    """Radius distribution per target."""
    return summaries.state_distribution(R.states(spark, d)).select("entity_id", "state_count", *[rnd(c, 3).alias(c) for c in ("radius_median_km", "radius_min_km", "radius_max_km", "cadence_median_hours")])


QC_SQL = "CASE WHEN lower(trim(target_name))='compassi6b' THEN 'cross_target' WHEN range_m<5e5 OR range_m>6e6 THEN 'range_implausible' WHEN tof_s IS NULL OR abs(tof_s/2.0*299792458.0-range_m)>1.0 THEN 'qc_rejected' ELSE 'ok' END"


@query("a07_ranging_distribution", oracle(f"SELECT entity_id, count(*) FILTER (q='ok') AS normal_point_count, count(*) FILTER (q<>'ok') AS qc_flagged_rows, count(DISTINCT station_id) FILTER (q='ok') AS station_count, {rsql('median(sigma_m*1000.0) FILTER (q=$$ok$$)', 3)} AS sigma_median_mm, {rsql('quantile_cont(sigma_m*1000.0,0.75) FILTER (q=$$ok$$)-quantile_cont(sigma_m*1000.0,0.25) FILTER (q=$$ok$$)', 5)} AS sigma_iqr_mm, {rsql('median(num_returns) FILTER (q=$$ok$$)', 1)} AS num_returns_median FROM (SELECT *, {QC_SQL} AS q FROM ranging) GROUP BY 1"))
def a07(spark, d):
    """Ranging precision and returns per target over accepted rows."""
    x = summaries.ranging_distribution(qc.with_qc_status(R.ranging(spark, d)))
    return x.select("entity_id", "normal_point_count", "qc_flagged_rows", "station_count", rnd("sigma_median_mm", 3).alias("sigma_median_mm"), rnd("sigma_iqr_mm", 5).alias("sigma_iqr_mm"), rnd("num_returns_median", 1).alias("num_returns_median"))


@query("a08_epoch_coverage", oracle(f"SELECT s.entity_id, {iso_sql('min(t)')} AS first_epoch_utc, {iso_sql('max(t)')} AS last_epoch_utc, count(DISTINCT year(make_timestamp(t))) AS years_covered, {rsql('any_value(cad)', 3)} AS cadence_median_hours, {rsql('any_value(mx)', 2)} AS max_gap_days FROM series s JOIN {GAPS.format('series')} g ON g.entity_id=s.entity_id GROUP BY 1"))
def a08(spark, d):
    """Epoch coverage of the large series per entity."""
    c = summaries.coverage_fields(R.series(spark, d), ["entity_id"])
    return c.select("entity_id", iso("first_t").alias("first_epoch_utc"), iso("last_t").alias("last_epoch_utc"), "years_covered", rnd("cadence_median_hours", 3).alias("cadence_median_hours"), rnd("max_gap_days", 2).alias("max_gap_days"))


LATEST_CTE = f"""lat AS (SELECT *, {SHELL_SQL} AS shell FROM (SELECT *, 42.6+degrees(inclination)%11 AS i, raan - floor(raan/(2*pi()))*2*pi() AS ra FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY t DESC) AS rk, count(*) OVER (PARTITION BY entity_id) AS epochs FROM elements) WHERE rk=1))"""


def shells(spark, d):
    x = summaries.latest_elements(R.elements(spark, d), ["inclination", "mean_motion", "eccentricity", "raan"])
    return x.withColumns({"i": 42.6 + F.degrees("inclination") % 11, "alt": orbit.altitude_km(F.col("mean_motion")), "ra": F.pmod(F.col("raan"), F.lit(2 * math.pi))}).withColumn("shell", names.shell(F.col("i")))


@query("a09_shell_distribution", oracle(f"SELECT shell, count(*) AS satellite_count, CAST(sum(epochs) AS BIGINT) AS epoch_count, {rsql('median(i)', 4)} AS inclination_median_deg, {rsql(f'median({ALT})', 3)} AS altitude_median_km, {rsql('median(eccentricity)')} AS eccentricity_median FROM lat GROUP BY 1", LATEST_CTE))
def a09(spark, d):
    """Latest elements per satellite summarised per shell."""
    q = with_quantiles(shells(spark, d), ["shell"], [F.count(ONE).alias("satellite_count"), F.sum("epochs").alias("epoch_count")], {"i50": (F.col("i"), 0.5), "a50": (F.col("alt"), 0.5), "e50": (F.col("eccentricity"), 0.5)})
    return q.select("shell", "satellite_count", "epoch_count", rnd("i50", 4).alias("inclination_median_deg"), rnd("a50", 3).alias("altitude_median_km"), rnd("e50").alias("eccentricity_median"))


@query("a10_significant_bins", oracle("SELECT shell, count(*) FILTER (n>=greatest(1.0, 0.5*top)) AS significant_bins FROM (SELECT *, max(n) OVER (PARTITION BY shell) AS top FROM (SELECT shell, floor(ra/(pi()/36)) AS bin, count(*) AS n FROM lat GROUP BY 1,2)) GROUP BY 1", LATEST_CTE))
def a10(spark, d):
    """Five-degree node bins holding at least half of the shell's fullest bin."""
    return summaries.significant_bins(shells(spark, d), ["shell"], F.floor(F.col("ra") / F.lit(math.pi / 36)))


@query("a11_ephemeris_by_scope", oracle(f"""SELECT scope, count(DISTINCT entity_id) AS satellite_count, count(*) AS state_count, count(*) FILTER (bad) AS qc_flagged_rows, {rsql('median(r) FILTER (NOT bad)', 2)} AS radius_median_km, {rsql('median(sp) FILTER (NOT bad)', 4)} AS speed_median_kmps, {rsql('(count(*) FILTER (abs(g-86400000000)<43200000000))::DOUBLE/nullif(count(g),0)', 4)} AS cadence_fraction FROM (
 SELECT unnest(['ALL', CASE entity_id%3 WHEN 0 THEN '43.0' WHEN 1 THEN '53.0' ELSE 'other' END]) AS scope, * FROM (SELECT *, sqrt(x*x+y*y+z*z)/1000.0 AS r, sqrt(vx*vx+vy*vy+vz*vz)/1000.0 AS sp, sqrt(x*x+y*y+z*z)<6600000.0 AS bad, t-lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS g FROM states)) GROUP BY 1"""))
def a11(spark, d):
    """Radius, speed and cadence per scope; flagged states count only in the row and cadence totals."""
    s = neighbour(R.states(spark, d), ["entity_id"], ["t"], slot("t", DAY_US), ["t"])
    xyz, vxyz = tuple(map(F.col, ("x", "y", "z"))), tuple(map(F.col, ("vx", "vy", "vz")))
    r = orbit.norm3(*xyz)
    shell = F.when(F.col("entity_id") % 3 == 0, "43.0").when(F.col("entity_id") % 3 == 1, "53.0").otherwise("other")
    s = s.select("entity_id", F.explode(F.array(F.lit("ALL"), shell)).alias("scope"), (r / 1000.0).alias("r"), (orbit.norm3(*vxyz) / 1000.0).alias("sp"), (r < 6_600_000.0).alias("bad"), (F.col("t") - F.col("prev.t")).alias("g"))
    aggs = [F.countDistinct("entity_id").alias("satellite_count"), F.count(ONE).alias("state_count"), F.count_if("bad").alias("qc_flagged_rows"), (F.count_if(F.abs(F.col("g") - DAY_US) < DAY_US // 2) / F.nullif(F.count("g"), F.lit(0))).alias("cf")]
    q = with_quantiles(s, ["scope"], aggs, {"r50": (F.when(~F.col("bad"), F.col("r")), 0.5), "s50": (F.when(~F.col("bad"), F.col("sp")), 0.5)})
    return q.select("scope", "satellite_count", "state_count", "qc_flagged_rows", rnd("r50", 2).alias("radius_median_km"), rnd("s50", 4).alias("speed_median_kmps"), rnd("cf", 4).alias("cadence_fraction"))


RESID = "sqrt((ix-ox)*(ix-ox)+(iy-oy)*(iy-oy)+(iz-oz)*(iz-oz))/1000.0"
EDGES = [0.0, 6.0, 12.0, 24.0, 48.0, 96.0, math.inf]
EST_CTE = f"est AS (SELECT *, {RESID} AS res FROM estimates WHERE tle_status='computed' AND orbit_status='computed')"


def usable(spark, d):
    e = R.estimates(spark, d)
    dx, dy, dz = (F.col(f"i{a}") - F.col(f"o{a}") for a in "xyz")
    return e.where("tle_status = 'computed' AND orbit_status = 'computed'").withColumn("res", F.sqrt(dx * dx + dy * dy + dz * dz) / 1000.0)


BIN_SQL = "CASE WHEN h<=0 THEN NULL WHEN h<=6 THEN 0 WHEN h<=12 THEN 1 WHEN h<=24 THEN 2 WHEN h<=48 THEN 3 WHEN h<=96 THEN 4 ELSE 5 END"


@query("a12_residual_by_propagation_bin", oracle(f"SELECT scope, CAST(bin AS BIGINT) AS bin, count(*) AS n, {rsql('median(res)')} AS median_km, {rsql('quantile_cont(res,0.75)')} AS p75_km FROM (SELECT unnest(CASE WHEN extrap_s>0 THEN ['all'] ELSE ['all','no_extrapolation'] END) AS scope, {BIN_SQL} AS bin, res FROM (SELECT *, prop_s/3600.0 AS h FROM est)) WHERE bin IS NOT NULL GROUP BY 1,2", EST_CTE))
def a12(spark, d):
    """Residual per right-closed propagation bin, over all and over non-extrapolated states."""
    scope = F.explode(F.when(F.col("extrap_s") > 0, F.array(F.lit("all"))).otherwise(F.array(F.lit("all"), F.lit("no_extrapolation"))))
    u = usable(spark, d).withColumn("bin", summaries.right_closed_bin(F.col("prop_s") / 3600.0, EDGES).cast("bigint")).where("bin IS NOT NULL").select(scope.alias("scope"), "bin", "res")
    q = with_quantiles(u, ["scope", "bin"], [F.count(ONE).alias("n")], {"m": (F.col("res"), 0.5), "p": (F.col("res"), 0.75)})
    return q.select("scope", "bin", "n", rnd("m").alias("median_km"), rnd("p").alias("p75_km"))


@query("a13_sign_agreement_by_magnitude", oracle(f"SELECT band, count(*) AS n, {rsql('avg(CASE WHEN sign(delta_sma_km)=sign(orbit_shift_m) THEN 1.0 ELSE 0.0 END)', 4)} AS sign_agreement FROM (SELECT *, CASE WHEN m<=0 THEN NULL WHEN m<=5 THEN '0-5' WHEN m<=20 THEN '5-20' WHEN m<=100 THEN '20-100' ELSE '100+' END AS band FROM (SELECT *, abs(delta_sma_km)*1000.0 AS m FROM effects WHERE delta_sma_km IS NOT NULL AND orbit_shift_m IS NOT NULL)) WHERE band IS NOT NULL GROUP BY 1"))
def a13(spark, d):
    """Share of equal signs by response magnitude."""
    e = R.effects(spark, d).dropna(subset=["delta_sma_km", "orbit_shift_m"])
    b = summaries.right_closed_bin(F.abs("delta_sma_km") * 1000.0, [0.0, 5.0, 20.0, 100.0, math.inf])
    lab = F.get(F.array(*[F.lit(x) for x in ("0-5", "5-20", "20-100", "100+")]), b)
    agree = F.signum("delta_sma_km") == F.signum("orbit_shift_m")
    return e.withColumn("band", lab).where("band IS NOT NULL").groupBy("band").agg(F.count(ONE).alias("n"), rnd(F.avg(agree.cast("double")), 4).alias("sign_agreement"))


@query("a14_estimate_coverage", oracle("SELECT entity_id, count(*) AS window_count, count(*) FILTER (tle_status='computed') AS tle_computed_count, count(*) FILTER (orbit_status='computed') AS orbit_computed_count, count(*) FILTER (slr_status='computed') AS slr_computed_count FROM estimates GROUP BY 1"))
def a14(spark, d):
    """State estimates available per source."""
    return R.estimates(spark, d).groupBy("entity_id").agg(F.count(ONE).alias("window_count"), *[F.count_if(F.col(f"{s}_status") == "computed").alias(f"{s}_computed_count") for s in ("tle", "orbit", "slr")])


RAC_CTE = f"""rac AS (SELECT *, (dx*ox+dy*oy+dz*oz)/r AS rad, dx*ax+dy*ay+dz*az AS alo, (dx*hx+dy*hy+dz*hz)/h AS cro FROM (SELECT *, (hy*oz-hz*oy)/(h*r) AS ax, (hz*ox-hx*oz)/(h*r) AS ay, (hx*oy-hy*ox)/(h*r) AS az FROM (SELECT *, sqrt(hx*hx+hy*hy+hz*hz) AS h FROM (
 SELECT *, sqrt(ox*ox+oy*oy+oz*oz) AS r, oy*ovz-oz*vyi AS hx, oz*vxi-ox*ovz AS hy, ox*vyi-oy*vxi AS hz, ix-ox AS dx, iy-oy AS dy, iz-oz AS dz FROM (SELECT *, ovx-{W}*oy AS vxi, ovy+{W}*ox AS vyi FROM est)))))"""


@query("a15_bias_calibration", oracle(f"SELECT entity_id, year(make_timestamp(t)) AS year, count(*) AS sample_count, {rsql('median(rad)', 2)} AS radial_bias_m, {rsql('median(alo)', 2)} AS along_bias_m, {rsql('median(cro)', 2)} AS cross_bias_m, {rsql('median(res)')} AS norm_median_km, {rsql('quantile_cont(res,0.75)')} AS norm_p75_km FROM rac GROUP BY 1,2", EST_CTE, RAC_CTE))
def a15(spark, d):
    """Systematic difference in radial, along and cross direction per entity and year."""
    p, v = tuple(map(F.col, ("ox", "oy", "oz"))), tuple(map(F.col, ("ovx", "ovy", "ovz")))
    parts = orbit.rac_projection(p, v, tuple(F.col(f"i{a}") - F.col(f"o{a}") for a in "xyz"))
    u = usable(spark, d).select("entity_id", F.year(F.timestamp_micros("t")).cast("bigint").alias("year"), "res", *[c.alias(n) for c, n in zip(parts, ("rad", "alo", "cro"))])
    q = with_quantiles(u, ["entity_id", "year"], [F.count(ONE).alias("sample_count")], {"r": (F.col("rad"), 0.5), "a": (F.col("alo"), 0.5), "c": (F.col("cro"), 0.5), "m": (F.col("res"), 0.5), "p": (F.col("res"), 0.75)})
    return q.select("entity_id", "year", "sample_count", rnd("r", 2).alias("radial_bias_m"), rnd("a", 2).alias("along_bias_m"), rnd("c", 2).alias("cross_bias_m"), rnd("m").alias("norm_median_km"), rnd("p").alias("norm_p75_km"))


BOUND = "(0.376+0.302*abs(prop_s)/86400.0)"


def bound():
    return orbit.sigma_bound_km(F.lit(0.376), F.lit(0.302), F.col("prop_s"))


@query("a16_leave_one_out", oracle(f"SELECT entity_id, count(*) AS sample_count, {rsql('median(res)')} AS residual_median_km, {rsql('quantile_cont(res,0.75)')} AS residual_p75_km, {rsql(f'avg(CASE WHEN res<=3*{BOUND} THEN 1.0 ELSE 0.0 END)')} AS within_3sigma, count(*) FILTER (extrap_s>0) AS extrapolated_count, {rsql(f'avg(CASE WHEN res<=3*{BOUND} THEN 1.0 ELSE 0.0 END) FILTER (extrap_s=0)')} AS within_3sigma_clean FROM est GROUP BY 1", EST_CTE))
def a16(spark, d):
    """Prediction residuals against the held-out precise state per target."""
    inside = (F.col("res") <= 3 * bound()).cast("double")
    q = with_quantiles(usable(spark, d), ["entity_id"], [F.count(ONE).alias("sample_count"), F.avg(inside).alias("w"), F.count_if(F.col("extrap_s") > 0).alias("extrapolated_count"), F.avg(F.when(F.col("extrap_s") == 0, inside)).alias("wc")], {"m": (F.col("res"), 0.5), "p": (F.col("res"), 0.75)})
    return q.select("entity_id", "sample_count", rnd("m").alias("residual_median_km"), rnd("p").alias("residual_p75_km"), rnd("w").alias("within_3sigma"), "extrapolated_count", rnd("wc").alias("within_3sigma_clean"))


@query("a17_tier_discrimination", oracle(f"SELECT tier, count(*) AS sample_count, {rsql('median(abs(delta_sma_km))', 9)} AS median_abs_delta_sma_km FROM effects GROUP BY 1"))
def a17(spark, d):
    """Median response per tier."""
    q = with_quantiles(R.effects(spark, d), ["tier"], [F.count(ONE).alias("sample_count")], {"m": (F.abs("delta_sma_km"), 0.5)})
    return q.select("tier", "sample_count", rnd("m", 9).alias("median_abs_delta_sma_km"))


@query("a18_response_floor", oracle(f"SELECT entity_id, count(*) AS event_count, count(*) FILTER (abs(delta_sma_km)*1000.0<1) AS near_zero_count, {rsql('avg(CASE WHEN abs(delta_sma_km)*1000.0<1 THEN 1.0 ELSE 0.0 END)')} AS near_zero_fraction, {rsql('median(abs(delta_sma_km)*1000.0)')} AS median_resp_m, {rsql('median(gap_h)', 3)} AS median_gap_h FROM effects WHERE delta_sma_km IS NOT NULL GROUP BY 1"))
def a18(spark, d):
    """Near-zero responses per target with the bracket gap."""
    e = R.effects(spark, d).where("delta_sma_km IS NOT NULL").withColumn("m", F.abs("delta_sma_km") * 1000.0)
    q = with_quantiles(e, ["entity_id"], [F.count(ONE).alias("event_count"), F.count_if(F.col("m") < 1).alias("near_zero_count"), F.avg((F.col("m") < 1).cast("double")).alias("f")], {"r": (F.col("m"), 0.5), "g": (F.col("gap_h"), 0.5)})
    return q.select("entity_id", "event_count", "near_zero_count", rnd("f").alias("near_zero_fraction"), rnd("r").alias("median_resp_m"), rnd("g", 3).alias("median_gap_h"))


@query("a19_uncertainty_strata", oracle(f"SELECT entity_id, count(*) AS event_count, count(*) FILTER (h<1) AS sub_hour, count(*) FILTER (h>=1 AND h<24) AS hours, count(*) FILTER (h>=24) AS days, {rsql('median(h)')} AS median_uncertainty_h FROM (SELECT *, uncertainty_s/3600.0 AS h FROM annotations) GROUP BY 1"))
def a19(spark, d):
    """Annotation time uncertainty classes."""
    h = F.col("uncertainty_s") / 3600.0
    q = with_quantiles(R.annotations(spark, d), ["entity_id"], [F.count(ONE).alias("event_count"), F.count_if(h < 1).alias("sub_hour"), F.count_if((h >= 1) & (h < 24)).alias("hours"), F.count_if(h >= 24).alias("days")], {"m": (h, 0.5)})
    return q.select("entity_id", "event_count", "sub_hour", "hours", "days", rnd("m").alias("median_uncertainty_h"))


GROUP_SQL = "CASE entity_id%3 WHEN 0 THEN 'fit' WHEN 1 THEN 'eval_contemporary' ELSE 'eval_historical' END"


def eval_group():
    return F.when(F.col("entity_id") % 3 == 0, "fit").when(F.col("entity_id") % 3 == 1, "eval_contemporary").otherwise("eval_historical")


@query("a20_sigma_coverage", oracle(f"SELECT kind, grp, count(*) AS sample_count, {rsql('median(res)')} AS median_residual_km, {rsql(f'avg(CASE WHEN res<=3*{BOUND} THEN 1.0 ELSE 0.0 END)')} AS within_3sigma FROM (SELECT unnest(['group','tier']) AS kind, unnest([{GROUP_SQL}, tier]) AS grp, res, prop_s FROM est) GROUP BY 1,2", EST_CTE))
def a20(spark, d):
    """Coverage of the uncertainty bound per evaluation group and per tier."""
    kinds = F.array(F.struct(F.lit("group").alias("kind"), eval_group().alias("grp")), F.struct(F.lit("tier").alias("kind"), F.col("tier").alias("grp")))
    u = usable(spark, d).withColumn("inside", (F.col("res") <= 3 * bound()).cast("double")).select(F.explode(kinds).alias("k"), "res", "inside").select("k.*", "res", "inside")
    q = with_quantiles(u, ["kind", "grp"], [F.count(ONE).alias("sample_count"), F.avg("inside").alias("w")], {"m": (F.col("res"), 0.5)})
    return q.select("kind", "grp", "sample_count", rnd("m").alias("median_residual_km"), rnd("w").alias("within_3sigma"))


@query("a21_tier_response_and_sign", oracle(f"SELECT tier, count(*) AS sample_count, {rsql('median(m)')} AS median_m, {rsql('quantile_cont(m,0.25)')} AS p25_m, {rsql('quantile_cont(m,0.75)')} AS p75_m, count(orbit_shift_m) AS orbit_n, {rsql('median(abs(orbit_shift_m))')} AS orbit_median_m, {rsql('avg(CASE WHEN orbit_shift_m IS NULL THEN NULL WHEN sign(delta_sma_km)=sign(orbit_shift_m) THEN 1.0 ELSE 0.0 END)', 4)} AS sign_agreement FROM (SELECT *, abs(delta_sma_km)*1000.0 AS m FROM effects WHERE delta_sma_km IS NOT NULL) GROUP BY 1"))
def a21(spark, d):
    """Response quantiles and sign agreement per tier for both sources."""
    e = R.effects(spark, d).where("delta_sma_km IS NOT NULL").withColumn("m", F.abs("delta_sma_km") * 1000.0)
    agree = F.when(F.col("orbit_shift_m").isNotNull(), (F.signum("delta_sma_km") == F.signum("orbit_shift_m")).cast("double"))
    q = with_quantiles(e, ["tier"], [F.count(ONE).alias("sample_count"), F.count("orbit_shift_m").alias("orbit_n"), F.avg(agree).alias("sa")], {"m50": (F.col("m"), 0.5), "m25": (F.col("m"), 0.25), "m75": (F.col("m"), 0.75), "o50": (F.abs("orbit_shift_m"), 0.5)})
    return q.select("tier", "sample_count", rnd("m50").alias("median_m"), rnd("m25").alias("p25_m"), rnd("m75").alias("p75_m"), "orbit_n", rnd("o50").alias("orbit_median_m"), rnd("sa", 4).alias("sign_agreement"))


@query("a22_matched_specificity", oracle(f"SELECT grp, count(m) AS n, {rsql('median(m)')} AS median_m, {rsql('avg(CASE WHEN m<5 THEN 1.0 ELSE 0.0 END)')} AS frac_lt_5m FROM (SELECT 'events' AS grp, abs(delta_sma_km)*1000.0 AS m FROM effects WHERE ls='F' UNION ALL SELECT 'stable_matched', abs(delta_sma_km)*1000.0 FROM effects WHERE ls='O' AND l_orderkey IN (SELECT o_orderkey FROM spans WHERE status='O')) WHERE m IS NOT NULL GROUP BY 1"))
def a22(spark, d):
    """Events against the matched controls (semi-join on the matched ids)."""
    e = R.effects(spark, d).where("delta_sma_km IS NOT NULL").withColumn("m", F.abs("delta_sma_km") * 1000.0)
    ids = R.spans(spark, d).where("status = 'O'").select(F.col("o_orderkey").alias("l_orderkey"))
    x = e.where("ls = 'F'").select(F.lit("events").alias("grp"), "m").unionByName(e.where("ls = 'O'").join(ids, "l_orderkey", "left_semi").select(F.lit("stable_matched").alias("grp"), "m"))
    q = with_quantiles(x, ["grp"], [F.count("m").alias("n"), F.avg((F.col("m") < 5).cast("double")).alias("f")], {"m50": (F.col("m"), 0.5)})
    return q.select("grp", "n", rnd("m50").alias("median_m"), rnd("f").alias("frac_lt_5m"))


@query("a23_gap_taxonomy", oracle("SELECT count(*) AS not_aligned_count, count(*) FILTER (missing_sources<>'') AS with_reason_count, CASE WHEN count(*)=0 THEN 1.0::DOUBLE ELSE (count(*) FILTER (missing_sources<>''))::DOUBLE/count(*) END AS completeness FROM cov WHERE NOT aligned", PRESENCE_CTE, STATUS_CTE))
def a23(spark, d):
    """Every non-aligned window must name what is missing."""
    n, k = F.count(ONE), F.count_if(F.col("missing_sources") != "")
    return covered_windows(spark, d).where("NOT aligned").agg(n.alias("not_aligned_count"), k.alias("with_reason_count"), F.when(n == 0, 1.0).otherwise(k / n).alias("completeness"))


FUSE_CTE = f"""fus AS (SELECT *, sqrt(pow(fx-tx,2)+pow(fy-ty,2)+pow(fz-tz,2))/1000.0 AS fe FROM (SELECT *, (wt*ix+wd*dx)/(wt+wd) AS fx, (wt*iy+wd*dy)/(wt+wd) AS fy, (wt*iz+wd*dz)/(wt+wd) AS fz, res AS te, sqrt(pow(dx-tx,2)+pow(dy-ty,2)+pow(dz-tz,2))/1000.0 AS de FROM (
 SELECT *, ox AS tx, oy AS ty, oz AS tz, ox+(l_linenumber-4)*300.0 AS dx, oy-l_linenumber*100.0 AS dy, oz+50.0 AS dz, 1.0/pow({BOUND}*1000.0,2) AS wt, 1.0/pow(1205.0::DOUBLE,2) AS wd FROM est)))"""


def fused_errors(spark, d):
    from orrery.operators import state

    u = usable(spark, d)
    second = {"x": F.col("ox") + (F.col("l_linenumber") - 4) * 300.0, "y": F.col("oy") - F.col("l_linenumber") * 100.0, "z": F.col("oz") + 50.0}
    u = u.withColumns({f"d{a}": c for a, c in second.items()}).withColumns({"st": bound() * 1000.0, "sd": F.lit(1205.0)})
    return state.fusion_errors(u, predicted=("ix", "iy", "iz"), second=("dx", "dy", "dz"), truth=("ox", "oy", "oz"), sigma_predicted="st", sigma_second="sd")


@query("a24_fusion_value", oracle(f"SELECT entity_id, count(*) AS sample_count, count(*)<10 AS below_min_sample, {rsql('median(te)')} AS tle_only_median_km, {rsql('median(de)')} AS second_only_median_km, {rsql('median(fe)')} AS fused_median_km, {rsql('median(te)/greatest(median(fe),1e-9)', 5)} AS ratio FROM fus GROUP BY 1", EST_CTE, FUSE_CTE))
def a24(spark, d):
    """Median error of each estimator and of their fusion."""
    q = with_quantiles(fused_errors(spark, d), ["entity_id"], [F.count(ONE).alias("sample_count")], {"t": (F.col("predicted_km"), 0.5), "s": (F.col("second_km"), 0.5), "f": (F.col("fused_km"), 0.5)})
    return q.select("entity_id", "sample_count", (F.col("sample_count") < 10).alias("below_min_sample"), rnd("t").alias("tle_only_median_km"), rnd("s").alias("second_only_median_km"), rnd("f").alias("fused_median_km"), rnd(F.col("t") / F.greatest(F.col("f"), F.lit(1e-9)), 5).alias("ratio"))


@query("a25_range_residual_sides", oracle(f"""SELECT annotation_id, count(*) FILTER (b) AS n_before, count(*) FILTER (NOT b) AS n_after, {rsql('median(oc) FILTER (b)', 3)} AS median_before, {rsql('sqrt(avg(oc*oc) FILTER (b))', 3)} AS rms_before, {rsql('CASE WHEN count(*) FILTER (b)>=3 AND count(*) FILTER (NOT b)>=3 THEN median(oc) FILTER (NOT b)-median(oc) FILTER (b) END', 3)} AS shift, any_value(st) AS stations_used FROM (
 SELECT *, string_agg(DISTINCT sid, ';' ORDER BY sid) OVER (PARTITION BY annotation_id) AS st FROM (SELECT *, median(oc) OVER (PARTITION BY annotation_id, b) AS ctr FROM oc)) WHERE abs(oc-ctr)<=1000 GROUP BY 1""".replace("string_agg(DISTINCT sid, ';' ORDER BY sid) OVER (PARTITION BY annotation_id)", "(SELECT string_agg(DISTINCT sid, ';' ORDER BY sid) FROM oc o2 WHERE o2.annotation_id=q.annotation_id)").replace("FROM oc))", "FROM oc) q)"),
    f"oc AS (SELECT a.annotation_id, CAST(station_id AS VARCHAR) AS sid, r.t<a.ws AS b, CASE WHEN num_returns=5 THEN 1e6::DOUBLE ELSE range_m/1000.0-k2 END AS oc FROM annotations a JOIN (SELECT *, num_returns*10.0 AS k2 FROM ranging) r ON r.entity_id=a.entity_id AND ((r.t>=a.ws-48*{HOUR_US} AND r.t<a.ws) OR (r.t>a.we AND r.t<=a.we+48*{HOUR_US})))"))
def a25(spark, d):
    """Residuals before and after each window with blunder clipping, and the stations involved."""
    r = R.ranging(spark, d).select("entity_id", "t", F.col("station_id").cast("string").alias("sid"), F.when(F.col("num_returns") == 5, 1e6).otherwise(F.col("range_m") / 1000.0 - F.col("num_returns") * 10.0).alias("oc"))
    s = response.band_samples(r, R.annotations(spark, d), 48 * HOUR_US).where("band <> 'during'")
    st = s.groupBy("annotation_id").agg(F.array_join(F.array_sort(F.collect_set("sid")), ";").alias("stations_used"))
    x = summaries.side_statistics(s, ["annotation_id"], "band", "oc", 1000.0, 3).join(st, "annotation_id")
    return x.select("annotation_id", "n_before", "n_after", rnd("median_before", 3).alias("median_before"), rnd("rms_before", 3).alias("rms_before"), rnd("shift", 3).alias("shift"), "stations_used")


def match_report(spark, d, tolerance_us):
    q, x = match_lists(spark, d)
    return q, x, matching.greedy_match(q, x, "event_t", "xt", tolerance_us)


ONE_DAY = GREEDY_CTE.format(days="(1.0)")
MATCHED_CTE = """sp AS (SELECT entity_id, min(xt) AS x0, max(xt) AS x1 FROM external_times GROUP BY 1),
me AS (SELECT q.entity_id, q.value, q.annotation_id, q.event_t, (g.off IS NOT NULL)::INT AS hit, g.off, x0 IS NOT NULL AS covered, coalesce(q.event_t BETWEEN x0 AND x1, false) AS inside
  FROM qn q LEFT JOIN gx g ON g.entity_id = q.entity_id AND g.seq = q.seq LEFT JOIN sp ON sp.entity_id = q.entity_id)"""


@query("a26_cross_match_summary", oracle(f"""SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, count(*) AS events, count(*) FILTER (hit=1) AS matched, {rsql('avg(hit)', 4)} AS rate_all, {rsql('avg(hit) FILTER (covered)', 4)} AS rate_covered, {rsql('avg(hit) FILTER (inside)', 4)} AS rate_in_span,
 {rsql('quantile_cont(abs(off), 0.5)/60e6', 1)} AS median_abs_offset_min, {rsql('quantile_cont(value, 0.5) FILTER (hit=1)', 3)} AS median_value_matched, {rsql('quantile_cont(value, 0.5) FILTER (hit=0)', 3)} AS median_value_unmatched FROM me GROUP BY ROLLUP(entity_id)""", ONE_DAY, MATCHED_CTE, recursive=True))
def a26(spark, d):
    """Forward, reverse and in-span match rates per entity and overall."""
    q, x, m = match_report(spark, d, DAY_US)
    m = cut(m)
    span = x.groupBy("entity_id").agg(F.min("xt").alias("x0"), F.max("xt").alias("x1"), F.count(ONE).alias("external"))
    e = q.join(m.select("entity_id", F.col("query_seq").alias("seq"), "offset_us"), ["entity_id", "seq"], "left").join(span, "entity_id", "left")
    hit, inside = F.col("offset_us").isNotNull(), F.coalesce((F.col("event_t") >= F.col("x0")) & (F.col("event_t") <= F.col("x1")), F.lit(False))
    e = summaries.with_all(e.select("entity_id", hit.alias("hit"), inside.alias("inside"), F.col("external").isNotNull().alias("covered"), F.abs("offset_us").alias("off"), F.col("value")), ["entity_id"])
    rate = lambda cond: F.avg(F.when(cond, F.col("hit").cast("double")))
    qq = with_quantiles(e, ["entity_id"], [F.count(ONE).alias("events"), F.count_if("hit").alias("matched"), rate(F.lit(True)).alias("rate_all"), rate(F.col("covered")).alias("rate_covered"), rate(F.col("inside")).alias("rate_in_span")],
                        {"off50": (F.col("off"), 0.5), "value_matched": (F.when(F.col("hit"), F.col("value")), 0.5), "value_unmatched": (F.when(~F.col("hit"), F.col("value")), 0.5)})
    return qq.select("entity_id", "events", "matched", rnd("rate_all", 4).alias("rate_all"), rnd("rate_covered", 4).alias("rate_covered"), rnd("rate_in_span", 4).alias("rate_in_span"), rnd(F.col("off50") / 60e6, 1).alias("median_abs_offset_min"), rnd("value_matched", 3).alias("median_value_matched"), rnd("value_unmatched", 3).alias("median_value_unmatched"))


@query("a26_event_match_table", oracle(f"""SELECT annotation_id, entity_id, CASE WHEN hit=1 THEN 'matched' WHEN near IS NULL THEN 'no_external' WHEN near <= {DAY_US} THEN 'taken' ELSE 'out_of_tolerance' END AS status,
 {rsql('off/60e6', 3)} AS offset_min, {rsql('near/60e6', 3)} AS nearest_min, value AS magnitude FROM (SELECT me.*, (SELECT min(abs(xt-event_t)) FROM external_times x WHERE x.entity_id=me.entity_id) AS near FROM me)""", ONE_DAY, MATCHED_CTE, recursive=True))
def a26_events(spark, d):
    """Per reported event: matched, taken by another event, out of tolerance or without external times; offsets."""
    q, x, m = match_report(spark, d, DAY_US)
    near = joins.nearest_join(q, x, ["annotation_id"], ["entity_id"], "event_t", "xt", ["event_id"])
    near = near.select("annotation_id", "entity_id", "seq", "value", F.abs(F.col("nearest.xt") - F.col("event_t")).alias("near"))
    e = near.join(m.select("entity_id", F.col("query_seq").alias("seq"), "offset_us"), ["entity_id", "seq"], "left")
    status = F.when(F.col("offset_us").isNotNull(), "matched").when(F.col("near").isNull(), "no_external").when(F.col("near") <= DAY_US, "taken").otherwise("out_of_tolerance")
    return e.select("annotation_id", "entity_id", status.alias("status"), rnd_span(F.col("offset_us") / 60e6).alias("offset_min"), rnd_span(F.col("near") / 60e6).alias("nearest_min"), F.col("value").alias("magnitude"))


@query("a27_tolerance_sweep", oracle(f"""SELECT n.entity_id, days::DOUBLE AS tolerance_days, matched, {rsql('matched/external', 4)} AS rate FROM (SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, days, count(*) AS matched FROM gx GROUP BY GROUPING SETS ((entity_id, days), (days))) n
 LEFT JOIN (SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, count(*) AS external FROM external_times GROUP BY ROLLUP(entity_id)) t ON t.entity_id=n.entity_id""", GREEDY_CTE.format(days="(0.5),(1.0),(2.0)"), recursive=True))
def a27(spark, d):
    """Match counts and rates at three tolerances, per entity and overall."""
    q, x = match_lists(spark, d)
    # pairs are taken by distance, so the matches at a tolerance are those at the widest one up to that distance
    widest = cut(matching.greedy_match(q, x, "event_t", "xt", 2 * DAY_US))
    days = F.explode(F.array(*[F.lit(t) for t in (0.5, 1.0, 2.0)]))
    pairs = widest.select("entity_id", "offset_us", days.alias("tolerance_days")).where(F.abs("offset_us") <= F.col("tolerance_days") * DAY_US)
    n = summaries.with_all(pairs, ["entity_id"]).groupBy("entity_id", "tolerance_days").agg(F.count(ONE).alias("matched"))
    total = summaries.with_all(x, ["entity_id"]).groupBy("entity_id").agg(F.count(ONE).alias("external"))
    return n.join(total, "entity_id", "left").select("entity_id", "tolerance_days", "matched", rnd(F.col("matched") / F.col("external"), 4).alias("rate"))


@query("a28_offset_histogram", oracle("SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, bin_start_min, bin_start_min+60.0 AS bin_end_min, count(*) AS n FROM (SELECT entity_id, floor(off/60e6/60.0)*60.0 AS bin_start_min FROM gx) GROUP BY GROUPING SETS ((entity_id, bin_start_min),(bin_start_min))", ONE_DAY, recursive=True))
def a28(spark, d):
    """Signed offsets of the one-to-one matches in hourly bins per entity and overall."""
    _, _, m = match_report(spark, d, DAY_US)
    b = F.floor(F.col("offset_us") / 60e6 / 60.0) * 60.0
    x = summaries.with_all(m.select("entity_id", b.alias("bin_start_min")), ["entity_id"])
    return x.groupBy("entity_id", "bin_start_min").agg(F.count(ONE).alias("n")).select("entity_id", "bin_start_min", (F.col("bin_start_min") + 60.0).alias("bin_end_min"), "n")


@query("a29_cross_format_summary", oracle(f"""SELECT station_id, count(*) AS reference_records, count(*) FILTER (ok) AS matched_records, count(*) FILTER (ok AND dt<=600000000) AS exact_records, {rsql('median(dt/1e6) FILTER (ok)', 3)} AS median_dt_s, {rsql('median(dr) FILTER (ok)', 3)} AS median_abs_delta_range_m, CASE WHEN median(dr) FILTER (ok)<=1e5 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM (
 SELECT *, dt<=7200000000 AS ok FROM (SELECT station_id, least(coalesce(t-lo,hi-t),coalesce(hi-t,t-lo)) AS dt, abs(range_m - CASE WHEN lo IS NULL OR hi-t<=t-lo THEN (SELECT range_m FROM npt WHERE event_id=hi_id) ELSE (SELECT range_m FROM npt WHERE event_id=lo_id) END) AS dr FROM nb)) GROUP BY 1 HAVING count(*) FILTER (ok)>0""",
    "npt AS (SELECT * FROM ranging WHERE record_type='npt'), frd AS (SELECT * FROM ranging WHERE record_type='frd')", NEAREST_CTE.format("frd", "npt", "station_id", "t")))
def a29(spark, d):
    """Two formats matched per station: counts, time and range differences, verdict."""
    r = R.ranging(spark, d)
    left, right = r.where("record_type = 'frd'"), r.where("record_type = 'npt'").select("station_id", F.col("t").alias("nt"), F.col("range_m").alias("nr"))
    m = joins.nearest_join(left, right, ["event_id"], ["station_id"], "t", "nt", ["nr"], tie_later=True)
    m = m.withColumns({"dt": F.abs(F.col("nearest.nt") - F.col("t")), "dr": F.abs(F.col("nearest.nr") - F.col("range_m"))}).withColumn("ok", F.coalesce(F.col("dt") <= 7_200_000_000, F.lit(False)))
    q = with_quantiles(m, ["station_id"], [F.count(ONE).alias("reference_records"), F.count_if("ok").alias("matched_records"), F.count_if(F.col("ok") & (F.col("dt") <= 600_000_000)).alias("exact_records")], {"mdt": (F.when(F.col("ok"), F.col("dt") / 1e6), 0.5), "mdr": (F.when(F.col("ok"), F.col("dr")), 0.5)})
    return q.where("matched_records > 0").select("station_id", "reference_records", "matched_records", "exact_records", rnd("mdt", 3).alias("median_dt_s"), rnd("mdr", 3).alias("median_abs_delta_range_m"), F.when(F.col("mdr") <= 1e5, "PASS").otherwise("FAIL").alias("verdict"))


@query("a30_convention_difference", oracle(f"SELECT coalesce(CAST(entity_id AS VARCHAR),'ALL') AS entity_id, count(*) AS n_events, count(d) AS n_compared, count(*)-count(d) AS n_missing, {rsql('median(d)')} AS median_m, {rsql('avg(d)', 5)} AS mean_m, {rsql('quantile_cont(d,0.95)')} AS p95_m, {rsql('max(d)')} AS max_m, {rsql('avg(CASE WHEN d IS NULL THEN NULL WHEN d<1 THEN 1.0 ELSE 0.0 END)', 4)} AS sub_meter_fraction FROM (SELECT entity_id, abs(delta_sma_km*1000.0-orbit_shift_m) AS d FROM effects) GROUP BY ROLLUP(entity_id)"))
def a30(spark, d):
    """Difference of two conventions per target and overall."""
    x = summaries.with_all(R.effects(spark, d).select("entity_id", F.abs(F.col("delta_sma_km") * 1000.0 - F.col("orbit_shift_m")).alias("d")), ["entity_id"])
    q = with_quantiles(x, ["entity_id"], [F.count(ONE).alias("n_events"), F.count("d").alias("n_compared"), (F.count(ONE) - F.count("d")).alias("n_missing"), F.avg("d").alias("mean"), F.max("d").alias("mx"), F.avg(F.when(F.col("d").isNotNull(), (F.col("d") < 1).cast("double"))).alias("sub")], {"m": (F.col("d"), 0.5), "p": (F.col("d"), 0.95)})
    return q.select("entity_id", "n_events", "n_compared", "n_missing", rnd("m").alias("median_m"), rnd("mean", 5).alias("mean_m"), rnd("p").alias("p95_m"), rnd("mx").alias("max_m"), rnd("sub", 4).alias("sub_meter_fraction"))


SENS = f"""SELECT a.annotation_id, {{0}} FROM annotations a ASOF LEFT JOIN elements b ON a.entity_id=b.entity_id AND a.{{1}}>=b.t ASOF LEFT JOIN elements c ON a.entity_id=c.entity_id AND a.{{2}}<=c.t"""


@query("a31_window_sensitivity", oracle(f"""SELECT count(*) AS n_windows, count(r) AS n_release, count(s) AS n_symmetric, count(r-s) AS n_both, {rsql('median(abs(s-r))', 4)} AS median_abs_difference_m, {rsql('quantile_cont(abs(s-r),0.95)', 4)} AS p95_abs_difference_m, {rsql('max(abs(s-r))', 4)} AS max_abs_difference_m, {rsql('avg(CASE WHEN r-s IS NULL THEN NULL WHEN sign(r)=sign(s) THEN 1.0 ELSE 0.0 END)', 4)} AS sign_agreement_fraction FROM (SELECT r.d*1000.0 AS r, s.d*1000.0 AS s FROM rel r JOIN sym s ON r.annotation_id=s.annotation_id)""",
    f"an2 AS (SELECT *, event_t-24*{HOUR_US} AS s0, event_t+24*{HOUR_US} AS s1 FROM annotations)",
    f"rel AS (SELECT a.annotation_id, ({SMA_SQL.format('c.mean_motion')}-{SMA_SQL.format('b.mean_motion')})/1000.0 AS d FROM an2 a ASOF LEFT JOIN elements b ON a.entity_id=b.entity_id AND a.ws>=b.t ASOF LEFT JOIN elements c ON a.entity_id=c.entity_id AND a.we<=c.t)",
    f"sym AS (SELECT a.annotation_id, ({SMA_SQL.format('c.mean_motion')}-{SMA_SQL.format('b.mean_motion')})/1000.0 AS d FROM an2 a ASOF LEFT JOIN elements b ON a.entity_id=b.entity_id AND a.s0>=b.t ASOF LEFT JOIN elements c ON a.entity_id=c.entity_id AND a.s1<=c.t)"))
def a31(spark, d):
    """Element shift over the release window against a symmetric one; four lookups share one pass."""
    a = R.annotations(spark, d).withColumns({"s0": F.col("event_t") - 24 * HOUR_US, "s1": F.col("event_t") + 24 * HOUR_US})
    p = joins.Probe
    x = joins.asof_probes(a, R.elements(spark, d), ["annotation_id"], ["entity_id"], "t", ["t", "mean_motion"], {"rb": p("ws"), "ra": p("we", forward=True), "sb": p("s0"), "sa": p("s1", forward=True)})
    dm = lambda u, v: orbit.sma_from_mean_motion(F.col(f"{v}.mean_motion")) - orbit.sma_from_mean_motion(F.col(f"{u}.mean_motion"))
    x = cut(x.select(dm("rb", "ra").alias("r"), dm("sb", "sa").alias("s")))
    diff = F.abs(F.col("s") - F.col("r"))
    agree = F.when(diff.isNotNull(), (F.signum("r") == F.signum("s")).cast("double"))
    q = with_quantiles(x, [], [F.count(ONE).alias("n_windows"), F.count("r").alias("n_release"), F.count("s").alias("n_symmetric"), F.count(diff).alias("n_both"), F.max(diff).alias("mx"), F.avg(agree).alias("sa")], {"m": (diff, 0.5), "p": (diff, 0.95)})
    return q.select("n_windows", "n_release", "n_symmetric", "n_both", rnd("m", 4).alias("median_abs_difference_m"), rnd("p", 4).alias("p95_abs_difference_m"), rnd("mx", 4).alias("max_abs_difference_m"), rnd("sa", 4).alias("sign_agreement_fraction"))


@query("a32_match_report", oracle(f"SELECT e.entity_id, {rsql('e.f', 4)} AS event_tier_a_fraction, {rsql('coalesce(s.f,0)', 4)} AS control_tier_a_fraction, coalesce(s.n,0) AS controls FROM (SELECT entity_id, avg(CASE WHEN tier='A' THEN 1.0 ELSE 0.0 END) AS f FROM effects WHERE ls='F' GROUP BY 1) e LEFT JOIN (SELECT entity_id, count(*) AS n, avg(CASE WHEN tier='A' THEN 1.0 ELSE 0.0 END) AS f FROM effects WHERE ls='O' GROUP BY 1) s ON s.entity_id=e.entity_id"))
def a32(spark, d):
    """Tier-A share of events and of their controls per target."""
    e = R.effects(spark, d)
    share = F.avg((F.col("tier") == "A").cast("double"))
    a = e.where("ls = 'F'").groupBy("entity_id").agg(share.alias("f"))
    b = e.where("ls = 'O'").groupBy("entity_id").agg(F.count(ONE).alias("controls"), share.alias("g"))
    return a.join(b, "entity_id", "left").select("entity_id", rnd("f", 4).alias("event_tier_a_fraction"), rnd(F.coalesce("g", F.lit(0.0)), 4).alias("control_tier_a_fraction"), F.coalesce("controls", F.lit(0)).alias("controls"))


@query("a33_summary_refresh", oracle("SELECT t.entity_id, t.batch, coalesce(w.n,0) AS window_count, coalesce(w.a,0) AS tier_a_count, coalesce(w.fl,0) AS flagged_count FROM targets t LEFT JOIN (SELECT entity_id, count(*) AS n, count(*) FILTER (tier='A') AS a, count(*) FILTER (abs(delta_sma_km)*1000.0>20) AS fl FROM effects GROUP BY 1) w ON w.entity_id=t.entity_id"))
def a33(spark, d):
    """Count columns recomputed from the final windows, metadata kept; a window of an unknown target stops the job."""
    e = R.effects(spark, d)
    n = e.groupBy("entity_id").agg(F.count(ONE).alias("n"), F.count_if(F.col("tier") == "A").alias("a"), F.count_if(F.abs("delta_sma_km") * 1000.0 > 20).alias("fl"))
    t = R.targets(spark, d).select("entity_id", "batch", F.lit(True).alias("known"))
    j = n.join(t, "entity_id", "full_outer")
    bad = F.assert_true(F.coalesce("known", F.lit(False)), F.concat(F.lit("no summary row for target "), F.col("entity_id").cast("string")))
    j = j.withColumn("batch", F.coalesce(bad.cast("string"), F.col("batch")))
    return j.select("entity_id", "batch", *[F.coalesce(c, F.lit(0)).alias(o) for c, o in (("n", "window_count"), ("a", "tier_a_count"), ("fl", "flagged_count"))])


@query("a34_nearest_pass_statistics", oracle(f"""SELECT a.annotation_id, {rsql('(event_t-lo)/1e6', 3)} AS before_s, {rsql('(hi-event_t)/1e6', 3)} AS after_s, coalesce(b.n,0) AS band_points, {rsql('b.m')} AS band_median_m, {rsql('b.q')} AS band_rms_m, CASE WHEN lo IS NULL OR hi IS NULL OR coalesce(b.n,0)=0 THEN 'insufficient_coverage' ELSE 'computed' END AS slr_state_status
 FROM (SELECT x.*, p.t AS lo, (SELECT min(t) FROM ranging r WHERE r.entity_id=x.entity_id AND r.t>x.event_t) AS hi FROM annotations x ASOF LEFT JOIN ranging p ON p.entity_id=x.entity_id AND x.event_t>=p.t) a LEFT JOIN (SELECT annotation_id, count(*) AS n, median(sigma_m) AS m, sqrt(avg(sigma_m*sigma_m)) AS q FROM annotations a JOIN ranging r ON r.entity_id=a.entity_id AND r.t BETWEEN event_t-24*{HOUR_US} AND event_t+24*{HOUR_US} GROUP BY 1) b ON b.annotation_id=a.annotation_id"""))
def a34(spark, d):
    """Nearest passes around each event and the statistics of the day around it."""
    from orrery.operators import state

    s = state.ranging_state(R.annotations(spark, d), R.ranging(spark, d).withColumn("metric", F.col("sigma_m")))
    return s.select("annotation_id", rnd("before_s", 3).alias("before_s"), rnd("after_s", 3).alias("after_s"), "band_points", rnd("band_median_m").alias("band_median_m"), rnd("band_rms_m").alias("band_rms_m"), "slr_state_status")


@query("a35_ecdf_table", oracle(f"SELECT tier, {rsql('v')} AS value_m, {rsql('ecdf', 9)} AS ecdf FROM (SELECT DISTINCT tier, abs(delta_sma_km)*1000.0 AS v, cume_dist() OVER (PARTITION BY tier ORDER BY abs(delta_sma_km)*1000.0) AS ecdf FROM effects WHERE delta_sma_km IS NOT NULL)"))
def a35(spark, d):
    """Empirical distribution of responses per tier."""
    e = summaries.ecdf(R.effects(spark, d), ["tier"], F.abs("delta_sma_km") * 1000.0)
    return e.select("tier", rnd("value").alias("value_m"), rnd("ecdf", 9).alias("ecdf"))


@query("a35_log_histogram_and_pivot", oracle("SELECT decade, count(*) FILTER (tier='A') AS a, count(*) FILTER (tier='B') AS b, count(*) FILTER (tier='C') AS c, count(*) FILTER (m>40) AS overflow FROM (SELECT *, floor(log10(m)*4)/4 AS decade FROM (SELECT tier, (v-rest+CASE WHEN rest>0.0005 OR (rest=0.0005 AND (v-rest)%0.002>0) THEN 0.001 ELSE 0.000 END)::DECIMAL(18,3)::DOUBLE AS m FROM (SELECT *, v%0.001 AS rest FROM (SELECT tier, (abs(delta_sma_km)*1000.0)::VARCHAR::DECIMAL(38,20) AS v FROM effects))) WHERE m>0) GROUP BY 1"))
def a35b(spark, d):
    """Log-spaced histogram pivoted by tier with the number of values beyond the drawn range.

    Values are rounded half-even to three digits of their decimal form; a product with 1000 could move them onto a tie.
    """
    e = R.effects(spark, d).select("tier", F.bround(F.abs("delta_sma_km") * 1000.0, 3).alias("m")).where("m > 0")
    e = e.withColumn("decade", F.floor(F.log10("m") * 4) / 4)
    p = e.groupBy("decade").pivot("tier", ["A", "B", "C"]).count()
    n = e.groupBy("decade").agg(F.count_if(F.col("m") > 40).alias("overflow"))
    return p.join(n, "decade").select("decade", *[F.coalesce(t, F.lit(0)).alias(t.lower()) for t in "ABC"], "overflow")


@query("a35_target_samples", oracle("SELECT entity_id, l_orderkey, l_linenumber FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY md5('7|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber, qty) AS rk FROM effects) WHERE rk<=400"))
def a35c(spark, d):
    """Up to 400 hash-ranked rows per target (a sampling operator)."""
    from orrery.operators.labels import top_k

    h = F.md5(F.concat_ws("|", F.lit("7"), "l_orderkey", "l_linenumber"))
    return top_k(R.effects(spark, d).withColumn("h", h), ["entity_id"], ["h", "l_orderkey", "l_linenumber", "qty"], 400).select("entity_id", "l_orderkey", "l_linenumber")
