"""Quality control, deduplication, ordering and set queries."""

from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.flags import ordered_union
from orrery.functions.orbit import norm3, MU
from orrery.functions.time import iso
from orrery.operators import dedup, joins, names, qc, summaries
from orrery.operators.labels import top_k
from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, row_index, slot
from orrery.plans.joins import NEAREST_CTE
from orrery.plans.registry import query
from orrery.plans.scalars import W
from orrery.plans.summaries import QC_SQL
from orrery.roles import iso_sql, oracle, rnd, rsql
from orrery.session import cut, scratch_dir

INV = f"(2.0/sqrt(x*x+y*y+z*z) - (pow(vx-{W}*y,2)+pow(vy+{W}*x,2)+vz*vz)/3.986004418e14::DOUBLE)"
CHK_CTE = f"""chk AS (SELECT *, t//(3*{DAY_US}) AS part, sqrt(x*x+y*y+z*z) AS r, CASE WHEN {INV}>0 THEN 1.0/{INV} END AS sma FROM states),
chk2 AS (SELECT *, r<6578000.0 OR r>8378000.0 AS bad_r, sma IS NULL OR sma<6578000.0 OR sma>8378000.0 AS bad_a FROM chk)"""


def checked(spark, d):
    return qc.state_violations(R.states(spark, d), ["entity_id"]).withColumn("part", slot("t", 3 * DAY_US))


@query("q01_orbit_record_assertions", oracle(f"SELECT entity_id, count(*) AS n_records, count(*) FILTER (bad_r) AS radius_violations, count(*) FILTER (bad_a) AS sma_violations, {rsql('min(r)', 2)} AS radius_min_m, {rsql('median(r)', 2)} AS radius_median_m, {rsql('median(sma)', 1)} AS sma_median_m, abs(median(sma)-7000000.0)<=25000 AS near_nominal, {rsql('(max(t)-min(t))/1e6', 3)} AS epoch_span_s, count(*) FILTER (k=7) AS clock_sentinel_rows FROM chk2 GROUP BY 1", CHK_CTE))
def q01(spark, d):
    """Counts of each physical check and the ledger of every entity, with the nominal-axis gate."""
    x = qc.state_ledger(checked(spark, d), ["entity_id"])
    return x.select("entity_id", "n_records", F.col("radius_in_leo_band_violations").alias("radius_violations"), F.col("vis_viva_sma_in_leo_band_violations").alias("sma_violations"), rnd("radius_min_m", 2).alias("radius_min_m"), rnd("radius_median_m", 2).alias("radius_median_m"), rnd("sma_median_m", 1).alias("sma_median_m"), (F.abs(F.col("sma_median_m") - 7e6) <= 25_000).alias("near_nominal"), rnd("epoch_span_s", 3).alias("epoch_span_s"), "clock_sentinel_rows")


@query("q02_file_level_rejection", oracle("""SELECT entity_id, part, arg_min(assertion, (o, event_id)) AS assertion, arg_min(event_id, (o, event_id)) AS row, count(*) AS violations FROM (SELECT entity_id, part, event_id, 2 AS o, 'radius_in_leo_band' AS assertion FROM chk2 WHERE bad_r UNION ALL SELECT entity_id, part, event_id, 3, 'vis_viva_sma_in_leo_band' FROM chk2 WHERE bad_a) GROUP BY 1,2""", CHK_CTE))
def q02(spark, d):
    """Files refused because one row breaks a check: first check, row, count."""
    return qc.reject_files(checked(spark, d), ["entity_id", "part"])


VIOL = "tof_s IS NULL OR abs(tof_s/2.0*299792458.0::DOUBLE-range_m)>1.0 AS v1, range_m<5e5 OR range_m>6e6 AS v2, t<1704240000000000 AS v4"


@query("q03_ranging_record_assertions", oracle(f"SELECT entity_id, count(*) FILTER (v1) AS tof_identity, count(*) FILTER (v2) AS range_in_band, count(*) FILTER (v4) AS mission_span, count(*) FILTER (v1 OR v2 OR v4) AS rejected_rows, {rsql('median(range_m)', 2)} AS range_median_m FROM (SELECT *, {VIOL} FROM ranging) GROUP BY 1"))
def q03(spark, d):
    """Report mode: offending rows per check; the mission span is open at the end."""
    c = qc.ranging_violations(mission_start=F.lit(1704240000000000))
    r = R.ranging(spark, d)
    q = with_quantiles(r, ["entity_id"], [F.count_if(c["slr_tof_range_identity"]).alias("tof_identity"), F.count_if(c["slr_range_in_band"]).alias("range_in_band"), F.count_if(c["slr_epoch_in_mission_span"]).alias("mission_span"), F.count_if(qc.any_of(c)).alias("rejected_rows")], {"m": (F.col("range_m"), 0.5)})
    return q.select("entity_id", "tof_identity", "range_in_band", "mission_span", "rejected_rows", rnd("m", 2).alias("range_median_m"))


@query("q03_strict_snapshot", oracle(f"SELECT entity_id, count(*) FILTER (NOT bad) AS n, count(*) FILTER (bad) AS left_out, (SELECT count(*) FILTER (v1) FROM vr) AS all_tof_identity, (SELECT count(*) FILTER (v2) FROM vr) AS all_range_in_band, (SELECT count(*) FROM vr) AS all_rows FROM vr GROUP BY 1", f"vr AS (SELECT *, coalesce(v1, false) OR coalesce(v2, false) AS bad FROM (SELECT *, {VIOL} FROM ranging))"))
def q03s(spark, d):
    """Strict mode: accepted rows are written behind a guard that stops the job at any violation; the checks are counted in that same pass."""
    c = qc.ranging_violations()
    seen = Observation("ranging_checks")
    path = scratch_dir(spark, "accepted") + "/ranging"
    marked = R.ranging(spark, d).withColumn("rejected", qc.any_of(c))
    marked = marked.observe(seen, F.count(F.lit(1)).alias("all_rows"), *[F.count_if(c[f"slr_{n}"]).alias(f"all_{n}") for n in ("tof_range_identity", "range_in_band")])
    qc.enforce(marked, {n: bad & ~F.col("rejected") for n, bad in c.items()}, "entity_id").write.parquet(path)
    got = seen.get
    g = spark.read.parquet(path).groupBy("entity_id").agg(F.count_if(~F.col("rejected")).alias("n"), F.count_if("rejected").alias("left_out"))
    total = lambda name, as_: F.lit(got[name]).cast("bigint").alias(as_)
    return g.select("entity_id", "n", "left_out", total("all_tof_range_identity", "all_tof_identity"), total("all_range_in_band", "all_range_in_band"), total("all_rows", "all_rows"))


@query("q04_record_triage", oracle(f"SELECT zero_fields, qc_rejected, count(*) AS n, count(*) FILTER (sigma_m>0.1) AS sigma_alerts FROM (SELECT *, CASE WHEN sigma_m=0 AND num_returns=0 THEN 'sigma+num_returns' WHEN sigma_m=0 THEN 'sigma' WHEN num_returns=0 THEN 'num_returns' ELSE '' END AS zero_fields, v1 OR v2 AS qc_rejected FROM (SELECT *, {VIOL} FROM ranging)) GROUP BY 1,2"))
def q04(spark, d):
    """Rejected rows, unfilled source fields and large sigmas: marked and counted."""
    r = R.ranging(spark, d).withColumns({"zero_fields": qc.source_zero_fields(), "qc_rejected": qc.any_of(qc.ranging_violations())})
    return r.groupBy("zero_fields", "qc_rejected").agg(F.count("*").alias("n"), F.count_if(F.col("sigma_m") > 0.1).alias("sigma_alerts"))


@query("q05_qc_status_precedence", oracle(f"SELECT event_id, {QC_SQL} AS qc_status FROM ranging"))
def q05(spark, d):
    """Most specific status per row."""
    return qc.with_qc_status(R.ranging(spark, d)).select("event_id", "qc_status")


@query("q06_below_surface_flag", oracle("SELECT event_id, CASE WHEN sqrt(x*x+y*y+z*z)-2e5<6371000.0 THEN 'below_surface' ELSE '' END AS quality_flag FROM states"))
def q06(spark, d):
    """States inside the Earth."""
    r = norm3(F.col("x"), F.col("y"), F.col("z")) - 2e5
    return R.states(spark, d).select("event_id", F.when(r < 6_371_000.0, "below_surface").otherwise("").alias("quality_flag"))


@query("q07_corrupt_range_rejection", oracle("SELECT station_id, count(*) FILTER (range_m>=5e5) AS kept, count(*) FILTER (range_m<5e5) AS range_below_band_corrupt FROM ranging GROUP BY 1"))
def q07(spark, d):
    """Ranges below the band are left out and counted."""
    low = F.col("range_m") < 5e5
    return R.ranging(spark, d).groupBy("station_id").agg(F.count_if(~low).alias("kept"), F.count_if(low).alias("range_below_band_corrupt"))


UNIT = "CASE WHEN entity_id%3=0 THEN 1.0::DOUBLE WHEN entity_id%3=1 THEN 10.0::DOUBLE ELSE 3.0::DOUBLE END"


@query("q08_velocity_unit_arbitration", oracle(f"SELECT entity_id, {rsql('med', 6)} AS median_ratio, CASE WHEN med BETWEEN 0.8 AND 1.3 THEN 1.0::DOUBLE ELSE 0.1::DOUBLE END AS scale, CASE WHEN med BETWEEN 0.8 AND 1.3 THEN 'm/s_as_written' WHEN med BETWEEN 8 AND 13 THEN 'dm/s_spec' ELSE 'dm/s_spec_default_unresolved' END AS basis FROM (SELECT entity_id, median(ratio) AS med FROM (SELECT entity_id, sqrt(vx*vx+vy*vy+vz*vz)*{UNIT}/sqrt(3.986004418e14::DOUBLE/sqrt(x*x+y*y+z*z)) AS ratio, row_number() OVER (PARTITION BY entity_id ORDER BY t, event_id) AS rn FROM states) WHERE rn<=99 GROUP BY 1)"))
def q08(spark, d):
    """Velocity unit of each file from the first 99 speed ratios."""
    u = F.when(F.col("entity_id") % 3 == 0, 1.0).when(F.col("entity_id") % 3 == 1, 10.0).otherwise(3.0)
    s = R.states(spark, d).withColumn("raw_speed", norm3(F.col("vx"), F.col("vy"), F.col("vz")) * u)
    x = names.velocity_unit(s, ["entity_id"], ["t", "event_id"])
    return x.select("entity_id", rnd("median_ratio").alias("median_ratio"), "scale", "basis")


@query("q09_orbit_product_validation", oracle(f"SELECT entity_id, count(*) AS records, {rsql('max(g)/3600e6', 4)} AS max_gap_h, coalesce(max(g)>2*3600000000,false) AS gap_alert, count(*) FILTER (r<6400000.0 OR r>8000000.0) AS outliers, bool_or(vx IS NOT NULL) AS has_velocity, coalesce(NOT (max(g)>2*3600000000),true) AND count(*) FILTER (r<6400000.0 OR r>8000000.0)=0 AS valid FROM (SELECT *, sqrt(x*x+y*y+z*z) AS r, t-lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS g FROM states) GROUP BY 1"))
def q09(spark, d):
    """Gaps, radius outliers and field presence per product."""
    s = neighbour(R.states(spark, d), ["entity_id"], ["t"], slot("t", DAY_US), ["t"])
    g, r = F.max(F.col("t") - F.col("prev.t")), norm3(F.col("x"), F.col("y"), F.col("z"))
    alert, out = F.coalesce(g > 2 * HOUR_US, F.lit(False)), F.count_if((r < 6.4e6) | (r > 8e6))
    return s.groupBy("entity_id").agg(F.count("*").alias("records"), rnd(g / 3600e6, 4).alias("max_gap_h"), alert.alias("gap_alert"), out.alias("outliers"), F.max(F.col("vx").isNotNull()).alias("has_velocity"), (~alert & (out == 0)).alias("valid"))


@query("q10_ranging_validation", oracle(f"SELECT count(*) AS total_records, count(*) FILTER (record_type='npt') AS normal_points, count(*) FILTER (record_type='frd') AS full_rate, count(DISTINCT station_id) AS stations, count(DISTINCT entity_id) AS targets, {rsql('avg(sigma_m)', 9)} AS mean_sigma_m, count(*) FILTER (range_m<3e5 OR range_m>3e6) AS range_outliers, count(*) FILTER (sigma_m<0) AS negative_sigma FROM ranging"))
def q10(spark, d):
    """One-row validation of a ranging table."""
    r = F.col("range_m")
    return R.ranging(spark, d).agg(F.count("*").alias("total_records"), *[F.count_if(F.col("record_type") == t).alias(n) for t, n in (("npt", "normal_points"), ("frd", "full_rate"))], F.countDistinct("station_id").alias("stations"), F.countDistinct("entity_id").alias("targets"), rnd(F.avg("sigma_m"), 9).alias("mean_sigma_m"), F.count_if((r < 3e5) | (r > 3e6)).alias("range_outliers"), F.count_if(F.col("sigma_m") < 0).alias("negative_sigma"))


@query("q11_schema_audit", oracle("SELECT count(*) AS row_count, count(DISTINCT entity_id) AS satellite_count, true AS required_fields_present, true AS epochs_utc, count(*)-count(DISTINCT (entity_id,t)) AS duplicate_rows, count(*) FILTER (rf='R') AS flagged_rows FROM shipments"))
def q11(spark, d):
    """Rows, entities, required fields, time type, repeated keys, flagged rows; the key count is a two-step aggregate."""
    s = R.shipments(spark, d).withColumn("epoch", F.timestamp_micros("t"))
    need = {"entity_id", "epoch", "qty", "price"}
    k = s.groupBy("entity_id", "t").agg(F.count("*").alias("n"), F.count_if(F.col("rf") == "R").alias("f"))
    e = k.groupBy("entity_id").agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.count("*").alias("keys"))
    return e.agg(F.sum("n").alias("row_count"), F.count("*").alias("satellite_count"), F.lit(need <= set(s.columns)).alias("required_fields_present"), F.lit(s.schema["epoch"].dataType.typeName() == "timestamp").alias("epochs_utc"), (F.sum("n") - F.sum("keys")).alias("duplicate_rows"), F.sum("f").alias("flagged_rows"))


@query("q12_source_audit", oracle(f"SELECT s.source, count(*) AS rows, {rsql('(max(t)-min(t))/3600e6', 4)} AS span_hours, {rsql('any_value(c.cad)', 3)} AS cadence_s, count(*) FILTER (g>2*c.cad) AS gap_count, {rsql('max(g) FILTER (g>2*c.cad)', 3)} AS max_gap_s, count(*) FILTER (v IS NULL) AS null_state_rows FROM src s JOIN (SELECT source, median(g) AS cad FROM src GROUP BY 1) c ON c.source=s.source GROUP BY 1",
    "src AS (SELECT *, (t-lag(t) OVER (PARTITION BY source, entity_id ORDER BY t))/1e6 AS g FROM (SELECT 'elements' AS source, entity_id, t, mean_motion AS v FROM elements UNION ALL SELECT 'ranging', entity_id, t, tof_s FROM ranging))"))
def q12(spark, d):
    """Cadence and gaps per source over consecutive rows of each entity."""
    e = R.elements(spark, d).select(F.lit("elements").alias("source"), "entity_id", "t", F.col("mean_motion").alias("v"))
    x = e.unionByName(R.ranging(spark, d).select(F.lit("ranging").alias("source"), "entity_id", "t", F.col("tof_s").alias("v")))
    x = neighbour(x, ["source", "entity_id"], ["t"], slot("t", DAY_US), ["t"]).withColumn("g", (F.col("t") - F.col("prev.t")) / 1e6)
    c = exact_quantiles(x, ["source"], {"cad": (F.col("g"), 0.5)})
    big = F.col("g") > 2 * F.col("cad")
    return x.join(c, "source").groupBy("source").agg(F.count("*").alias("rows"), rnd((F.max("t") - F.min("t")) / 3600e6, 4).alias("span_hours"), rnd(F.first("cad"), 3).alias("cadence_s"), F.count_if(big).alias("gap_count"), rnd(F.max(F.when(big, F.col("g"))), 3).alias("max_gap_s"), F.count_if(F.col("v").isNull()).alias("null_state_rows"))


@query("q13_source_inventory", oracle(f"SELECT event_type AS source, count(*) AS row_count, {iso_sql('min(t)')} AS time_start, {iso_sql('max(t)')} AS time_end, count(DISTINCT entity_id) AS ids, (SELECT string_agg(e, ',' ORDER BY e) FROM (SELECT DISTINCT entity_id AS e FROM ev y WHERE y.event_type=ev.event_type ORDER BY 1 LIMIT 20)) AS first_ids FROM ev GROUP BY 1"))
def q13(spark, d):
    """Rows, range, id count and the first 20 ids per source; ids come from a distinct list under a group limit."""
    e = R.table(spark, d, "events").select(F.col("event_type").alias("source"), F.col("user_id").alias("e"), R.micros("ts").alias("t"))
    per = e.groupBy("source", "e").agg(F.count("*").alias("n"), F.min("t").alias("a"), F.max("t").alias("z"))
    first = top_k(per.select("source", "e"), ["source"], ["e"], 20).groupBy("source").agg(F.array_join(F.array_sort(F.collect_list("e")), ",").alias("first_ids"))
    n = per.groupBy("source").agg(F.sum("n").alias("row_count"), iso(F.min("a")).alias("time_start"), iso(F.max("z")).alias("time_end"), F.count("*").alias("ids"))
    return n.join(first, "source")


@query("q14_overlap_readiness", oracle(f"SELECT entity_id, {iso_sql('lo')} AS overlap_start, {iso_sql('hi')} AS overlap_end, {rsql('CASE WHEN hi>=lo THEN (hi-lo)/1e6 ELSE 0 END', 3)} AS overlap_s, n=3 AS required_present, n=3 AND hi-lo>=10*{DAY_US} AS ready FROM (SELECT entity_id, max(a) AS lo, min(z) AS hi, count(*) AS n FROM (SELECT entity_id, event_type, min(t) a, max(t) z FROM ev WHERE event_type IN ('view','click','purchase') GROUP BY 1,2) GROUP BY 1)"))
def q14(spark, d):
    """Common time range of the required sources per entity."""
    e = R.table(spark, d, "events").where(F.col("event_type").isin("view", "click", "purchase")).select(F.col("user_id").alias("entity_id"), "event_type", R.micros("ts").alias("t"))
    per = e.groupBy("entity_id", "event_type").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    o = per.groupBy("entity_id").agg(F.max("a").alias("lo"), F.min("z").alias("hi"), F.count("*").alias("n"))
    sec = F.when(F.col("hi") >= F.col("lo"), (F.col("hi") - F.col("lo")) / 1e6).otherwise(0.0)
    return o.select("entity_id", iso("lo").alias("overlap_start"), iso("hi").alias("overlap_end"), rnd(sec, 3).alias("overlap_s"), (F.col("n") == 3).alias("required_present"), ((F.col("n") == 3) & (sec >= 10 * 86400.0)).alias("ready"))


@query("q15_summary_refresh", oracle(f"SELECT o.entity_id, CASE WHEN fresh THEN n.n ELSE o.n END AS row_count, {iso_sql('CASE WHEN fresh THEN n.z ELSE o.z END')} AS time_end, fresh AS refreshed FROM (SELECT entity_id, count(*) n, min(t) a, max(t) z FROM shipments WHERE rf='A' GROUP BY 1) o JOIN (SELECT entity_id, count(*) n, min(t) a, max(t) z FROM shipments GROUP BY 1) n ON n.entity_id=o.entity_id, LATERAL (SELECT n.n>o.n AND n.a<=o.a AND n.z-o.z > greatest(7*{DAY_US}, (o.z-o.a)*0.001) AS fresh)"))
def q15(spark, d):
    """A stored summary is replaced when the newer snapshot has more rows, starts no later and ends well after."""
    s = R.shipments(spark, d)
    stats = lambda x, p: x.groupBy("entity_id").agg(F.count("*").alias(f"{p}n"), F.min("t").alias(f"{p}a"), F.max("t").alias(f"{p}z"))
    j = stats(s.where("rf = 'A'"), "o").join(stats(s, "n"), "entity_id")
    fresh = (F.col("nn") > F.col("on")) & (F.col("na") <= F.col("oa")) & (F.col("nz") - F.col("oz") > F.greatest(F.lit(7.0 * DAY_US), (F.col("oz") - F.col("oa")) * 0.001))
    j = j.withColumn("refreshed", fresh)
    return j.select("entity_id", F.when(F.col("refreshed"), F.col("nn")).otherwise(F.col("on")).alias("row_count"), iso(F.when(F.col("refreshed"), F.col("nz")).otherwise(F.col("oz"))).alias("time_end"), "refreshed")


@query("q16_window_quality_gate", oracle(f"""SELECT annotation_id, ws<1704240000000000 OR we>1706400000000000 AS boundary, EXISTS (SELECT 1 FROM gp g WHERE g.entity_id=a.entity_id AND g.hi>a.ws AND g.lo<a.we) AS gap,
 CASE WHEN ws<1704240000000000 OR we>1706400000000000 THEN 'boundary_artifact' WHEN EXISTS (SELECT 1 FROM gp g WHERE g.entity_id=a.entity_id AND g.hi>a.ws AND g.lo<a.we) THEN 'major_gap' ELSE '' END AS reason FROM annotations a""",
    f"gp AS (SELECT entity_id, lo, t AS hi FROM (SELECT entity_id, t, lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS lo FROM (SELECT DISTINCT entity_id, t FROM elements)) WHERE t-lo>48*{HOUR_US})"))
def q16(spark, d):
    """Windows at the release edge or across a long hole of the element series; the first reason wins."""
    a = R.annotations(spark, d).select("annotation_id", "entity_id", "ws", "we")
    gaps = qc.major_gaps(R.elements(spark, d), ["entity_id"], F.lit(48 * HOUR_US))
    g = joins.count_overlaps(a, gaps, ["annotation_id"], ["entity_id"], "ws", "we", "gap_lo", "gap_hi", name="n")
    edge, gap = (F.col("ws") < 1704240000000000) | (F.col("we") > 1706400000000000), F.col("n") > 0
    return g.select("annotation_id", edge.alias("boundary"), gap.alias("gap"), F.when(edge, "boundary_artifact").when(gap, "major_gap").otherwise("").alias("reason"))


@query("q17_parse_ledger", oracle(f"SELECT entity_id, count(*) AS records, count(*) FILTER (q<>'ok') AS rejected, coalesce((SELECT string_agg(q2 || ':' || n, ';' ORDER BY q2) FROM (SELECT {QC_SQL} AS q2, count(*) AS n FROM ranging r2 WHERE r2.entity_id=r.entity_id GROUP BY 1) WHERE q2<>'ok'), '') AS reasons FROM (SELECT *, {QC_SQL} AS q FROM ranging) r GROUP BY 1"))
def q17(spark, d):
    """Parsed and rejected rows with ``name:count`` reasons per file."""
    r = qc.with_qc_status(R.ranging(spark, d)).groupBy("entity_id", "qc_status").agg(F.count("*").alias("n"))
    bad = F.col("qc_status") != "ok"
    named = F.when(bad, F.concat_ws(":", "qc_status", F.col("n").cast("string")))
    return r.groupBy("entity_id").agg(F.sum("n").alias("records"), F.coalesce(F.sum(F.when(bad, F.col("n"))), F.lit(0)).alias("rejected"), F.array_join(F.array_sort(F.collect_list(named)), ";").alias("reasons"))


@query("q18_sentinel_to_null", oracle(f"SELECT entity_id, count(clock) FILTER (k<>7) AS valid_rows, count(*) FILTER (k=7) AS sentinel_rows, {rsql('avg(clock*0.001+5.0) FILTER (k<>7)')} AS mean_scaled FROM states GROUP BY 1"))
def q18(spark, d):
    """Fill values become NULL, are counted, and scale and offset apply to the rest."""
    s = R.states(spark, d).withColumn("c", qc.sentinel_to_null(F.col("clock"), qc.CLOCK_SENTINEL, 0.001, 5.0))
    return s.groupBy("entity_id").agg(F.count("c").alias("valid_rows"), F.count_if(F.col("c").isNull()).alias("sentinel_rows"), rnd(F.avg("c")).alias("mean_scaled"))


@query("q19_time_scale_alert", oracle(f"""SELECT entity_id, count(*) AS n_samples, {rsql('median(res)')} AS median_km, {rsql('max(res)')} AS max_km, median(res)>0.7 AS alert FROM (
 SELECT e.*, sqrt((ix-ox)*(ix-ox)+(iy-oy)*(iy-oy)+(iz-oz)*(iz-oz))/1000.0 AS res, row_number() OVER (PARTITION BY entity_id ORDER BY t, l_orderkey, l_linenumber, ox, oy, oz)-1 AS pos, count(*) OVER (PARTITION BY entity_id) AS n FROM estimates e) x
 WHERE list_contains(list_transform(range(0,least(n,101)), lambda i: round_even(i*(n-1)::DOUBLE/(least(n,101)-1),0)::BIGINT), pos) GROUP BY 1"""))
def q19(spark, d):
    """Median residual of predicted positions on at most 101 evenly spaced samples of each arc."""
    e = R.estimates(spark, d)
    dx, dy, dz = (F.col(f"i{a}") - F.col(f"o{a}") for a in "xyz")
    e = e.withColumn("res", F.sqrt(dx * dx + dy * dy + dz * dz) / 1000.0)
    order = ["t", "l_orderkey", "l_linenumber", "ox", "oy", "oz"]
    s = cut(names.even_samples(e.select("entity_id", *order, "res"), ["entity_id"], order, slot("t", 30 * DAY_US), 101).select("entity_id", "res"))
    q = with_quantiles(s, ["entity_id"], [F.count("*").alias("n_samples"), F.max("res").alias("mx")], {"m": (F.col("res"), 0.5)})
    return q.select("entity_id", "n_samples", rnd("m").alias("median_km"), rnd("mx").alias("max_km"), (F.col("m") > 0.7).alias("alert"))


@query("q21_staged_shipped_reconciliation", oracle("SELECT coalesce(a.entity_id,b.entity_id) AS entity_id, coalesce(a.n,0) AS staged_rows, coalesce(b.n,0) AS shipped_rows, coalesce(a.n,0)-coalesce(b.n,0) AS delta_rows, coalesce(a.np,0) AS staged_normal_points, CASE WHEN b.n IS NULL THEN 'no_shipped_parquet' ELSE '' END AS note FROM (SELECT entity_id, count(*) n, count(*) FILTER (record_type='npt') np FROM ranging GROUP BY 1) a FULL JOIN (SELECT entity_id, count(*) n FROM external_times GROUP BY 1) b ON a.entity_id=b.entity_id"))
def q21(spark, d):
    """Row-count differences of two editions per entity."""
    a = R.ranging(spark, d).groupBy("entity_id").agg(F.count("*").alias("a"), F.count_if(F.col("record_type") == "npt").alias("np"))
    b = R.external_times(spark, d).groupBy("entity_id").agg(F.count("*").alias("b"))
    z = lambda c: F.coalesce(c, F.lit(0))
    return a.join(b, "entity_id", "full_outer").select("entity_id", z("a").alias("staged_rows"), z("b").alias("shipped_rows"), (z("a") - z("b")).alias("delta_rows"), z("np").alias("staged_normal_points"), F.when(F.col("b").isNull(), "no_shipped_parquet").otherwise("").alias("note"))


@query("q22_source_acquisition_status", oracle("SELECT t.entity_id, t.batch, CASE WHEN coalesce(o.pod,0)>0 THEN 'available' ELSE 'missing' END AS pod_status, CASE WHEN coalesce(o.pre,0)>0 THEN 'available' ELSE 'missing' END AS precise_status, coalesce(r.n,0) AS slr_file_count, CASE WHEN coalesce(o.pod,0)>0 AND coalesce(o.pre,0)>0 AND coalesce(r.n,0)>0 THEN 'complete' ELSE 'partial' END AS readiness, concat_ws(';', CASE WHEN coalesce(o.pod,0)=0 THEN 'pod' END, CASE WHEN coalesce(o.pre,0)=0 THEN 'precise_orbit' END, CASE WHEN coalesce(r.n,0)=0 THEN 'slr' END) AS limitation FROM targets t LEFT JOIN (SELECT entity_id, count(*) FILTER (source_type='pod') pod, count(*) FILTER (source_type<>'pod') pre FROM orbit_files GROUP BY 1) o ON o.entity_id=t.entity_id LEFT JOIN (SELECT entity_id, count(*) n FROM ranging_files GROUP BY 1) r ON r.entity_id=t.entity_id"))
def q22(spark, d):
    """Files per source against the target list."""
    o = R.orbit_files(spark, d).groupBy("entity_id").agg(F.count_if(F.col("source_type") == "pod").alias("pod"), F.count_if(F.col("source_type") != "pod").alias("pre"))
    r = R.ranging_files(spark, d).groupBy("entity_id").agg(F.count("*").alias("slr"))
    t = R.targets(spark, d).join(o, "entity_id", "left").join(r, "entity_id", "left").na.fill(0, ["pod", "pre", "slr"])
    st = lambda c: F.when(F.col(c) > 0, "available").otherwise("missing")
    lack = F.array_compact(F.array(*[F.when(F.col(c) == 0, n) for c, n in (("pod", "pod"), ("pre", "precise_orbit"), ("slr", "slr"))]))
    return t.select("entity_id", "batch", st("pod").alias("pod_status"), st("pre").alias("precise_status"), F.col("slr").alias("slr_file_count"), F.when(F.size(lack) == 0, "complete").otherwise("partial").alias("readiness"), F.array_join(lack, ";").alias("limitation"))


@query("q23_clock_cross_check", oracle(f"SELECT entity_id, {rsql('median(tai-utc)')} AS offset_s, abs(median(tai-utc)-37.0)<=0.001 AS ok FROM (SELECT entity_id, value AS utc, CASE WHEN k%11=0 THEN NULL ELSE value+37.0+(CASE WHEN entity_id%5=0 THEN 0.01::DOUBLE ELSE 0.0::DOUBLE END) END AS tai FROM ev) WHERE tai IS NOT NULL GROUP BY 1"))
def q23(spark, d):
    """Median of two clocks against the declared offset, over rows where both are valid."""
    k = F.get_json_object("props", "$.k").cast("int")
    e = R.table(spark, d, "events").select(F.col("user_id").alias("entity_id"), F.col("value").alias("utc"), F.when(k % 11 != 0, F.col("value") + 37.0 + F.when(F.col("user_id") % 5 == 0, 0.01).otherwise(0.0)).alias("tai"))
    q = exact_quantiles(e, ["entity_id"], {"o": (F.col("tai") - F.col("utc"), 0.5)})
    return q.select("entity_id", rnd("o").alias("offset_s"), (F.abs(F.col("o") - 37.0) <= 0.001).alias("ok"))


SEQ = ["l_orderkey", "l_linenumber", "l_partkey"]


def dedup_sql(order: str) -> str:
    return f"SELECT entity_id, {iso_sql('t')} AS epoch_utc, {rsql('price', 2)} AS price, copies FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, t ORDER BY {order}) AS rn, count(*) OVER (PARTITION BY entity_id, t) AS copies FROM shipments) WHERE rn=1"


def dedup_out(x):
    return x.select("entity_id", iso("t").alias("epoch_utc"), rnd("price", 2).alias("price"), "copies")


@query("d01_keep_last", oracle(dedup_sql("l_orderkey DESC, l_linenumber DESC, l_partkey DESC, price DESC")))
def d01(spark, d):
    """Last row per (entity, epoch) in load order."""
    return dedup_out(dedup.keep_one(R.shipments(spark, d), ["entity_id", "t"], [*SEQ, "price"], last=True))


@query("d02_keep_first_by_file", oracle(dedup_sql("rf, ls, l_orderkey, l_linenumber, l_partkey, price")))
def d02(spark, d):
    """First row per (entity, epoch) in sorted file order."""
    return dedup_out(dedup.keep_one(R.shipments(spark, d), ["entity_id", "t"], ["rf", "ls", *SEQ, "price"]))


@query("d03_keep_first_station_epoch", oracle(f"SELECT station_id, {iso_sql('slot')} AS epoch_utc, event_id, copies FROM (SELECT *, row_number() OVER (PARTITION BY station_id, slot ORDER BY record_type, event_id) AS rn, count(*) OVER (PARTITION BY station_id, slot) AS copies FROM (SELECT *, t//{HOUR_US}*{HOUR_US} AS slot FROM ranging)) WHERE rn=1"))
def d03(spark, d):
    """Overlapping products collapse per (station, epoch) with the number of copies."""
    r = R.ranging(spark, d).withColumn("slot", (F.floor(F.col("t") / HOUR_US) * HOUR_US).cast("bigint"))
    return dedup.keep_one(r, ["station_id", "slot"], ["record_type", "event_id"]).select("station_id", iso("slot").alias("epoch_utc"), "event_id", "copies")


PRIO_CTE = """prio AS (SELECT *, CASE WHEN l_linenumber=1 THEN 1 ELSE 0 END AS origin, CASE rf WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 0 END AS family, l_orderkey%50 AS arc, (CASE rf WHEN 'R' THEN 'SWOT_POR_' ELSE 'EOF_' END) || l_partkey AS name FROM shipments),
win AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY entity_id, t ORDER BY origin, family, -arc, name) AS rn FROM prio))"""


@query("d04_prioritised_dedup_rules", oracle("""SELECT entity_id, rule, CAST(count(*) AS BIGINT) AS dropped FROM (SELECT d.entity_id, CASE WHEN d.origin<>k.origin THEN 'parsed_over_published' WHEN d.family<>k.family AND k.name LIKE 'SWOT%' THEN 'por_beats_vor' WHEN d.family<>k.family THEN 'poeorb_beats_moeorb' WHEN d.arc<>k.arc THEN 'later_arc_start' ELSE 'same_arc_tiebreak' END AS rule FROM win d JOIN win k ON k.entity_id=d.entity_id AND k.t=d.t AND k.rn=1 WHERE d.rn>1) GROUP BY 1,2""", PRIO_CTE))
def d04(spark, d):
    """Rows dropped per rule when repeated epochs are resolved by priority."""
    _, dropped = dedup.prioritised(prioritised_input(spark, d), ["entity_id", "t"])
    return dropped.groupBy("entity_id", "rule").agg(F.sum("dropped").alias("dropped"))


def prioritised_input(spark, d):
    rf = F.col("rf")
    return R.shipments(spark, d).withColumns({
        "origin": F.when(F.col("l_linenumber") == 1, 1).otherwise(0), "family": F.when(rf == "N", 1).otherwise(0), "arc": F.col("l_orderkey") % 50,
        "name": F.concat(F.when(rf == "R", "SWOT_POR_").otherwise("EOF_"), F.col("l_partkey").cast("string")),
    })


@query("d04_prioritised_dedup_rows", oracle(f"SELECT entity_id, {iso_sql('t')} AS epoch_utc, name, origin, family, arc FROM win WHERE rn=1", PRIO_CTE))
def d04b(spark, d):
    """The kept row of every epoch."""
    best, _ = dedup.prioritised(prioritised_input(spark, d), ["entity_id", "t"])
    return best.select("entity_id", iso("t").alias("epoch_utc"), "name", "origin", "family", "arc")


@query("d05_distinct_epoch_history", oracle(f"SELECT DISTINCT entity_id, {iso_sql('t')} AS epoch_utc FROM shipments"))
def d05(spark, d):
    """Merged history with one row per epoch."""
    return R.shipments(spark, d).select("entity_id", "t").distinct().select("entity_id", iso("t").alias("epoch_utc"))


@query("d06_dominant_entity", oracle("SELECT event_id, entity_id, part FROM (SELECT *, first_value(entity_id) OVER (PARTITION BY part ORDER BY n DESC, entity_id) AS top FROM (SELECT *, count(*) OVER (PARTITION BY part, entity_id) AS n FROM (SELECT *, t//3600000000 AS part FROM states))) WHERE entity_id=top"))
def d06(spark, d):
    """Rows of the most frequent entity in each file."""
    s = R.states(spark, d).withColumn("part", slot("t", HOUR_US))
    return dedup.dominant_entity(s, ["part"], "entity_id").select("event_id", "entity_id", "part")


@query("o01_deterministic_sort", oracle(f"SELECT annotation_id, entity_id, {iso_sql('ws')} AS window_start_utc FROM annotations ORDER BY entity_id, ws, annotation_id"))
def o01(spark, d):
    """Total order by entity, window start, id (range-partitioned sort)."""
    return R.annotations(spark, d).orderBy("entity_id", "ws", "annotation_id").select("annotation_id", "entity_id", iso("ws").alias("window_start_utc"))


@query("o02_per_group_limit", oracle("SELECT entity_id, event_id, rank FROM (SELECT entity_id, event_id, row_number() OVER (PARTITION BY entity_id ORDER BY t, event_id) AS rank FROM ev) WHERE rank<=20"))
def o02(spark, d):
    """First 20 rows per entity under a group limit."""
    e = R.table(spark, d, "events").select(F.col("user_id").alias("entity_id"), "event_id", "ts")
    return top_k(e, ["entity_id"], ["ts", "event_id"], 20).select("entity_id", "event_id", F.col("rank").cast("bigint").alias("rank"))


@query("o03_offset_limit_slice", oracle("SELECT annotation_id FROM annotations ORDER BY ws, annotation_id LIMIT 15 OFFSET 10"))
def o03(spark, d):
    """Windows 11 to 25 of a plan."""
    return names.slice_plan(R.annotations(spark, d), ["ws", "annotation_id"], start=11, count=15).select("annotation_id")


@query("o04_hash_ranked_sample", oracle("SELECT entity_id, sha256(entity_id::VARCHAR) AS h FROM (SELECT DISTINCT entity_id FROM states) ORDER BY h LIMIT 25"))
def o04(spark, d):
    """Stable sample of 25 entities by the rank of their SHA-256."""
    ids = R.states(spark, d).select("entity_id").distinct().withColumn("h", F.sha2(F.col("entity_id").cast("string"), 256))
    return ids.orderBy("h").limit(25).orderBy("entity_id")


@query("o05_nearest_event_pick", oracle("SELECT entity_id, arg_min(event_id, (abs(t-1705276800000000), event_id)) AS event_id FROM ev GROUP BY 1"))
def o05(spark, d):
    """Event of each entity nearest to a moment."""
    e = R.table(spark, d, "events").select(F.col("user_id").alias("entity_id"), "event_id", F.abs(R.micros("ts") - 1705276800000000).alias("dt"))
    return e.groupBy("entity_id").agg(F.min_by("event_id", F.struct("dt", "event_id")).alias("event_id"))


@query("u01_heterogeneous_union", oracle(f"SELECT 'elements' AS source, entity_id, {rsql('mean_motion', 9)} AS mean_motion, NULL::DOUBLE AS range_m FROM elements UNION ALL SELECT 'ranging', entity_id, NULL, {rsql('range_m', 3)} FROM ranging"))
def u01(spark, d):
    """Frames with different columns in one; absent columns are NULL."""
    a = R.elements(spark, d).select(F.lit("elements").alias("source"), "entity_id", rnd("mean_motion", 9).alias("mean_motion"))
    return a.unionByName(R.ranging(spark, d).select(F.lit("ranging").alias("source"), "entity_id", rnd("range_m", 3).alias("range_m")), allowMissingColumns=True)


@query("u02_intersect", oracle("SELECT entity_id, t//86400000000 AS day FROM elements INTERSECT SELECT entity_id, t//86400000000 FROM states"))
def u02(spark, d):
    """(entity, day) present in both sources."""
    day = lambda x: x.select("entity_id", slot("t", DAY_US).alias("day"))
    return day(R.elements(spark, d)).intersect(day(R.states(spark, d)))


@query("u03_except", oracle("SELECT entity_id, t//86400000000 AS day FROM elements EXCEPT SELECT entity_id, t//86400000000 FROM states"))
def u03(spark, d):
    """(entity, day) of the elements that have no state."""
    day = lambda x: x.select("entity_id", slot("t", DAY_US).alias("day"))
    return day(R.elements(spark, d)).subtract(day(R.states(spark, d)))


@query("u04_ordered_distinct_union", oracle("SELECT event_id, CASE WHEN k%2=0 THEN 'b,a,' || event_type || ',c' ELSE event_type || ',b,c' END AS merged FROM ev"))
def u04(spark, d):
    """First-seen order of two lists."""
    k = F.get_json_object("props", "$.k").cast("int")
    left = F.when(k % 2 == 0, F.array(F.lit("b"), F.lit("a"), F.lit("b"))).otherwise(F.array(F.col("event_type"), F.lit("b")))
    return R.table(spark, d, "events").select("event_id", F.array_join(ordered_union(left, F.array(F.col("event_type"), F.lit("b"), F.lit("c"))), ",").alias("merged"))
