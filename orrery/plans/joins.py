"""As-of, nearest, interval and matching queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.orbit import angle_delta, sma_from_mean_motion
from orrery.functions.time import iso
from orrery.operators import coverage, joins, matching
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.scan import DAY_US, HOUR_US, row_index, slot
from orrery.operators.windows import merge_spans
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rnd_span, rsql
from orrery.session import cut

EL = ["t", "mean_motion", "inclination", "eccentricity", "bstar"]
SMA_SQL = "pow(3.986004418e14::DOUBLE/(({0}/60.0)*({0}/60.0)), 1.0/3.0)"
WRAP_SQL = "(({0}+pi()) - floor(({0}+pi())/(2*pi()))*2*pi() - pi())"

BRACKET_CTE = """br AS (SELECT a.*, b.t AS bt, b.mean_motion AS bn, b.inclination AS bi, b.eccentricity AS be, b.bstar AS bb,
 c.t AS at_, c.mean_motion AS an, c.inclination AS ai, c.eccentricity AS ae, c.bstar AS ab
 FROM annotations a ASOF LEFT JOIN elements b ON a.entity_id=b.entity_id AND a.ws>=b.t
 ASOF LEFT JOIN elements c ON a.entity_id=c.entity_id AND a.we<=c.t)"""


def bracket(spark, d):
    return joins.bracket_join(R.annotations(spark, d), R.elements(spark, d), ["annotation_id"], ["entity_id"], "ws", "we", "t", EL)


@query("j01_bracketing_asof", oracle(f"""
SELECT annotation_id, entity_id, CASE WHEN bt IS NULL OR at_ IS NULL THEN 'insufficient_coverage' ELSE 'computed' END AS tle_status,
 {iso_sql('bt')} AS before_utc, {iso_sql('at_')} AS after_utc, {rsql('an-bn', 12)} AS delta_mean_motion, {rsql(WRAP_SQL.format('(ai-bi)'), 9)} AS delta_inclination,
 {rsql('ae-be', 9)} AS delta_eccentricity, {rsql('ab-bb', 9)} AS delta_bstar, {rsql(f"({SMA_SQL.format('an')} - {SMA_SQL.format('bn')})/1000.0")} AS delta_sma_km FROM br""", BRACKET_CTE))
def j01(spark, d):
    """Last elements at or before each window start, first at or after its end, and their differences."""
    b = bracket(spark, d)
    both = F.col("before").isNotNull() & F.col("after").isNotNull()
    return b.select(
        "annotation_id", "entity_id", F.when(both, "computed").otherwise("insufficient_coverage").alias("tle_status"),
        iso("before.t").alias("before_utc"), iso("after.t").alias("after_utc"),
        rnd(F.col("after.mean_motion") - F.col("before.mean_motion"), 12).alias("delta_mean_motion"),
        rnd(angle_delta(F.col("after.inclination"), F.col("before.inclination"))[0], 9).alias("delta_inclination"),
        rnd(F.col("after.eccentricity") - F.col("before.eccentricity"), 9).alias("delta_eccentricity"),
        rnd(F.col("after.bstar") - F.col("before.bstar"), 9).alias("delta_bstar"),
        rnd((sma_from_mean_motion(F.col("after.mean_motion")) - sma_from_mean_motion(F.col("before.mean_motion"))) / 1000.0).alias("delta_sma_km"),
    )


@query("j02_backward_asof_max_age", oracle(f"""
SELECT a.annotation_id, {iso_sql('e.t')} AS element_utc, {rsql('(a.event_t-e.t)/1e6', 3)} AS age_s,
 CASE WHEN e.t IS NULL THEN 'no_prior_element' WHEN a.event_t-e.t > 7*{DAY_US} THEN 'propagation_too_far' ELSE 'computed' END AS state_status,
 coalesce(a.event_t-e2.t < 12*{HOUR_US}, false) AS fresh_12h
FROM annotations a ASOF LEFT JOIN elements e ON a.entity_id=e.entity_id AND a.event_t>=e.t
ASOF LEFT JOIN elements e2 ON a.entity_id=e2.entity_id AND a.event_t>e2.t"""))
def j02(spark, d):
    """Latest prior elements with a 7-day age limit, and the strictly-earlier 12-hour variant."""
    a, e = R.annotations(spark, d), R.elements(spark, d)
    probes = {"m": joins.Probe("event_t"), "s": joins.Probe("event_t", strict=True)}
    out = joins.asof_probes(a, e, ["annotation_id"], ["entity_id"], "t", ["t"], probes)
    age = F.col("event_t") - F.col("m.t")
    return out.select(
        "annotation_id", iso("m.t").alias("element_utc"), rnd_span(age / 1e6).alias("age_s"),
        F.when(F.col("m").isNull(), "no_prior_element").when(age > 7 * DAY_US, "propagation_too_far").otherwise("computed").alias("state_status"),
        F.coalesce(F.col("event_t") - F.col("s.t") < 12 * HOUR_US, F.lit(False)).alias("fresh_12h"),
    )


NEAREST_CTE = """nb AS (SELECT a.*, b.t AS lo, b.event_id AS lo_id, c.t AS hi, c.event_id AS hi_id FROM {0} a
 ASOF LEFT JOIN {1} b ON a.{2}=b.{2} AND a.{3}>=b.t ASOF LEFT JOIN {1} c ON a.{2}=c.{2} AND a.{3}<=c.t)"""


@query("j03_nearest_epoch", oracle(f"""
SELECT annotation_id, CASE WHEN lo IS NULL OR hi-event_t < event_t-lo THEN hi_id ELSE lo_id END AS element_id,
 {rsql('least(coalesce(event_t-lo, hi-event_t), coalesce(hi-event_t, event_t-lo))/1e6', 3)} AS abs_dt_s FROM nb""",
    NEAREST_CTE.format("annotations", "elements", "entity_id", "event_t")))
def j03(spark, d):
    """Elements closest in time to each event; equal distances keep the earlier."""
    out = joins.nearest_join(R.annotations(spark, d), R.elements(spark, d), ["annotation_id"], ["entity_id"], "event_t", "t", ["event_id"])
    return out.select("annotation_id", F.col("nearest.event_id").alias("element_id"), rnd_span(F.abs(F.col("nearest.t") - F.col("event_t")) / 1e6).alias("abs_dt_s"))


@query("j04_nearest_within_tolerance", oracle(f"""
SELECT event_id, CASE WHEN ok THEN mid ELSE -1 END AS matched_id, CASE WHEN ok THEN {rsql('dt/1e6', 6)} END AS dt_s, ok AND dt<=60000000 AS exact FROM (
 SELECT event_id, CASE WHEN lo IS NULL OR hi-t <= t-lo THEN hi_id ELSE lo_id END AS mid, least(coalesce(t-lo, hi-t), coalesce(hi-t, t-lo)) AS dt,
  coalesce(least(coalesce(t-lo, hi-t), coalesce(hi-t, t-lo)) <= 1800000000, false) AS ok FROM nb)""",
    "npt AS (SELECT * FROM ranging WHERE record_type='npt'), frd AS (SELECT * FROM ranging WHERE record_type='frd')",
    NEAREST_CTE.format("frd", "npt", "station_id", "t")))
def j04(spark, d):
    """Full-rate points matched to the nearest normal point of the same station within a tolerance; ties keep the later."""
    r = R.ranging(spark, d)
    left = r.where("record_type = 'frd'")
    right = r.where("record_type = 'npt'").select("station_id", F.col("t").alias("nt"), F.col("event_id").alias("nid"))
    out = joins.nearest_join(left, right, ["event_id"], ["station_id"], "t", "nt", ["nid"], tie_later=True, tolerance_us=1_800_000_000)
    dt = F.abs(F.col("nearest.nt") - F.col("t"))
    return out.select("event_id", F.coalesce(F.col("nearest.nid"), F.lit(-1)).alias("matched_id"), rnd(dt / 1e6).alias("dt_s"), F.coalesce(dt <= 60_000_000, F.lit(False)).alias("exact"))


@query("j05_interval_overlap_audit", oracle(f"""
SELECT a.annotation_id, count(o.path) AS orbit_file_count, coalesce(string_agg(DISTINCT o.source_type, ',' ORDER BY o.source_type),'') AS source_types,
 coalesce(string_agg(o.path, ';' ORDER BY o.s, o.path),'') AS orbit_files,
 (SELECT count(*) FROM ranging_files r WHERE r.entity_id=a.entity_id AND r.s < a.we+{DAY_US} AND r.e > a.ws-{DAY_US}) AS ranging_file_count
FROM annotations a LEFT JOIN orbit_files o ON o.entity_id=a.entity_id AND o.s<a.we AND o.e>a.ws GROUP BY a.annotation_id, a.entity_id, a.ws, a.we"""))
def j05(spark, d):
    """Product files overlapping each window, with their names and types; ranging with a one-day margin."""
    a = R.annotations(spark, d)
    pairs = joins.spans_over_windows(R.orbit_files(spark, d), a.select("annotation_id", "entity_id", "ws", "we"), ["entity_id"], "s", "e", "ws", "we")
    files = pairs.groupBy("annotation_id").agg(
        F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_set("source_type")), ",").alias("types"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "path"))), lambda x: x["path"]), ";").alias("files"),
    )
    wide = a.select("annotation_id", "entity_id", (F.col("ws") - DAY_US).alias("lo"), (F.col("we") + DAY_US).alias("hi"))
    counted = joins.count_overlaps(wide, R.ranging_files(spark, d), ["annotation_id"], ["entity_id"], "lo", "hi", "s", "e", name="ranging_file_count")
    return counted.join(files, "annotation_id", "left").select(
        "annotation_id", F.coalesce("n", F.lit(0)).alias("orbit_file_count"), F.coalesce("types", F.lit("")).alias("source_types"),
        F.coalesce("files", F.lit("")).alias("orbit_files"), "ranging_file_count",
    )


PRESENCE_CTE = f"""pres AS (SELECT a.*,
 (SELECT count(*) FROM states s WHERE s.entity_id=a.entity_id AND s.t//1000*1000 BETWEEN a.ws AND a.we) AS orbit_sample_count,
 (SELECT count(*) FROM ranging s WHERE s.entity_id=a.entity_id AND s.t//1000*1000 BETWEEN a.ws-{DAY_US} AND a.we+{DAY_US}) AS slr_np_count,
 (SELECT count(*) FROM elements s WHERE s.entity_id=a.entity_id AND s.t//1000*1000 <= a.ws) AS tle_epochs_before,
 (SELECT count(*) FROM elements s WHERE s.entity_id=a.entity_id AND s.t//1000*1000 >= a.we) AS tle_epochs_after FROM annotations a)"""
STATUS_CTE = """cov0 AS (SELECT *, CASE WHEN tle_epochs_before>0 AND tle_epochs_after>0 THEN 'covered' ELSE 'missing' END AS tle_status,
 CASE WHEN slr_np_count>0 THEN 'covered' ELSE 'missing' END AS slr_status, CASE WHEN orbit_sample_count>0 THEN 'covered' ELSE 'missing' END AS orbit_status FROM pres),
cov AS (SELECT *, CASE WHEN tle_status='covered' AND slr_status='covered' AND orbit_status='covered' THEN 'A' WHEN tle_status='covered' AND orbit_status='covered' THEN 'B' ELSE 'C' END AS coverage_tier,
 concat_ws(',', CASE WHEN tle_status<>'covered' THEN 'tle' END, CASE WHEN slr_status<>'covered' THEN 'slr' END, CASE WHEN orbit_status<>'covered' THEN 'orbit' END) AS missing_sources,
 tle_status='covered' AND slr_status='covered' AND orbit_status='covered' AS aligned FROM cov0)"""


def covered_windows(spark, d):
    return coverage.presence_coverage(R.annotations(spark, d), R.elements(spark, d), R.states(spark, d), R.ranging(spark, d))


@query("j06_presence_counts", oracle(
    "SELECT annotation_id, orbit_sample_count, slr_np_count, tle_epochs_before, tle_epochs_after, tle_status, slr_status, orbit_status, coverage_tier FROM cov",
    PRESENCE_CTE, STATUS_CTE))
def j06(spark, d):
    """Inclusive sample counts per window and source by differences of running counts."""
    return covered_windows(spark, d).select(
        "annotation_id", "orbit_sample_count", "slr_np_count", "tle_epochs_before", "tle_epochs_after", "tle_status", "slr_status", "orbit_status", "coverage_tier"
    )


@query("j07_band_samples", oracle(f"""
SELECT a.annotation_id, count(*) FILTER (s.t>=a.ws-12*{HOUR_US} AND s.t<a.ws) AS n_before, count(*) FILTER (s.t>=a.ws AND s.t<=a.we) AS n_during,
 count(*) FILTER (s.t>a.we AND s.t<=a.we+12*{HOUR_US}) AS n_after, {rsql(f'median(s.x) FILTER (s.t>=a.ws-12*{HOUR_US} AND s.t<a.ws)', 3)} AS median_before,
 {rsql(f'median(s.x) FILTER (s.t>a.we AND s.t<=a.we+12*{HOUR_US})', 3)} AS median_after
FROM annotations a JOIN (SELECT entity_id, t, sqrt(x*x+y*y+z*z) AS x FROM states) s ON s.entity_id=a.entity_id AND s.t BETWEEN a.ws-12*{HOUR_US} AND a.we+12*{HOUR_US} GROUP BY a.annotation_id"""))
def j07(spark, d):
    """Samples in the 12-hour bands before and after each window, and their medians."""
    from orrery.operators.response import band_samples

    s = R.states(spark, d).select("entity_id", "t", F.sqrt(F.col("x") ** 2 + F.col("y") ** 2 + F.col("z") ** 2).alias("radius"))
    b = band_samples(s, R.annotations(spark, d))
    n = b.groupBy("annotation_id").agg(*[F.count_if(F.col("band") == x).alias(f"n_{x}") for x in ("before", "during", "after")])
    q = exact_quantiles(b, ["annotation_id"], {f"median_{x}": (F.when(F.col("band") == x, F.col("radius")), 0.5) for x in ("before", "after")})
    return n.join(q, "annotation_id", "left").select("annotation_id", "n_before", "n_during", "n_after", rnd("median_before", 3).alias("median_before"), rnd("median_after", 3).alias("median_after"))


PRIORITY_SQL = "(CASE WHEN source_type='precise_orbit' THEN 0 ELSE 1 END + CASE WHEN path LIKE 'POEORB%' THEN -0.5 WHEN path LIKE 'MOEORB%' THEN 0.5 ELSE 0 END)"


def file_priority():
    up = F.upper("path")
    return F.when(F.col("source_type") == "precise_orbit", 0.0).otherwise(1.0) + F.when(up.contains("POEORB"), -0.5).when(up.contains("MOEORB"), 0.5).otherwise(0.0)


FILE_PAIRS_CTE = f"fp AS (SELECT a.annotation_id, o.*, CAST({PRIORITY_SQL} AS DOUBLE) AS pr FROM annotations a JOIN orbit_files o ON o.entity_id=a.entity_id AND o.s<a.we+12*{HOUR_US} AND o.e>a.ws-12*{HOUR_US})"


def file_pairs(spark, d):
    a = R.annotations(spark, d).select("annotation_id", "entity_id", (F.col("ws") - 12 * HOUR_US).alias("lo"), (F.col("we") + 12 * HOUR_US).alias("hi"))
    return joins.spans_over_windows(R.orbit_files(spark, d).withColumn("pr", file_priority()), a, ["entity_id"], "s", "e", "lo", "hi")


def best_files(spark, d):
    p = file_pairs(spark, d)
    best = p.groupBy("annotation_id").agg(F.min("pr").alias("best"))
    return p.join(best, "annotation_id").where(F.col("pr") == F.col("best")).select("annotation_id", "path", "source_type", "pr")


@query("j08_best_priority_files", oracle(
    "SELECT annotation_id, path, pr AS priority FROM (SELECT *, rank() OVER (PARTITION BY annotation_id ORDER BY pr) AS rk FROM fp) WHERE rk=1", FILE_PAIRS_CTE))
def j08(spark, d):
    """All overlapping files at the best product priority of each window."""
    return best_files(spark, d).select("annotation_id", "path", F.col("pr").alias("priority"))


@query("j09_ranked_candidates", oracle(
    "SELECT annotation_id, path, row_number() OVER (PARTITION BY annotation_id ORDER BY source_type, -part, path) AS choice FROM fp", FILE_PAIRS_CTE))
def j09(spark, d):
    """Overlapping candidates of each window ranked by series, newest version, name."""
    p = file_pairs(spark, d)
    order = Window.partitionBy("annotation_id").orderBy("source_type", F.desc("part"), "path")  # sorted and spilled, never held as a list
    return p.select("annotation_id", "path", F.row_number().over(order).cast("bigint").alias("choice"))


def numbered(df, t, extra=()):
    return row_index(df, ["entity_id"], [t, *extra], slot(t, DAY_US), "seq")


def match_lists(spark, d):
    """Both lists with their numbers, written: a match reads them several times, and its caller once more."""
    q = numbered(R.annotations(spark, d), "event_t", ["annotation_id"])
    x = numbered(R.external_times(spark, d), "xt", ["event_id"])
    return cut(q), cut(x)


GREEDY_CTE = """qn AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY event_t, annotation_id) AS seq FROM annotations),
xn AS (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY xt, event_id) AS seq FROM external_times),
gp AS (SELECT days, entity_id, q.seq AS qs, x.seq AS rs, row_number() OVER (PARTITION BY days, entity_id ORDER BY abs(xt-event_t), q.seq, x.seq) AS i
  FROM qn q JOIN xn x USING (entity_id) JOIN (VALUES {days}) v(days) ON abs(xt-event_t) <= days*86400000000),
gr AS (SELECT DISTINCT days, entity_id, 0::BIGINT AS i, []::BIGINT[] AS uq, []::BIGINT[] AS ur FROM gp
  UNION ALL SELECT g.days, g.entity_id, p.i, CASE WHEN list_contains(uq, qs) OR list_contains(ur, rs) THEN uq ELSE list_append(uq, qs) END, CASE WHEN list_contains(uq, qs) OR list_contains(ur, rs) THEN ur ELSE list_append(ur, rs) END
  FROM gr g JOIN gp p ON p.days = g.days AND p.entity_id = g.entity_id AND p.i = g.i + 1),
gm AS (SELECT days, entity_id, unnest(uq) AS qs, unnest(ur) AS rs FROM (SELECT days, entity_id, arg_max(uq, i) AS uq, arg_max(ur, i) AS ur FROM gr GROUP BY 1, 2)),
gx AS (SELECT m.days, m.entity_id, q.seq, q.annotation_id, x.event_id, x.xt - q.event_t AS off FROM gm m JOIN qn q ON q.entity_id = m.entity_id AND q.seq = qs JOIN xn x ON x.entity_id = m.entity_id AND x.seq = rs)"""


@query("j10_greedy_unique_match", oracle(f"SELECT entity_id, annotation_id, event_id, {rsql('off/1e6')} AS offset_s FROM gx", GREEDY_CTE.format(days="(1.0)"), recursive=True))
def j10(spark, d):
    """Bijective match of reported and external event times within a day."""
    q, x = match_lists(spark, d)
    m = matching.greedy_match(q, x, "event_t", "xt", DAY_US)
    return (
        m.join(q.select("entity_id", F.col("seq").alias("query_seq"), "annotation_id"), ["entity_id", "query_seq"])
        .join(x.select("entity_id", F.col("seq").alias("reference_seq"), "event_id"), ["entity_id", "reference_seq"])
        .select("entity_id", "annotation_id", "event_id", rnd(F.col("offset_us") / 1e6).alias("offset_s"))
    )


@query("j11_anti_overlap_exclusion", oracle(f"""
SELECT DISTINCT entity_id, {iso_sql('s')} AS start_utc FROM series_w w WHERE NOT EXISTS (SELECT 1 FROM spans x WHERE x.status='F' AND x.entity_id=w.entity_id AND x.s < w.s+30*{HOUR_US} AND x.e > w.s)""",
    "series_w AS (SELECT o_orderkey, entity_id, s FROM spans WHERE status<>'F')"))
def j11(spark, d):
    """Candidate windows that overlap no exclusion; exclusions are merged first, so one as-of join decides."""
    sp = R.spans(spark, d)
    merged = merge_spans(sp.where("status = 'F'"), ["entity_id"], "s", "e").select("entity_id", F.col("s").alias("xs"), F.col("e").alias("xe"))
    w = sp.where("status <> 'F'").select("entity_id", "s").distinct().withColumn("e", F.col("s") + 30 * HOUR_US)
    return joins.overlaps_merged(w, merged, ["entity_id", "s"], ["entity_id"], "s", "e", "xs", "xe").where(~F.col("overlaps")).select("entity_id", iso("s").alias("start_utc"))


@query("j12_uncovered_windows", oracle(
    "SELECT annotation_id, entity_id FROM annotations a WHERE NOT EXISTS (SELECT 1 FROM orbit_files o WHERE o.entity_id=a.entity_id AND o.s<a.we AND o.e>a.ws)"))
def j12(spark, d):
    """Windows no local product overlaps."""
    out = joins.count_overlaps(R.annotations(spark, d), R.orbit_files(spark, d), ["annotation_id"], ["entity_id"], "ws", "we", "s", "e")
    return out.where(F.col("n_spans") == 0).select("annotation_id", "entity_id")


@query("j13_equi_joins", oracle("""
SELECT a.annotation_id, a.entity_id, coalesce(t.batch,'') AS batch, c.coverage_tier FROM annotations a LEFT JOIN targets t ON a.entity_id=t.entity_id AND t.enabled JOIN cov c ON c.annotation_id=a.annotation_id""",
    PRESENCE_CTE, STATUS_CTE))
def j13(spark, d):
    """Annotations joined to their target and tier; missing batch becomes ''. Both right keys are unique."""
    t = R.targets(spark, d).where("enabled").select("entity_id", "batch")
    c = covered_windows(spark, d).select("annotation_id", "coverage_tier")
    return R.annotations(spark, d).join(t, "entity_id", "left").join(c, "annotation_id").select("annotation_id", "entity_id", F.coalesce("batch", F.lit("")).alias("batch"), "coverage_tier")


@query("j14_semi_join_ids", oracle(f"SELECT event_id, entity_id, {rsql('mean_motion', 9)} AS mean_motion FROM elements WHERE entity_id IN (SELECT entity_id FROM annotations)"))
def j14(spark, d):
    """Element rows of the entities that have a reported event."""
    return R.elements(spark, d).join(R.annotations(spark, d).select("entity_id"), "entity_id", "left_semi").select("event_id", "entity_id", rnd("mean_motion", 9).alias("mean_motion"))


@query("j15_orphan_ids", oracle("SELECT event_id, entity_id FROM external_times WHERE entity_id NOT IN (SELECT entity_id FROM annotations)"))
def j15(spark, d):
    """External events of entities without any annotation."""
    return R.external_times(spark, d).join(R.annotations(spark, d).select("entity_id"), "entity_id", "left_anti").select("event_id", "entity_id")


@query("j16_outer_id_union", oracle(f"""
SELECT coalesce(a.entity_id,b.entity_id) AS entity_id, coalesce(a.n,0) AS element_rows, coalesce(b.n,0) AS external_rows, {iso_sql('a.lo')} AS element_start_utc, {iso_sql('b.hi')} AS external_end_utc,
 a.entity_id IS NOT NULL AND b.entity_id IS NOT NULL AS in_both
FROM (SELECT entity_id, count(*) n, min(t) lo FROM elements GROUP BY 1) a FULL JOIN (SELECT entity_id, count(*) n, max(xt) hi FROM external_times GROUP BY 1) b ON a.entity_id=b.entity_id"""))
def j16(spark, d):
    """Every entity of either source with its counts and ranges."""
    a = R.elements(spark, d).groupBy("entity_id").agg(F.count(F.lit(1)).alias("na"), F.min("t").alias("lo"))
    b = R.external_times(spark, d).groupBy("entity_id").agg(F.count(F.lit(1)).alias("nb"), F.max("xt").alias("hi"))
    return a.join(b, "entity_id", "full_outer").select(
        "entity_id", F.coalesce("na", F.lit(0)).alias("element_rows"), F.coalesce("nb", F.lit(0)).alias("external_rows"), iso("lo").alias("element_start_utc"),
        iso("hi").alias("external_end_utc"), (F.col("na").isNotNull() & F.col("nb").isNotNull()).alias("in_both"),
    )


@query("j17_validity_interval_dimension", oracle(f"""
SELECT r.event_id, s.soln, {rsql('s.pos + s.vel*(r.t-s.ref)/31557600e6', 6)} AS station_pos FROM ranging r JOIN LATERAL (
 SELECT * FROM sol s WHERE s.station_id=r.station_id AND s.s<=r.t ORDER BY s.s DESC LIMIT 1) s ON true WHERE s.e IS NULL OR r.t<s.e
UNION ALL SELECT r.event_id, s.soln, {rsql('s.pos + s.vel*(r.t-s.ref)/31557600e6', 6)} FROM ranging r JOIN sol s ON s.station_id=r.station_id AND s.soln=1 WHERE r.t < s.s
UNION ALL SELECT r.event_id, l.soln, {rsql('l.pos + l.vel*(r.t-l.ref)/31557600e6', 6)} FROM ranging r JOIN LATERAL (
 SELECT * FROM sol s WHERE s.station_id=r.station_id AND s.s<=r.t ORDER BY s.s DESC LIMIT 1) c ON c.e IS NOT NULL AND r.t>=c.e
 JOIN (SELECT *, row_number() OVER (PARTITION BY station_id ORDER BY s DESC) AS rn FROM sol) l ON l.station_id=r.station_id AND l.rn=1""",
    f"""sol AS (SELECT *, CASE WHEN nxt IS NULL THEN NULL WHEN soln%3=0 THEN s+(nxt-s)//2 ELSE nxt END AS e FROM (SELECT station_id, s, row_number() OVER (PARTITION BY station_id ORDER BY s) AS soln, lead(s) OVER (PARTITION BY station_id ORDER BY s) AS nxt,
 pos, vel, s AS ref FROM (SELECT k%20 AS station_id, t//{DAY_US*7}*{DAY_US*7} AS s, min(value)*1e3 AS pos, max(value)*1e-3 AS vel FROM ev WHERE event_type='signup' GROUP BY 1,2)))"""))
def j17(spark, d):
    """Station solution valid at each point: the covering one, before the first the first, in a hole or after the end the last."""
    sol = station_solutions(spark, d)
    r = R.ranging(spark, d)
    pay = ["s", "e", "soln", "pos", "vel", "ref"]
    out = joins.asof_probes(r, sol, ["event_id"], ["station_id"], "s", pay, {"c": joins.Probe("t")})
    ends = sol.groupBy("station_id").agg(F.min_by(F.struct(*pay), "s").alias("first"), F.max_by(F.struct(*pay), "s").alias("last"))
    out = out.join(ends, "station_id")
    pick = F.when(F.col("c").isNull(), F.col("first")).when(F.col("c.e").isNull() | (F.col("t") < F.col("c.e")), F.col("c")).otherwise(F.col("last"))
    out = out.withColumn("p", pick)
    return out.select("event_id", F.col("p.soln").alias("soln"), rnd(F.col("p.pos") + F.col("p.vel") * (F.col("t") - F.col("p.ref")) / 31557600e6).alias("station_pos"))


def station_solutions(spark, d):
    ev = R._events(spark, d, "signup")
    week = 7 * DAY_US
    base = ev.groupBy((F.col("k") % 20).alias("station_id"), (F.floor(F.col("t") / week) * week).cast("bigint").alias("s")).agg((F.min("value") * 1e3).alias("pos"), (F.max("value") * 1e-3).alias("vel"))
    # one row per station and week: the dimension is small per station by construction
    w = F.row_number().over(Window.partitionBy("station_id").orderBy("s"))
    nxt = F.lead("s").over(Window.partitionBy("station_id").orderBy("s"))
    base = base.withColumns({"soln": w.cast("bigint"), "nxt": nxt, "ref": F.col("s")})
    return base.withColumn("e", F.when(F.col("nxt").isNull(), F.lit(None)).when(F.col("soln") % 3 == 0, F.col("s") + F.floor((F.col("nxt") - F.col("s")) / 2)).otherwise(F.col("nxt")).cast("bigint"))


SPANCOV_CTE = f"""ship AS (SELECT a.annotation_id, a.entity_id,
 CASE WHEN EXISTS (SELECT 1 FROM elements e WHERE e.entity_id=a.entity_id AND e.t<=a.ws) AND EXISTS (SELECT 1 FROM elements e WHERE e.entity_id=a.entity_id AND e.t>=a.we) THEN 'covered' ELSE 'missing' END AS tle_status,
 CASE WHEN EXISTS (SELECT 1 FROM ranging_files r WHERE r.entity_id=a.entity_id AND r.s<a.we+{DAY_US} AND r.e>a.ws-{DAY_US}) THEN 'covered' ELSE 'missing' END AS slr_status,
 CASE WHEN EXISTS (SELECT 1 FROM orbit_files r WHERE r.entity_id=a.entity_id AND r.s<a.we AND r.e>a.ws) THEN 'covered' ELSE 'missing' END AS orbit_status FROM annotations a),
shipt AS (SELECT *, CASE WHEN tle_status='covered' AND slr_status='covered' AND orbit_status='covered' THEN 'A' WHEN tle_status='covered' AND orbit_status='covered' THEN 'B' ELSE 'C' END AS coverage_tier FROM ship)"""


def shipped_labels(spark, d):
    return coverage.span_coverage(R.annotations(spark, d), R.elements(spark, d), R.ranging_files(spark, d), R.orbit_files(spark, d))


DIFF_CTE = """dif AS (SELECT s.annotation_id, s.entity_id, f.field, f.o AS old, f.n AS new FROM shipt s JOIN cov c ON s.annotation_id=c.annotation_id,
 LATERAL (VALUES ('tle_status', s.tle_status, c.tle_status), ('slr_status', s.slr_status, c.slr_status), ('orbit_status', s.orbit_status, c.orbit_status), ('coverage_tier', s.coverage_tier, c.coverage_tier)) f(field,o,n) WHERE f.o<>f.n),
difc AS (SELECT *, CASE WHEN field='coverage_tier' THEN 'tier_follows_status' WHEN old='covered' AND field='orbit_status' THEN 'semantics_flip_orbit' WHEN old='covered' AND field='slr_status' THEN 'semantics_flip_slr' ELSE 'unexpected' END AS category,
 CASE WHEN field='coverage_tier' THEN 'tier_change' WHEN old='covered' AND field='tle_status' THEN 'tle_downgrade' WHEN old='covered' THEN 'status_downgrade' ELSE 'status_upgrade' END AS kind FROM dif)"""


@query("j18_table_diff", oracle("SELECT annotation_id, field, old, new, category, kind FROM difc", SPANCOV_CTE, PRESENCE_CTE, STATUS_CTE, DIFF_CTE))
def j18(spark, d):
    """Span-based statuses and tiers against those recomputed from samples, field by field."""
    return coverage.status_diff(shipped_labels(spark, d), covered_windows(spark, d)).select("annotation_id", "field", "old", "new", "category", "kind")


@query("j19_parameter_grid", oracle("""
SELECT entity_id, tol AS tolerance_days, n_annotations, floor(n_annotations*tol) AS scaled FROM (SELECT entity_id, count(*) AS n_annotations FROM annotations GROUP BY 1), (VALUES (0.5::DOUBLE),(1.0),(2.0)) g(tol)"""))
def j19(spark, d):
    """Each entity repeated for each value of a fixed three-step tolerance grid (explode, no cross join)."""
    grid = F.explode(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0)))
    per = R.annotations(spark, d).groupBy("entity_id").agg(F.count(F.lit(1)).alias("n_annotations"))
    return per.select("entity_id", grid.alias("tolerance_days"), "n_annotations").withColumn("scaled", F.floor(F.col("n_annotations") * F.col("tolerance_days")).cast("double"))


@query("j20_registry_routed_evidence", oracle(f"""
SELECT a.annotation_id, r.semantics, CASE WHEN r.artifact='' THEN 'artifact_unregistered' ELSE '' END AS error_kind,
 CASE WHEN r.artifact='' THEN 'missing' WHEN r.semantics='orbit_states' AND EXISTS (SELECT 1 FROM states s WHERE s.entity_id=a.entity_id AND s.t BETWEEN a.ws AND a.we) THEN 'covered'
  WHEN r.semantics='tracking_availability' AND EXISTS (SELECT 1 FROM orbit_files o WHERE o.entity_id=a.entity_id AND o.s<a.we AND o.e>a.ws) THEN 'covered' ELSE 'missing' END AS orbit_status
FROM annotations a JOIN reg r ON a.entity_id=r.entity_id""",
    "reg AS (SELECT entity_id, CASE batch WHEN 'MACHINERY' THEN '' ELSE 'evidence/' || entity_id END AS artifact, CASE WHEN batch='BUILDING' THEN 'tracking_availability' ELSE 'orbit_states' END AS semantics FROM targets)"))
def j20(spark, d):
    """A registry row per entity decides whether presence or span rules apply, and which artifacts are absent."""
    reg = R.targets(spark, d).select(
        "entity_id", F.when(F.col("batch") == "MACHINERY", "").otherwise(F.concat(F.lit("evidence/"), F.col("entity_id"))).alias("artifact"),
        F.when(F.col("batch") == "BUILDING", "tracking_availability").otherwise("orbit_states").alias("semantics"),
    )
    w = R.annotations(spark, d).join(reg, "entity_id")
    w = joins.count_within(w, R.states(spark, d), ["annotation_id"], ["entity_id"], "ws", "we", "t", name="n_points")
    w = joins.count_overlaps(w, R.orbit_files(spark, d), ["annotation_id"], ["entity_id"], "ws", "we", "s", "e", name="n_files")
    absent = F.col("artifact") == ""
    hits = F.when(F.col("semantics") == "orbit_states", F.col("n_points")).otherwise(F.col("n_files"))
    return w.select(
        "annotation_id", "semantics", F.when(absent, "artifact_unregistered").otherwise("").alias("error_kind"),
        F.when(~absent & (hits > 0), "covered").otherwise("missing").alias("orbit_status"),
    )
