"""Window generation and labelling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.flags import covered, missing_flags
from orrery.functions.time import iso
from orrery.operators import joins, labels, response, windows
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, row_index, slot
from orrery.plans.joins import BRACKET_CTE, DIFF_CTE, PRESENCE_CTE, SMA_SQL, SPANCOV_CTE, STATUS_CTE, covered_windows, shipped_labels
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rsql
from orrery.session import cut


@query("w01_event_windows", oracle(f"SELECT annotation_id, entity_id, {iso_sql('ws')} AS window_start_utc, {iso_sql('we')} AS window_end_utc, 'event' AS event_label, 'C' AS confidence_tier FROM annotations"))
def w01(spark, d):
    """Analysis window around each reported event."""
    w = windows.event_windows(R.annotations(spark, d).drop("ws", "we"))
    return w.select("annotation_id", "entity_id", iso("ws").alias("window_start_utc"), iso("we").alias("window_end_utc"), "event_label", "confidence_tier")


def merged_cte(name: str, src: str) -> str:
    return f"""{name} AS (SELECT entity_id, min(s) AS s, max(e) AS e, count(*) AS members FROM (SELECT *, sum(fresh) OVER (PARTITION BY entity_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS isl FROM (
 SELECT *, CASE WHEN reach IS NULL OR s>reach THEN 1 ELSE 0 END AS fresh FROM (SELECT *, max(e) OVER (PARTITION BY entity_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM {src}))) GROUP BY entity_id, isl)"""


@query("w02_interval_merge", oracle(f"SELECT entity_id, {iso_sql('s')} AS start_utc, {iso_sql('e')} AS end_utc, members FROM mg", merged_cte("mg", "spans")))
def w02(spark, d):
    """Overlapping and touching spans of an entity merged."""
    m = windows.merge_spans(R.spans(spark, d), ["entity_id"], "s", "e")
    return m.select("entity_id", iso("s").alias("start_utc"), iso("e").alias("end_utc"), "members")


MISSION_CTE = "mission AS (SELECT entity_id, min(t) AS m0, max(t) AS m1 FROM elements GROUP BY 1)"
GRID_CTE = f"grid AS (SELECT entity_id, m0+i*30*{HOUR_US} AS ws, m0+(i+1)*30*{HOUR_US} AS we FROM (SELECT *, unnest(range(0, (m1-m0)//(30*{HOUR_US}))) AS i FROM mission))"


@query("w03_grid_candidates", oracle(f"SELECT entity_id, {iso_sql('ws')} AS start_utc, {iso_sql('we')} AS end_utc FROM grid", MISSION_CTE, GRID_CTE))
def w03(spark, d):
    """30-hour grid over the element coverage."""
    m = R.elements(spark, d).groupBy("entity_id").agg(F.min("t").alias("m0"), F.max("t").alias("m1"))
    return windows.grid_candidates(m, "m0", "m1").select("entity_id", iso("ws").alias("start_utc"), iso("we").alias("end_utc"))


def picked_cte(name: str, cand: str, quota: str) -> str:
    return f"""{name} AS (SELECT * FROM (SELECT *, least(greatest(1, coalesce(q,0)), n) AS take FROM (SELECT c.*, x.q, row_number() OVER (PARTITION BY c.entity_id, c.yr ORDER BY c.ws)-1 AS pos, count(*) OVER (PARTITION BY c.entity_id, c.yr) AS n
 FROM {cand} c LEFT JOIN {quota} x ON x.entity_id=c.entity_id AND x.yr=c.yr)) WHERE take=n OR (take=1 AND pos=(n-1)//2) OR (take>1 AND list_contains(list_transform(range(0,take::BIGINT), lambda i: round_even(i*(n-1)::DOUBLE/(take-1),0)::BIGINT), pos)))"""


@query("w04_even_yearly_selection", oracle(f"SELECT entity_id, {iso_sql('ws')} AS start_utc FROM pk",
    "cand AS (SELECT DISTINCT entity_id, s AS ws, year(make_timestamp(s)) AS yr FROM spans WHERE status<>'F')",
    "quo AS (SELECT entity_id, year(make_timestamp(s)) AS yr, count(*)//3 AS q FROM spans WHERE status='F' GROUP BY 1,2)", picked_cte("pk", "cand", "quo")))
def w04(spark, d):
    """Evenly spaced candidates per entity and year up to a quota."""
    sp = R.spans(spark, d)
    cand = sp.where("status <> 'F'").select("entity_id", F.col("s").alias("ws")).distinct().withColumn("year", windows.year_of("ws"))
    quota = sp.where("status = 'F'").groupBy("entity_id", windows.year_of("s").alias("year")).agg(F.floor(F.count(F.lit(1)) / 3).alias("quota"))
    return windows.pick_evenly(cand, quota, ["entity_id", "year"]).select("entity_id", iso("ws").alias("start_utc"))


QUIET_CTES = [
    MISSION_CTE, GRID_CTE, f"blk AS (SELECT entity_id, ws-24*{HOUR_US} AS s, we+24*{HOUR_US} AS e FROM annotations)",
    "free AS (SELECT *, year(make_timestamp(ws)) AS yr FROM grid g WHERE NOT EXISTS (SELECT 1 FROM blk b WHERE b.entity_id=g.entity_id AND b.s<g.we AND b.e>g.ws))",
    "quo AS (SELECT entity_id, year(make_timestamp(ws)) AS yr, count(*) AS q FROM annotations GROUP BY 1,2)", picked_cte("pk", "free", "quo"),
    f"""quiet0 AS (SELECT entity_id, ws, we, CASE WHEN EXISTS (SELECT 1 FROM elements e WHERE e.entity_id=p.entity_id AND e.t<=p.ws) AND EXISTS (SELECT 1 FROM elements e WHERE e.entity_id=p.entity_id AND e.t>=p.we) THEN 'covered' ELSE 'missing' END AS tle_status,
 CASE WHEN EXISTS (SELECT 1 FROM ranging_files r WHERE r.entity_id=p.entity_id AND r.s<p.we+{DAY_US} AND r.e>p.ws-{DAY_US}) THEN 'covered' ELSE 'missing' END AS slr_status,
 CASE WHEN EXISTS (SELECT 1 FROM orbit_files r WHERE r.entity_id=p.entity_id AND r.s<p.we AND r.e>p.ws) THEN 'covered' ELSE 'missing' END AS orbit_status,
 'stab_' || substr(md5(entity_id || '|' || CASE WHEN ws%1000000=0 THEN strftime(make_timestamp(ws),'%Y-%m-%dT%H:%M:%SZ') ELSE strftime(make_timestamp(ws),'%Y-%m-%dT%H:%M:%S.%gZ') END || '|' || CASE WHEN we%1000000=0 THEN strftime(make_timestamp(we),'%Y-%m-%dT%H:%M:%SZ') ELSE strftime(make_timestamp(we),'%Y-%m-%dT%H:%M:%S.%gZ') END),1,12) AS annotation_id FROM pk p)""",
    "quiet AS (SELECT *, CASE WHEN tle_status='covered' AND slr_status='covered' AND orbit_status='covered' THEN 'A' WHEN tle_status='covered' AND orbit_status='covered' THEN 'B' ELSE 'C' END AS coverage_tier FROM quiet0)",
]


def quiet(spark, d):
    return windows.quiet_windows(R.annotations(spark, d), R.elements(spark, d), R.ranging_files(spark, d), R.orbit_files(spark, d))


@query("w05_quiet_window_mining", oracle(f"SELECT annotation_id, entity_id, {iso_sql('ws')} AS start_utc, tle_status, slr_status, orbit_status, coverage_tier FROM quiet", *QUIET_CTES))
def w05(spark, d):
    """No-event windows: grid, exclusion of buffered events, even yearly pick, coverage."""
    return quiet(spark, d).select("annotation_id", "entity_id", iso("ws").alias("start_utc"), "tle_status", "slr_status", "orbit_status", "coverage_tier")


@query("w05_quiet_window_summary", oracle("""SELECT a.entity_id, a.requested, coalesce(f.found,0) AS found, coalesce(f.ta,0) AS tier_a, coalesce(ev.n,0) AS events, coalesce(f.found,0)<a.requested AS constrained FROM (
 SELECT m.entity_id, CAST(sum(greatest(1, coalesce(q.q,0))) AS BIGINT) AS requested FROM (SELECT entity_id, unnest(range(year(make_timestamp(m0)), year(make_timestamp(m1))+1)) AS yr FROM mission) m LEFT JOIN quo q ON q.entity_id=m.entity_id AND q.yr=m.yr GROUP BY 1) a
 LEFT JOIN (SELECT entity_id, count(*) AS found, count(*) FILTER (coverage_tier='A') AS ta FROM quiet GROUP BY 1) f ON f.entity_id=a.entity_id LEFT JOIN (SELECT entity_id, count(*) AS n FROM annotations GROUP BY 1) ev ON ev.entity_id=a.entity_id""", *QUIET_CTES))
def w05s(spark, d):
    """Requested and found no-event windows per entity."""
    s = windows.quiet_window_summary(quiet(spark, d), R.annotations(spark, d), R.elements(spark, d))
    return s.select("entity_id", F.col("requested").cast("bigint").alias("requested"), "found", F.col("tier_A").alias("tier_a"), "events", "constrained")


@query("w06_mission_tail_windows", oracle(f"SELECT o_orderkey, {iso_sql('cutoff')} AS cutoff_utc FROM (SELECT *, max(e) OVER (PARTITION BY entity_id)-365*{DAY_US} AS cutoff FROM spans WHERE e<=957139200000000) WHERE e>=cutoff"))
def w06(spark, d):
    """Spans ending in the last year of each entity, as of a date."""
    return windows.tail_windows(R.spans(spark, d), ["entity_id"], "e", 365, as_of_us=957139200000000).select("o_orderkey", iso("cutoff").alias("cutoff_utc"))


@query("w07_coverage_matched_sample", oracle("""SELECT l_orderkey, l_linenumber FROM (SELECT p.*, row_number() OVER (PARTITION BY p.entity_id, p.pool ORDER BY md5('42|' || l_orderkey || '|' || l_linenumber), l_orderkey, l_linenumber, l_partkey) AS rk,
 CASE WHEN pool='A' THEN least(na, round_even(frac*n_total,0)) ELSE least(n-na, n_total-least(na, round_even(frac*n_total,0))) END AS want FROM (
 SELECT s.*, CASE WHEN rf='A' THEN 'A' ELSE 'other' END AS pool, c.*EXCLUDE(entity_id) FROM shipments s JOIN cnt c ON c.entity_id=s.entity_id WHERE s.ls='O') p) WHERE rk<=want""",
    """cnt AS (SELECT *, least(n, floor(na/frac)) AS n_total FROM (SELECT entity_id, count(*) FILTER (ls='O') AS n, count(*) FILTER (ls='O' AND rf='A') AS na, (count(*) FILTER (ls='F' AND rf='A'))::DOUBLE/(count(*) FILTER (ls='F')) AS frac FROM shipments GROUP BY 1) WHERE frac>0 AND na>0)"""))
def w07(spark, d):
    """Controls (status O) resampled per entity to the events' (status F) share of tier A, by hash rank.

    Members differ from any seeded library RNG; the counts are the same. Counts are
    aggregates; the pick is a window over (entity, pool) hash bands joined by threshold,
    so no pool is sorted in one task.
    """
    s = R.shipments(spark, d).withColumn("tier", F.when(F.col("rf") == "A", "A").otherwise("other"))
    return windows.coverage_matched(s.where("ls = 'O'"), s.where("ls = 'F'"), ["l_orderkey", "l_linenumber", "l_partkey"], seed=42).select("l_orderkey", "l_linenumber")


@query("w08_quiet_arc", oracle(f"""SELECT entity_id, {iso_sql('lo')} AS gap_start_utc, {iso_sql('hi')} AS gap_end_utc, {iso_sql(f'(SELECT min(t) FROM states s WHERE s.entity_id=q.entity_id AND s.t BETWEEN (lo+hi)//2-5*{DAY_US}//2 AND (lo+hi)//2+5*{DAY_US}//2)')} AS arc_start_utc,
 {iso_sql(f'(SELECT max(t) FROM states s WHERE s.entity_id=q.entity_id AND s.t BETWEEN (lo+hi)//2-5*{DAY_US}//2 AND (lo+hi)//2+5*{DAY_US}//2)')} AS arc_end_utc FROM (
 SELECT g.*, row_number() OVER (PARTITION BY g.entity_id ORDER BY hi-lo DESC, lo) AS rk FROM g WHERE hi-lo>=5*{DAY_US}
 AND NOT EXISTS (SELECT 1 FROM states s WHERE s.entity_id=g.entity_id AND s.k=7 AND s.t BETWEEN (lo+hi)//2-5*{DAY_US}//2 AND (lo+hi)//2+5*{DAY_US}//2)
 AND coalesce((SELECT max(gap) FROM (SELECT t - lag(t) OVER (ORDER BY t) AS gap FROM states s WHERE s.entity_id=g.entity_id AND s.t BETWEEN (lo+hi)//2-5*{DAY_US}//2 AND (lo+hi)//2+5*{DAY_US}//2)), 9e18) <= 4*{DAY_US}) q WHERE rk=1""",
    f"""edge AS (SELECT entity_id, min(t) AS a, max(t) AS z FROM states GROUP BY 1), w AS (SELECT a.entity_id, a.ws, a.we FROM annotations a JOIN edge e USING (entity_id)),
 g AS (SELECT entity_id, lo, hi FROM (SELECT entity_id, we AS lo, lead(ws) OVER (PARTITION BY entity_id ORDER BY ws, we) AS nx FROM w), LATERAL (SELECT coalesce(nx, (SELECT z FROM edge e WHERE e.entity_id=w.entity_id)) AS hi) UNION ALL SELECT e.entity_id, e.a, coalesce((SELECT min(ws) FROM w WHERE w.entity_id=e.entity_id), e.z) FROM edge e)""".replace("FROM w), LATERAL (SELECT coalesce(nx, (SELECT z FROM edge e WHERE e.entity_id=w.entity_id)) AS hi)", "FROM w) q JOIN edge USING (entity_id), LATERAL (SELECT coalesce(nx, z) AS hi)")))
def w08(spark, d):
    """Longest event-free stretch per entity whose central five days are continuous and clean."""
    s = R.states(spark, d).withColumn("bad", F.col("k") == 7)
    return windows.quiet_arcs(s, R.annotations(spark, d), arc_us=5 * DAY_US, max_gap_us=4 * DAY_US).select("entity_id", iso("lo").alias("gap_start_utc"), iso("hi").alias("gap_end_utc"), iso("a0").alias("arc_start_utc"), iso("a1").alias("arc_end_utc"))


@query("w09_acquisition_windows", oracle(f"""SELECT a.annotation_id, {iso_sql('ws-'+str(DAY_US))} AS plan_start_utc, {iso_sql('we+'+str(DAY_US))} AS plan_end_utc, {iso_sql('lo-30*'+str(DAY_US))} AS target_start_utc, {iso_sql('least(hi+30*'+str(DAY_US)+', 1706745600000000)')} AS target_end_utc, rn AS window_index FROM (
 SELECT *, min(event_t) OVER (PARTITION BY entity_id) AS lo, max(event_t) OVER (PARTITION BY entity_id) AS hi, row_number() OVER (PARTITION BY entity_id ORDER BY ws, annotation_id) AS rn FROM annotations) a WHERE rn BETWEEN 2 AND 4"""))
def w09(spark, d):
    """Per-window plans (one day margin) and per-target range (30 days, clipped), windows 2 to 4 of each target."""
    a = R.annotations(spark, d)
    span = a.groupBy("entity_id").agg((F.min("event_t") - 30 * DAY_US).alias("lo"), F.least(F.max("event_t") + 30 * DAY_US, F.lit(1706745600000000)).alias("hi"))
    n = row_index(a, ["entity_id"], ["ws", "annotation_id"], slot("ws", DAY_US), "window_index").where("window_index BETWEEN 2 AND 4")
    return n.join(span, "entity_id").select(
        "annotation_id", iso(F.col("ws") - DAY_US).alias("plan_start_utc"), iso(F.col("we") + DAY_US).alias("plan_end_utc"), iso("lo").alias("target_start_utc"), iso("hi").alias("target_end_utc"), "window_index"
    )


@query("w10_coverage_plan_summary", oracle(f"""SELECT annotation_id, local_files, remote_candidates, CASE WHEN remote_candidates>0 THEN 'probe_available' ELSE 'probe_no_hits' END AS probe_status FROM (SELECT annotation_id,
 (SELECT count(*) FROM ranging_files r WHERE r.entity_id=a.entity_id AND r.s//{DAY_US} BETWEEN a.ws//{DAY_US} AND a.we//{DAY_US}) AS local_files,
 (SELECT count(*) FROM external_times x WHERE x.entity_id=a.entity_id AND x.xt//{DAY_US} BETWEEN a.ws//{DAY_US} AND a.we//{DAY_US}) AS remote_candidates FROM annotations a)"""))
def w10(spark, d):
    """Dated local files and remote candidates on the days of each plan window."""
    day = lambda c: (F.floor(F.col(c) / DAY_US) * DAY_US).cast("bigint")
    a = R.annotations(spark, d).select("annotation_id", "entity_id", day("ws").alias("lo"), day("we").alias("hi"))
    loc = joins.count_within(a, R.ranging_files(spark, d), ["annotation_id"], ["entity_id"], "lo", "hi", "s", name="local_files")
    ext = R.external_times(spark, d).withColumn("day", day("xt"))
    rem = joins.count_within(a, ext, ["annotation_id"], ["entity_id"], "lo", "hi", "day", name="remote_candidates").select("annotation_id", "remote_candidates")
    return loc.join(rem, "annotation_id").select("annotation_id", "local_files", "remote_candidates", F.when(F.col("remote_candidates") > 0, "probe_available").otherwise("probe_no_hits").alias("probe_status"))


B = 12 * HOUR_US


def slr_audit(spark, d, w):
    r = R.ranging(spark, d)
    p = {"a": joins.Probe("lo", strict=True), "b": joins.Probe("ws", strict=True), "c": joins.Probe("we"), "e": joins.Probe("hi")}
    out = joins.count_probes(w.withColumn("lo", F.col("ws") - B).withColumn("hi", F.col("we") + B), r, ["annotation_id"], ["entity_id"], "t", p)
    return out.select("annotation_id", (F.col("b") - F.col("a")).alias("n_before"), (F.col("c") - F.col("b")).alias("n_during"), (F.col("e") - F.col("c")).alias("n_after"))


def classify_cte(src: str) -> str:
    return f"""cls AS (SELECT *, CASE WHEN cf THEN 'ignore' ELSE 'event' END AS event_label, CASE WHEN cf THEN 'audit_only' WHEN rs AND slr='support_available' THEN 'A' WHEN rs THEN 'B' ELSE 'C' END AS response_tier,
 CASE WHEN cf THEN 'source_conflict' WHEN rs THEN 'none' ELSE 'coverage_insufficient' END AS source_conflict_status,
 array_to_string(list_sort(list_filter([CASE WHEN tle='conflict' THEN 'tle_conflict' END, CASE WHEN pod='conflict' THEN 'pod_conflict' END, CASE WHEN pre='conflict' THEN 'precise_orbit_conflict' END, CASE WHEN slr='conflict' THEN 'slr_conflict' END,
  CASE WHEN slr='insufficient_coverage' THEN 'slr_insufficient_coverage' END, CASE WHEN NOT cf AND tle='missing_source' THEN 'missing_tle' WHEN NOT cf AND tle='insufficient_coverage' THEN 'tle_insufficient_coverage' END,
  CASE WHEN NOT cf AND pod='missing_source' AND pre IN ('missing_source','not_available') THEN 'missing_pod' WHEN NOT cf AND pod='insufficient_coverage' AND pre IN ('missing_source','not_available') THEN 'pod_insufficient_coverage' END], lambda x: x IS NOT NULL)), ',') AS quality_flags
 FROM (SELECT *, tle='conflict' OR pod='conflict' OR pre='conflict' OR slr='conflict' AS cf, tle IN ('response_detected','coverage_only') AND (pod='response_detected' OR pre='response_detected') AS rs FROM {src}))"""


@query("l01_evidence_alignment", oracle("SELECT annotation_id, tle AS tle_response_status, pod AS pod_response_status, slr AS slr_audit_status, event_label, response_tier, quality_flags FROM cls",
    BRACKET_CTE, f"""nn AS (SELECT br.*, (SELECT count(*) FROM ranging r WHERE r.entity_id=br.entity_id AND r.t>=ws-{B} AND r.t<ws) AS rb, (SELECT count(*) FROM ranging r WHERE r.entity_id=br.entity_id AND r.t BETWEEN ws AND we) AS rd, (SELECT count(*) FROM ranging r WHERE r.entity_id=br.entity_id AND r.t>we AND r.t<=we+{B}) AS ra,
 (SELECT count(*) FROM states r WHERE r.entity_id=br.entity_id AND r.t>=ws-{B} AND r.t<ws) AS ob, (SELECT count(*) FROM states r WHERE r.entity_id=br.entity_id AND r.t>we AND r.t<=we+{B}) AS oa FROM br),
 st AS (SELECT annotation_id, CASE WHEN bt IS NULL OR at_ IS NULL THEN 'insufficient_coverage' ELSE 'response_detected' END AS tle, CASE WHEN ob>0 AND oa>0 THEN 'response_detected' ELSE 'insufficient_coverage' END AS pod, 'not_available' AS pre,
 CASE WHEN rb>0 AND rd>0 AND ra>0 THEN 'support_available' ELSE 'insufficient_coverage' END AS slr FROM nn)""", classify_cte("st")))
def l01(spark, d):
    """One alignment row per window: element bracket, orbit bands, ranging bands, classification."""
    w = R.annotations(spark, d)
    b = joins.bracket_join(w, R.elements(spark, d), ["annotation_id"], ["entity_id"], "ws", "we", "t", ["t"])
    b = b.join(slr_audit(spark, d, w), "annotation_id")
    p = {"a": joins.Probe("lo", strict=True), "b0": joins.Probe("ws", strict=True), "c": joins.Probe("we"), "e": joins.Probe("hi")}
    o = joins.count_probes(w.withColumn("lo", F.col("ws") - B).withColumn("hi", F.col("we") + B), R.states(spark, d), ["annotation_id"], ["entity_id"], "t", p)
    b = b.join(o.select("annotation_id", ((F.col("b0") > F.col("a")) & (F.col("e") > F.col("c"))).alias("orbit_ok")), "annotation_id")
    b = b.withColumns({
        "tle_response_status": F.when(F.col("before").isNotNull() & F.col("after").isNotNull(), "response_detected").otherwise("insufficient_coverage"),
        "pod_response_status": F.when(F.col("orbit_ok"), "response_detected").otherwise("insufficient_coverage"),
        "slr_audit_status": F.when((F.col("n_before") > 0) & (F.col("n_during") > 0) & (F.col("n_after") > 0), "support_available").otherwise("insufficient_coverage"),
    })
    c = labels.classify_event(F.col("tle_response_status"), F.col("pod_response_status"), F.lit("not_available"), F.col("slr_audit_status"))
    return b.select("annotation_id", "tle_response_status", "pod_response_status", "slr_audit_status", *[c[x].alias(x) for x in ("event_label", "response_tier", "quality_flags")])


PICK = "(['response_detected','coverage_only','missing_source','insufficient_coverage','conflict','not_available'])"


@query("l02_status_classification", oracle("SELECT event_id, event_label, response_tier, source_conflict_status, quality_flags FROM cls",
    f"st AS (SELECT event_id, {PICK}[1+k%5] AS tle, {PICK}[1+k//5%5] AS pod, {PICK}[1+k//25%4+2*(k%2)] AS pre, CASE WHEN event_type='view' THEN 'conflict' WHEN k%3=0 THEN 'support_available' ELSE 'insufficient_coverage' END AS slr FROM ev)", classify_cte("st")))
def l02(spark, d):
    """Classification over all status combinations."""
    names = F.array(*[F.lit(x) for x in ("response_detected", "coverage_only", "missing_source", "insufficient_coverage", "conflict", "not_available")])
    k = F.get_json_object("props", "$.k").cast("int")
    at = lambda i: F.get(names, i.cast("int"))
    slr = F.when(F.col("event_type") == "view", "conflict").when(k % 3 == 0, "support_available").otherwise("insufficient_coverage")
    c = labels.classify_event(at(k % 5), at(F.floor(k / 5) % 5), at(F.floor(k / 25) % 4 + 2 * (k % 2)), slr)
    return R.table(spark, d, "events").select("event_id", *[v.alias(n) for n, v in c.items()])


TYPES = "orbit_raise orbit_lower plane_change phasing station_keeping collision_avoidance unknown".split()
EVID_CTE = f"""evid AS (SELECT l_orderkey AS candidate_id, 'evd_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS evidence_id, l_linenumber*100000000+l_partkey*10000+l_suppkey AS seq,
 CASE l_returnflag WHEN 'A' THEN 'pod' WHEN 'N' THEN 'tle' ELSE 'slr' END AS source, l_discount*10 AS score, NOT (l_tax=0.08::DOUBLE) AS supports_event, CASE WHEN l_linestatus='O' THEN 'insufficient_slr_coverage' ELSE '' END AS details, ({TYPES!r})[1+l_partkey%7] AS maneuver_type FROM lineitem)"""


def evidence(spark, d):
    kinds = F.array(*[F.lit(x) for x in TYPES])
    return R.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("candidate_id"), F.concat_ws("_", F.lit("evd"), "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("evidence_id"),
        (F.col("l_linenumber") * F.lit(100000000) + F.col("l_partkey") * 10000 + F.col("l_suppkey")).alias("seq"),
        F.when(F.col("l_returnflag") == "A", "pod").when(F.col("l_returnflag") == "N", "tle").otherwise("slr").alias("source"), (F.col("l_discount") * 10).alias("score"),
        (F.col("l_tax") != 0.08).alias("supports_event"), F.when(F.col("l_linestatus") == "O", "insufficient_slr_coverage").otherwise("").alias("details"),
        F.get(kinds, (F.col("l_partkey") % 7).cast("int")).alias("maneuver_type"),
    )


def candidates(spark, d):
    return R.spans(spark, d).select(F.col("o_orderkey").alias("candidate_id"), "entity_id", "s", "e")


SRC_CTE = "src AS (SELECT candidate_id, source, greatest(coalesce(max(score) FILTER (supports_event),0),0) AS pos, greatest(coalesce(max(score) FILTER (NOT supports_event),0),0) AS neg, count(*) AS n FROM evid GROUP BY 1,2)"


@query("l03_source_summary", oracle(f"SELECT candidate_id, source, {rsql('pos')} AS positive_score, {rsql('neg')} AS negative_score, n FROM src", EVID_CTE, SRC_CTE))
def l03(spark, d):
    """Best supporting and opposing score per candidate and source."""
    return labels.source_summary(evidence(spark, d)).select("candidate_id", "source", rnd("positive_score").alias("positive_score"), rnd("negative_score").alias("negative_score"), "n")


LABEL_CTE = """lab AS (SELECT c.o_orderkey AS candidate_id, c.entity_id, coalesce(a.comb,0) AS comb, coalesce(a.pod,0)>0 AS hp, coalesce(a.tle,0)>0 AS ht, coalesce(a.slr,0)>0 AS hs, coalesce(a.srcs,'') AS evidence_sources, coalesce(f.tc,false) AS tc, coalesce(f.sc,false) AS sc, coalesce(f.thin,false) AS thin, f.ty, coalesce(i.ids,'') AS evidence_ids, coalesce(f.n,0) AS n
 FROM spans c LEFT JOIN (SELECT candidate_id, coalesce(max(pos) FILTER (source='pod'),0)+coalesce(max(pos) FILTER (source='slr'),0)+coalesce(max(pos) FILTER (source='tle'),0) AS comb, max(pos) FILTER (source='pod') AS pod, max(pos) FILTER (source='tle') AS tle, max(pos) FILTER (source='slr') AS slr, string_agg(source, ',' ORDER BY source) FILTER (pos>0) AS srcs FROM src GROUP BY 1) a ON a.candidate_id=c.o_orderkey
 LEFT JOIN (SELECT candidate_id, bool_or(source='tle' AND NOT supports_event) AS tc, bool_or(source='slr' AND NOT supports_event) AS sc, bool_or(source='slr' AND details='insufficient_slr_coverage') AS thin, arg_min(maneuver_type, seq) FILTER (maneuver_type NOT IN ('collision_avoidance','unknown')) AS ty, count(*) AS n FROM evid GROUP BY 1) f ON f.candidate_id=c.o_orderkey
 LEFT JOIN (SELECT candidate_id, string_agg(DISTINCT evidence_id, ',' ORDER BY evidence_id) AS ids FROM (SELECT *, row_number() OVER (PARTITION BY candidate_id ORDER BY seq) AS rk FROM evid) WHERE rk<=20 GROUP BY 1) i ON i.candidate_id=c.o_orderkey),
labr AS (SELECT *, CASE WHEN tc THEN 'tle_conflict' WHEN sc AND thin THEN 'slr_insufficient_coverage' WHEN sc THEN 'slr_conflict' WHEN NOT hp THEN 'missing_pod' WHEN NOT ht THEN 'missing_tle' WHEN NOT (hs AND comb>=0.8) THEN 'combined_score_below_threshold' ELSE '' END AS ignore_reason FROM lab),
labx AS (SELECT *, CASE WHEN ignore_reason='' THEN 'event' ELSE 'ignore' END AS event_label,
 '{"pod":"' || CASE WHEN hp THEN 'pass' ELSE 'missing' END || '","slr":"' || CASE WHEN NOT tc AND sc AND thin THEN 'insufficient' WHEN NOT tc AND sc THEN 'conflict' WHEN hs THEN 'pass' ELSE 'missing' END || '","tle":"' || CASE WHEN tc THEN 'conflict' WHEN ht THEN 'pass' ELSE 'missing' END || '"}' AS gate_status_json FROM labr)"""
LAB = (EVID_CTE, SRC_CTE, LABEL_CTE)


def labelled(spark, d):
    return labels.label_candidates(candidates(spark, d), evidence(spark, d), ["pod", "tle"], ["slr"], 0.8)


@query("l04_candidate_labelling", oracle("""SELECT candidate_id, event_label, ignore_reason, evidence_sources, evidence_ids, gate_status_json, CASE WHEN ignore_reason<>'' THEN 'none' WHEN ty IN ('orbit_raise','orbit_lower','plane_change','station_keeping') THEN ty ELSE 'unknown_maneuver' END AS event_family,
 CASE WHEN ignore_reason<>'' THEN 'none' WHEN ty IN ('orbit_raise','orbit_lower') THEN 'semi_major_axis' WHEN ty='plane_change' THEN 'inclination' WHEN ty='phasing' THEN 'mean_longitude' ELSE 'multi_axis' END AS orbital_effect FROM labx""", *LAB))
def l04(spark, d):
    """Event or ignore per candidate with reason, gates and first evidence ids."""
    return labelled(spark, d).select("candidate_id", "event_label", "ignore_reason", "evidence_sources", "evidence_ids", "gate_status_json", "event_family", "orbital_effect")


@query("l05_event_rows", oracle(f"SELECT candidate_id, 'evt_' || substr(sha1(entity_id || '|validated|' || event_label || '|' || {iso_sql('s')} || '|' || {iso_sql('e')} || '|' || evidence_sources),1,12) AS event_id, event_label FROM labx JOIN (SELECT o_orderkey, s, e FROM spans) x ON x.o_orderkey=labx.candidate_id", *LAB))
def l05(spark, d):
    """Label rows with checked vocabulary and hash ids."""
    rows = labelled(spark, d).withColumns({"t_start": iso("s"), "t_end": iso("e")})
    return labels.event_rows(rows, track="validated").select("candidate_id", "event_id", "event_label")


@query("l06_gate_attrition", oracle("""SELECT entity_id, count(*) AS pod_candidate_count, count(*) FILTER (gate_status_json LIKE '%"tle":"pass"%') AS tle_consistent_count, count(*) FILTER (tc) AS tle_conflict_count, count(*) FILTER (gate_status_json LIKE '%"slr":"pass"%') AS slr_supportive_count,
 count(*) FILTER (gate_status_json LIKE '%insufficient%') AS slr_insufficient_count, count(*) FILTER (event_label='event') AS quality_pass_count, count(*) FILTER (event_label='event') AS event_count, 0::BIGINT AS no_event_count, count(*) FILTER (event_label='ignore') AS ignore_count FROM labx GROUP BY 1""", *LAB))
def l06(spark, d):
    """Gate outcomes per entity."""
    return labels.gate_attrition(labelled(spark, d), ["entity_id"])


@query("l07_public_label_export", oracle(f"""SELECT annotation_id, 'event' AS event_label, {iso_sql('event_t')} AS event_time_utc, quality_flags FROM (SELECT *, concat_ws(',', CASE WHEN tle_status<>'covered' THEN 'missing_tle' END, CASE WHEN slr_status<>'covered' THEN 'missing_slr' END, CASE WHEN orbit_status<>'covered' THEN 'missing_orbit' END) AS quality_flags FROM cov) WHERE ws>=1704240000000000 AND we<=1706400000000000
 UNION ALL SELECT annotation_id, 'no_event', '', concat_ws(',', CASE WHEN tle_status<>'covered' THEN 'missing_tle' END, CASE WHEN slr_status<>'covered' THEN 'missing_slr' END, CASE WHEN orbit_status<>'covered' THEN 'missing_orbit' END) FROM quiet WHERE ws>=1704240000000000 AND we<=1706400000000000""", PRESENCE_CTE, STATUS_CTE, *QUIET_CTES))
def l07(spark, d):
    """Event and no-event rows with the public columns, event times filled in, clipped to the release."""
    ev = covered_windows(spark, d).select("annotation_id", F.lit("event").alias("event_label"), "ws", "we", "quality_flags")
    ev = ev.join(R.annotations(spark, d).select("annotation_id", iso("event_t").alias("event_time_utc")), "annotation_id", "left").na.fill("", ["event_time_utc"])
    no = quiet(spark, d).select("annotation_id", "event_label", "ws", "we", "quality_flags", F.lit("").alias("event_time_utc"))
    both = ev.unionByName(no).where((F.col("ws") >= 1704240000000000) & (F.col("we") <= 1706400000000000))
    return both.select("annotation_id", "event_label", "event_time_utc", "quality_flags")


@query("l08_annotated_windows", oracle("SELECT c.annotation_id, coalesce(t.batch,'') AS batch, coverage_tier, missing_sources, concat_ws(',', CASE WHEN tle_status<>'covered' THEN 'missing_tle' END, CASE WHEN slr_status<>'covered' THEN 'missing_slr' END, CASE WHEN orbit_status<>'covered' THEN 'missing_orbit' END) AS quality_flags, aligned FROM cov c LEFT JOIN targets t ON t.entity_id=c.entity_id", PRESENCE_CTE, STATUS_CTE))
def l08(spark, d):
    """Audited windows with batch, tier and flags."""
    c = covered_windows(spark, d).join(R.targets(spark, d).select("entity_id", "batch"), "entity_id", "left")
    return c.select("annotation_id", F.coalesce("batch", F.lit("")).alias("batch"), "coverage_tier", "missing_sources", missing_flags(F.col("missing_sources")).alias("quality_flags"), "aligned")


@query("l09_tail_flagging", oracle(f"SELECT annotation_id, CASE WHEN abs({SMA_SQL.format('an')}-{SMA_SQL.format('bn')})>20.0 THEN 'reviewed,suspect_unreported_maneuver' ELSE 'reviewed' END AS quality_flags FROM br", BRACKET_CTE))
def l09(spark, d):
    """Windows whose element shift exceeds 20 m flagged once."""
    r = response.element_response(R.annotations(spark, d), R.elements(spark, d))
    w = R.annotations(spark, d).select("annotation_id", F.lit("reviewed").alias("quality_flags"))
    return labels.flag_tail(w, r)


@query("l10_operational_flags", oracle("""SELECT entity_id, unnest(list_filter([CASE WHEN NOT fw THEN 'ephemeris_window_incomplete' END, CASE WHEN ne=0 THEN 'missing_tle_in_window' END, CASE WHEN ne>=5 THEN 'tle_rows_ge5' ELSE 'tle_rows_lt5' END, CASE WHEN fw AND ne>=1 THEN 'eligible_operational_subset' END], lambda x: x IS NOT NULL)) AS quality_flag FROM (
 SELECT coalesce(s.entity_id,e.entity_id) AS entity_id, coalesce(e.ne,0) AS ne, coalesce(s.a<=1704240000000000 AND s.z>=1706400000000000,false) AS fw FROM (SELECT entity_id, min(t) a, max(t) z FROM states GROUP BY 1) s FULL JOIN (SELECT entity_id, count(*) ne FROM elements GROUP BY 1) e ON s.entity_id=e.entity_id)"""))
def l10(spark, d):
    """Operational readiness flags per entity."""
    s = R.states(spark, d).groupBy("entity_id").agg(F.min("t").alias("a"), F.max("t").alias("z"))
    e = R.elements(spark, d).groupBy("entity_id").agg(F.count(F.lit(1)).alias("ne"))
    full = F.coalesce((F.col("a") <= 1704240000000000) & (F.col("z") >= 1706400000000000), F.lit(False))
    x = s.join(e, "entity_id", "full_outer").withColumn("ne", F.coalesce("ne", F.lit(0))).withColumns({"has_full_window": full, "has_elements": F.col("ne") >= 1, "elements_ge5": F.col("ne") >= 5})
    return labels.operational_flags(x.withColumn("eligible", F.col("has_full_window") & F.col("has_elements")))


@query("l11_self_consistency_gate", oracle("""SELECT category, kind, count(*) AS n, count(DISTINCT entity_id) AS entities, (SELECT count(*) FROM difc WHERE category='unexpected')=0 AND (SELECT count(*)-count(DISTINCT annotation_id) FROM annotations)=0 AS ok FROM difc GROUP BY 1,2""", SPANCOV_CTE, PRESENCE_CTE, STATUS_CTE, DIFF_CTE))
def l11(spark, d):
    """Stored against recomputed coverage by category, duplicate ids, and the verdict."""
    from orrery.operators.coverage import status_diff

    diff = cut(status_diff(shipped_labels(spark, d), covered_windows(spark, d)))
    dup = R.annotations(spark, d).groupBy("annotation_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").agg(F.count(F.lit(1)).alias("dups"))
    bad = diff.where("category = 'unexpected'").agg(F.count(F.lit(1)).alias("bad"))
    verdict = bad.join(F.broadcast(dup)).select(((F.col("bad") == 0) & (F.col("dups") == 0)).alias("ok"))  # two one-row tables
    per = diff.groupBy("category", "kind").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("entity_id").alias("entities"))
    return per.join(F.broadcast(verdict))
