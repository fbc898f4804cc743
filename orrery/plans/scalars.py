"""Column-level rules: time, identifiers, geometry, flags, names."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions import flags, ids, orbit, time
from orrery.operators import names
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, row_index, slot
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rsql

XYZ, VXYZ = ("x", "y", "z"), ("vx", "vy", "vz")


def vec(names_):
    return tuple(F.col(n) for n in names_)


def event_text(spark, d):
    """Event epochs as text in mixed notations, some unreadable."""
    ev = R.table(spark, d, "events")
    ts = F.col("ts").cast("timestamp")
    text = (
        F.when(F.col("event_type") == "view", F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss"), F.lit(" UTC")))
        .when(F.col("event_type") == "click", F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .when(F.col("event_type") == "error", F.concat(F.lit("bad-"), F.col("event_id")))
        .when(F.col("event_type") == "signup", F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    )
    return ev.select("event_id", "event_type", text.alias("txt"), ts.alias("ts"))


SEC = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
MIC = "strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ')"


@query("p01_parse_utc", f"SELECT event_id, CASE WHEN event_type IN ('view','click') THEN strftime(ts, '%Y-%m-%dT%H:%M:%S.000000Z') WHEN event_type='signup' THEN {MIC} END AS parsed_utc FROM events")
def p01(spark, d):
    """Text epochs to timestamps; trailing UTC dropped, failures NULL."""
    return event_text(spark, d).select("event_id", time.iso(time.micros(time.parse_utc(F.col("txt")))).alias("parsed_utc"))


@query("p02_iso_micro_form", f"""SELECT event_id, CASE WHEN epoch_us(ts)%1000000=0 THEN {SEC} ELSE {MIC} END AS iso,
 CASE event_type WHEN 'view' THEN {SEC} WHEN 'click' THEN {SEC} WHEN 'signup' THEN CASE WHEN epoch_us(ts)%1000000=0 THEN {SEC} ELSE {MIC} END ELSE '' END AS normalised FROM events""")
def p02(spark, d):
    """ISO form with microseconds only when present, and normalisation of compact and spaced text."""
    return event_text(spark, d).select("event_id", time.iso_micro_form(F.col("ts")).alias("iso"), time.normalise_iso_text(F.col("txt")).alias("normalised"))


@query("p03_iso_milli_form", f"SELECT event_id, CASE WHEN epoch_us(ts)%1000000=0 THEN {SEC} ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') END AS iso FROM events")
def p03(spark, d):
    """ISO form truncated to milliseconds."""
    return R.table(spark, d, "events").select("event_id", time.iso_milli_form(F.col("ts").cast("timestamp")).alias("iso"))


@query("p04_stable_ids", "SELECT event_id, 'evt_' || substr(sha1(user_id || '|' || event_type || '|' || coalesce(props,'')),1,12) AS stable_id, 'stab_' || substr(md5(user_id || '|' || event_type),1,12) AS quiet_id FROM events")
def p04(spark, d):
    """SHA-1 and MD5 based ids."""
    u, e = F.col("user_id"), F.col("event_type")
    return R.table(spark, d, "events").select("event_id", ids.stable_id("evt", u, e, F.col("props")).alias("stable_id"), ids.quiet_id(u, e).alias("quiet_id"))


@query("p05_alias_rename_schema_fill", "SELECT CAST(l_suppkey AS VARCHAR) AS sat_id, strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S.%fZ') AS epoch, round_even(l_quantity,6) AS x_m, NULL::DOUBLE AS y_m, round_even(l_tax,6) AS sigma_x_m, l_returnflag AS quality FROM lineitem")
def p05(spark, d):
    """Provider column names mapped to the canonical schema; absent columns are NULL, extras dropped."""
    raw = R.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("SatId"), F.col("l_shipdate").cast("timestamp").alias("Timestamp"), F.col("l_quantity").alias("X"), F.col("l_tax").alias("SigmaX"), F.col("l_returnflag").alias("quality"), "l_discount")
    canon = names.canonical(raw, names.STATE_ALIASES, {"sat_id": "string", "epoch": "timestamp", "x_m": "double", "y_m": "double", "sigma_x_m": "double", "quality": "string"})
    return canon.select("sat_id", time.iso(time.micros("epoch")).alias("epoch"), rnd("x_m").alias("x_m"), "y_m", rnd("sigma_x_m").alias("sigma_x_m"), "quality")


@query("p06_counted_numeric_coercion", "SELECT event_type, count(try_cast(s AS DOUBLE)) AS numeric_rows, count(*) FILTER (s<>'' AND try_cast(s AS DOUBLE) IS NULL) AS failed_rows, count(*) FILTER (s='') AS empty_rows FROM (SELECT event_type, CASE WHEN k=3 THEN '' WHEN k=5 THEN 'n/a' ELSE CAST(value AS VARCHAR) END AS s FROM (SELECT *, CAST(regexp_extract(props,'\\d+') AS INT) k FROM events)) GROUP BY 1")
def p06(spark, d):
    """Text to numbers, with non-empty failures counted."""
    k = F.get_json_object("props", "$.k").cast("int")
    s = F.when(k == 3, "").when(k == 5, "n/a").otherwise(F.col("value").cast("string"))
    x = R.table(spark, d, "events").select("event_type", s.alias("s")).withColumn("v", F.expr("try_cast(s AS DOUBLE)"))
    return x.groupBy("event_type").agg(F.count("v").alias("numeric_rows"), F.count_if((F.col("s") != "") & F.col("v").isNull()).alias("failed_rows"), F.count_if(F.col("s") == "").alias("empty_rows"))


@query("p07_identifier_normalisation", "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS entity_id FROM orders")
def p07(spark, d):
    """Ids that came through a float column: spaces and ``.0`` removed."""
    o = R.table(spark, d, "orders").withColumn("raw", F.concat(F.lit(" "), F.col("o_custkey").cast("double").cast("decimal(20,1)").cast("string"), F.lit(" ")))
    return o.select("o_orderkey", ids.clean_entity_id(F.col("raw")).alias("entity_id"))


SMA = "pow(3.986004418e14::DOUBLE/((mean_motion/60.0)*(mean_motion/60.0)), 1.0/3.0)"


@query("p08_semi_major_axis", oracle(f"SELECT event_id, {rsql(SMA, 3)} AS sma_m, {rsql(SMA + '/1000.0-6371.0', 6)} AS altitude_km FROM elements"))
def p08(spark, d):
    """Mean motion to semi-major axis and altitude."""
    n = F.col("mean_motion")
    return R.elements(spark, d).select("event_id", rnd(orbit.sma_from_mean_motion(n), 3).alias("sma_m"), rnd(orbit.altitude_km(n)).alias("altitude_km"))


WR = "((raan-3.0*inclination+pi()) - floor((raan-3.0*inclination+pi())/(2*pi()))*2*pi() - pi())"


@query("p09_wrapped_angle_delta", oracle(f"SELECT event_id, {rsql(WR, 9)} AS delta, abs({WR}-(raan-3.0*inclination))>1e-12 AS unwrapped FROM elements"))
def p09(spark, d):
    """Angle difference wrapped to [-pi, pi) and whether wrapping applied."""
    w, flag = orbit.angle_delta(F.col("raan"), F.col("inclination") * 3.0)
    return R.elements(spark, d).select("event_id", rnd(w, 9).alias("delta"), flag.alias("unwrapped"))


NORM, SPD = "sqrt(x*x+y*y+z*z)", "sqrt(vx*vx+vy*vy+vz*vz)"


@query("p10_vector_norms", oracle(f"SELECT event_id, {rsql(NORM, 3)} AS radius_m, {rsql(SPD, 6)} AS speed_mps FROM states"))
def p10(spark, d):
    """Radius and speed of every state."""
    return R.states(spark, d).select("event_id", rnd(orbit.norm3(*vec(XYZ)), 3).alias("radius_m"), rnd(orbit.norm3(*vec(VXYZ))).alias("speed_mps"))


W = "7.292115e-5::DOUBLE"


@query("p11_inertial_velocity", oracle(f"SELECT event_id, {rsql(f'vx-{W}*y')} AS vxi, {rsql(f'vy+{W}*x')} AS vyi, {rsql('vz')} AS vzi FROM states"))
def p11(spark, d):
    """Earth-fixed to inertial velocity."""
    v = orbit.inertial_velocity(vec(XYZ), vec(VXYZ))
    return R.states(spark, d).select("event_id", rnd(v[0]).alias("vxi"), rnd(v[1]).alias("vyi"), rnd(v[2]).alias("vzi"))


INV = f"(2.0/{NORM} - (pow(vx-{W}*y,2)+pow(vy+{W}*x,2)+vz*vz)/3.986004418e14::DOUBLE)"


@query("p12_vis_viva", oracle(f"SELECT event_id, {rsql(f'CASE WHEN {INV}>0 THEN 1.0/{INV} END', 2)} AS sma_m FROM states"))
def p12(spark, d):
    """Osculating semi-major axis; unbound states give NULL."""
    return R.states(spark, d).select("event_id", rnd(orbit.vis_viva_sma(vec(XYZ), orbit.inertial_velocity(vec(XYZ), vec(VXYZ))), 2).alias("sma_m"))


@query("p13_radial_along_cross", oracle(f"""SELECT event_id, {rsql('(dx*x+dy*y+dz*z)/r', 5)} AS radial_m, {rsql('dx*ax+dy*ay+dz*az', 5)} AS along_m, {rsql('(dx*hx+dy*hy+dz*hz)/h', 5)} AS cross_m FROM (
 SELECT *, (hy*z-hz*y)/(h*r) AS ax, (hz*x-hx*z)/(h*r) AS ay, (hx*y-hy*x)/(h*r) AS az FROM (
 SELECT *, sqrt(hx*hx+hy*hy+hz*hz) AS h FROM (SELECT *, {NORM} AS r, y*vz-z*vyi AS hx, z*vxi-x*vz AS hy, x*vyi-y*vxi AS hz FROM (
 SELECT *, vx-{W}*y AS vxi, vy+{W}*x AS vyi, value AS dx, k*1.0 AS dy, value-k AS dz FROM states))))"""))
def p13(spark, d):
    """A difference vector in radial, along-track and cross-track parts."""
    diff = (F.col("value"), F.col("k") * 1.0, F.col("value") - F.col("k"))
    parts = orbit.rac_projection(vec(XYZ), vec(VXYZ), diff)
    return R.states(spark, d).select("event_id", *[rnd(p, 5).alias(n) for p, n in zip(parts, ("radial_m", "along_m", "cross_m"))])


@query("p14_element_enrichment", oracle(f"""SELECT event_id, {rsql('CASE WHEN en<0 THEN -mu/(2*en) END', 2)} AS sma_m, {rsql('e', 8)} AS eccentricity, {rsql('degrees(acos(greatest(-1,least(1,hz/h))))', 6)} AS inclination_deg,
 {rsql('CASE WHEN en<0 THEN 2*pi()*sqrt(pow(-mu/(2*en),3)/mu) END', 4)} AS period_s, {rsql('h', 0)} AS angular_momentum, {rsql('en', 2)} AS energy FROM (
 SELECT *, sqrt(hx*hx+hy*hy+hz*hz) AS h, v2/2-mu/r AS en, sqrt(ex*ex+ey*ey+ez*ez) AS e FROM (
 SELECT *, ((v2-mu/r)*x-rv*vx)/mu AS ex, ((v2-mu/r)*y-rv*vy)/mu AS ey, ((v2-mu/r)*z-rv*vz)/mu AS ez FROM (
 SELECT *, 3.986004418e14::DOUBLE AS mu, {NORM} AS r, vx*vx+vy*vy+vz*vz AS v2, x*vx+y*vy+z*vz AS rv, y*vz-z*vy AS hx, z*vx-x*vz AS hy, x*vy-y*vx AS hz FROM states)))"""))
def p14(spark, d):
    """Classical elements of a whole state table as column expressions; open orbits have no axis or period."""
    e = orbit.classical_elements(vec(XYZ), vec(VXYZ))
    return R.states(spark, d).select(
        "event_id", rnd(e["sma_m"], 2).alias("sma_m"), rnd(e["eccentricity"], 8).alias("eccentricity"), rnd(F.degrees(e["inclination"])).alias("inclination_deg"),
        rnd(e["period_s"], 4).alias("period_s"), rnd(e["angular_momentum"], 0).alias("angular_momentum"), rnd(e["energy"], 2).alias("energy"),
    )


E2 = "(1/298.257::DOUBLE*(2.0-1/298.257::DOUBLE))"
NP = f"(6378136.3::DOUBLE/sqrt(1.0-{E2}*sin(la)*sin(la)))"


@query("p17_geodetic_to_ecef", f"SELECT event_id, {rsql(f'({NP}+h)*cos(la)*cos(lo)', 3)} AS x_m, {rsql(f'({NP}+h)*cos(la)*sin(lo)', 3)} AS y_m, {rsql(f'({NP}*(1.0-{E2})+h)*sin(la)', 3)} AS z_m FROM (SELECT event_id, radians(user_id%360-180.0) AS lo, radians(k*1.8-90.0) AS la, value*1000.0 AS h FROM (SELECT *, CAST(regexp_extract(props,'\\d+') AS INT) k FROM events))")
def p17(spark, d):
    """Geodetic positions to Earth-fixed coordinates on a declared ellipsoid."""
    k = F.get_json_object("props", "$.k").cast("int")
    p = orbit.geodetic_to_ecef(F.col("user_id") % 360 - 180.0, k * 1.8 - 90.0, F.col("value") * 1000.0, 6378136.3, 1 / 298.257)
    return R.table(spark, d, "events").select("event_id", *[rnd(c, 3).alias(n) for c, n in zip(p, ("x_m", "y_m", "z_m"))])


@query("p18_finite_difference_velocity", oracle(f"""SELECT event_id, {rsql('CASE WHEN dt<>0 THEN dz/dt END', 9)} AS vz FROM (
 SELECT event_id, (coalesce(lead(z) OVER w, z)-coalesce(lag(z) OVER w, z)) AS dz, (coalesce(lead(t) OVER w, t)-coalesce(lag(t) OVER w, t))/1e6 AS dt FROM states WINDOW w AS (PARTITION BY entity_id ORDER BY t, event_id))"""))
def p18(spark, d):
    """Central differences inside, one-sided at the ends; neighbours cross time slots by carry-in."""
    s = R.states(spark, d).select("event_id", "entity_id", "t", "z")
    order, b = ["t", "event_id"], slot("t", DAY_US)
    s = neighbour(s, ["entity_id"], order, b, ["t", "z"], name="p")
    s = neighbour(s, ["entity_id"], order, b, ["t", "z"], name="n", ahead=True)
    dz = F.coalesce(F.col("n.z"), F.col("z")) - F.coalesce(F.col("p.z"), F.col("z"))
    dt = (F.coalesce(F.col("n.t"), F.col("t")) - F.coalesce(F.col("p.t"), F.col("t"))) / 1e6
    return s.select("event_id", rnd(F.when(dt != 0, dz / dt), 9).alias("vz"))


SHELL_SQL = "(SELECT CASE WHEN min(abs(i-c))<=0.3 THEN arg_min(n, abs(i-c)) ELSE 'other' END FROM (VALUES " + ",".join(f"({c}::DOUBLE,'{n}')" for n, c in names.SHELLS) + ") s(c,n))"


@query("p19_shell_assignment", oracle(f"SELECT event_id, {rsql('i')} AS inclination_deg, {SHELL_SQL} AS shell FROM (SELECT event_id, 40.0 + (k*61%100) + value/100 AS i FROM ev)"))
def p19(spark, d):
    """Nearest inclination shell within 0.3 degrees."""
    ev = R.table(spark, d, "events")
    i = 40.0 + (F.get_json_object("props", "$.k").cast("int") * 61 % 100) + F.col("value") / 100
    return ev.select("event_id", i.alias("i")).select("event_id", rnd("i").alias("inclination_deg"), names.shell(F.col("i")).alias("shell"))


FLAG3 = "CASE WHEN k%2=0 THEN 'covered' ELSE 'missing' END AS a, CASE WHEN k%3<>0 THEN 'covered' ELSE 'missing' END AS b, CASE WHEN k%5<>0 THEN 'covered' ELSE 'missing' END AS c"


def three_statuses(spark, d):
    ev = R.table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("int"))
    return ev.select("event_id", "k", "event_type", flags.covered(F.col("k") % 2 == 0).alias("a"), flags.covered(F.col("k") % 3 != 0).alias("b"), flags.covered(F.col("k") % 5 != 0).alias("c"))


@query("p20_coverage_tier", oracle(f"SELECT event_id, CASE WHEN a='covered' AND b='covered' AND c='covered' THEN 'A' WHEN a='covered' AND c='covered' THEN 'B' ELSE 'C' END AS tier FROM (SELECT event_id, {FLAG3} FROM ev)"))
def p20(spark, d):
    """A, B, C from three source statuses."""
    return three_statuses(spark, d).select("event_id", flags.coverage_tier(F.col("a"), F.col("b"), F.col("c")).alias("tier"))


MISS = "concat_ws(',', CASE WHEN a<>'covered' THEN 'tle' END, CASE WHEN b<>'covered' THEN 'slr' END, CASE WHEN c<>'covered' THEN 'orbit' END)"


@query("p21_flag_list_algebra", oracle(f"""SELECT event_id, m AS missing_sources, concat_ws(',', CASE WHEN a<>'covered' THEN 'missing_tle' END, CASE WHEN b<>'covered' THEN 'missing_slr' END, CASE WHEN c<>'covered' THEN 'missing_orbit' END) AS flags,
 array_to_string(list_sort(list_distinct(list_concat(string_split(event_type,','), CASE WHEN m='' THEN [] ELSE string_split(m,',') END, ['view']))), ',') AS unioned,
 CASE WHEN event_type='view' THEN 'view' ELSE event_type || ',view' END AS appended, CASE WHEN k%2=0 AND k%3<>0 THEN 'ok' ELSE concat_ws('|', CASE WHEN k%2<>0 THEN 'odd' END, CASE WHEN k%3=0 THEN 'third' END) END AS summary
 FROM (SELECT *, {MISS} AS m FROM (SELECT event_id, event_type, k, {FLAG3} FROM ev))"""))
def p21(spark, d):
    """Missing lists, sorted set union, append-once, summary flags."""
    s = three_statuses(spark, d).withColumn("m", flags.missing_sources(F.col("a"), F.col("b"), F.col("c")))
    return s.select(
        "event_id", F.col("m").alias("missing_sources"), flags.missing_flags(F.col("m")).alias("flags"),
        flags.union_flags(flags.union_flags(F.col("event_type"), F.col("m")), F.lit("view")).alias("unioned"), flags.add_flag(F.col("event_type"), "view").alias("appended"),
        flags.summary_flags(F.when(F.col("k") % 2 != 0, "odd"), F.when(F.col("k") % 3 == 0, "third")).alias("summary"),
    )


@query("p22_json_metrics", "SELECT event_id, '{\"obs\":{\"k\":' || k || ',\"type\":\"' || event_type || '\"},\"user\":' || user_id || '}' AS metrics_json, k AS parsed_k, CASE WHEN k%10=0 THEN '{}' WHEN k%10=5 THEN '{\"a\":1}' ELSE props END AS safe_json FROM (SELECT *, CAST(regexp_extract(props,'\\d+') AS INT) k FROM events)")
def p22(spark, d):
    """Nested metrics written with sorted keys and read back; unreadable JSON becomes {}."""
    k = F.get_json_object("props", "$.k").cast("int")
    ev = R.table(spark, d, "events").withColumn("k", k)
    nested = F.to_json(F.struct(F.struct("k", F.col("event_type").alias("type")).alias("obs"), F.col("user_id").alias("user")))
    broken = F.when(F.col("k") % 10 == 0, F.lit("{not json")).when(F.col("k") % 10 == 5, F.lit('{"a":1}')).otherwise(F.col("props"))
    safe = F.when(F.try_parse_json(broken).isNull(), F.lit("{}")).otherwise(broken)
    return ev.select("event_id", nested.alias("metrics_json"), F.from_json("props", "k int")["k"].alias("parsed_k"), safe.alias("safe_json"))


LO, HI = "make_timestamp(1704700800000000)", "make_timestamp(1705910400000000)"


@query("p23_window_clip", oracle("""SELECT 'bounded' AS mode, count(*) FILTER (keep) AS kept, count(*) FILTER (NOT keep) AS dropped FROM (SELECT ws>=1704700800000000 AND we<=1705910400000000 AS keep FROM annotations)
 UNION ALL SELECT 'open_end', count(*) FILTER (keep), count(*) FILTER (NOT keep) FROM (SELECT ws>=1704700800000000 AS keep FROM annotations)"""))
def p23(spark, d):
    """Rows fully inside a release window, with the dropped count, for a closed and an open end."""
    a = R.annotations(spark, d)
    lo, hi = 1704700800000000, 1705910400000000
    modes = F.array(F.struct(F.lit("bounded").alias("mode"), ((F.col("ws") >= lo) & (F.col("we") <= hi)).alias("keep")), F.struct(F.lit("open_end").alias("mode"), (F.col("ws") >= lo).alias("keep")))
    return a.select(F.explode(modes).alias("m")).groupBy(F.col("m.mode").alias("mode")).agg(F.count_if("m.keep").alias("kept"), F.count_if(~F.col("m.keep")).alias("dropped"))


@query("p24_truthy_parsing", oracle("SELECT event_id, k%5 IN (0,1,2) AS flag FROM ev"))
def p24(spark, d):
    """true / 1 / yes in any case; everything else and NULL is false."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    raw = F.when(k == 0, "TRUE").when(k == 1, " 1 ").when(k == 2, "Yes").when(k == 3, "no")
    return R.table(spark, d, "events").select("event_id", ids.truthy(raw).alias("flag"))


@query("p25_time_uncertainty", oracle("""SELECT event_id, CASE WHEN event_type='view' THEN round_even(0.5*pow(10.0, -(CASE WHEN k%3=0 THEN 0 ELSE k%3 END)), 9) WHEN event_type='click' THEN k*60.0+30.0 END AS uncertainty_s FROM ev"""))
def p25(spark, d):
    """Half a unit of the last written decimal of an impulse time, or interval width + 30 s, else unknown."""
    k = F.get_json_object("props", "$.k").cast("int")
    token = F.when(k % 3 == 0, "26").when(k % 3 == 1, "26.8").otherwise("26.81")
    role = F.when(F.col("event_type") == "view", "first_impulse").when(F.col("event_type") == "click", "operation_end")
    return R.table(spark, d, "events").select("event_id", rnd(names.time_uncertainty(role, token, k * 60.0), 9).alias("uncertainty_s"))


@query("p26_melt", "SELECT l_orderkey, l_linenumber, f AS auxiliary_field, v AS auxiliary_value FROM (SELECT l_orderkey, l_linenumber, unnest([{'f':'high_order_discount','v':l_discount},{'f':'high_order_tax','v':nullif(l_tax,0)}], recursive:=true) FROM lineitem) WHERE v IS NOT NULL")
def p26(spark, d):
    """Wide ``High_Order_*`` columns to long rows without the NULLs."""
    li = R.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_discount").alias("High_Order_discount"), F.nullif(F.col("l_tax"), F.lit(0.0)).alias("High_Order_tax"))
    return names.melt(li, ["l_orderkey", "l_linenumber"], "High_Order_")


@query("p27_row_decimation", oracle("SELECT entity_id, part, event_id FROM (SELECT entity_id, t//(3*86400000000) AS part, event_id, row_number() OVER (PARTITION BY entity_id, t//(3*86400000000) ORDER BY t, event_id) AS rn FROM states) WHERE (rn-1)%3=0"))
def p27(spark, d):
    """Every third row of each file, in file order."""
    s = R.states(spark, d).withColumn("part", slot("t", 3 * DAY_US))
    return row_index(s, ["entity_id", "part"], ["t", "event_id"], slot("t", HOUR_US)).where((F.col("row_no") - 1) % 3 == 0).select("entity_id", "part", "event_id")


@query("p28_time_thinning", oracle("SELECT s.l_orderkey, s.l_linenumber FROM series s JOIN (SELECT entity_id, min(t) AS t0 FROM series GROUP BY 1) m ON s.entity_id=m.entity_id WHERE (s.t-m.t0)%600000000 < 60000000"))
def p28(spark, d):
    """Rows within a minute of every tenth minute since the entity's first row; the first row comes from an aggregate."""
    s = R.series(spark, d)
    first = s.groupBy("entity_id").agg(F.min("t").alias("t0"))
    return s.join(first, "entity_id").where((F.col("t") - F.col("t0")) % 600_000_000 < 60_000_000).select("l_orderkey", "l_linenumber")


@query("p29_sign_agreement", oracle("SELECT event_id, sign(value-50)=sign(k-50) AS agrees FROM ev"))
def p29(spark, d):
    """sign(a) = sign(b), where zero agrees only with zero."""
    k = F.get_json_object("props", "$.k").cast("int")
    return R.table(spark, d, "events").select("event_id", (F.signum(F.col("value") - 50) == F.signum((k - 50).cast("double"))).alias("agrees"))


@query("p30_sigma_bound", oracle(f"SELECT event_id, {rsql('0.376+0.302*abs(value*1000)/86400.0', 9)} AS sigma_km FROM ev"))
def p30(spark, d):
    """Linear uncertainty bound over propagation time."""
    return R.table(spark, d, "events").select("event_id", rnd(orbit.sigma_bound_km(F.lit(0.376), F.lit(0.302), F.col("value") * 1000), 9).alias("sigma_km"))


@query("p31_profile_injection", oracle(f"SELECT event_id, {rsql('value+20.0*(CASE WHEN k%4=0 THEN CASE WHEN h>=0 THEN 1.0 ELSE 0.0 END ELSE least(greatest(h/(k%4*6.0),0.0),1.0) END)', 6)} AS injected FROM (SELECT *, (t-1705276800000000)/3600e6 AS h FROM ev)"))
def p31(spark, d):
    """A ramp (or step where the duration is zero) added to a series."""
    k = F.get_json_object("props", "$.k").cast("int") % 4
    h = (time.micros("ts") - 1705276800000000) / 3600e6
    return R.table(spark, d, "events").select("event_id", rnd(F.col("value") + 20.0 * names.ramp(h, k * 6.0)).alias("injected"))


@query("p32_gps_week", "SELECT o_orderkey, date_diff('day', DATE '1980-01-06', o_orderdate::DATE)//7 AS week, date_diff('day', DATE '1980-01-06', o_orderdate::DATE)%7 AS dow, strftime(o_orderdate,'%Y-%m-%d') AS back FROM orders")
def p32(spark, d):
    """GPS week and weekday of a date, and back."""
    o = R.table(spark, d, "orders").select("o_orderkey", time.gps_week(F.col("o_orderdate").cast("date")).alias("g"))
    return o.select("o_orderkey", F.col("g.week").cast("bigint").alias("week"), F.col("g.dow").cast("bigint").alias("dow"), time.gps_week_day(F.col("g.week"), F.col("g.dow")).cast("string").alias("back"))


LEAP_SQL = "(SELECT max(n) FROM (VALUES " + ",".join(f"(DATE '{s}',{n})" for s, n in time.LEAP_SECONDS) + ") l(s,n) WHERE s<=o_orderdate::DATE)"


@query("p33_time_scale_shift", f"SELECT o_orderkey, CAST(CASE o_orderstatus WHEN 'F' THEN -{LEAP_SQL} WHEN 'O' THEN -({LEAP_SQL}-19) ELSE 0 END AS BIGINT) AS shift_s FROM orders")
def p33(spark, d):
    """Seconds from TAI or GPS time to UTC by the leap-second steps."""
    scale = F.when(F.col("o_orderstatus") == "F", "TAI").when(F.col("o_orderstatus") == "O", "GPS").otherwise("UTC")
    return R.table(spark, d, "orders").select("o_orderkey", time.time_scale_shift_seconds(scale, F.col("o_orderdate").cast("date")).cast("bigint").alias("shift_s"))


@query("p34_family_and_arc_rank", """SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag='A' AND l_linestatus='O' THEN 1 WHEN l_returnflag='N' AND l_linestatus='O' THEN 1 ELSE 0 END AS family,
 CASE WHEN l_returnflag='R' AND l_linestatus='O' THEN -1 ELSE date_diff('day', DATE '2000-01-01', l_shipdate::DATE) END AS arc_day FROM lineitem""")
def p34(spark, d):
    """Product family rank and arc-start day read from provider file names."""
    li = R.table(spark, d, "lineitem").withColumn("day", F.col("l_shipdate").cast("timestamp"))
    name = names.synthetic_product_name()
    return li.select("l_orderkey", "l_linenumber", name.alias("n")).select("l_orderkey", "l_linenumber", names.family_rank(F.col("n")).alias("family"), names.arc_start_day(F.col("n")).cast("bigint").alias("arc_day"))


@query("p35_undecodable_byte_flag", "SELECT doc_id, CASE WHEN contains(text, chr(233)) THEN 'non_utf8_sanitized_copy' ELSE '' END AS note FROM documents")
def p35(spark, d):
    """Files whose bytes do not decode get a note; here é is written as the single Latin-1 byte."""
    raw = F.encode(F.regexp_replace("text", "[^\\x00-\\xff]", "?"), "ISO-8859-1")
    doc = R.table(spark, d, "documents").select("doc_id", F.when(F.col("text").contains("é"), raw).otherwise(F.encode("text", "UTF-8")).alias("content"))
    return doc.select("doc_id", F.when(~F.is_valid_utf8(F.col("content").cast("string")), "non_utf8_sanitized_copy").otherwise("").alias("note"))


@query("p36_units_time_decode", oracle(f"SELECT event_id, CASE WHEN k%5=4 THEN NULL ELSE {iso_sql('CASE k%5 WHEN 0 THEN 946684800000000 WHEN 1 THEN 946728000000000 WHEN 2 THEN 946684800000000 ELSE 946684800250000 END + value::DECIMAL(12,2)*1000000')} END AS epoch_utc FROM ev"))
def p36(spark, d):
    """``seconds since <reference>`` in four notations; other calendars are refused."""
    k = F.get_json_object("props", "$.k").cast("int") % 5
    units = F.concat(F.lit("seconds since "), F.when(k == 0, "2000-01-01 00:00:00.0").when(k == 1, "2000-01-01 12:00:00").when(k == 2, "2000-01-01").when(k == 3, "2000-01-01T00:00:00.25").otherwise("2000-01-01"))
    cal = F.when(k == 4, "noleap").otherwise("gregorian")
    return R.table(spark, d, "events").select("event_id", time.iso(names.decode_seconds_since(units, cal, F.col("value"))).alias("epoch_utc"))
