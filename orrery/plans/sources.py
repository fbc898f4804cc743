"""Ingest queries. Provider files are written from the driver tables, plain and gzipped, several for each group of
entities, and read back in splits."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.ids import seven_digit
from orrery.functions.time import iso
from orrery.operators.names import STATE_ALIASES
from orrery.operators.scan import DAY_US, HOUR_US
from orrery.plans.joins import station_solutions
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rsql
from orrery.session import scratch_dir
from orrery.sinks import release
from orrery.sinks.lines import write_lines
from orrery.sources import elements, filenames, lines, manoeuvres, orbits, ranging, stations, tables

#: A provider file holds up to 16 entities and ten days of them: its keys, and its name in SQL.
PART_US = 10 * DAY_US
F_OF = "CAST(floor(entity_id / 64) * 4 + entity_id % 4 AS INT)"
FILE = f"((entity_id//64*4 + entity_id%4) || '-' || (t//{PART_US}))"


def read_back(spark, rows, purpose):
    """Write (f, part, at, i, value) as text files and read them: every third file gzipped, every other with CR LF and a byte order mark."""
    path = f"{scratch_dir(spark, purpose)}/files"
    key = F.col("f") + F.col("part")
    write_lines(rows, path, ["at", "i"], compressed=key % 3 == 1, crlf=key % 2 == 1, marked=key % 2 == 1)
    name = lambda k: F.regexp_extract("file", f"{k}=(-?\\d+)", 1)
    return lines.read_lines(spark, path).withColumn("file", F.concat_ws("-", name("f"), name("part")))


def emit(df, purpose, *parts):
    """(condition, text) pairs of each row become lines of its file, in order of time."""
    rows = F.array_compact(F.array(*[F.when(cond, F.struct(F.lit(i).alias("i"), text.alias("value"))) for i, (cond, text) in enumerate(parts)]))
    part = F.floor(F.col("t") / PART_US).cast("int").alias("part")
    return read_back(df.sparkSession, df.select(F.expr(F_OF).alias("f"), part, F.struct("t", "event_id").alias("at"), F.explode(rows).alias("l")).select("f", "part", "at", "l.*"), purpose)


YES = True


def lit(x):
    return F.lit(x)


def element_lines(spark, d):
    e = R.elements(spark, d)
    ev = R._events(spark, d, "view").select("event_id", "k", "value")
    e = e.join(ev, "event_id")
    norad = F.lpad((F.col("entity_id") % 100000).cast("string"), 5, "0")
    ts = F.timestamp_micros("t")
    frac = F.lpad(F.floor((F.col("t") % DAY_US) / 864).cast("string"), 8, "0")
    c = F.col("k") % 10
    day = F.when(c == 6, F.lit("XXX.")).otherwise(F.concat(F.lpad(F.dayofyear(ts).cast("string"), 3, "0"), F.lit(".")))
    bstar = F.concat(F.lit(" "), F.lpad((F.bround(F.col("value") * 100).cast("bigint") % 100000).cast("string"), 5, "0"), F.lit("-4"))
    l1 = F.concat(F.lit("1 "), norad, F.lit("U 98067A   "), F.date_format(ts, "yy"), day, frac, F.lit("  .00000000  00000-0 "), bstar, F.lit(" 0  999"))
    n2 = F.when(c == 2, F.lit("99999")).otherwise(norad)
    l2 = F.concat(F.lit("2 "), n2, F.lit(" "), F.format_string("%8.4f", F.degrees("inclination")), F.lit(" 123.4567 "), F.lpad(F.bround(F.col("eccentricity") * 1e7).cast("bigint").cast("string"), 7, "0"), F.lit(" 123.4567 234.5678 "), F.format_string("%11.8f", F.col("mean_motion") * (1440.0 / (2 * math.pi))), F.lit("12345"))
    e = e.withColumns({"l1": l1, "l2": l2})
    flip = lambda line, hit: F.concat(line, ((elements.checksum(line) + F.when(hit, 1).otherwise(0)) % 10).cast("string"))
    one, two = flip(F.col("l1"), c.isin(0, 5)), flip(F.col("l2"), c == 5)
    return emit(e, "elements", (c == 3, F.lit("0 SOME NAME")), (lit(YES), one), (lit(YES), F.when(c == 1, F.substring(two, 1, 60)).otherwise(two)), (c == 4, F.lit("2 stray line")))


def parsed_elements(spark, d):
    return elements.parse_pairs(element_lines(spark, d))


@query("s01_element_set_ingest", oracle(f"SELECT {FILE.replace('entity_id', 'e.entity_id').replace('(t//', '(e.t//')} AS file, lpad(CAST(e.entity_id%100000 AS VARCHAR),5,'0') AS entity_id, {iso_sql(f'e.t//864*864')} AS epoch_utc, {rsql('round(mean_motion*'+repr(1440.0/(2*math.pi))+',8)*'+repr(2*math.pi/1440.0), 9)} AS mean_motion, {rsql('radians(round(degrees(inclination),4))', 8)} AS inclination, {rsql('round(eccentricity*1e7)/1e7', 7)} AS eccentricity, {rsql('(round_even(v.value*100,0)::BIGINT%100000)*1e-9', 10)} AS bstar FROM elements e JOIN ev v ON v.event_id=e.event_id WHERE v.k%10 IN (3,4,7,8,9)"))
def s01(spark, d):
    """Line pairs with checksums and cross-checks to element rows."""
    p = elements.accepted(parsed_elements(spark, d))
    return p.select("file", "entity_id", iso("t").alias("epoch_utc"), rnd("mean_motion", 9).alias("mean_motion"), rnd("inclination", 8).alias("inclination"), rnd("eccentricity", 7).alias("eccentricity"), rnd("bstar", 10).alias("bstar"))


@query("s01_element_set_ledger", oracle(f"""SELECT {FILE} AS file, reason, count(*) AS n FROM (SELECT entity_id, t, unnest(CASE k%10 WHEN 0 THEN ['checksum_line1'] WHEN 1 THEN ['short_line'] WHEN 2 THEN ['norad_mismatch'] WHEN 3 THEN ['name_lines','pairs_accepted'] WHEN 4 THEN ['pairs_accepted','unrecognized_line'] WHEN 5 THEN ['checksum_line1','checksum_line2'] WHEN 6 THEN ['bad_epoch'] ELSE ['pairs_accepted'] END) AS reason FROM ev WHERE event_type='view') GROUP BY 1,2"""))
def s01b(spark, d):
    """Every rejected pair and stray line counted by reason."""
    return elements.reject_ledger(parsed_elements(spark, d))


def manoeuvre_lines(spark, d):
    e = R._events(spark, d, "error").withColumn("m", (F.floor(F.col("t") / 60_000_000) * 60_000_000).cast("bigint"))
    stamp = lambda us: F.date_format(F.timestamp_micros(us), "yyyy DDD HH mm")
    a, b = stamp(F.col("m")), stamp(F.col("m") + F.col("k").cast("bigint") * 60_000_000)
    head = F.concat_ws(" ", F.lit("SAT"), a, b)
    imp = F.concat(stamp(F.col("m")), F.lit(" "), F.when(F.col("k") % 2 == 0, "26").otherwise("26.812"))
    c = F.col("k") % 3
    line = F.when(c == 0, head).when(c == 1, F.concat(head, F.lit(" CODE1 2"))).otherwise(F.concat(head, F.lit(" CODE2 1 "), imp, F.lit(" 0.1 0.2 0.3")))
    return emit(e, "history", (F.col("k") == 50, F.concat(F.lit("# comment "), F.unhex(F.lit("FF")).cast("string"))), (lit(YES), line))


@query("s02_manoeuvre_history_ingest", oracle(f"""SELECT file, {iso_sql('ev_t')} AS event_utc, CASE WHEN k%3=2 THEN 'first_impulse_time' ELSE 'reported_operation_end_time' END AS role, {iso_sql('ev_t-6*'+str(HOUR_US))} AS window_start_utc, {rsql('CASE WHEN k%3=2 THEN CASE WHEN k%2=0 THEN 0.5 ELSE 0.0005 END ELSE k*60.0+30.0 END', 6)} AS uncertainty_s, CASE k%3 WHEN 0 THEN 0 WHEN 1 THEN 2 ELSE 1 END AS impulses, CASE k%3 WHEN 0 THEN '' WHEN 1 THEN 'CODE1' ELSE 'CODE2' END AS code
 FROM (SELECT DISTINCT file, m, k, CASE WHEN k%3=2 THEN m+CASE WHEN k%2=0 THEN 26000000 ELSE 26812000 END ELSE m+k::BIGINT*60000000 END AS ev_t FROM (SELECT *, {FILE} AS file, t//60000000*60000000 AS m FROM ev WHERE event_type='error'))"""))
def s02(spark, d):
    """Records of 9, 11 and 16+ tokens to annotations with windows and time uncertainty."""
    p = manoeuvres.parse_history(manoeuvre_lines(spark, d), "history")
    return p.select("file", iso("event_t").alias("event_utc"), "role", iso("ws").alias("window_start_utc"), rnd("uncertainty_s").alias("uncertainty_s"), "impulses", "code")


def tof_ps():
    return F.bround((F.col("range_m") * 2 / 299792458.0) * 1e12).cast("bigint")


def shot(spark, d):
    r = R.ranging(spark, d)
    k = R._events(spark, d, "purchase").select("event_id", "k")
    return r.join(k, "event_id").withColumns({"ps": tof_ps(), "tod": F.floor((F.col("t") % DAY_US) / 100).cast("bigint") * 1000})


def fixed_lines(spark, d):
    s = shot(spark, d)
    ts = F.timestamp_micros("t")
    line = F.concat(
        F.lit(" 200101"), F.when(F.col("k") % 10 == 0, F.lit("xx")).otherwise(F.date_format(ts, "yy")), F.lpad(F.dayofyear(ts).cast("string"), 3, "0"), F.lpad(F.col("tod").cast("string"), 12, "0"),
        F.lpad((F.col("station_id") + 7000).cast("string"), 4, "0"), F.lit("    "), F.lit("0000000"), F.lit("000000"), F.lpad(F.col("ps").cast("string"), 12, "0"),
        F.lpad((F.col("k") * 10).cast("string"), 7, "0"), F.lit("5320"), F.rpad(F.lit(""), 46, " "), (F.col("k") % 10).cast("string"), F.lpad(F.col("num_returns").cast("string"), 4, "0"),
    )
    return emit(s, "monthly", (lit(YES), F.when(F.col("k") % 10 == 1, F.substring(line, 1, 40)).otherwise(line)))


SHOT_CTE = f"shot AS (SELECT r.*, v.k, round_even(range_m*2/299792458.0::DOUBLE*1e12,0)::BIGINT AS ps, t//100*100 AS te FROM ranging r JOIN (SELECT event_id, k FROM ev) v ON v.event_id=r.event_id)"
WINDOWS = "CASE WHEN k%10 IN (1,2,3,4) THEN 10.0 WHEN k%10=5 THEN 5.0 WHEN k%10=6 THEN 15.0 WHEN k%10=7 THEN 30.0 WHEN k%10=8 THEN 60.0 WHEN k%10=9 THEN 120.0 END"
RNG = "ps*1e-12::DOUBLE/2*299792458.0::DOUBLE"


@query("s03_fixed_width_ranging_ingest", oracle(f"""SELECT {FILE} AS file, CASE WHEN k%10 IN (0,1) THEN 'malformed_record' WHEN entity_id%4=3 THEN 'epoch_outside_mission_window' ELSE 'accepted' END AS status, CASE WHEN k%10>1 AND entity_id%4<>3 THEN {iso_sql('te')} END AS epoch_utc, {rsql(f'CASE WHEN k%10>1 AND entity_id%4<>3 THEN {RNG} END', 3)} AS range_m, {rsql(f'CASE WHEN k%10>1 AND entity_id%4<>3 THEN {WINDOWS} END', 1)} AS window_s FROM shot""", SHOT_CTE))
def s03(spark, d):
    """Column slices, century by mission window or launch year, picoseconds to metres, counted rejects."""
    text = fixed_lines(spark, d)
    e = R.ranging(spark, d).select(F.expr(F_OF).alias("e"), F.floor(F.col("t") / PART_US).alias("part")).distinct()
    # every fourth file has a mission that ends before its data, the next one has no window at all
    mission = e.where("e % 4 <> 2").select(F.concat_ws("-", "e", "part").alias("file"), F.lit(1577836800000000).alias("start_t"), F.when(F.col("e") % 4 == 3, F.lit(1640995200000000)).alias("end_t"))
    p = ranging.parse_fixed_width(text, mission)
    return p.select("file", F.coalesce("reject_reason", F.lit("accepted")).alias("status"), iso("t").alias("epoch_utc"), rnd("range_m", 3).alias("range_m"), rnd("window_s", 1).alias("window_s"))


def session_lines(spark, d):
    s = shot(spark, d)
    k = F.col("k")
    ts = F.timestamp_micros("t")
    sod = F.format_string("%.4f", (F.col("t") % DAY_US - F.col("t") % 100) / 1e6)
    tof = F.format_string("%.12f", F.col("ps") / 1e12)
    kind = F.when(k % 2 == 0, "10").otherwise("11")
    full = F.concat_ws(" ", kind, sod, tof, F.lit("std1 2"), F.lit("30.0"), F.col("num_returns").cast("string"), (k * 10).cast("string"))
    data = F.when(k % 13 == 2, F.concat_ws(" ", kind, sod, tof)).when(k % 13 == 3, F.concat_ws(" ", kind, F.lit("abc"), tof, F.lit("std1 2 30 1 1"))).when(k % 13 == 4, F.lit("ZZ 1 2 3 4 5")).when(k % 13 == 5, F.lit("93 free form")).otherwise(full)
    return emit(
        s, "sessions", (k % 9 == 0, F.lit("H8")), (k % 4 == 0, F.concat(F.lit("H2 STAT "), F.col("station_id").cast("string"), F.lit(" 1 1 4"))),
        (k % 7 != 0, F.concat(F.lit("H4 1 "), F.date_format(ts, "yyyy MM dd"), F.lit(" 00 00 00 2024 12 31 23 59 59 0"))), (lit(YES), data),
    )


@query("s04_sessioned_ranging_ingest", oracle(f"""SELECT file, reason AS status, {iso_sql("CASE WHEN reason='accepted' THEN day+te%86400000000 END")} AS epoch_utc, {rsql(f"CASE WHEN reason='accepted' THEN {RNG} END", 3)} AS range_m, coalesce(CAST(stn AS VARCHAR),'') AS station_id FROM (
 SELECT *, CASE WHEN k%13=4 THEN 'unknown_record_type' WHEN k%13=2 THEN 'short_record' WHEN k%13=3 THEN 'malformed_record' WHEN coalesce(day,-1)<0 THEN 'epoch_reference_missing' ELSE 'accepted' END AS reason FROM (
 SELECT *, {FILE} AS file, last_value(CASE WHEN k%7<>0 THEN t//86400000000*86400000000 WHEN k%9=0 THEN -1 END IGNORE NULLS) OVER w AS day, last_value(CASE WHEN k%4=0 THEN station_id END IGNORE NULLS) OVER w AS stn FROM shot WINDOW w AS (PARTITION BY {FILE} ORDER BY t, event_id ROWS UNBOUNDED PRECEDING))) WHERE k%13<>5""", SHOT_CTE))
def s04(spark, d):
    """Data rows take date and station from the session headers before them; session ends clear the date."""
    p = ranging.parse_sessions(session_lines(spark, d))
    return p.select("file", F.coalesce("reject_reason", F.lit("accepted")).alias("status"), iso("t").alias("epoch_utc"), rnd("range_m", 3).alias("range_m"), F.coalesce("station_id", F.lit("")).alias("station_id"))


def pass_lines(spark, d):
    s = shot(spark, d)
    k = F.col("k")
    ts = F.timestamp_micros("t")
    head = F.when(k % 11 == 0, F.lit("BADHEADER")).otherwise(F.concat(F.lit("2001001"), F.date_format(ts, "yy"), F.lpad(F.dayofyear(ts).cast("string"), 3, "0"), F.lpad((F.col("station_id") + 7000).cast("string"), 4, "0"), F.lit("0000")))
    data = F.concat(F.lpad(F.col("tod").cast("string"), 12, "0"), F.lpad(F.col("ps").cast("string"), 12, "0"), F.lpad((k * 10).cast("string"), 7, "0"), F.lit("000000000000"), F.lpad(F.col("num_returns").cast("string"), 4, "0"), F.lit("0000000"))
    return emit(s, "passes", (k % 3 == 0, F.lit("99999")), (k % 3 == 0, head), (lit(YES), F.when(k % 13 == 0, F.substring(data, 1, 30)).otherwise(data)))


@query("s05_pass_header_ranging_ingest", oracle(f"""SELECT file, reason AS status, {iso_sql("CASE WHEN reason='accepted' THEN day+te%86400000000 END")} AS epoch_utc, {rsql(f"CASE WHEN reason='accepted' THEN {RNG} END", 3)} AS range_m, CASE WHEN reason='accepted' THEN stn END AS station_id FROM (
 SELECT *, CASE WHEN day IS NULL THEN 'data_without_active_pass' WHEN k%13=0 THEN 'short_data_record' ELSE 'accepted' END AS reason FROM (SELECT *, {FILE} AS file, last_value(CASE WHEN k%3=0 AND k%11<>0 THEN t//86400000000*86400000000 END IGNORE NULLS) OVER w AS day, last_value(CASE WHEN k%3=0 AND k%11<>0 THEN CAST(station_id+7000 AS VARCHAR) END IGNORE NULLS) OVER w AS stn FROM shot WINDOW w AS (PARTITION BY {FILE} ORDER BY t, event_id ROWS UNBOUNDED PRECEDING)))
 UNION ALL SELECT {FILE}, 'malformed_header_record', NULL, NULL, NULL FROM shot WHERE k%3=0 AND k%11=0""", SHOT_CTE))
def s05(spark, d):
    """Pass headers announced by 99999 carried to their data rows."""
    p = ranging.parse_passes(pass_lines(spark, d))
    return p.select("file", F.coalesce("reject_reason", F.lit("accepted")).alias("status"), iso("t").alias("epoch_utc"), rnd("range_m", 3).alias("range_m"), "station_id")


def block_lines(spark, d):
    s = R.states(spark, d)
    k = F.col("k")
    ts = F.timestamp_micros("t")
    num = lambda c: F.format_string("%14.6f", c)
    unit = F.when(F.col("entity_id") % 2 == 0, 10.0).otherwise(1.0)
    star = F.concat(F.lit("*  "), F.date_format(ts, "yyyy MM dd HH mm"), F.lit(" "), F.format_string("%11.8f", (F.col("t") % 60_000_000) / 1e6))
    sat = F.lpad((F.floor(F.col("entity_id") / 4) % 16).cast("string"), 3, "0")
    p = F.concat(F.lit("P"), sat, num(F.col("x") / 1000), num(F.col("y") / 1000), num(F.col("z") / 1000), num(F.col("clock")))
    v = F.concat(F.lit("V"), sat, num(F.col("vx") * unit), num(F.col("vy") * unit), num(F.col("vz") * unit))
    return emit(s, "orbits", (lit(YES), F.when(k % 19 == 0, F.lit("*  bad epoch")).otherwise(star)), (lit(YES), F.when(k % 17 == 0, F.concat(F.lit("P"), sat, F.lit(" garbage"))).otherwise(p)), (k % 5 != 0, v))


@query("s06_epoch_block_orbit_ingest", oracle(f"SELECT {FILE} AS file, {iso_sql('t')} AS epoch_utc, {rsql('round(x/1000,6)*1000', 3)} AS x, {rsql('CASE WHEN k<>7 THEN round(clock,6) END', 6)} AS clock, {rsql('CASE WHEN k%5<>0 THEN CASE WHEN entity_id%2=0 THEN round(vy*10,6)*0.1 ELSE round(vy,6) END END', 4)} AS vy FROM states WHERE k%19<>0 AND k%17<>0"))
def s06(spark, d):
    """Epoch blocks to states: units, sentinel, velocity join and per-file velocity unit."""
    out, _ = orbits.parse_epoch_blocks(block_lines(spark, d))
    return out.select("file", iso("t").alias("epoch_utc"), rnd("x", 3).alias("x"), rnd("clock").alias("clock"), rnd("vy", 4).alias("vy"))


@query("s06_epoch_block_ledger", oracle(f"SELECT {FILE} AS file, count(*) AS epoch_lines, count(*) FILTER (k%19=0) AS epoch_lines_rejected, count(*) FILTER (k%17<>0) AS p_records, count(*) FILTER (k%17=0) AS p_records_rejected, count(*) FILTER (k%5<>0) AS v_records, count(*) FILTER (k=7) AS clock_sentinel_rows, CASE WHEN count(*)<>count(*) FILTER (k%17<>0) THEN 'p_record_count_mismatch' ELSE '' END AS warning FROM states GROUP BY 1"))
def s06b(spark, d):
    """Counted lines of each file and the declared-count warning."""
    _, led = orbits.parse_epoch_blocks(block_lines(spark, d))
    file = F.concat_ws("-", F.expr(F_OF), F.floor(F.col("t") / PART_US).cast("string"))
    heads = R.states(spark, d).groupBy(file.alias("file")).agg(F.count("*").alias("num_epochs"), F.lit(1).alias("num_sats"))
    w = orbits.count_check(led, heads).select("file", "warning")
    return led.join(w, "file").select("file", "epoch_lines", "epoch_lines_rejected", "p_records", "p_records_rejected", "v_records", "clock_sentinel_rows", "warning")


@query("s07_xml_state_vector_ingest", oracle(f"SELECT CASE WHEN k%10=2 THEN 'missing_or_unparsable_epoch' WHEN k%10=3 THEN 'malformed_osv' ELSE 'accepted' END AS status, {iso_sql('CASE WHEN k%10=2 THEN NULL ELSE t END')} AS epoch_utc, {rsql('CASE WHEN k%10<>3 THEN round(x,3) END', 3)} AS x, k%10=4 AS non_nominal FROM states"))
def s07(spark, d):
    """State vectors written as XML and read with the built-in XML source; UTC preferred, TAI converted."""
    s = R.states(spark, d)
    k = F.col("k") % 10
    text = lambda us: F.date_format(F.timestamp_micros(us), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    x = s.select(
        F.when(k == 2, F.lit("TAI=never")).otherwise(F.concat(F.lit("TAI="), text(F.col("t") + 37_000_000))).alias("TAI"), F.when(~k.isin(1, 2), F.concat(F.lit("UTC="), text(F.col("t")))).alias("UTC"),
        F.when(k == 3, F.lit("n/a")).otherwise(F.format_string("%.3f", "x")).alias("X"), *[F.format_string("%.3f", c.lower()).alias(c) for c in ("Y", "Z", "VX", "VY", "VZ")], F.when(k == 4, "DEGRADED").otherwise("NOMINAL").alias("Quality"),
    )
    path = scratch_dir(spark, "osv") + "/osv"
    x.write.format("xml").option("rowTag", "OSV").option("rootTag", "List_of_OSVs").save(path)
    p = orbits.read_state_vectors(spark, path)
    return p.select(F.coalesce("reject_reason", F.lit("accepted")).alias("status"), iso("t").alias("epoch_utc"), rnd("x", 3).alias("x"), "non_nominal")


@query("s08_format_routing_census", oracle(f"""SELECT format, count(*) AS files FROM (SELECT 'html_error_page' AS format FROM pages WHERE upper(ltrim(html)) LIKE '<!DOCTYPE%' OR upper(ltrim(html)) LIKE '<HTML%' UNION ALL SELECT CASE WHEN m.k%10 IN (0,1) THEN 'unknown' ELSE 'merit_monthly' END FROM (SELECT {FILE} AS file, arg_min(k, t) AS k FROM shot GROUP BY 1) m
 UNION ALL SELECT CASE WHEN k%9=0 OR k%4=0 OR k%7<>0 THEN 'crd' ELSE 'unknown' END FROM (SELECT {FILE} AS file, arg_min(k, t) AS k FROM shot GROUP BY 1) UNION ALL SELECT CASE WHEN k%3=0 THEN 'legacy_npt' ELSE 'unknown' END FROM (SELECT {FILE} AS file, arg_min(k, t) AS k FROM shot GROUP BY 1)) GROUP BY 1""", SHOT_CTE))
def s08(spark, d):
    """Every file, excluded ones too, classified by its first non-empty line."""
    pages = R.table(spark, d, "pages").select(F.concat(F.lit("page_"), F.col("page_id")).alias("file"), F.posexplode(F.split("html", "\n")).alias("line_no", "value")).withColumn("line_no", F.col("line_no").cast("bigint"))
    tag = lambda df, p: df.withColumn("file", F.concat(F.lit(p), F.col("file")))
    text = pages.unionByName(tag(fixed_lines(spark, d), "m_")).unionByName(tag(session_lines(spark, d), "c_")).unionByName(tag(pass_lines(spark, d), "l_"))
    return ranging.detect_format(text).groupBy("format").agg(F.count("*").alias("files"))


@query("s09_alias_tolerant_csv", oracle(f"SELECT CAST(entity_id AS VARCHAR) AS sat_id, {iso_sql('t')} AS epoch_utc, {rsql('x', 2)} AS x_m, NULL::DOUBLE AS vx_mps FROM states"))
def s09(spark, d):
    """Provider headings mapped, missing columns NULL, canonical order."""
    path = scratch_dir(spark, "csv") + "/pod"
    s = R.states(spark, d).select(F.col("entity_id").alias("SatId"), iso("t").alias("Timestamp"), F.col("x").alias("X"), F.col("y").alias("Y"), F.col("value").alias("Extra"))
    s.write.option("header", True).csv(path)
    c = tables.read_aliased_csv(spark, path, STATE_ALIASES, {"sat_id": "string", "epoch": "timestamp", "x_m": "double", "y_m": "double", "vx_mps": "double"})
    return c.select("sat_id", iso(F.unix_micros("epoch")).alias("epoch_utc"), rnd("x_m", 2).alias("x_m"), "vx_mps")


CLIP = (1704240000000000, 1706400000000000)


def constellation_csv(spark, d):
    path = scratch_dir(spark, "constellation") + "/ephemeris"
    s = R.states(spark, d)
    num = lambda c: (F.col(c) / 1000).cast("string")
    s.select(
        F.concat(F.col("entity_id").cast("string"), F.lit(".0")).alias("Satellite_Number"), F.when(F.col("entity_id") % 5 == 0, "OTHER-1").otherwise(F.concat(F.lit("Fleet-"), F.col("entity_id"))).alias("Satellite_Name"),
        F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"), F.when(F.col("k") == 3, "bad").otherwise(num("x")).alias("X"), num("y").alias("Y"), num("z").alias("Z"), num("vx").alias("Vx"), num("vy").alias("Vy"), num("vz").alias("Vz"),
        F.when(F.col("k") % 2 == 0, F.col("k")).alias("High_Order_A"), F.col("value").alias("High_Order_B"),
    ).write.option("header", True).csv(path)
    return path


@query("s10_constellation_ephemeris_csv", oracle(f"""SELECT 'state' AS kind, CAST(entity_id AS VARCHAR) AS entity_id, {iso_sql('t')} AS epoch_utc, '' AS field, {rsql('CASE WHEN k<>3 THEN x END', 2)} AS value FROM states WHERE entity_id%5<>0 AND t BETWEEN {CLIP[0]} AND {CLIP[1]}
 UNION ALL SELECT 'auxiliary', CAST(entity_id AS VARCHAR), {iso_sql('t')}, 'high_order_a', {rsql('k', 2)} FROM states WHERE k%2=0 AND entity_id%5<>0 AND t BETWEEN {CLIP[0]} AND {CLIP[1]} UNION ALL SELECT 'auxiliary', CAST(entity_id AS VARCHAR), {iso_sql('t')}, 'high_order_b', {rsql('value', 2)} FROM states WHERE entity_id%5<>0 AND t BETWEEN {CLIP[0]} AND {CLIP[1]}
 UNION ALL SELECT 'failures', '', '', '', {rsql('count(*)', 2)} FROM states WHERE k=3 AND entity_id%5<>0 AND t BETWEEN {CLIP[0]} AND {CLIP[1]}"""))
def s10(spark, d):
    """Name filter, clip, unit scaling, counted coercion failures, melted auxiliary fields."""
    st, aux, fail = tables.read_ephemeris_csv(spark, constellation_csv(spark, d), "FLEET", *CLIP)
    a = st.select(F.lit("state").alias("kind"), "entity_id", iso("t").alias("epoch_utc"), F.lit("").alias("field"), rnd("x_m", 2).alias("value"))
    b = aux.select(F.lit("auxiliary").alias("kind"), "entity_id", iso("t").alias("epoch_utc"), F.col("auxiliary_field").alias("field"), rnd("auxiliary_value", 2).alias("value"))
    c = fail.agg(rnd(F.sum("numeric_failures"), 2).alias("value")).select(F.lit("failures").alias("kind"), F.lit("").alias("entity_id"), F.lit("").alias("epoch_utc"), F.lit("").alias("field"), "value")
    return a.unionByName(b).unionByName(c)


def raw_elements(spark, d):
    e = R.elements(spark, d)
    num = F.when(F.col("entity_id") % 7 == 0, F.lit("unknown")).otherwise(F.concat(F.col("entity_id").cast("string"), F.lit(".0")))
    name = F.when(F.col("entity_id") % 3 == 0, F.lit("Fleet-1")).when(F.col("entity_id") % 3 == 1, F.lit("EX-FLEET-2")).otherwise(F.lit("other"))
    return e.select(num.alias("Satellite_Number"), name.alias("Satellite_Name"), F.date_format(F.timestamp_micros("t"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"), F.col("mean_motion").cast("string").alias("Mean_Motion"), F.col("inclination").cast("string").alias("Inclination"), F.concat(F.lit("f"), F.col("entity_id")).alias("source_file"))


@query("s11_constellation_element_csv", oracle(f"""SELECT 'interim' AS variant, CASE WHEN entity_id%7=0 THEN 'unknown' ELSE CAST(entity_id AS VARCHAR) END AS entity_id, {iso_sql('t')} AS epoch_utc, {rsql('mean_motion', 9)} AS mean_motion FROM elements WHERE entity_id%3 IN (0,1)
 UNION ALL SELECT 'release', CAST(entity_id AS VARCHAR), {iso_sql('t')}, {rsql('mean_motion', 9)} FROM elements WHERE entity_id%3=0 AND entity_id%7<>0"""))
def s11(spark, d):
    """Both name filters and id types of the element tables."""
    raw = raw_elements(spark, d)
    out = lambda x, v: x.select(F.lit(v).alias("variant"), F.col("entity_id").cast("string").alias("entity_id"), iso("t").alias("epoch_utc"), rnd("mean_motion", 9).alias("mean_motion"))
    return out(tables.element_csv(raw, "FLEET", release=False), "interim").unionByName(out(tables.element_csv(raw, "FLEET", release=True), "release"))


@query("s12_external_time_lists", oracle(f"SELECT entity_id, {iso_sql('xt')} AS event_utc FROM external_times"))
def s12(spark, d):
    """JSON lists of event moments per target."""
    path = scratch_dir(spark, "times") + "/lists"
    x = R.external_times(spark, d).withColumn("day", F.floor(F.col("xt") / DAY_US))
    # one document per (target, day) keeps every document small
    x.groupBy("entity_id", "day").agg(F.array_sort(F.collect_list(iso("xt"))).alias("timestamps")).drop("day").write.json(path)
    return tables.read_time_lists(spark, path).select("entity_id", iso("xt").alias("event_utc"))


@query("s13_evidence_parquet_scan", oracle(f"SELECT entity_id, event_id, {rsql('x', 2)} AS x FROM states WHERE entity_id IN (SELECT entity_id FROM annotations)"))
def s13(spark, d):
    """Bucketed snapshot read back with column pruning and dynamic partition pruning by the annotated entities' buckets."""
    path = scratch_dir(spark, "snapshot") + "/orbit"
    release.write_snapshot(R.states(spark, d), path)
    s = spark.read.parquet(path).select("bucket", "entity_id", "event_id", "x")
    ids = R.annotations(spark, d).select("entity_id").distinct().withColumn("bucket", release.bucket_of())
    return s.join(ids, ["bucket", "entity_id"]).select("entity_id", "event_id", rnd("x", 2).alias("x"))


def solution_lines(spark, d):
    s = station_solutions(spark, d)
    snx = lambda c: F.concat(F.date_format(F.timestamp_micros(c), "yy"), F.lit(":"), F.lpad(F.dayofyear(F.timestamp_micros(c)).cast("string"), 3, "0"), F.lit(":"), F.lpad(F.floor(F.col(c) % DAY_US / 1e6).cast("string"), 5, "0"))
    end = F.when(F.col("e").isNull(), F.lit("00:000:00000")).otherwise(snx("e"))
    key = F.concat_ws(" ", F.col("station_id").cast("string"), F.lit("A"), F.col("soln").cast("string"))
    ep = F.concat_ws(" ", key, F.lit("L"), snx("s"), end, snx("s"))
    est = lambda t, v: F.concat_ws(" ", F.lit("1"), F.lit(t), key, snx("s"), F.lit("m 2"), F.format_string("%.5f", v), F.lit("0.001"))
    rows = F.array(ep, *[est(t, v) for t, v in (("STAX", F.col("pos")), ("STAY", F.col("pos") * 2), ("STAZ", F.col("pos") * 3), ("VELX", F.col("vel")))])
    head = F.array(F.lit("+SOLUTION/EPOCHS"), F.lit("-SOLUTION/EPOCHS"), F.lit("+SOLUTION/ESTIMATE"), F.lit("-SOLUTION/ESTIMATE"))
    file = s.select((F.col("station_id") % 4).cast("int").alias("f"), F.floor(F.col("station_id") / 4).cast("int").alias("part"), "*")
    # blocks 0 to 5: opening, validity, closing, opening, coordinates, closing
    body = file.select("f", "part", F.col("soln").cast("long").alias("at"), F.posexplode(rows).alias("i", "value")).withColumn("block", F.when(F.col("i") == 0, 1).otherwise(4))
    marks = file.select("f", "part").distinct().select("f", "part", F.lit(0).cast("long").alias("at"), F.posexplode(head).alias("i", "value")).withColumn("block", F.element_at(F.array(*map(F.lit, (0, 2, 3, 5))), F.col("i") + 1))
    return read_back(spark, body.unionByName(marks).withColumn("at", F.struct("block", "at")).drop("block"), "solutions")


SOL_CTE = f"""sol AS (SELECT *, CASE WHEN nxt IS NULL THEN NULL WHEN soln%3=0 THEN s+(nxt-s)//2 ELSE nxt END AS e FROM (SELECT station_id, s, row_number() OVER (PARTITION BY station_id ORDER BY s) AS soln, lead(s) OVER (PARTITION BY station_id ORDER BY s) AS nxt,
 pos, vel, s AS ref FROM (SELECT k%20 AS station_id, t//{DAY_US*7}*{DAY_US*7} AS s, min(value)*1e3 AS pos, max(value)*1e-3 AS vel FROM ev WHERE event_type='signup' GROUP BY 1,2)))"""


@query("s14_station_solution_ingest", oracle(f"SELECT CAST(station_id AS VARCHAR) AS code, CAST(soln AS VARCHAR) AS soln, {iso_sql('s')} AS start_utc, {iso_sql('e')} AS end_utc, {rsql('round(pos*3,5)', 4)} AS stax_z, {rsql('round(vel,5)', 5)} AS velx, 0.0::DOUBLE AS vely FROM sol", SOL_CTE))
def s14(spark, d):
    """Validity and coordinate blocks joined per (code, point, solution)."""
    p = stations.parse_solutions(solution_lines(spark, d))
    return p.select("code", "soln", iso("s").alias("start_utc"), iso("e").alias("end_utc"), rnd("STAZ", 4).alias("stax_z"), rnd("VELX", 5).alias("velx"), F.col("VELY").alias("vely"))


def observation_lines(spark, d):
    """One observation file for each provider file's three days: a header, and the first and last epoch of every entity."""
    f = R.orbit_files(spark, d).select(F.expr(F_OF).alias("f"), F.col("part").cast("int").alias("part"), "s", "e", "path")
    ts = lambda c: F.date_format(F.timestamp_micros(c), "yyyy MM dd HH mm ss.SSSSSS")
    lab = lambda body, label: F.concat(F.rpad(body, 60, " "), F.lit(label))
    whole = f.groupBy("f", "part").agg(F.min("s").alias("s"), F.max("e").alias("e"))
    head = F.array_compact(F.array(
        lab(F.lit("     3.04           OBSERVATION DATA    M"), "RINEX VERSION / TYPE"), lab(ts("s"), "TIME OF FIRST OBS"), F.when(F.col("part") % 2 == 0, lab(ts("e"), "TIME OF LAST OBS")), lab(F.lit(""), "END OF HEADER"),
    ))
    heads = whole.select("f", "part", F.lit(0).cast("long").alias("at"), F.posexplode(head).alias("i", "value"))
    body = f.select("f", "part", F.explode(F.array("s", "e")).alias("at"), "path").select("f", "part", "at", F.lit(9).alias("i"), F.concat(F.lit("> "), ts("at"), F.lit("  0 12")).alias("value"))
    return read_back(spark, heads.unionByName(body), "observations")


@query("s15_observation_coverage_manifest", oracle(f"SELECT (entity_id//64*4 + entity_id%4) || '-' || part AS file, '3.04' AS rinex_version, {iso_sql('min(s)')} AS span_start_utc, {iso_sql('max(e)')} AS span_end_utc, CASE WHEN part%2=0 THEN 'header' ELSE 'body_last_epoch' END AS last_obs_source FROM orbit_files GROUP BY 1, part"))
def s15(spark, d):
    """Observation spans from headers, else from the last epoch line; an invalid file stops the job."""
    m = stations.coverage_manifest(observation_lines(spark, d))
    return m.select("file", "rinex_version", iso("first_obs").alias("span_start_utc"), iso("last_obs").alias("span_end_utc"), "last_obs_source")


def product_names(spark, d):
    o = R.table(spark, d, "orders").withColumn("day", F.col("o_orderdate").cast("timestamp"))
    fmt = lambda c, f: F.date_format(c, f)
    nxt = F.timestamp_micros(F.unix_micros("day") + DAY_US)
    doy = lambda c: F.concat(F.date_format(c, "yy"), F.lpad(F.dayofyear(c).cast("string"), 3, "0"))
    c = F.col("o_orderkey") % 5
    day = F.col("day")
    return o.select("o_orderkey", "o_custkey", F.when(c == 0, F.concat(F.lit("S3A_V"), fmt(day, "yyyyMMdd"), F.lit("T215942_"), fmt(nxt, "yyyyMMdd"), F.lit("T235942_.EOF")))
                    .when(c == 1, F.concat(F.lit("SWOT_POR_"), fmt(day, "yyyyMMdd"), F.lit("_000000_"), fmt(nxt, "yyyyMMdd"), F.lit("_010000.nc")))
                    .when(c == 2, F.concat(F.lit("S6A_"), fmt(day, "yyyy"), F.lpad(F.dayofyear(day).cast("string"), 3, "0"), F.lit("0130_02D_30S.rnx.gz")))
                    .when(c == 3, F.concat(F.lit("ssaja2.b"), doy(day), F.lit(".e"), doy(nxt), F.lit(".DG_.sp3"))).otherwise(F.concat(F.lit("other_"), F.col("o_orderkey"), F.lit(".dat"))).alias("name"))


@query("s16_orbit_name_spans", oracle(f"""SELECT o_orderkey, {iso_sql('s+CASE o_orderkey%5 WHEN 0 THEN 79182000000 WHEN 1 THEN 0 WHEN 2 THEN 5400000000 WHEN 3 THEN 0 END')} AS start_utc, {iso_sql(f's+CASE o_orderkey%5 WHEN 0 THEN {DAY_US}+86382000000 WHEN 1 THEN {DAY_US}+3600000000 WHEN 2 THEN 2*{DAY_US}+5400000000 WHEN 3 THEN 2*{DAY_US} END')} AS end_utc FROM spans"""))
def s16(spark, d):
    """Spans from four file-name notations."""
    n = product_names(spark, d).withColumn("span", filenames.orbit_span(F.col("name")))
    return n.select("o_orderkey", iso("span.s").alias("start_utc"), iso("span.e").alias("end_utc"))


@query("s17_ranging_name_spans", oracle(f"""SELECT o_orderkey, {iso_sql("CASE o_orderkey%3 WHEN 0 THEN s WHEN 1 THEN epoch_us(date_trunc('month', make_timestamp(s))) END")} AS start_utc, {iso_sql(f"CASE o_orderkey%3 WHEN 0 THEN s+{DAY_US} WHEN 1 THEN epoch_us(date_trunc('month', make_timestamp(s)) + INTERVAL 1 MONTH) END")} AS end_utc FROM spans"""))
def s17(spark, d):
    """Daily and monthly tokens."""
    day = F.col("o_orderdate").cast("timestamp")
    c = F.col("o_orderkey") % 3
    name = F.when(c == 0, F.concat(F.lit("jason2_"), F.date_format(day, "yyyyMMdd"), F.lit(".npt"))).when(c == 1, F.concat(F.lit("jason2."), F.date_format(day, "yyyyMM"))).otherwise(F.lit("jason2.npt"))
    n = R.table(spark, d, "orders").select("o_orderkey", filenames.ranging_span(name).alias("span"))
    return n.select("o_orderkey", iso("span.s").alias("start_utc"), iso("span.e").alias("end_utc"))


@query("s18_target_config", oracle("SELECT entity_id, batch, CASE WHEN entity_id%2=0 THEN 'tle,slr' ELSE 'tle' END AS sources FROM targets WHERE batch IN ('BUILDING','MACHINERY')"))
def s18(spark, d):
    """Configuration documents with nested targets: batch filter, enabled sources only."""
    path = scratch_dir(spark, "config") + "/targets"
    src = F.array(F.struct(F.lit("tle").alias("name"), F.lit(True).alias("enabled")), F.struct(F.lit("slr").alias("name"), (F.col("entity_id") % 2 == 0).alias("enabled")))
    # one document per thousand targets
    t = R.targets(spark, d).select(F.floor(F.col("entity_id") / 1000).alias("doc"), F.struct("entity_id", "batch", src.alias("sources")).alias("t"))
    t.groupBy("doc").agg(F.collect_list("t").alias("targets")).write.json(path)
    c = tables.read_config_targets(spark, path, ["BUILDING", "MACHINERY"], multi_line=False)
    return c.select("entity_id", "batch", F.array_join("sources", ",").alias("sources"))


@query("s19_day_file_pruning", oracle(f"SELECT event_id, entity_id FROM elements WHERE t//{DAY_US} BETWEEN 19737 AND 19747"))
def s19(spark, d):
    """Day-partitioned archive read only from two days before to one day after the wanted range."""
    path = scratch_dir(spark, "days") + "/elements"
    e = R.elements(spark, d).select("event_id", "entity_id", F.timestamp_micros("t").cast("date").alias("day"))
    e.repartition("day").write.partitionBy("day").parquet(path)
    start, end = F.lit("2024-01-17").cast("date"), F.lit("2024-01-24").cast("date")
    return tables.pruned_days(spark.read.parquet(path), F.col("day"), start, end).select("event_id", "entity_id")


@query("s20_mission_window_lookup", oracle("SELECT r.event_id, lpad(CAST(entity_id AS VARCHAR),7,'0') AS target_id, t.target_name, r.t>=1704240000000000 AND (t.batch='BUILDING' OR r.t<=1706000000000000) AS in_mission FROM ranging r JOIN targets t USING (entity_id)"))
def s20(spark, d):
    """Seven-digit target ids resolved to names and mission windows with open ends."""
    t = R.targets(spark, d).select(seven_digit(F.col("entity_id")).alias("target_id"), "target_name", F.lit(1704240000000000).alias("m0"), F.when(F.col("batch") != "BUILDING", F.lit(1706000000000000)).alias("m1"))
    r = R.ranging(spark, d).drop("target_name").withColumn("target_id", seven_digit(F.col("entity_id"))).join(t, "target_id")
    return r.select("event_id", "target_id", "target_name", ((F.col("t") >= F.col("m0")) & (F.col("m1").isNull() | (F.col("t") <= F.col("m1")))).alias("in_mission"))


@query("s21_file_bounds", oracle(f"SELECT entity_id, {iso_sql('min(t)')} AS start_utc, {iso_sql('max(t)')} AS end_utc, count(*) AS rows, min(t)<={CLIP[0]} AND max(t)>={CLIP[1]} AS has_full_window FROM states GROUP BY 1"))
def s21(spark, d):
    """Bounds of written files from their footers, and whether the files of an entity span the window."""
    path = scratch_dir(spark, "bounds") + "/states"
    R.states(spark, d).select("entity_id", "t").repartitionByRange("entity_id", "t").sortWithinPartitions("entity_id", "t").write.parquet(path)
    w = tables.full_window(tables.footer_bounds(spark, path), *CLIP)
    return w.select("entity_id", iso("start_t").alias("start_utc"), iso("end_t").alias("end_utc"), "rows", "has_full_window")


@query("s22_product_type_dispatch", oracle("SELECT o_orderkey, CASE o_orderkey%5 WHEN 0 THEN 'state_vectors' WHEN 1 THEN 'precise_netcdf' WHEN 2 THEN 'gnss_rinex_observation_not_satellite_ephemeris' WHEN 3 THEN 'epoch_blocks' ELSE 'unsupported_orbit_format' END AS family, o_orderkey%5 IN (0,1) AS rotating FROM spans"))
def s22(spark, d):
    """Reader and frame flag of each product by its name."""
    fam = orbits.product_family(F.col("name"))
    return product_names(spark, d).select("o_orderkey", fam.alias("family"), orbits.rotating_frame(fam).alias("rotating"))
