"""How the driver tables play the roles of the domain, once for Spark and once as SQL.

``events`` carries the time series: one event type per evidence source. The SQL
text holds the same definitions as common table expressions, so an oracle is
``WITH`` these followed by its own SELECT.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.orbit import LIGHT, MU
from orrery.functions.time import micros

HOUR = 3_600_000_000
DAY = 24 * HOUR


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _events(spark: SparkSession, d: str, kind: str) -> DataFrame:
    ev = table(spark, d, "events").where(F.col("event_type") == kind)
    k = F.get_json_object("props", "$.k").cast("int")
    return ev.select("event_id", F.col("user_id").alias("entity_id"), micros("ts").alias("t"), "value", k.alias("k"))


def elements(spark: SparkSession, d: str) -> DataFrame:
    v, k = F.col("value"), F.col("k")
    return _events(spark, d, "view").select(
        "event_id", "entity_id", "t", (0.06 + v * 1e-6).alias("mean_motion"), (0.9 + k * 0.001).alias("inclination"),
        (0.001 + k * 1e-5).alias("eccentricity"), (v * 1e-6).alias("bstar"), (k * 0.0628).alias("raan"),
    )


def states(spark: SparkSession, d: str) -> DataFrame:
    """Earth-fixed state vectors on circles of varying radius; some break the physical bands."""
    v, k = F.col("value"), F.col("k")
    r, a = 6.55e6 + v * 4e3, k * (2 * math.pi / 100)
    speed = F.sqrt(F.lit(MU) / r) * (1 + (k - 50) * 0.001)
    return _events(spark, d, "click").select(
        "event_id", "entity_id", "t", "k", (r * F.cos(a)).alias("x"), (r * F.sin(a)).alias("y"), (v * 100.0).alias("z"),
        (-speed * F.sin(a)).alias("vx"), (speed * F.cos(a)).alias("vy"), F.lit(10.0).alias("vz"),
        F.when(k == 7, F.lit(999999.999999)).otherwise(v).alias("clock"), v.alias("value"),
    )


def ranging(spark: SparkSession, d: str) -> DataFrame:
    v, k = F.col("value"), F.col("k")
    rng = 4.9e5 + v * 2e4
    tof = F.when(k == 17, F.lit(None).cast("double")).otherwise(rng * 2 / F.lit(LIGHT) + F.when(k == 13, F.lit(1e-8)).otherwise(F.lit(0.0)))
    return _events(spark, d, "purchase").select(
        "event_id", "entity_id", "t", (k % 20).alias("station_id"), F.when(k < 50, "npt").otherwise("frd").alias("record_type"),
        tof.alias("tof_s"), rng.alias("range_m"), F.when(k == 0, F.lit(0.0)).otherwise(v / 1000.0).alias("sigma_m"),
        (k % 30).alias("num_returns"), F.when(k == 99, F.lit(" CompassI6B ")).otherwise(F.lit("target")).alias("target_name"),
    )


def annotations(spark: SparkSession, d: str) -> DataFrame:
    """Reported events with their analysis window of -6 h .. +24 h."""
    ev = _events(spark, d, "error")
    return ev.select(
        F.concat(F.lit("ann_"), F.substring(F.sha1(F.concat_ws("|", "entity_id", "t")), 1, 12)).alias("annotation_id"),
        "entity_id", F.col("t").alias("event_t"), (F.col("t") - 6 * HOUR).alias("ws"), (F.col("t") + 24 * HOUR).alias("we"),
        (F.col("value") * F.col("k") * 10).alias("uncertainty_s"), "value", "k",
    )


def external_times(spark: SparkSession, d: str) -> DataFrame:
    return _events(spark, d, "signup").select("event_id", "entity_id", F.col("t").alias("xt"), "value")


def targets(spark: SparkSession, d: str) -> DataFrame:
    """Target dimension: id, batch, enabled."""
    return table(spark, d, "customer").select(
        F.col("c_custkey").alias("entity_id"), F.col("c_mktsegment").alias("batch"), (F.col("c_acctbal") > 0).alias("enabled"), F.col("c_name").alias("target_name")
    )


def orbit_files(spark: SparkSession, d: str) -> DataFrame:
    """Orbit products: the states of an entity in three-day files."""
    s = states(spark, d).withColumn("part", F.floor(F.col("t") / (3 * DAY)).cast("bigint"))
    return s.groupBy("entity_id", "part").agg(F.min("t").alias("s"), F.max("t").alias("e"), F.count(F.lit(1)).alias("n")).select(
        "entity_id", F.concat_ws("_", F.when(F.col("part") % 3 == 0, "POEORB").otherwise("MOEORB"), "entity_id", "part").alias("path"),
        F.when(F.col("part") % 2 == 0, "pod").otherwise("precise_orbit").alias("source_type"), "s", "e", "n", "part",
    )


def ranging_files(spark: SparkSession, d: str) -> DataFrame:
    """Ranging products: one span per entity and day that holds a point."""
    return ranging(spark, d).select("entity_id", F.floor(F.col("t") / DAY).cast("bigint").alias("day")).distinct().select(
        "entity_id", F.concat_ws("_", F.lit("npt"), "entity_id", "day").alias("path"), (F.col("day") * DAY).alias("s"), ((F.col("day") + 1) * DAY).alias("e")
    )


def spans(spark: SparkSession, d: str) -> DataFrame:
    """A long list of overlapping spans per entity."""
    o = table(spark, d, "orders")
    s = micros("o_orderdate")
    return o.select(
        (F.col("o_custkey") % 100).alias("entity_id"), "o_orderkey", s.alias("s"), (s + (F.col("o_orderkey") % 5 + 1) * DAY).alias("e"),
        F.col("o_orderpriority").alias("family"), F.col("o_orderstatus").alias("status"),
    )


def shipments(spark: SparkSession, d: str) -> DataFrame:
    """The large series with repeated (entity, epoch) keys."""
    return table(spark, d, "lineitem").select(
        F.col("l_suppkey").alias("entity_id"), micros("l_shipdate").alias("t"), "l_orderkey", "l_linenumber", "l_partkey",
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), "l_discount", "l_tax", F.col("l_returnflag").alias("rf"), F.col("l_linestatus").alias("ls"),
    )


def series(spark: SparkSession, d: str) -> DataFrame:
    """A dense series per entity: shipments spread over their day so that epochs are distinct in practice."""
    s = shipments(spark, d)
    off = (F.col("l_orderkey") * 7 + F.col("l_linenumber")) % 86_400
    return s.withColumn("t", F.col("t") + off * 1_000_000)


def estimates(spark: SparkSession, d: str) -> DataFrame:
    """Predicted against precise positions per event: large, with tiers, statuses and propagation times."""
    li = table(spark, d, "lineitem")
    ox, oy, oz = F.col("l_extendedprice") * 100.0, F.col("l_quantity") * 1e5, F.col("l_partkey") * 10.0
    return li.select(
        F.col("l_suppkey").alias("entity_id"), "l_orderkey", "l_linenumber", micros("l_shipdate").alias("t"), tier_of_flag().alias("tier"),
        ox.alias("ox"), oy.alias("oy"), oz.alias("oz"), (ox + F.col("l_discount") * 1e4).alias("ix"), (oy + F.col("l_tax") * 1e4).alias("iy"),
        (oz + (F.col("l_linenumber") - 3) * 50.0).alias("iz"), (F.col("l_quantity") + 100.0).alias("ovx"), (F.col("l_quantity") + 7000.0).alias("ovy"), F.lit(50.0).alias("ovz"),
        ((F.col("l_orderkey") * 37 + F.col("l_linenumber") * 1111) % 500_000).cast("double").alias("prop_s"),
        F.when((F.col("l_linestatus") == "O") & (F.col("l_linenumber") == 1), 300.0).otherwise(0.0).alias("extrap_s"),
        F.when(F.col("l_discount") == 0.05, "propagation_too_far").otherwise("computed").alias("tle_status"),
        F.when(F.col("l_tax") == 0.08, "insufficient_coverage").otherwise("computed").alias("orbit_status"),
        F.when(F.col("l_linestatus") == "O", "computed").otherwise("insufficient_coverage").alias("slr_status"),
    )


def tier_of_flag() -> Column:
    return F.when(F.col("l_returnflag") == "A", "A").when(F.col("l_returnflag") == "R", "B").otherwise("C")


def effects(spark: SparkSession, d: str) -> DataFrame:
    """Per-window responses at volume: element shift, orbit shift, bracket times, tier; some NULL."""
    li = table(spark, d, "lineitem")
    x = (F.col("l_discount") - 0.05) * F.col("l_extendedprice") * 1e-5
    return li.select(
        F.col("l_suppkey").alias("entity_id"), "l_orderkey", "l_linenumber", tier_of_flag().alias("tier"), micros("l_shipdate").alias("t"),
        F.when(F.col("l_linenumber") != 7, x).alias("delta_sma_km"),
        F.when(F.col("l_linenumber") != 6, x * 1000.0 * 0.6 + (F.col("l_tax") - 0.04) * 10.0).alias("orbit_shift_m"),
        (F.col("l_orderkey") % 48 + F.col("l_linenumber")).cast("double").alias("gap_h"), F.col("l_quantity").alias("qty"), F.col("l_linestatus").alias("ls"),
        F.abs(F.col("l_tax") * 100).alias("tax_pct"),
    )


CTES = f"""
ev AS (SELECT event_id, user_id AS entity_id, epoch_us(ts) AS t, event_type, value, CAST(regexp_extract(props, '\\d+') AS INTEGER) AS k FROM events),
elements AS (SELECT event_id, entity_id, t, 0.06 + value*1e-6 AS mean_motion, 0.9 + k*0.001 AS inclination, 0.001 + k*1e-5 AS eccentricity,
  value*1e-6 AS bstar, k*0.0628 AS raan FROM ev WHERE event_type='view'),
states AS (SELECT event_id, entity_id, t, k, (6.55e6 + value*4e3)*cos(k*{2 * math.pi / 100!r}) AS x, (6.55e6 + value*4e3)*sin(k*{2 * math.pi / 100!r}) AS y, value*100.0 AS z,
  -sqrt({MU!r}/(6.55e6 + value*4e3))*(1+(k-50)*0.001)*sin(k*{2 * math.pi / 100!r}) AS vx, sqrt({MU!r}/(6.55e6 + value*4e3))*(1+(k-50)*0.001)*cos(k*{2 * math.pi / 100!r}) AS vy,
  10.0::DOUBLE AS vz, CASE WHEN k=7 THEN 999999.999999::DOUBLE ELSE value END AS clock, value FROM ev WHERE event_type='click'),
ranging AS (SELECT event_id, entity_id, t, k%20 AS station_id, CASE WHEN k<50 THEN 'npt' ELSE 'frd' END AS record_type,
  CASE WHEN k=17 THEN NULL ELSE (4.9e5+value*2e4)*2/{LIGHT!r}::DOUBLE + CASE WHEN k=13 THEN 1e-8::DOUBLE ELSE 0.0::DOUBLE END END AS tof_s, 4.9e5+value*2e4 AS range_m,
  CASE WHEN k=0 THEN 0.0::DOUBLE ELSE value/1000.0::DOUBLE END AS sigma_m, k%30 AS num_returns, CASE WHEN k=99 THEN ' CompassI6B ' ELSE 'target' END AS target_name FROM ev WHERE event_type='purchase'),
annotations AS (SELECT 'ann_' || substr(sha1(entity_id || '|' || t),1,12) AS annotation_id, entity_id, t AS event_t, t-6*{HOUR} AS ws, t+24*{HOUR} AS we,
  value*k*10 AS uncertainty_s, value, k FROM ev WHERE event_type='error'),
external_times AS (SELECT event_id, entity_id, t AS xt, value FROM ev WHERE event_type='signup'),
targets AS (SELECT c_custkey AS entity_id, c_mktsegment AS batch, c_acctbal>0 AS enabled, c_name AS target_name FROM customer),
orbit_files AS (SELECT entity_id, (CASE WHEN part%3=0 THEN 'POEORB' ELSE 'MOEORB' END) || '_' || entity_id || '_' || part AS path,
  CASE WHEN part%2=0 THEN 'pod' ELSE 'precise_orbit' END AS source_type, min(t) AS s, max(t) AS e, count(*) AS n, part
  FROM (SELECT *, t//(3*{DAY}) AS part FROM states) GROUP BY entity_id, part),
ranging_files AS (SELECT entity_id, 'npt_' || entity_id || '_' || day AS path, day*{DAY} AS s, (day+1)*{DAY} AS e FROM (SELECT DISTINCT entity_id, t//{DAY} AS day FROM ranging)),
spans AS (SELECT o_custkey%100 AS entity_id, o_orderkey, epoch_us(o_orderdate) AS s, epoch_us(o_orderdate) + (o_orderkey%5+1)*{DAY} AS e, o_orderpriority AS family, o_orderstatus AS status FROM orders),
shipments AS (SELECT l_suppkey AS entity_id, epoch_us(l_shipdate) AS t, l_orderkey, l_linenumber, l_partkey, l_quantity AS qty, l_extendedprice AS price, l_discount, l_tax, l_returnflag AS rf, l_linestatus AS ls FROM lineitem),
estimates AS (SELECT l_suppkey AS entity_id, l_orderkey, l_linenumber, epoch_us(l_shipdate) AS t, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'B' ELSE 'C' END AS tier,
  l_extendedprice*100.0::DOUBLE AS ox, l_quantity*1e5 AS oy, l_partkey*10.0::DOUBLE AS oz, l_extendedprice*100.0::DOUBLE+l_discount*1e4 AS ix, l_quantity*1e5+l_tax*1e4 AS iy, l_partkey*10.0::DOUBLE+(l_linenumber-3)*50.0::DOUBLE AS iz,
  l_quantity+100.0::DOUBLE AS ovx, l_quantity+7000.0::DOUBLE AS ovy, 50.0::DOUBLE AS ovz, ((l_orderkey*37+l_linenumber*1111)%500000)::DOUBLE AS prop_s, CASE WHEN l_linestatus='O' AND l_linenumber=1 THEN 300.0::DOUBLE ELSE 0.0::DOUBLE END AS extrap_s,
  CASE WHEN l_discount=0.05::DOUBLE THEN 'propagation_too_far' ELSE 'computed' END AS tle_status, CASE WHEN l_tax=0.08::DOUBLE THEN 'insufficient_coverage' ELSE 'computed' END AS orbit_status,
  CASE WHEN l_linestatus='O' THEN 'computed' ELSE 'insufficient_coverage' END AS slr_status FROM lineitem),
effects AS (SELECT l_suppkey AS entity_id, l_orderkey, l_linenumber, CASE l_returnflag WHEN 'A' THEN 'A' WHEN 'R' THEN 'B' ELSE 'C' END AS tier, epoch_us(l_shipdate) AS t,
  CASE WHEN l_linenumber<>7 THEN (l_discount-0.05::DOUBLE)*l_extendedprice*1e-5 END AS delta_sma_km,
  CASE WHEN l_linenumber<>6 THEN (l_discount-0.05::DOUBLE)*l_extendedprice*1e-5*1000.0::DOUBLE*0.6::DOUBLE + (l_tax-0.04::DOUBLE)*10.0::DOUBLE END AS orbit_shift_m,
  (l_orderkey%48+l_linenumber)::DOUBLE AS gap_h, l_quantity AS qty, l_linestatus AS ls, abs(l_tax*100) AS tax_pct FROM lineitem),
series AS (SELECT * REPLACE (t + ((l_orderkey*7 + l_linenumber)%86400)*1000000 AS t) FROM shipments)
"""


def oracle(body: str, *extra: str, recursive: bool = False) -> str:
    """SQL text with the role tables in front. ``extra`` are more CTEs."""
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join([CTES.strip(), *extra]) + "\n" + body


def iso_sql(t: str) -> str:
    return f"strftime(make_timestamp(CAST({t} AS BIGINT)), '%Y-%m-%dT%H:%M:%S.%fZ')"


def rnd(c: Column | str, digits: int = 6) -> Column:
    """Half-even rounding at the output boundary."""
    c = F.col(c) if isinstance(c, str) else c
    return F.bround(c.cast("double"), digits)


def rnd_span(c: Column, digits: int = 3) -> Column:
    """The same for spans of whole microseconds, which often lie on a tie of their decimal form: as SQL's round_even does, the
    double times the power of ten is rounded half-even."""
    return F.rint(c * 10.0**digits) / 10.0**digits


def rsql(expr: str, digits: int = 6) -> str:
    return f"round_even(CAST({expr} AS DOUBLE), {digits})"
