"""Streaming queries: the driver tables delivered as files, drained, and returned as tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.orbit import sma_from_mean_motion
from orrery.functions.time import iso
from orrery.operators.scan import DAY_US, HOUR_US
from orrery.plans.joins import SMA_SQL
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rsql
from orrery.session import scratch_dir
from orrery.streaming import streams


def feed(spark, rows, drain, *, overlap_us=0, parts=3, disorder=False):
    """Deliver rows by time, one folder after the other, and drain after each.

    Every drain is a restart from the checkpoint that takes one delivery as one
    micro-batch. Deliveries repeat the last ``overlap_us`` of the one before. With ``disorder``, rows
    whose time divides by ``DELAYED`` come one delivery after their own, the last of them in an extra one.
    """
    root = scratch_dir(spark, "stream")
    rows = rows.withColumn("t", F.timestamp_micros("t_us"))
    lo, hi = rows.agg(F.min("t_us"), F.max("t_us")).first()
    if lo is None:
        lo = hi = 0
    step, last_end = (hi - lo) // parts + 1, None
    delayed = (F.col("t_us") % DELAYED == 0) if disorder else F.lit(False)
    for i in range(parts + disorder):
        end = lo + (i + 1) * step - 1
        a = streams.effective_start(lo, end, last_end, overlap_us) if overlap_us else lo + i * step
        last_end = end
        due = F.col("t_us").between(a, end) & ~delayed
        if disorder:
            due = due | (F.col("t_us").between(a - step, a - 1) & delayed)
        rows.where(due).write.parquet(f"{root}/in/part{i}")
        drain(root, rows.schema)
    return root


DELAYED = 11


def feed_ctes(rows, width_us, delay_us=HOUR_US, parts=3):
    """SQL of a disordered feed of ``rows`` (entity_id, t, v): ``kept`` with the mark of the end, and ``behind``, the rows that came too late."""
    return f"""fr AS ({rows}), fs AS (SELECT min(t) AS lo, (max(t)-min(t))//{parts}+1 AS step FROM fr),
fd AS (SELECT fr.*, (t-lo)//step + (t%{DELAYED}=0)::INT AS delivery FROM fr, fs), fm AS (SELECT delivery, max(t) AS m FROM fd GROUP BY 1),
fk AS (SELECT a.delivery, max(b.m)-{delay_us} AS mark FROM fm a JOIN fm b ON b.delivery<a.delivery GROUP BY 1),
fl AS (SELECT fd.*, coalesce((t//{width_us}+1)*{width_us}<=mark, false) AS late, (t//{width_us}+1)*{width_us}>(SELECT max(m)-{delay_us} FROM fm) AS open FROM fd LEFT JOIN fk USING (delivery)),
behind AS (SELECT * FROM fl WHERE late), kept AS (SELECT *, lag(t) OVER w AS pt, lag(v) OVER w AS pv FROM fl WHERE NOT late WINDOW w AS (PARTITION BY entity_id ORDER BY t, v))"""


def appending(spark, make):
    """Drain of the stream ``make(source)`` into the table ``out`` of the delivery root."""
    def drain(root, schema):
        streams.drain_append(make(streams.open_stream(spark, f"{root}/in", schema)), f"{root}/out", f"{root}/ck")

    return drain


def distinct(source):
    return streams.distinct_deliveries(source, ["entity_id", "t"], "t", "3 days")


def state_rows(spark, d):
    return R.states(spark, d).select("entity_id", F.col("t").alias("t_us"), "value")


@query("r01_incremental_cursor", oracle("SELECT entity_id, count(*) AS n FROM states GROUP BY 1"))
def r01(spark, d):
    """Successive drains with one checkpoint: each reads only what arrived since, the half-hour overlap is absorbed."""
    root = feed(spark, state_rows(spark, d), appending(spark, distinct), overlap_us=1_800_000_000)
    return spark.read.parquet(f"{root}/out").groupBy("entity_id").agg(F.count("*").alias("n"))


@query("r02_dedup_overlapping_deliveries", oracle(f"SELECT entity_id, {iso_sql('t')} AS epoch_utc FROM states"))
def r02(spark, d):
    """A day of overlap between deliveries, each key kept once."""
    root = feed(spark, state_rows(spark, d), appending(spark, distinct), overlap_us=DAY_US)
    return spark.read.parquet(f"{root}/out").select("entity_id", iso("t_us").alias("epoch_utc"))


def pairs(spark, rows, width_us):
    """Closed pairs and late rows of the stream, and the pairs it leaves open."""
    root = feed(spark, rows, appending(spark, lambda s: streams.consecutive_pairs(s, "t", "1 hour", width_us)), disorder=True)
    return spark.read.parquet(f"{root}/out").unionByName(streams.open_pairs(spark, f"{root}/ck", width_us))


R03_CTES = feed_ctes("SELECT entity_id, t, value AS v FROM states", HOUR_US)


@query("r03_cross_batch_cadence", oracle(f"SELECT entity_id, sum(total)::BIGINT AS total, sum(within_day)::BIGINT AS within_day, sum(still_open)::BIGINT AS still_open, sum(late)::BIGINT AS late FROM (SELECT entity_id, count(pt) AS total, count(*) FILTER (t-pt<={DAY_US}) AS within_day, count(pt) FILTER (open) AS still_open, 0 AS late FROM kept GROUP BY 1 UNION ALL SELECT entity_id, 0, 0, 0, count(*) FROM behind GROUP BY 1) GROUP BY 1 HAVING sum(total)+sum(late)>0", R03_CTES))
def r03(spark, d):
    """Consecutive-row cadence counted across micro-batches that arrive out of order; rows behind the watermark are counted, not paired."""
    p = pairs(spark, state_rows(spark, d), HOUR_US)
    paired, gap = F.col("status") != "late", F.col("t_us") - F.col("prev_us")
    return p.groupBy("entity_id").agg(
        F.count_if(paired).alias("total"), F.count_if(paired & (gap <= DAY_US)).alias("within_day"),
        F.count_if(F.col("status") == "open").alias("still_open"), F.count_if(~paired).alias("late"),
    )


@query("r04_cadence_windows", oracle(f"SELECT 'tumbling' AS kind, entity_id, {iso_sql(f't//{HOUR_US}*{HOUR_US}')} AS window_start_utc, count(*) AS n FROM states GROUP BY 2,3 UNION ALL SELECT 'sliding', entity_id, {iso_sql('w')}, count(*) FROM (SELECT entity_id, unnest([t//1800000000*1800000000, t//1800000000*1800000000-1800000000]) AS w FROM states) GROUP BY 2,3"))
def r04(spark, d):
    """Tumbling and sliding hourly counts in update mode, latest value per key."""
    kinds = {"tumbling": None, "sliding": "30 minutes"}
    latest = {}

    def drain(root, schema):
        for kind, slide in kinds.items():
            w = streams.cadence_windows(streams.open_stream(spark, f"{root}/in", schema), ["entity_id"], "t", "1 day", "1 hour", slide)
            latest[kind] = streams.drain_upsert(w, ["entity_id", "window_start"], f"{root}/{kind}", f"{root}/ck_{kind}")

    feed(spark, state_rows(spark, d), drain)
    rows = [x.select(F.lit(k).alias("kind"), "entity_id", iso(F.unix_micros("window_start")).alias("window_start_utc"), "n") for k, x in latest.items()]
    return rows[0].unionByName(rows[1])


@query("r05_session_arcs", oracle(f"SELECT entity_id, {iso_sql('min(t)')} AS arc_start_utc, {iso_sql('max(t)')} AS last_utc, count(*) AS n, CASE WHEN max(t)+{12 * HOUR_US}<=(SELECT max(t)//1000*1000 FROM states)-{HOUR_US} THEN 'closed' ELSE 'open' END AS status FROM (SELECT *, sum(CASE WHEN g IS NULL OR g>={12 * HOUR_US} THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS arc FROM (SELECT *, t-lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS g FROM states)) GROUP BY entity_id, arc"))
def r05(spark, d):
    """Session windows with a twelve-hour hole; arcs not yet closed by the watermark are read from the state."""
    root = feed(spark, state_rows(spark, d), appending(spark, lambda s: streams.session_arcs(s, ["entity_id"], "t", "1 hour", "12 hours")))
    closed = spark.read.parquet(f"{root}/out").withColumn("status", F.lit("closed"))
    o = closed.unionByName(streams.open_arcs(spark, f"{root}/ck", ["entity_id"]).withColumn("status", F.lit("open")))
    return o.select("entity_id", iso(F.unix_micros("arc_start")).alias("arc_start_utc"), iso(F.unix_micros("last_t")).alias("last_utc"), "n", "status")


R06_CTES = feed_ctes(f"SELECT entity_id, t, {SMA_SQL.format('mean_motion')} AS v FROM elements", DAY_US)


@query("r06_streaming_step_alerts", oracle(f"SELECT entity_id, {iso_sql('pt')} AS bracket_start_utc, {iso_sql('t')} AS bracket_end_utc, {rsql('v-pv', 3)} AS delta_m, CASE WHEN open THEN 'open' ELSE 'closed' END AS status FROM kept WHERE abs(v-pv)>100 UNION ALL SELECT entity_id, NULL, {iso_sql('t')}, NULL, 'late' FROM behind", R06_CTES))
def r06(spark, d):
    """Element steps over 100 m, alerted once both elements are closed or still open at the end; elements that came too late are listed."""
    e = R.elements(spark, d).select("entity_id", F.col("t").alias("t_us"), sma_from_mean_motion(F.col("mean_motion")).alias("value"))
    p = pairs(spark, e, DAY_US).where((F.col("status") == "late") | (F.abs(F.col("v") - F.col("prev_v")) > 100))
    return p.select("entity_id", iso("prev_us").alias("bracket_start_utc"), iso("t_us").alias("bracket_end_utc"), rnd(F.col("v") - F.col("prev_v"), 3).alias("delta_m"), "status")


@query("r07_snapshot_upsert", oracle(f"SELECT entity_id, count(*) AS n, {iso_sql('max(t)')} AS last_utc FROM states GROUP BY 1"))
def r07(spark, d):
    """Running per-entity totals upserted by idempotent micro-batch partitions."""
    latest = []

    def drain(root, schema):
        g = streams.open_stream(spark, f"{root}/in", schema).groupBy("entity_id").agg(F.count("*").alias("n"), F.max("t_us").alias("last_us"))
        latest.append(streams.drain_upsert(g, ["entity_id"], f"{root}/out", f"{root}/ck"))

    feed(spark, state_rows(spark, d), drain)
    x = latest[-1]
    return x.select("entity_id", "n", iso("last_us").alias("last_utc"))
