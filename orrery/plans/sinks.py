"""Release output queries: each writes to a fresh scratch folder and reads its result back."""

from __future__ import annotations

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions.time import iso
from orrery.plans.joins import PRESENCE_CTE, STATUS_CTE, covered_windows
from orrery.plans.registry import query
from orrery.roles import iso_sql, oracle, rnd, rsql
from orrery.session import scratch_dir
from orrery.sinks import release


@query("k01_snapshot_sink", oracle(f"SELECT entity_id, count(*) AS rows, {rsql('sum(x)', 1)} AS sum_x FROM states GROUP BY 1"))
def k01(spark, d):
    """Bucketed parquet snapshot, read back."""
    path = scratch_dir(spark, "snapshot") + "/orbit"
    release.write_snapshot(R.states(spark, d), path)
    return spark.read.parquet(path).groupBy(F.col("entity_id").cast("bigint").alias("entity_id")).agg(F.count("*").alias("rows"), rnd(F.sum("x"), 1).alias("sum_x"))


@query("k02_label_csv_sink", oracle("SELECT annotation_id, coverage_tier, missing_sources FROM cov", PRESENCE_CTE, STATUS_CTE))
def k02(spark, d):
    """Gzipped label table, read back as text."""
    path = scratch_dir(spark, "labels") + "/labels"
    release.write_csv(covered_windows(spark, d).select("annotation_id", "entity_id", "coverage_tier", "missing_sources"), path, gzip=True)
    return spark.read.csv(path, header=True).select("annotation_id", "coverage_tier", F.coalesce("missing_sources", F.lit("")).alias("missing_sources"))


@query("k03_json_report_sink", oracle("""SELECT '{"entity_id":' || entity_id || ',"rows":' || n || ',"stations":' || s || '}' AS line FROM (SELECT entity_id, count(*) AS n, count(DISTINCT station_id) AS s FROM ranging GROUP BY 1)"""))
def k03(spark, d):
    """JSON lines with sorted keys."""
    path = scratch_dir(spark, "report") + "/report"
    r = R.ranging(spark, d).groupBy("entity_id").agg(F.countDistinct("station_id").alias("stations"), F.count("*").alias("rows"))
    release.write_jsonl(r, path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query("k04_release_manifest", oracle("SELECT count(*) AS rows, true AS all_hashed, 1::BIGINT AS differing, min('bucket=' || (('0x' || substr(md5(entity_id::VARCHAR),1,15))::BIGINT % 64)) AS altered FROM states"))
def k04(spark, d):
    """Hash, size and rows of every snapshot file; a copy with one altered file is told by that file's name."""
    base = scratch_dir(spark, "manifest")
    path, copy = base + "/orbit", base + "/copy"
    release.write_snapshot(R.states(spark, d), path)
    m = release.manifest(spark, path)
    first, second = (r.path for r in m.orderBy("path").limit(2).collect())
    hadoop = spark._jvm.org.apache.hadoop.fs
    conf = spark._jsc.hadoopConfiguration()
    fs = hadoop.Path(base).getFileSystem(conf)
    hadoop.FileUtil.copy(fs, hadoop.Path(path), fs, hadoop.Path(copy), False, True, conf)
    hadoop.FileUtil.copy(fs, hadoop.Path(f"{path}/{second}"), fs, hadoop.Path(f"{copy}/{first}"), False, True, conf)
    bad = release.verify(release.manifest(spark, copy), m).agg(F.count("*").alias("differing"), F.min(F.substring_index("path", "/", 1)).alias("altered"))
    s = m.agg(F.sum("rows").alias("rows"), F.min((F.length("sha256") == 64) & (F.col("bytes") > 0)).alias("all_hashed"))
    return s.join(F.broadcast(bad))  # two one-row tables


@query("k05_flat_name_map", oracle("SELECT 'evidence__' || source_type || '__' || path AS flat, 'evidence/' || source_type || '/' || path AS path, false AS collision FROM orbit_files"))
def k05(spark, d):
    """Path separators become double underscores; shared names are marked."""
    p = R.orbit_files(spark, d).select(F.concat_ws("/", F.lit("evidence"), "source_type", "path").alias("path"))
    return release.flat_names(p).select("flat", "path", "collision")


@query("k06_first_entities_sample", oracle("SELECT event_id, entity_id FROM states WHERE entity_id IN (SELECT entity_id FROM (SELECT DISTINCT entity_id FROM states) ORDER BY entity_id::VARCHAR LIMIT 25)"))
def k06(spark, d):
    """Rows of the 25 alphabetically first entities."""
    return release.first_entities(R.states(spark, d)).select("event_id", "entity_id")


@query("k07_data_dictionary", """SELECT 'orders' AS "table", f AS field, n AS non_null, t AS rows FROM (SELECT unnest([{'f':'o_orderkey','n':count(o_orderkey)},{'f':'o_custkey','n':count(o_custkey)},{'f':'o_orderstatus','n':count(o_orderstatus)},{'f':'o_totalprice','n':count(o_totalprice)},{'f':'o_orderdate','n':count(o_orderdate)},{'f':'o_orderpriority','n':count(o_orderpriority)}], recursive:=true), count(*) AS t FROM orders)
 UNION ALL SELECT 'events', f, n, t FROM (SELECT unnest([{'f':'event_id','n':count(event_id)},{'f':'ts','n':count(ts)},{'f':'user_id','n':count(user_id)},{'f':'event_type','n':count(event_type)},{'f':'value','n':count(value)},{'f':'props','n':count(props)}], recursive:=true), count(*) AS t FROM events)""")
def k07(spark, d):
    """Fields of the tables with types, units and counts."""
    return release.data_dictionary({n: R.table(spark, d, n) for n in ("orders", "events")}).select("table", "field", "non_null", "rows")


@query("k08_csv_canonicaliser", oracle(f"SELECT annotation_id, CASE WHEN ws%1000000=0 THEN strftime(make_timestamp(ws), '%Y-%m-%dT%H:%M:%SZ') ELSE {iso_sql('ws')} END AS window_start_utc FROM annotations"))
def k08(spark, d):
    """Time columns of a CSV table rewritten to ISO form in place."""
    path = scratch_dir(spark, "canonical") + "/windows"
    w = R.annotations(spark, d).select("annotation_id", F.date_format(F.timestamp_micros("ws"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("window_start_utc"))
    release.write_csv(w, path)
    release.canonicalise_csv(spark, path, ["window_start_utc"])
    return spark.read.csv(path, header=True).select("annotation_id", "window_start_utc")


@query("k09_label_bundle", oracle("SELECT 'row' AS kind, annotation_id AS id FROM annotations UNION ALL SELECT 'row', CAST(event_id AS VARCHAR) FROM external_times UNION ALL SELECT 'no_input', CAST(entity_id AS VARCHAR) FROM targets WHERE entity_id NOT IN (SELECT entity_id FROM annotations UNION SELECT entity_id FROM external_times)"))
def k09(spark, d):
    """Label tables concatenated without the split column, and the targets without input."""
    a = R.annotations(spark, d).select("entity_id", F.col("annotation_id").alias("id"), F.lit("train").alias("split"))
    b = R.external_times(spark, d).select("entity_id", F.col("event_id").cast("string").alias("id"))
    rows, lack = release.label_bundle([a, b], R.targets(spark, d).select("entity_id"))
    return rows.select(F.lit("row").alias("kind"), "id").unionByName(lack.select(F.lit("no_input").alias("kind"), F.col("entity_id").cast("string").alias("id")))
