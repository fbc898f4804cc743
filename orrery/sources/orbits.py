"""Orbit products: epoch blocks, XML state vectors, routing by product type."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.orbit import MU, norm3
from orrery.functions.time import LEAP_SECONDS, micros
from orrery.operators.qc import CLOCK_SENTINEL
from orrery.operators.scan import fill_forward
from orrery.sources.lines import CHUNK, chunk_of, cols, number


def parse_epoch_blocks(lines: DataFrame, *, base: float = 1.25, chunk: int = CHUNK) -> tuple[DataFrame, DataFrame]:
    """States (km to m, velocity unit decided per file) and the per-file ledger of counted lines."""
    v = F.col("value")
    kind = F.substring(v, 1, 1)
    x = lines.withColumn("kind", kind).where(F.col("kind").isin("*", "P", "V"))
    ints = [number(cols(v, a, b), "int") for a, b in ((4, 7), (9, 10), (12, 13), (15, 16), (18, 19))]
    sec = number(cols(v, 21, 31))
    ts = F.try_make_timestamp(*ints, sec.cast("decimal(16,6)"))
    mark = F.when(F.col("kind") == "*", F.coalesce(F.unix_micros(ts), F.lit(-1)))
    x = fill_forward(x, ["file"], ["line_no"], chunk_of(chunk), {"t": mark})
    a, b, c, clk = (number(cols(v, *s)) for s in ((5, 18), (19, 32), (33, 46), (47, 60)))
    full = F.length(v) >= 60
    sig = lambda i, j: F.when(F.length(v) >= 73, F.pow(F.lit(base), number(cols(v, i, j), "int")) / 1000)
    x = x.withColumns({"sat": F.trim(cols(v, 2, 4)), "a": a, "b": b, "c": c, "clk": F.when(full, clk), "sx": sig(62, 63), "sy": sig(65, 66), "sz": sig(68, 69)})
    bad = F.col("a").isNull() | F.col("b").isNull() | F.col("c").isNull() | (full & F.col("clk").isNull())
    x = x.withColumn("bad", (F.col("kind") != "*") & bad)
    k = F.col("kind")
    sentinel = F.coalesce(F.col("clk") == CLOCK_SENTINEL, F.lit(False))
    led = x.groupBy("file").agg(
        F.count_if(k == "*").alias("epoch_lines"), F.count_if((k == "*") & (F.col("t") < 0)).alias("epoch_lines_rejected"), F.count_if((k == "P") & ~F.col("bad")).alias("p_records"),
        F.count_if((k == "P") & F.col("bad")).alias("p_records_rejected"), F.count_if((k == "V") & ~F.col("bad")).alias("v_records"), F.count_if((k == "V") & F.col("bad")).alias("v_records_rejected"),
        F.count_if((k != "*") & ~F.col("bad") & sentinel).alias("clock_sentinel_rows"),
    )
    good = x.where("kind <> '*' AND NOT bad AND t >= 0").withColumn("clk", F.nullif("clk", F.lit(CLOCK_SENTINEL)))
    # later lines of an epoch replace earlier ones of the same vehicle
    one = good.groupBy("file", "t", "sat").agg(
        F.max_by(F.struct("a", "b", "c", "clk", "sx", "sy", "sz"), F.when(k == "P", F.col("line_no"))).alias("p"),
        F.max_by(F.struct("a", "b", "c"), F.when(k == "V", F.col("line_no"))).alias("v"), F.min("line_no").alias("first_line"),
    ).where("p is not null")
    out = one.select("file", "t", "sat", "first_line", *[(F.col(f"p.{s}") * 1000).alias(n) for s, n in zip("abc", "xyz")], F.col("p.clk").alias("clock"), F.col("p.sx").alias("sigma_x"), F.col("p.sy").alias("sigma_y"), F.col("p.sz").alias("sigma_z"), *[F.col(f"v.{s}").alias(f"raw_{n}") for s, n in zip("abc", ("vx", "vy", "vz"))])
    scale = velocity_scale(out)
    out = out.join(scale, "file", "left")
    return out.select("file", "t", "sat", "x", "y", "z", "clock", "sigma_x", "sigma_y", "sigma_z", *[(F.col(f"raw_{n}") * F.coalesce("scale", F.lit(0.1))).alias(n) for n in ("vx", "vy", "vz")]), led.join(scale, "file", "left")


def velocity_scale(states: DataFrame) -> DataFrame:
    from orrery.operators.names import velocity_unit

    raw = states.where("raw_vx is not null").withColumn("raw_speed", norm3(F.col("raw_vx"), F.col("raw_vy"), F.col("raw_vz")))
    return velocity_unit(raw, ["file"], ["first_line"]).select("file", "scale", F.col("basis").alias("velocity_unit_basis"))


def count_check(ledger: DataFrame, headers: DataFrame) -> DataFrame:
    """Declared epochs x satellites against the position lines read; a difference is a warning."""
    j = ledger.join(headers, "file")
    expected = F.col("num_epochs") * F.col("num_sats")
    return j.select("file", "p_records", expected.alias("expected"), F.when((expected > 0) & (expected != F.col("p_records")), "p_record_count_mismatch").otherwise("").alias("warning"))


def read_state_vectors(spark: SparkSession, path: str) -> DataFrame:
    """XML state vectors: UTC preferred, else TAI through the leap-second steps; non-nominal rows stay."""
    schema = "TAI string, UTC string, X string, Y string, Z string, VX string, VY string, VZ string, Quality string"
    raw = spark.read.format("xml").option("rowTag", "OSV").schema(schema).load(path)
    stamp = lambda c: micros(F.try_to_timestamp(F.replace(F.element_at(F.split(c, "="), -1), F.lit("T"), F.lit(" "))))
    tai = stamp(F.col("TAI"))
    utc = F.lit(None).cast("bigint")
    for since, step in LEAP_SECONDS:
        # a TAI moment belongs to the last step that had begun at that moment
        utc = F.when(tai - step * 1_000_000 >= F.unix_micros(F.lit(f"{since} 00:00:00").cast("timestamp")), tai - step * 1_000_000).otherwise(utc)
    t = F.coalesce(F.when(F.coalesce("UTC", F.lit("")) != "", stamp(F.col("UTC"))).otherwise(utc))
    nums = {c.lower(): F.coalesce(F.col(c), F.lit("0")).try_cast("double") for c in ("X", "Y", "Z", "VX", "VY", "VZ")}
    bad = F.lit(False)
    for c in nums.values():
        bad = bad | c.isNull()
    reason = F.when(t.isNull(), "missing_or_unparsable_epoch").when(bad, "malformed_osv")
    q = F.trim(F.coalesce("Quality", F.lit("")))
    return raw.select(t.alias("t"), *[c.alias(n) for n, c in nums.items()], q.alias("quality"), ((q != "") & (q != "NOMINAL")).alias("non_nominal"), reason.alias("reject_reason"))


def product_family(name: Column) -> Column:
    """Reader of a product by its name; observation files are refused."""
    up = F.upper(name)
    return (
        F.when(up.rlike(r"\.(EOF|XML)$"), "state_vectors").when(up.rlike(r"\.(Z|SP3|EPH)$"), "epoch_blocks").when(up.endswith(".GZ") | up.contains(".RNX"), "gnss_rinex_observation_not_satellite_ephemeris")
        .when(up.endswith(".NC") & (up.startswith("SWOT_POR") | up.startswith("SWOT_VOR")), "precise_netcdf").when(up.endswith(".NC"), "near_real_time_netcdf").otherwise("unsupported_orbit_format")
    )


def rotating_frame(family: Column) -> Column:
    return family.isin("state_vectors", "precise_netcdf", "near_real_time_netcdf")
