"""Station solutions and observation-file coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.time import day_of_year_us, full_year
from orrery.operators.scan import fill_forward
from orrery.sources.lines import CHUNK, chunk_of


def _epoch(token: Column) -> Column:
    p = F.split(token, ":")
    yy, doy, sod = (F.get(p, F.lit(i)).try_cast("int") for i in range(3))
    return day_of_year_us(full_year(yy, 50), doy) + sod.cast("bigint") * 1_000_000


def parse_solutions(lines: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """One row per (code, point, solution): validity, reference epoch, position, velocity (0 where absent)."""
    v = F.col("value")
    mark = F.when(v.startswith("+SOLUTION/EPOCHS"), "epochs").when(v.startswith("+SOLUTION/ESTIMATE"), "estimate").when(v.startswith("-SOLUTION"), "none")
    x = fill_forward(lines, ["file"], ["line_no"], chunk_of(chunk), {"block": mark})
    x = x.where(F.col("block").isin("epochs", "estimate") & ~v.rlike(r"^[+\-*]") & (F.trim(v) != "")).withColumn("p", F.split(F.trim(v), r"\s+"))
    at = lambda i: F.get("p", F.lit(i))
    ep = x.where("block = 'epochs'").select("file", at(0).alias("code"), at(1).alias("pt"), at(2).alias("soln"), _epoch(at(4)).alias("s"), F.when(at(5) != "00:000:00000", _epoch(at(5))).alias("e"))
    es = x.where("block = 'estimate'").select("file", at(2).alias("code"), at(3).alias("pt"), at(4).alias("soln"), at(1).alias("type"), _epoch(at(5)).alias("ref"), at(8).try_cast("double").alias("value"))
    wide = es.groupBy("file", "code", "pt", "soln").pivot("type", ["STAX", "STAY", "STAZ", "VELX", "VELY", "VELZ"]).agg(F.max("value"))
    ref = es.groupBy("file", "code", "pt", "soln").agg(F.max("ref").alias("ref"))
    key = ["file", "code", "pt", "soln"]
    wide = wide.where("STAX is not null and STAY is not null and STAZ is not null").na.fill(0.0, ["VELX", "VELY", "VELZ"])
    return wide.join(ref, key).join(ep, key, "left")


def coverage_manifest(lines: DataFrame, *, strict: bool = True) -> DataFrame:
    """Span of each observation file from its header, the end from the last epoch line where the header lacks it."""
    v = F.col("value")
    label = F.trim(F.substring(v, 61, 20))
    body = F.split(F.trim(F.substring(v, 1, 60)), r"\s+")

    def moment(p: Column) -> Column:
        g = lambda i: F.get(p, F.lit(i))
        return F.unix_micros(F.try_make_timestamp(*[g(i).try_cast("int") for i in range(5)], g(5).try_cast("double").cast("decimal(16,6)")))

    marker = F.split(F.trim(F.substring(v, 2, 59)), r"\s+")
    end_header = F.min(F.when(label == "END OF HEADER", F.col("line_no")))
    agg = lines.groupBy("file").agg(
        F.max(F.when(label == "RINEX VERSION / TYPE", F.get(body, F.lit(0)))).alias("rinex_version"), F.max(F.when(label == "RINEX VERSION / TYPE", F.get(body, F.lit(1)))).alias("obs_type"),
        F.max(F.when(label == "TIME OF FIRST OBS", moment(body))).alias("first_obs"), F.max(F.when(label == "TIME OF LAST OBS", moment(body))).alias("header_last"),
        F.max_by(moment(marker), F.when(v.startswith(">"), F.col("line_no"))).alias("body_last"), end_header.alias("_end"),
    )
    out = agg.withColumns({"last_obs": F.coalesce("header_last", "body_last"), "last_obs_source": F.when(F.col("header_last").isNotNull(), "header").when(F.col("body_last").isNotNull(), "body_last_epoch").otherwise("")})
    problem = (
        F.when(~F.coalesce(F.col("rinex_version").startswith("3.") & F.upper("obs_type").startswith("O"), F.lit(False)), "not_version_3_observation")
        .when(F.col("first_obs").isNull(), "missing_first_obs").when(F.col("last_obs").isNull(), "missing_last_obs")
    )
    out = out.withColumn("problem", problem)
    if strict:
        out = out.withColumn("file", F.coalesce(F.assert_true(F.col("problem").isNull(), F.concat(F.col("file"), F.lit(": "), F.col("problem"))).cast("string"), F.col("file")))
    return out.select("file", "rinex_version", "first_obs", "last_obs", "last_obs_source", "problem")
