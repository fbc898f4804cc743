"""Laser ranging formats: content routing, fixed width, sessioned, pass-header."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.orbit import LIGHT
from orrery.functions.time import day_of_year_us, full_year
from orrery.operators.scan import DAY_US, fill_forward, neighbour
from orrery.sources.lines import CHUNK, chunk_of, cols, digits, number

# Normal-point indicator -> window seconds.
NP_WINDOW = {"1": 10.0, "2": 10.0, "3": 10.0, "4": 10.0, "5": 5.0, "6": 15.0, "7": 30.0, "8": 60.0, "9": 120.0}


def one_way(tof_s: Column) -> Column:
    return tof_s / 2 * LIGHT


# First and last column of each field of the record.
SPANS = {"target": (1, 7), "yy": (8, 9), "doy": (10, 12), "tod": (13, 24), "station": (25, 28), "tof": (46, 57), "sigma": (58, 64), "np": (115, 115), "returns": (116, 119)}


def fixed_width_fields(v: Column) -> dict[str, Column]:
    """Columns of the fixed-width record, trimmed text."""
    return {k: F.trim(cols(v, *s)) for k, s in SPANS.items()}


# Fixed values of the record: fewest digits of its required fields, and the ranges of two of them.
FEWEST = {"target": 6, "yy": 1, "doy": 1, "tod": 1, "station": 4, "tof": 1}
RANGES = {"doy": (1, 366), "tod": (0, 863_999_999_999)}


def looks_fixed_width(v: Column) -> Column:
    """Whether every required field is a number of its size and range."""
    ok = F.length(v) >= SPANS["tof"][1]
    for name, fewest in FEWEST.items():
        text = F.trim(cols(v, *SPANS[name]))
        ok = ok & digits(text) & (F.length(text) >= fewest)
        if name in RANGES:
            ok = ok & text.try_cast("bigint").between(*RANGES[name])
    return ok


# Header and configuration record types that may open a sessioned file.
CRD_RECORDS = [f"H{k}" for k in range(1, 10)] + [f"C{k}" for k in range(10)]


def detect_format(lines: DataFrame) -> DataFrame:
    """Format of each file from its first non-empty line, never from its name."""
    filled = F.trim("value") != ""
    first = lines.groupBy("file").agg(F.min_by(F.when(filled, F.col("value")), F.when(filled, F.col("line_no"))).alias("head"))
    h = F.ltrim("head")
    up = F.upper(h)
    fmt = (
        F.when(F.col("head").isNull(), "unknown")
        .when(up.startswith("<!DOCTYPE") | up.startswith("<HTML"), "html_error_page")
        .when(F.upper(F.get(F.split(h, r"\s"), F.lit(0))).isin(CRD_RECORDS), "crd")
        .when(h == "99999", "legacy_npt")
        .when(looks_fixed_width(F.col("head")), "merit_monthly")
        .otherwise("unknown")
    )
    return first.select("file", fmt.alias("format"))


def parse_fixed_width(lines: DataFrame, mission: DataFrame | None = None) -> DataFrame:
    """Fixed-width records. ``mission`` (file, start_t, end_t; NULL = open) settles the century: exactly one
    candidate must lie inside. Files without a window use launch year .. launch year + 40."""
    x = lines.where(F.col("value") != "")
    f = fixed_width_fields(F.col("value"))
    x = x.withColumns(f)
    well = (F.length("value") >= 57) & digits(F.col("target")) & digits(F.col("yy")) & digits(F.col("doy")) & digits(F.col("tod")) & digits(F.col("station")) & digits(F.col("tof"))
    doy, tod = F.col("doy").try_cast("int"), F.col("tod").try_cast("bigint")
    well = well & F.coalesce(doy.between(1, 366) & (tod < 864_000_000_000), F.lit(False))
    yy = F.col("yy").try_cast("int")
    at = lambda century: day_of_year_us(yy + century, doy) + F.floor(tod / 10).cast("bigint")
    cand = F.array(at(1900), at(2000))
    target = F.lpad("target", 7, "0")
    if mission is None:
        x = x.withColumns({"start_t": F.lit(None).cast("bigint"), "end_t": F.lit(None).cast("bigint"), "_known": F.lit(False)})
    else:
        x = x.join(mission.withColumn("_known", F.col("start_t").isNotNull() | F.col("end_t").isNotNull()), "file", "left").na.fill(False, ["_known"])
    launch = full_year(F.substring(target, 1, 2).try_cast("int"), 57)
    inside = F.filter(cand, lambda c: (F.col("start_t").isNull() | (c >= F.col("start_t"))) & (F.col("end_t").isNull() | (c <= F.col("end_t"))))
    near = F.filter(cand, lambda c: F.year(F.timestamp_micros(c)).between(launch, launch + 40))
    x = x.withColumns({"_well": well, "_t": F.when(F.col("_known"), inside).otherwise(near)})
    reason = F.when(~F.col("_well"), "malformed_record").when(F.size("_t") != 1, "epoch_outside_mission_window")
    ok = reason.isNull()
    tof = F.col("tof").try_cast("bigint") * 1e-12
    np_map = F.create_map(*[F.lit(v) for kv in NP_WINDOW.items() for v in kv])
    is_np = (F.col("np") != "") & (F.col("np") != "0")
    take = lambda c: F.when(ok, c)
    return x.select(
        "file", "line_no", reason.alias("reject_reason"), take(F.when(is_np, "normal_point").otherwise("full_rate")).alias("record_type"), take(F.get("_t", F.lit(0))).alias("t"),
        take(tof).alias("tof_s"), take(one_way(tof)).alias("range_m"), take(one_way(F.col("sigma").try_cast("bigint") * 1e-12)).alias("sigma_m"),
        take(F.col("returns").try_cast("int")).alias("num_returns"), take(np_map[F.col("np")]).alias("window_s"), take(F.col("station")).alias("station_id"), take(target).alias("target_id"),
    )


def parse_sessions(lines: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Session records: data rows take the latest station, target and session date of their file.

    A session end (H8/H9) clears the date. Only data and unknown lines are returned.
    """
    x = lines.withColumn("v", F.trim("value")).where("v <> ''").withColumn("p", F.split("v", r"\s+"))
    at = lambda i: F.get("p", F.lit(i))
    kind, n = F.upper(at(0)), F.size("p")
    shift = F.when(F.length(at(1)) == 4, 1).otherwise(2)
    ymd = F.try_to_timestamp(F.concat_ws("-", *[F.lpad(F.get("p", shift + i), w, "0") for i, w in ((0, 4), (1, 2), (2, 2))]), F.lit("yyyy-MM-dd"))
    marks = {
        "station_id": F.when((kind == "H2") & (n >= 3), at(2)), "target_id": F.when((kind == "H3") & (n >= 3), at(2)),
        # -1 marks a cleared session; a header without a readable date changes nothing
        "day": F.when(kind.isin("H8", "H9"), F.lit(-1).cast("bigint")).when((kind == "H4") & (n >= 8), F.unix_micros(ymd)),
    }
    x = fill_forward(x.withColumn("kind", kind), ["file"], ["line_no"], chunk_of(chunk), marks)
    data = F.col("kind").isin("10", "11")
    known = data | F.col("kind").isin("12", "20", "30", "40", "50", "60", "00") | F.col("kind").rlike("^(9.|[HC][0-9])$")
    x = x.where(data | ~known)
    n, npt = F.size("p"), F.col("kind") == "11"
    sod, tof = at(1).try_cast("double"), at(2).try_cast("double")
    bad = sod.isNull() | tof.isNull() | (npt & (at(5).try_cast("double").isNull() | at(6).try_cast("double").isNull() | at(7).try_cast("double").isNull()))
    reason = (
        F.when(~F.col("kind").isin("10", "11"), "unknown_record_type").when(n < F.when(npt, 8).otherwise(5), "short_record").when(bad, "malformed_record")
        .when(F.coalesce("day", F.lit(-1)) < 0, "epoch_reference_missing")
    )
    take = lambda c: F.when(reason.isNull(), c)
    return x.select(
        "file", "line_no", reason.alias("reject_reason"), take(F.when(npt, "normal_point").otherwise("full_rate")).alias("record_type"), take(F.col("day") + F.bround(sod * 1e6).cast("bigint")).alias("t"),
        take(tof).alias("tof_s"), take(one_way(tof)).alias("range_m"), take(F.when(npt, one_way(at(7).try_cast("double") * 1e-12))).alias("sigma_m"),
        take(F.when(npt, at(6).try_cast("double").cast("int"))).alias("num_returns"), take(F.when(npt, at(5).try_cast("double"))).alias("window_s"), "station_id", "target_id",
    )


def parse_passes(lines: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """Pass-header normal points: a 99999 line announces the header whose date and station later rows use."""
    x = lines.withColumn("v", F.trim("value")).where("v <> ''")
    x = neighbour(x, ["file"], ["line_no"], chunk_of(chunk), ["v"], name="prv").where("v <> '99999'")
    head = F.coalesce(F.col("prv.v") == "99999", F.lit(False))
    v = F.col("v")
    yy, doy = F.substring(v, 8, 2).try_cast("int"), F.substring(v, 10, 3).try_cast("int")
    good_head = head & (F.length(v) >= 16) & digits(F.trim(F.substring(v, 1, 12))) & yy.isNotNull() & doy.isNotNull()
    day = F.when(good_head, day_of_year_us(full_year(yy, 85, inclusive=True), doy))
    marks = {"day": day, "station_id": F.when(good_head, F.trim(F.substring(v, 13, 4))), "target_id": F.when(good_head, F.trim(F.substring(v, 1, 7)))}
    x = fill_forward(x.withColumns({"head": head, "good_head": good_head}), ["file"], ["line_no"], chunk_of(chunk), marks).where("NOT good_head")
    tod, tof, rms, ret = (F.substring(v, a, n).try_cast("bigint") for a, n in ((1, 12), (13, 12), (25, 7), (44, 4)))
    reason = (
        F.when(F.col("head"), "malformed_header_record").when(F.col("day").isNull(), "data_without_active_pass").when(F.length(v) < 47, "short_data_record")
        .when(~digits(F.substring(v, 1, 12)) | tof.isNull() | rms.isNull() | ret.isNull(), "malformed_record")
    )
    take = lambda c: F.when(reason.isNull(), c)
    return x.select(
        "file", "line_no", reason.alias("reject_reason"), take(F.col("day") + F.floor(tod % 864_000_000_000 / 10).cast("bigint")).alias("t"), take(tof * 1e-12).alias("tof_s"),
        take(one_way(tof * 1e-12)).alias("range_m"), take(one_way(rms * 1e-12)).alias("sigma_m"), take(ret.cast("int")).alias("num_returns"), take(F.col("station_id")).alias("station_id"), take(F.col("target_id")).alias("target_id"),
    )
