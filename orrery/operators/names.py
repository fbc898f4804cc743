"""Names and schemas of provider products: alias maps, shells, file-name rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.functions.orbit import MU, norm3
from orrery.functions.time import full_year, micros
from orrery.operators.scan import row_index
from orrery.sources import filenames

# Provider column names (lower case) and their canonical names.
STATE_ALIASES = {
    "satid": "sat_id", "satellite_id": "sat_id", "timestamp": "epoch", "time": "epoch", "x": "x_m", "y": "y_m", "z": "z_m",
    "vx": "vx_mps", "vy": "vy_mps", "vz": "vz_mps", "sigmax": "sigma_x_m", "sigmay": "sigma_y_m", "sigmaz": "sigma_z_m",
}
# Inclination centres (degrees) of the constellation shells.
SHELLS = [("43.0", 43.0), ("53.0", 53.0), ("53.2", 53.2), ("70", 70.0), ("97.6", 97.6)]
SHELL_TOLERANCE_DEG = 0.3


def canonical(df: DataFrame, aliases: dict[str, str], schema: dict[str, str]) -> DataFrame:
    """Rename known aliases, add missing columns as NULL, drop the rest, fix order and types."""
    by_name = {aliases.get(c.lower(), c): c for c in df.columns}
    return df.select(*[(F.col(by_name[n]) if n in by_name else F.lit(None)).cast(t).alias(n) for n, t in schema.items()])


def melt(df: DataFrame, ids: list[str], prefix: str) -> DataFrame:
    wide = [c for c in df.columns if c.startswith(prefix)]
    long = df.unpivot(ids, wide, "auxiliary_field", "auxiliary_value").where(F.col("auxiliary_value").isNotNull())
    return long.withColumn("auxiliary_field", F.lower("auxiliary_field"))


def shell(inclination_deg: Column) -> Column:
    """Nearest shell centre if within the tolerance; equal distances keep the listed order."""
    dist = F.array(*[F.struct(F.abs(inclination_deg - c).alias("d"), F.lit(i).alias("i"), F.lit(n).alias("n")) for i, (n, c) in enumerate(SHELLS)])
    best = F.array_min(dist)
    return F.when(best["d"] <= SHELL_TOLERANCE_DEG, best["n"]).otherwise("other")


def time_uncertainty(role: Column, seconds_token: Column, width_s: Column) -> Column:
    decimals = F.when(F.instr(seconds_token, ".") > 0, F.length(F.substring_index(seconds_token, ".", -1))).otherwise(0)
    return F.when(role == "first_impulse", 0.5 * F.pow(F.lit(10.0), -decimals)).when(role == "operation_end", width_s + 30.0)


def ramp(hours: Column, duration_h: Column) -> Column:
    step = F.when(hours >= 0, 1.0).otherwise(0.0)
    return F.when(duration_h <= 0, step).otherwise(F.least(F.greatest(hours / duration_h, F.lit(0.0)), F.lit(1.0)))


def family_rank(name: Column) -> Column:
    up = F.upper(name)
    return F.when(up.startswith("SWOT_VOR") | up.contains("MOEORB"), 1).otherwise(0)


def arc_start_day(name: Column, first_year: Column | None = None, last_year: Column | None = None) -> Column:
    """Days from 2000-01-01 to the arc start named in the file; -1 without a token.

    ``first_year`` / ``last_year`` bound the mission: a two-digit year is taken in the
    century that fits it, else by the pivot 57.
    """
    toks = filenames.tokens(F.upper(name))
    one = lambda *shapes: filenames.digits_at(toks, F.get(filenames.find(toks, *shapes), F.lit(0)))
    token = one(filenames.FIRST_DAY)
    yy = F.substring(token, 1, 2).cast("int")
    year = full_year(yy, 57)
    if first_year is not None or last_year is not None:
        def fits(y: Column) -> Column:
            ok = F.lit(True)
            if first_year is not None:
                ok = ok & (F.coalesce(y >= first_year, F.lit(True)))
            if last_year is not None:
                ok = ok & (F.coalesce(y <= last_year, F.lit(True)))
            return ok
        old, new = fits(1900 + yy), fits(2000 + yy)
        year = F.when(old & ~new, 1900 + yy).when(new & ~old, 2000 + yy).otherwise(year)
    sp3 = F.unix_date(F.date_add(F.make_date(year, F.lit(1), F.lit(1)), F.substring(token, 3, 3).cast("int") - 1))
    span = one(filenames.DATE, filenames.CLOCK, filenames.DATE, filenames.CLOCK)
    stamp = F.substring(F.coalesce(span, one(filenames.VALID_FROM)), 1, 8)
    dated = F.unix_date(F.to_date(stamp, "yyyyMMdd"))
    since_2000 = F.lit(10_957)
    return F.when(token.isNotNull(), sp3 - since_2000).when(stamp.isNotNull(), dated - since_2000).otherwise(-1)


def synthetic_product_name() -> Column:
    """A product name per shipment row in the notation of its flag pair."""
    ymd = F.date_format("day", "yyyyMMdd")
    pair = F.concat(ymd, F.lit("_000000_"), ymd, F.lit("_235959"))
    doy = F.concat(F.date_format("day", "yy"), F.lpad(F.dayofyear("day").cast("string"), 3, "0"))
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when((rf == "A") & (ls == "O"), F.concat(F.lit("SWOT_VOR_AXVCNE_"), pair, F.lit(".nc")))
        .when((rf == "A"), F.concat(F.lit("SWOT_POR_AXVCNE_"), pair, F.lit(".nc")))
        .when((rf == "N") & (ls == "O"), F.concat(F.lit("S3A_AUX_MOEORB_POD_V"), ymd, F.lit("T215942_"), ymd, F.lit("T235942.EOF")))
        .when((rf == "N"), F.concat(F.lit("S3A_AUX_POEORB_POD_V"), ymd, F.lit("T215942_"), ymd, F.lit("T235942.EOF")))
        .when((rf == "R") & (ls == "O"), F.lit("plain_product.sp3"))
        .otherwise(F.concat(F.lit("ssaja320.b"), doy, F.lit(".e"), doy, F.lit(".DG_.sp3.001")))
    )


def decode_seconds_since(units: Column, calendar: Column, seconds: Column) -> Column:
    """Microsecond epoch from ``seconds since <reference>``; only standard calendars."""
    ref = F.regexp_replace(F.regexp_extract(units, r"(?i)seconds\s+since\s+(.+)$", 1), "T", " ")
    base = F.coalesce(*[F.try_to_timestamp(ref, F.lit(f)) for f in ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss.SS", "yyyy-MM-dd HH:mm:ss.S", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd")])
    ok = F.lower(calendar).isin("standard", "gregorian", "proleptic_gregorian")
    return F.when(ok, micros(base) + F.bround(seconds * 1e6).cast("bigint"))


def velocity_unit(states: DataFrame, by: list[str], order: list[str], samples: int = 99) -> DataFrame:
    """Unit of the raw speeds of each file from the median ratio to circular speed over its first samples."""
    ratio = F.col("raw_speed") / F.sqrt(F.lit(MU) / norm3(F.col("x"), F.col("y"), F.col("z")))
    first = states.withColumn("_rn", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("_rn") <= samples)
    med = first.groupBy(*by).agg(F.percentile(ratio, 0.5).alias("median_ratio"))  # at most 99 values per file
    m = F.col("median_ratio")
    return med.withColumns({
        "scale": F.when(m.between(0.8, 1.3), 1.0).otherwise(0.1),
        "basis": F.when(m.between(0.8, 1.3), "m/s_as_written").when(m.between(8, 13), "dm/s_spec").otherwise("dm/s_spec_default_unresolved"),
    })


def even_samples(df: DataFrame, by: list[str], order: list[str], bucket: Column, limit: int) -> DataFrame:
    """Rows at evenly spaced (half-even rounded) positions of each group, at most ``limit``."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"))
    x = row_index(df, by, order, bucket, "_pos").join(n, by)
    take = F.least(F.col("_n"), F.lit(limit))
    pos, last, steps = F.col("_pos") - 1, F.greatest(F.col("_n") - 1, F.lit(1)), F.greatest(take - 1, F.lit(1))
    # at most one sample is as near as half a row; its number is the row's share of the steps, rounded either way
    near = F.floor(pos * steps / last)
    wanted = [(i >= 0) & (i < take) & (F.rint(i * (F.col("_n") - 1) / steps) == pos) for i in (near - 1, near, near + 1)]
    return x.where(wanted[0] | wanted[1] | wanted[2]).drop("_pos", "_n")


def slice_plan(df: DataFrame, order: list[str], start: int, count: int | None) -> DataFrame:
    """1-based slice of an ordered plan."""
    if start < 1 or (count is not None and count < 1):
        raise ValueError("start and count are 1-based and positive")
    out = df.orderBy(*order).offset(start - 1)
    return out if count is None else out.limit(count)
