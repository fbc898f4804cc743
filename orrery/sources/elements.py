"""Two-line element sets."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.time import day_of_year_us, full_year
from orrery.operators.scan import neighbour
from orrery.sources.lines import CHUNK, chunk_of, cols, number


def checksum(line: Column) -> Column:
    """Modulo-10 sum over the first 68 characters: digits count themselves, minus signs one."""
    kept = F.regexp_replace(F.substring(line, 1, 68), r"[^0-9\-]", "")
    return F.aggregate(F.split(F.regexp_replace(kept, "-", "1"), ""), F.lit(0), lambda a, c: a + F.coalesce(c.try_cast("int"), F.lit(0))) % 10


def scientific(field: Column) -> Column:
    """`` 12345-4`` -> 0.12345e-4; a blank second character is zero."""
    text = F.concat(F.when(F.substring(field, 1, 1) == "-", "-").otherwise(""), F.lit("."), F.substring(field, 2, 5), F.lit("e"), F.substring(field, 7, 2))
    return F.when(F.trim(field) == "", 0.0).when(F.substring(field, 2, 1) == " ", 0.0).otherwise(text.try_cast("double"))


def parse_pairs(lines: DataFrame, *, chunk: int = CHUNK) -> DataFrame:
    """One row per line-1/line-2 pair, name line or stray line, with its list of reject reasons.

    A line starting with 1 and directly followed by one starting with 2 is a pair, so
    the decision is local to neighbouring lines of the file.
    """
    x = lines.withColumn("value", F.trim("value")).where(F.col("value") != "")
    x = neighbour(x, ["file"], ["line_no"], chunk_of(chunk), ["value"], name="nxt", ahead=True)
    x = neighbour(x, ["file"], ["line_no"], chunk_of(chunk), ["value"], name="prv")
    one = F.col("value").startswith("1")
    two = F.col("value").startswith("2")
    next_two, next_one = F.coalesce(F.col("nxt.value").startswith("2"), F.lit(False)), F.coalesce(F.col("nxt.value").startswith("1"), F.lit(False))
    taken = two & F.coalesce(F.col("prv.value").startswith("1"), F.lit(False))
    kind = F.when(one & next_two, "pair").when(taken, "second").when(~one & ~two & next_one, "name_line").otherwise("unrecognized_line")
    x = x.withColumn("kind", kind).where("kind <> 'second'").select("file", "line_no", "kind", F.col("value").alias("line1"), F.col("nxt.value").alias("line2"))
    a, b = F.col("line1"), F.col("line2")
    short = (F.length(a) < 69) | (F.length(b) < 69)
    bad1 = checksum(a) != F.coalesce(F.substring(a, 69, 1).try_cast("int"), F.lit(-1))
    bad2 = checksum(b) != F.coalesce(F.substring(b, 69, 1).try_cast("int"), F.lit(-1))
    mismatch = F.trim(cols(a, 3, 7)) != F.trim(cols(b, 3, 7))
    yy, doy, frac = number(cols(a, 19, 20), "int"), number(cols(a, 21, 23), "int"), number(cols(a, 25, 32), "bigint")
    bad_epoch = yy.isNull() | doy.isNull() | frac.isNull() | (cols(a, 24, 24) != ".")
    pair = F.col("kind") == "pair"
    sums = F.array_compact(F.array(F.when(bad1, "checksum_line1"), F.when(bad2, "checksum_line2")))
    why = (
        F.when(F.col("kind") == "unrecognized_line", F.array(F.lit("unrecognized_line")))
        .when(~pair, F.array().cast("array<string>"))
        .when(short, F.array(F.lit("short_line")))
        .when(bad1 | bad2, sums)
        .when(mismatch, F.array(F.lit("norad_mismatch")))
        .when(bad_epoch, F.array(F.lit("bad_epoch")))
        .otherwise(F.array().cast("array<string>"))
    )
    ok = pair & (F.size("reasons") == 0)
    take = lambda c: F.when(ok, c)
    return x.withColumn("reasons", why).select(
        "file", "line_no", "kind", "reasons", take(F.trim(cols(a, 3, 7))).alias("entity_id"),
        # eight decimals of a day are exactly 864 microseconds each
        take(day_of_year_us(full_year(yy, 57), doy) + frac * 864).alias("t"),
        take(number(cols(b, 53, 63)) * (2 * math.pi / 1440.0)).alias("mean_motion"), take(F.radians(number(cols(b, 9, 16)))).alias("inclination"),
        take(F.concat(F.lit("0."), F.trim(cols(b, 27, 33))).try_cast("double")).alias("eccentricity"), take(scientific(cols(a, 54, 61))).alias("bstar"), "line1", "line2",
    )


def accepted(parsed: DataFrame) -> DataFrame:
    return parsed.where("kind = 'pair' AND size(reasons) = 0")


def reject_ledger(parsed: DataFrame) -> DataFrame:
    """Name lines, accepted pairs and every counted reason per file."""
    what = F.when(F.col("kind") == "name_line", F.array(F.lit("name_lines"))).when(F.size("reasons") == 0, F.array(F.lit("pairs_accepted"))).otherwise(F.col("reasons"))
    return parsed.select("file", F.explode(what).alias("reason")).groupBy("file", "reason").agg(F.count(F.lit(1)).alias("n"))
