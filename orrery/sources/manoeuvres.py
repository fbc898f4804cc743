"""Reported manoeuvre histories: whitespace records of 9, 11 or at least 16 tokens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.ids import stable_id
from orrery.functions.time import day_of_year_us, iso_milli_form
from orrery.operators.dedup import keep_one
from orrery.operators.names import time_uncertainty
from orrery.operators.scan import HOUR_US


def _moment(tok: Column, i: int, second: Column | None = None) -> Column:
    """Year, day of year, hour, minute (and seconds) at token i; NULL for a day outside its year."""
    part = lambda k: F.get(tok, F.lit(i + k)).try_cast("int")
    year, doy = part(0), part(1)
    us = day_of_year_us(year, doy) + (part(2) * 60 + part(3)).cast("bigint") * 60_000_000
    if second is not None:
        us = us + F.bround(second * 1e6).cast("bigint")
    return F.when((doy >= 1) & (F.year(F.timestamp_micros(us)) == year), us)


def parse_history(lines: DataFrame, source: str, *, strict: bool = True) -> DataFrame:
    """Annotation rows with their windows; one unreadable record stops the job in strict mode.

    Without ``strict`` such records come back with ``problem`` set.
    """
    x = lines.withColumn("raw", F.trim("value")).where((F.col("raw") != "") & ~F.col("raw").startswith("#"))
    x = x.withColumn("tok", F.split("raw", r"\s+")).withColumn("n", F.size("tok"))
    tok, n = F.col("tok"), F.col("n")
    impulse = n >= 16
    start, end = _moment(tok, 1), _moment(tok, 5)
    token = F.get(tok, F.lit(15))
    hit = _moment(tok, 11, token.try_cast("double"))
    x = x.withColumns({
        "op_start": start, "op_end": end, "event_t": F.when(impulse, hit).otherwise(end),
        "role": F.when(impulse, "first_impulse_time").otherwise("reported_operation_end_time"),
        "code": F.when(n >= 11, F.get(tok, F.lit(9))).otherwise(""), "impulses": F.when(n >= 11, F.get(tok, F.lit(10)).try_cast("int")).otherwise(0),
    })
    problem = F.when(~n.isin(9, 11) & (n < 16), "unsupported_arity").when(F.col("op_start").isNull() | F.col("op_end").isNull() | F.col("event_t").isNull() | F.col("impulses").isNull(), "unreadable_time")
    x = x.withColumn("problem", problem)
    if strict:
        x = x.withColumn("raw", F.coalesce(F.assert_true(F.col("problem").isNull(), F.concat(F.lit("manoeuvre record: "), F.col("raw"))).cast("string"), F.col("raw")))
    text = lambda c: iso_milli_form(F.timestamp_micros(c))
    role = F.when(impulse, "first_impulse").otherwise("operation_end")
    ident = stable_id("ann", F.col("file"), F.lit(source), text("event_t"), text("op_start"), text("op_end"), F.when(F.col("code") == "", "operation_only").otherwise(F.col("code")), F.col("impulses"))
    out = x.select(
        ident.alias("annotation_id"), "file", "line_no", "event_t", "role", "op_start", "op_end", (F.col("event_t") - 6 * HOUR_US).alias("ws"), (F.col("event_t") + 24 * HOUR_US).alias("we"),
        time_uncertainty(role, token, (F.col("op_end") - F.col("op_start")) / 1e6).alias("uncertainty_s"), "impulses", "code", "problem", "raw",
    )
    return keep_one(out, ["annotation_id"], ["file", "line_no"])
