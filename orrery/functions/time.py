"""Epoch parsing, formatting and calendar columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(c: Column | str) -> Column:
    """Epoch in integer microseconds (a timestamp without zone is read as UTC)."""
    return F.unix_micros(F.col(c).cast("timestamp") if isinstance(c, str) else c.cast("timestamp"))


def iso(t_us: Column | str) -> Column:
    """Full-precision ISO-8601 UTC text of a microsecond epoch."""
    c = F.col(t_us) if isinstance(t_us, str) else t_us
    return F.date_format(F.timestamp_micros(c), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_utc(text: Column) -> Column:
    """Timestamp from text; a trailing `` UTC`` is dropped, unreadable text gives NULL."""
    return F.try_to_timestamp(F.regexp_replace(F.trim(text), r"\s*UTC$", ""))


def iso_micro_form(ts: Column) -> Column:
    """``...Z`` with six decimals only when the fraction is not zero; NULL gives ''."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(ts.isNull(), F.lit("")).otherwise(
        F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
            F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
        )
    )


def iso_milli_form(ts: Column) -> Column:
    """As above with truncated milliseconds."""
    whole = F.unix_micros(ts) % 1_000_000 == 0
    return F.when(ts.isNull(), F.lit("")).otherwise(
        F.when(whole, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
            F.date_format(F.date_trunc("MILLISECOND", ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
        )
    )


def normalise_iso_text(text: Column) -> Column:
    """Compact ``...T...Z`` text passes; ``date time`` text is brought to that form."""
    t = F.trim(text)
    compact = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$"
    return F.when(t.isNull() | (t == ""), F.lit("")).when(t.rlike(compact), t).otherwise(iso_micro_form(parse_utc(t)))


def full_year(two_digit: Column, pivot: int, inclusive: bool = False) -> Column:
    """Century of a two-digit year: below the pivot is 20xx (``inclusive``: up to it)."""
    low = two_digit <= pivot if inclusive else two_digit < pivot
    return F.when(low, two_digit + 2000).otherwise(two_digit + 1900)


def day_of_year_us(year: Column, doy: Column) -> Column:
    """Microsecond epoch of the start of a day-of-year."""
    return F.unix_date(F.date_add(F.make_date(year.cast("int"), F.lit(1), F.lit(1)), (doy - 1).cast("int"))).cast("bigint") * 86_400_000_000


def gps_week(day: Column) -> Column:
    """(week, weekday) since 1980-01-06."""
    days = F.datediff(day, F.lit("1980-01-06").cast("date"))
    return F.struct(F.floor(days / 7).cast("int").alias("week"), F.pmod(days, F.lit(7)).cast("int").alias("dow"))


def gps_week_day(week: Column, dow: Column) -> Column:
    return F.date_add(F.lit("1980-01-06").cast("date"), (week * 7 + dow).cast("int"))


# TAI-UTC in whole seconds from each date on (IERS announcements).
LEAP_SECONDS = [
    ("1972-01-01", 10), ("1972-07-01", 11), ("1973-01-01", 12), ("1974-01-01", 13), ("1975-01-01", 14),
    ("1976-01-01", 15), ("1977-01-01", 16), ("1978-01-01", 17), ("1979-01-01", 18), ("1980-01-01", 19),
    ("1981-07-01", 20), ("1982-07-01", 21), ("1983-07-01", 22), ("1985-07-01", 23), ("1988-01-01", 24),
    ("1990-01-01", 25), ("1991-01-01", 26), ("1992-07-01", 27), ("1993-07-01", 28), ("1994-07-01", 29),
    ("1996-01-01", 30), ("1997-07-01", 31), ("1999-01-01", 32), ("2006-01-01", 33), ("2009-01-01", 34),
    ("2012-07-01", 35), ("2015-07-01", 36), ("2017-01-01", 37),
]


def tai_minus_utc(day: Column) -> Column:
    """Leap-second step at a UTC date, as one CASE over the 28 fixed steps."""
    out = F.lit(None).cast("int")
    for since, step in LEAP_SECONDS:
        out = F.when(day >= F.lit(since).cast("date"), F.lit(step)).otherwise(out)
    return out


def time_scale_shift_seconds(scale: Column, day: Column) -> Column:
    """Seconds to add to an epoch in TAI / GPS / UTC to get UTC; NULL for other scales."""
    step = tai_minus_utc(day)
    return F.when(scale == "UTC", F.lit(0)).when(scale == "TAI", -step).when(scale == "GPS", -(step - 19))
