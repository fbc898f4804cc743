"""Time spans read from provider file names.

A name is a list of tokens between ``_`` and ``.``; each notation is told by the shape of its tokens.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orrery.functions.time import day_of_year_us, full_year, micros
from orrery.operators.scan import DAY_US

# Shapes of time tokens, as the providers' naming conventions prescribe them.
DATE = r"^\d{8}$"  # yyyyMMdd
CLOCK = r"^\d{6}$"  # HHmmss; alone: yyyyMM
VALID_FROM = r"^V\d{8}T\d{6}$"  # start of validity; the end is the next token
YEAR_DAY_MINUTE = r"^\d{11}$"  # yyyyDDDHHmm
LENGTH_IN_DAYS = r"^\d{2}D$"
FIRST_DAY, LAST_DAY = r"^[bB]\d{5}$", r"^[eE]\d{5}$"  # yyDDD


def tokens(name: Column) -> Column:
    return F.split(name, r"[._]")


def find(toks: Column, *shapes: str) -> Column:
    """Positions (from 0) at which consecutive tokens have these shapes."""
    def here(i: Column) -> Column:
        ok = F.lit(True)
        for k, shape in enumerate(shapes):
            ok = ok & F.coalesce(F.get(toks, i + k).rlike(shape), F.lit(False))
        return ok

    return F.filter(F.sequence(F.lit(0), F.size(toks) - 1), here)


def digits_at(toks: Column, position: Column, count: int = 1) -> Column:
    """The digits of ``count`` tokens from a position on; NULL beyond the name."""
    return F.regexp_replace(F.concat(*[F.get(toks, position + k) for k in range(count)]), r"\D", "")


def _moment(text: Column) -> Column:
    return micros(F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def _number(text: Column, start: int, width: int) -> Column:
    return F.substring(text, start, width).try_cast("int")


def orbit_span(name: Column) -> Column:
    """struct(s, e) by the first notation whose tokens the name holds; NULL when none fits."""
    toks = tokens(name)
    valid = F.get(find(toks, VALID_FROM), F.lit(0))
    stamped = find(toks, DATE, CLOCK)
    count = F.size(stamped)
    started = digits_at(toks, F.get(find(toks, YEAR_DAY_MINUTE, LENGTH_IN_DAYS), F.lit(0)), 2)
    minute = (_number(started, 8, 2) * 60 + _number(started, 10, 2)).cast("bigint") * 60_000_000
    start = day_of_year_us(_number(started, 1, 4), _number(started, 5, 3)) + minute
    arc = digits_at(toks, F.get(find(toks, FIRST_DAY, LAST_DAY), F.lit(0)), 2)
    day = lambda at: day_of_year_us(full_year(_number(arc, at, 2), 57), _number(arc, at + 2, 3))
    spans = [
        (_moment(digits_at(toks, valid)), _moment(digits_at(toks, valid + 1))),
        (_moment(digits_at(toks, F.get(stamped, count - 2), 2)), _moment(digits_at(toks, F.get(stamped, count - 1), 2))),
        (start, start + _number(started, 12, 2) * F.lit(DAY_US)),
        (day(1), day(6) + DAY_US),
    ]
    return F.coalesce(*[F.when(s.isNotNull() & e.isNotNull(), F.struct(s.alias("s"), e.alias("e"))) for s, e in spans])


def ranging_span(name: Column) -> Column:
    """Daily token -> one day, else monthly token -> one month. The first token is the product's name."""
    toks = tokens(name)
    first = lambda shape: F.get(toks, F.get(F.filter(find(toks, shape), lambda i: i > 0), F.lit(0)))
    d, m = first(DATE), first(CLOCK)
    day, month = F.try_to_date(d, "yyyyMMdd"), F.try_to_date(F.concat(m, F.lit("01")), "yyyyMMdd")
    us = lambda c: F.unix_date(c).cast("bigint") * DAY_US
    daily = F.struct(us(day).alias("s"), (us(day) + DAY_US).alias("e"))
    monthly = F.struct(us(month).alias("s"), us(F.add_months(month, 1)).alias("e"))
    return F.when(d.isNotNull(), F.when(day.isNotNull(), daily)).when(month.isNotNull(), monthly)
