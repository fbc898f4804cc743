"""Deterministic identifiers and small text rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_id(prefix: str, *parts: Column) -> Column:
    """``prefix_`` + 12 hex of SHA-1 over the ``|``-joined parts."""
    text = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(f"{prefix}_"), F.substring(F.sha1(text), 1, 12))


def quiet_id(*parts: Column) -> Column:
    """``stab_`` + 12 hex of MD5, the id of a mined no-event window."""
    return F.concat(F.lit("stab_"), F.substring(F.md5(F.concat_ws("|", *[p.cast("string") for p in parts])), 1, 12))


def clean_entity_id(c: Column) -> Column:
    return F.regexp_replace(F.trim(c.cast("string")), r"\.0$", "")


def truthy(c: Column) -> Column:
    return F.coalesce(F.lower(F.trim(c.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def seven_digit(c: Column) -> Column:
    return F.lpad(F.trim(c.cast("string")), 7, "0")
