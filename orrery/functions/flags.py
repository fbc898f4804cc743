"""Comma-list and flag-list algebra on text columns, and coverage tiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_list(text: Column, sep: str = ",") -> Column:
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), sep), F.trim)
    return F.filter(parts, lambda x: x != "")


def missing_flags(missing: Column) -> Column:
    """``tle,slr`` -> ``missing_tle,missing_slr``."""
    return F.array_join(F.transform(as_list(missing), lambda s: F.concat(F.lit("missing_"), s)), ",")


def union_flags(a: Column, b: Column) -> Column:
    return F.array_join(F.array_sort(F.array_union(as_list(a), as_list(b))), ",")


def add_flag(flags: Column, flag: str) -> Column:
    """Append once, keeping the order of what is there."""
    have = as_list(flags)
    return F.array_join(F.when(F.array_contains(have, flag), have).otherwise(F.concat(have, F.array(F.lit(flag)))), ",")


def summary_flags(*conditional: Column) -> Column:
    """``|``-joined names of the conditions that hold, ``ok`` when none does."""
    kept = F.array_compact(F.array(*conditional))
    return F.when(F.size(kept) == 0, F.lit("ok")).otherwise(F.array_join(kept, "|"))


def ordered_union(a: Column, b: Column) -> Column:
    return F.array_distinct(F.concat(a, b))


def coverage_tier(tle: Column, slr: Column, orbit: Column) -> Column:
    """A: all three covered; B: elements and orbit; C: anything else."""
    t, s, o = (F.coalesce(c == "covered", F.lit(False)) for c in (tle, slr, orbit))
    return F.when(t & s & o, "A").when(t & o, "B").otherwise("C")


def covered(cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), "covered").otherwise("missing")


def missing_sources(tle: Column, slr: Column, orbit: Column) -> Column:
    named = [F.when(c != "covered", F.lit(n)) for n, c in (("tle", tle), ("slr", slr), ("orbit", orbit))]
    return F.array_join(F.array_compact(F.array(*named)), ",")
