"""Edge rules of the joins, and no nested loop in their plans."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.operators.joins import Probe, asof_probes, bracket_join, count_overlaps, count_within, nearest_join, overlaps_merged, points_in_windows, spans_over_windows
from orrery.operators import matching
from orrery.operators.matching import greedy_match
from orrery.operators.windows import merge_spans


def frame(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("width", [3, 1000])
def test_asof_edges(spark, width):
    left = frame(spark, [(1, 1, 10), (2, 1, 4), (3, 1, 31), (4, 2, 10), (5, 1, 20)], "id long, e long, q long")
    right = frame(spark, [(1, 5, 50), (1, 10, 100), (1, 20, 200), (1, 30, 300)], "e long, t long, v long")
    p = {"b": Probe("q"), "bs": Probe("q", strict=True), "f": Probe("q", forward=True), "fs": Probe("q", forward=True, strict=True)}
    out = asof_probes(left, right, ["id"], ["e"], "t", ["v"], p, width_us=width)
    got = {r.id: tuple(r[k].v if r[k] else None for k in p) for r in out.collect()}
    assert got == {1: (100, 50, 100, 200), 2: (None, None, 50, 50), 3: (300, 300, None, None), 4: (None, None, None, None), 5: (200, 100, 200, 300)}
    assert "NestedLoop" not in plan(out) and "Cartesian" not in plan(out)


@pytest.mark.parametrize("width", [7, 1000])
def test_left_rows_travel_once(spark, width):
    """Repeated and NULL keys and times, ties and columns named like the right side's; every left row is kept, and moves once."""
    rng = np.random.default_rng(1)
    rows = [(i // 2, None if i % 29 == 0 else int(rng.integers(1, 4)), None if i % 31 == 0 else int(rng.integers(0, 60)), -i) for i in range(120)]
    pts = [(int(rng.integers(1, 4)), int(rng.integers(0, 60)), i) for i in range(90)] + [(None, 5, 1000), (1, None, 1001)]
    left, right = frame(spark, rows, "id long, e long, t long, v long"), frame(spark, pts, "e long, t long, n long")
    p = {"b": Probe("t"), "bs": Probe("t", strict=True), "f": Probe("t", forward=True), "fs": Probe("t", forward=True, strict=True)}
    out = asof_probes(left, right, ["id"], ["e"], "t", ["t", "n"], p, tie=["n"], width_us=width)
    got = sorted(((r.v, *[r[k].n if r[k] else None for k in p]) for r in out.collect()))

    def best(e, q, name):
        if e is None or q is None:
            return None
        keep = {"b": lambda t: t <= q, "bs": lambda t: t < q, "f": lambda t: t >= q, "fs": lambda t: t > q}[name]
        found = [(t, n) for k, t, n in pts if k == e and t is not None and keep(t)]
        return None if not found else (max if name[0] == "b" else min)(found)[1]

    assert got == sorted((v, *[best(e, t, k) for k in p]) for _, e, t, v in rows)
    wide = [line for line in plan(out).splitlines() if "Exchange hashpartitioning(e" in line]
    assert "Generate explode" not in plan(out) and "NestedLoop" not in plan(out) and wide


def test_bracket_returns_same_row_for_empty_window(spark):
    w = frame(spark, [(1, 1, 10, 10)], "id long, e long, s long, f long")
    s = frame(spark, [(1, 10)], "e long, t long")
    r = bracket_join(w, s, ["id"], ["e"], "s", "f", "t", ["t"]).first()
    assert r.before.t == r.after.t == 10


def test_nearest_tie_and_single_row(spark):
    left = frame(spark, [(1, 1, 15), (2, 2, 99)], "id long, e long, q long")
    right = frame(spark, [(1, 10), (1, 20), (2, 1)], "e long, t long")
    early = {r.id: r.nearest.t for r in nearest_join(left, right, ["id"], ["e"], "q", "t", ["t"]).collect()}
    late = {r.id: r.nearest.t for r in nearest_join(left, right, ["id"], ["e"], "q", "t", ["t"], tie_later=True).collect()}
    assert early == {1: 10, 2: 1} and late == {1: 20, 2: 1}


def test_counts_against_brute_force(spark):
    rng = np.random.default_rng(0)
    w = [(i, int(rng.integers(1, 4)), int(a), int(a + rng.integers(1, 40))) for i, a in enumerate(rng.integers(0, 200, 60))]
    s = [(int(rng.integers(1, 4)), int(a), int(a + rng.integers(0, 30))) for a in rng.integers(0, 200, 80)]
    wd, sd = frame(spark, w, "id long, e long, lo long, hi long"), frame(spark, s, "e long, s long, f long")
    over = count_overlaps(wd, sd, ["id"], ["e"], "lo", "hi", "s", "f", width_us=17)
    got = {r.id: r.n_spans for r in over.collect()}
    assert got == {i: sum(e == e2 and a < hi and b > lo for e2, a, b in s) for i, e, lo, hi in w}
    inside = {r.id: r.n for r in count_within(wd, sd, ["id"], ["e"], "lo", "hi", "s", width_us=17).collect()}
    assert inside == {i: sum(e == e2 and lo <= a <= hi for e2, a, _ in s) for i, e, lo, hi in w}
    pairs = spans_over_windows(sd.withColumn("k", F.monotonically_increasing_id()), wd, ["e"], "s", "f", "lo", "hi", width_us=17)
    assert pairs.count() == sum(got.values()) and "NestedLoop" not in plan(pairs)
    pts = points_in_windows(sd, wd, ["e"], "s", "lo", "hi", width_us=17)
    assert pts.count() == sum(inside.values()) and "NestedLoop" not in plan(pts)
    merged = merge_spans(sd, ["e"], "s", "f", rows=25)
    flag = {r.id: r.overlaps for r in overlaps_merged(wd, merged, ["id"], ["e"], "lo", "hi", "s", "f").collect()}
    proper = {i: any(e == e2 and a < hi and b > lo for e2, a, b in [(r.e, r.s, r.f) for r in merged.collect()]) for i, e, lo, hi in w}
    assert flag == proper


def test_touching_spans(spark):
    s = frame(spark, [(1, 0, 10), (1, 10, 20), (1, 25, 30), (1, 2, 5)], "e long, s long, f long")
    assert sorted((r.s, r.f, r.members) for r in merge_spans(s, ["e"], "s", "f", rows=2).collect()) == [(0, 20, 3), (25, 30, 1)]
    w = frame(spark, [(1, 1, 20, 25)], "id long, e long, lo long, hi long")
    assert count_overlaps(w, s, ["id"], ["e"], "lo", "hi", "s", "f").first().n_spans == 0


def greedy(q, r, tol):
    cand = sorted((abs(b - a), i, j, b - a) for i, a in enumerate(q, 1) for j, b in enumerate(r, 1) if abs(b - a) <= tol)
    uq, ur, out = set(), set(), set()
    for _, i, j, d in cand:
        if i not in uq and j not in ur:
            uq.add(i), ur.add(j), out.add((i, j, d))
    return out


@pytest.mark.parametrize("cell", [50_000, 3])
def test_greedy_matching(spark, cell):
    """Many crowded entities with ties, runs of one side and equal times, also where cells cut runs."""
    rng = np.random.default_rng(5)
    qs, rs, want = [], [], set()
    for e in range(60):
        span = int(rng.choice([12, 60, 400]))
        q, r = (sorted(map(int, rng.integers(0, span, int(n)))) for n in rng.integers(0, 25, 2))
        qs += [(e, i, t) for i, t in enumerate(q, 1)]
        rs += [(e, i, t) for i, t in enumerate(r, 1)]
        want |= {(e, *m) for m in greedy(q, r, 20)}
    qd = frame(spark, qs + [(None, 1, 5), (1, 99, None)], "entity_id long, seq long, qt long")
    rd = frame(spark, rs + [(None, 1, 5)], "entity_id long, seq long, rt long")
    got = [tuple(x) for x in greedy_match(qd, rd, "qt", "rt", 20, cell=cell).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    assert greedy_match(qd.limit(0), rd, "qt", "rt", 20).count() == 0


def test_matched_lists_are_numbered_once(spark):
    from orrery.plans.joins import match_lists

    for side in match_lists(spark, "/root/testdata/sf0.001"):
        assert "parquet" not in plan(side) and "Window" not in plan(side) and side.count()


def test_greedy_matching_of_a_ladder(spark, monkeypatch):
    """20,000 points whose gaps shrink from end to end: the last pair decides all others, in one round of jumps."""
    n, rounds = 20_000, []
    take = matching._take
    monkeypatch.setattr(matching, "_take", lambda edges: rounds.append(1) or take(edges))
    # gaps 2n-1, 2n-2, ..., n+1 between sides in turn
    pts = spark.range(n).withColumn("t", F.expr(f"id * {2 * n - 1} - (id * (id - 1)) div 2")).withColumn("entity_id", F.lit(1).cast("long"))
    sides = [pts.where(f"id % 2 = {i}").select("entity_id", F.expr("id div 2").alias("seq"), "t") for i in (0, 1)]
    out = greedy_match(*sides, "t", "t", 2 * n, cell=1500)
    assert out.where("query_seq = reference_seq and offset_us = 2 * %d - 1 - 2 * query_seq" % n).count() == out.count() == n // 2
    assert len(rounds) <= 2
