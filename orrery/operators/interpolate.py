"""State interpolation: ten-point polynomial for coarse series, cubic spline for dense or short ones."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.orbit import LIGHT, norm3
from orrery.operators.joins import Probe, asof_probes, count_probes
from orrery.operators.scan import DAY_US, row_index, slot
from orrery.session import cut, deal

NEIGHBOURS = 10
LEAST_ROWS = 4
DENSE_S = 5.0
EDGE_US = 900_000_000
#: Rounding of positions (nanometres at orbit height) that polynomials may magnify beyond what they do to evenly spread rows.
CROWDED = 1e6
#: Rows on either side of an event that its spline is built from. What lies beyond counts 0.27 per row: below rounding.
REACH = 20
SPLINE_CHUNK = 20_000
HALO = 64
#: Rows of a series that may travel as one list.
LIST_ROWS = 1_000
#: Events to a task where each meets its rows.
EVENTS = 20_000
STATE = [f"orbit_{v}{a}_{u}" for v, u in (("", "m"), ("v", "mps")) for a in "xyz"]


def _series(states: DataFrame, by: list[str], width_us: int) -> tuple[DataFrame, DataFrame]:
    """Numbered rows and one row per series: size, ends, whether it is coarse, whether an epoch repeats.

    Coarse means a median step over ``DENSE_S``. That needs no median: the number of short steps tells, and where they
    are exactly half, the longest short and the shortest long one.
    """
    x = states.select(*by, "t", "x", "y", "z").withColumn("_b", slot("t", width_us))
    local, across = Window.partitionBy(*by, "_b").orderBy("t"), Window.partitionBy(*by).orderBy("_b")
    # numbers and previous epochs in one pass: a slot takes over the rows and the last epoch of those before it
    slots = x.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_rows"), F.max("t").alias("_end"))
    off = F.coalesce(F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    slots = slots.select(*by, "_b", off.alias("_off"), F.lag("_end").over(across).alias("_last"))
    x = x.select("*", F.row_number().over(local).alias("_n"), F.lag("t").over(local).alias("_near")).join(slots, [*by, "_b"])
    rows = cut(x.select(*by, "t", "x", "y", "z", (F.col("_off") + F.col("_n")).alias("_pos"), F.coalesce("_near", "_last").alias("_prev")))
    step = (F.col("t") - F.col("_prev")) / 1e6
    short = step <= DENSE_S
    span = rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"), F.min("t").alias("_a"), F.max("t").alias("_z"), F.count_if(short).alias("_short"),
        F.max(F.when(short, step)).alias("_under"), F.min(F.when(~short, step)).alias("_over"), (F.min(step) == 0).alias("_repeats"),
    )
    twice, steps = 2 * F.col("_short"), F.col("_n") - 1
    coarse = (twice < steps) | ((twice == steps) & ((F.col("_under") + F.col("_over")) / 2 > DENSE_S))
    span = span.where(F.col("_n") >= LEAST_ROWS).withColumn("_method", F.when(coarse & (F.col("_n") >= NEIGHBOURS), "polynomial").otherwise("spline"))
    return rows.drop("_prev"), span.drop("_short", "_under", "_over")


def _reach(poly: Column, below: Column, n: Column) -> tuple[Column, Column]:
    """Number of the row before the first one an event takes, and of the last, from the rows before it and those of its series."""
    centre = F.least(F.greatest(below, F.lit(5)), n - 5)
    first = F.when(poly, F.greatest(F.lit(0), F.least(centre - 5, n - NEIGHBOURS))).otherwise(F.greatest(F.lit(0), F.least(below - REACH, n - LEAST_ROWS)))
    return first, F.when(poly, first + NEIGHBOURS).otherwise(F.least(n, F.greatest(below + REACH, F.lit(LEAST_ROWS))))


def _points_by_slot(events: DataFrame, states: DataFrame, key: list[str], by: list[str], t0: str, edge_us: int, width_us: int) -> DataFrame:
    """(key, extrapolation_s, method, pts): the rows each event takes, in order of time.

    Row numbers make the neighbours an equi-join: an event meets ten rows, or ``REACH`` on either side.
    """
    rows, span = _series(states, by, width_us)
    e = count_probes(events, rows, key, by, "t", {"_below": Probe(t0, strict=True)}, width_us=width_us).join(span, by)
    beyond = F.greatest(F.col("_a") - F.col(t0), F.col(t0) - F.col("_z"), F.lit(0))
    poly = F.col("_method") == "polynomial"
    first, last = _reach(poly, F.col("_below"), F.col("_n"))
    e = e.withColumn("extrapolation_s", beyond / 1e6).where((beyond <= edge_us) & (poly | ~F.col("_repeats")))
    # an event becomes ten or forty rows
    e = deal(cut(e.select(*key, *[c for c in by if c not in key], t0, "extrapolation_s", "_method", (first + 1).alias("_first"), last.alias("_final"))), EVENTS, *key)
    e = e.withColumn("_pos", F.explode(F.sequence("_first", "_final"))).drop("_first", "_final")
    near = e.join(rows.hint("merge"), [*by, "_pos"])  # Spark takes rows made by an explode for as few as they came from, and would broadcast them
    pts = F.sort_array(F.collect_list(F.struct(((F.col("t") - F.col(t0)) / 1e6).alias("s"), "x", "y", "z")))
    return near.groupBy(*key, "extrapolation_s", F.col("_method").alias("method")).agg(pts.alias("pts"))


def _points_of_lists(events: DataFrame, states: DataFrame, key: list[str], by: list[str], t0: str, edge_us: int) -> DataFrame:
    """The same of short series. Each becomes one list, which its events meet and are cut from; where ``states`` is dealt by
    ``by`` already, no state row is moved or stored."""
    t = lambda i: F.get("_rows", i)["t"]
    lists = states.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("t", "x", "y", "z"))).alias("_rows")).withColumn("_n", F.size("_rows")).where(F.col("_n") >= LEAST_ROWS)
    lists = lists.withColumn("_steps", F.sort_array(F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda i: (t(i) - t(i - 1)) / 1e6)))
    at = lambda i: F.get("_steps", F.floor(i / 2).cast("int"))
    coarse = (at(F.col("_n") - 2) + at(F.col("_n") - 1)) / 2 > DENSE_S  # the median step
    lists = lists.select(*by, "_rows", "_n", F.when(coarse & (F.col("_n") >= NEIGHBOURS), "polynomial").otherwise("spline").alias("method"), (F.get("_steps", F.lit(0)) == 0).alias("_repeats"))
    e = events.join(lists.hint("merge"), by)  # Spark takes them for as few as the rows they were made from
    beyond, poly = F.greatest(t(F.lit(0)) - F.col(t0), F.col(t0) - t(F.col("_n") - 1), F.lit(0)), F.col("method") == "polynomial"
    e = e.where((beyond <= edge_us) & (poly | ~F.col("_repeats")))
    e = e.withColumn("_below", F.size(F.filter("_rows", lambda r: r["t"] < F.col(t0))))
    first, last = _reach(poly, F.col("_below"), F.col("_n"))
    point = lambda r: F.struct(((r["t"] - F.col(t0)) / 1e6).alias("s"), r["x"].alias("x"), r["y"].alias("y"), r["z"].alias("z"))
    return e.select(*key, (beyond / 1e6).alias("extrapolation_s"), "method", F.transform(F.slice("_rows", first + 1, last - first), point).alias("pts"))


def interpolated_states(
    events: DataFrame, states: DataFrame, key: Sequence[str], by: Sequence[str], t0: str, *, edge_us: int = EDGE_US, width_us: int = DAY_US, short: bool = False,
) -> DataFrame:
    """Position and velocity at ``t0`` from the rows of the event's series around it.

    Coarse series of ten rows or more: the polynomial through ten rows, less those that crowd. Dense ones, and those of four to nine rows: the
    not-a-knot cubic spline. NULL for shorter series, out of reach, or where an epoch repeats (anywhere for a
    spline, among its ten rows for a polynomial). Up to ``edge_us`` beyond the ends is extrapolated and recorded.
    With ``short`` a count finds the series of up to ``LIST_ROWS`` rows, which go to their events as lists; all others are cut
    into slots of ``width_us`` and numbered.
    """
    key, by = list(key), list(by)
    asked = events.select(*dict.fromkeys([*key, *by, t0]))
    if short:
        long = cut(states.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > LIST_ROWS).select(*by))
        if long.isEmpty():
            g = _points_of_lists(asked, states, key, by, t0, edge_us)
        else:
            g = _points_of_lists(asked, states.join(long, by, "left_anti"), key, by, t0, edge_us).unionByName(
                _points_by_slot(asked, states.join(long, by, "left_semi"), key, by, t0, edge_us, width_us))
    else:
        g = _points_by_slot(asked, states, key, by, t0, edge_us, width_us)
    g = g.where((F.col("method") == "spline") | (F.size(F.array_distinct("pts.s")) == NEIGHBOURS))
    state = state_at_zero("method", *[f"pts.{c}" for c in "sxyz"])
    g = g.select(*key, "extrapolation_s", "method", state.alias("_state")).select(*key, "extrapolation_s", "method", *[F.col("_state")[i].alias(c) for i, c in enumerate(STATE)])
    return events.join(g, key, "left").withColumn("orbit_state_status", F.when(F.col("orbit_x_m").isNull(), "insufficient_coverage").otherwise("computed"))


def best_states(events: DataFrame, candidates: DataFrame, states: DataFrame, key: Sequence[str], arc: str, t0: str, **kw) -> DataFrame:
    """The state of each event from the first of its candidate arcs that yields one.

    ``candidates``: (key, arc, rank). An arc that cannot be interpolated is passed over, never an error of the event. All
    candidates of all events are worked out in one pass; they are few for each event. Arcs of up to ``LIST_ROWS`` rows travel as lists.
    """
    key = list(key)
    tried = interpolated_states(candidates.join(events.select(*key, t0), key), states, [*key, arc], [arc], t0, short=True, **kw)
    found = F.when(F.col("orbit_state_status") == "computed", F.col("rank"))
    best = tried.groupBy(*key).agg(F.min_by(F.struct(arc, "rank", "method", "extrapolation_s", *STATE), found).alias("_best"), F.count(F.lit(1)).alias("candidates"))
    status = F.when(F.col("candidates").isNull(), "missing_data").when(F.col("_best").isNull(), "insufficient_coverage").otherwise("computed")
    return events.join(best, key, "left").select(*events.columns, status.alias("orbit_state_status"), F.coalesce("candidates", F.lit(0)).alias("candidates"), "_best.*")


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def state_at_zero(method: pd.Series, s: pd.Series, x: pd.Series, y: pd.Series, z: pd.Series) -> pd.Series:
    """Value and derivative at 0 through each row's points: x, y, z, vx, vy, vz. All rows of one method and length at once."""
    out, sizes = np.empty(len(s), object), s.map(len)
    for (how, n), at in pd.Series(np.arange(len(s))).groupby([method.to_numpy(), sizes.to_numpy()]).groups.items():
        t, p = np.stack(s.iloc[at].to_list()), np.stack([np.stack(c.iloc[at].to_list()) for c in (x, y, z)], axis=-1)
        for k, r in zip(at, polynomial_at_zero(t, p) if how == "polynomial" else spline_at_zero(t, p), strict=True):
            out[k] = r
    return pd.Series(out)


def _weights(t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each point of the rows of ``t`` (rows, n) counts in value and derivative at 0 of the polynomial through them."""
    n, value, slope = t.shape[1], np.empty_like(t), np.zeros_like(t)
    for p in range(n):
        others = [q for q in range(n) if q != p]
        ratio = -t[:, others] / (t[:, [p]] - t[:, others])
        value[:, p] = ratio.prod(axis=1)
        for i, r in enumerate(others):
            slope[:, p] += np.delete(ratio, i, axis=1).prod(axis=1) / (t[:, p] - t[:, r])
    return value, slope


def _crowding(t: np.ndarray, even: np.ndarray) -> np.ndarray:
    """How many times more the polynomials magnify rounding of their points than those through ``even``."""
    return np.max([np.abs(w).sum(axis=1) / np.abs(e).sum(axis=1) for w, e in zip(_weights(t), _weights(even), strict=True)], axis=0)


def polynomial_at_zero(t: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Value and derivative at 0 of the polynomials through the points of each row of ``t`` (rows, n) and ``y`` (rows, n, axes).

    Points that crowd (a second apart among others days apart) magnify the rounding of positions to metres. Where that is over
    ``CROWDED`` times what as many evenly spread points would do, the point that does most is left out, until it is not or
    ``LEAST_ROWS`` are left.
    """
    value, slope = _weights(t)
    out, n = np.concatenate([np.einsum("rp,rpa->ra", w, y) for w in (value, slope)], axis=1), t.shape[1]
    # even points magnify values and derivatives times the span at least once
    at = np.flatnonzero(np.maximum(np.abs(value).sum(axis=1), np.abs(slope).sum(axis=1) * np.ptp(t, axis=1)) > CROWDED)
    even = np.linspace(t[at, 0], t[at, -1], n, axis=1)
    over = _crowding(t[at], even) > CROWDED
    at, even = at[over], even[over]
    if n > LEAST_ROWS and len(at):
        most = np.argmin([_crowding(np.delete(t[at], p, axis=1), even) for p in range(n)], axis=0)
        kept = np.arange(n) != most[:, None]
        out[at] = polynomial_at_zero(t[at][kept].reshape(len(at), n - 1), y[at][kept].reshape(len(at), n - 1, -1))
    return out


def spline_at_zero(t: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The same of the not-a-knot splines."""
    m = spline_coefficients(np.moveaxis(t, 0, -1)[..., None], np.moveaxis(y, 0, 1))
    i, lane = np.clip((t <= 0).sum(axis=1) - 1, 0, t.shape[1] - 2), np.arange(len(t))
    h = (t[lane, i + 1] - t[lane, i])[:, None]
    a, u = t[lane, i + 1][:, None], -t[lane, i][:, None]
    lo, hi, below, above = m[i, lane], m[i + 1, lane], y[lane, i], y[lane, i + 1]
    value = (lo * a**3 + hi * u**3) / (6 * h) + (below / h - lo * h / 6) * a + (above / h - hi * h / 6) * u
    slope = (hi * u**2 - lo * a**2) / (2 * h) + (above - below) / h - (hi - lo) * h / 6
    return np.concatenate([value, slope], axis=1)


def spline_coefficients(t: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Second derivatives of the not-a-knot cubic spline through (t, y) along the first axis; ``y`` may have more axes, ``t`` is
    one-dimensional or fits them."""
    t = t if t.ndim > 1 else t[:, None]
    n, h = len(t), np.diff(t, axis=0)
    slope = np.diff(y, axis=0) / h
    lower, diag, upper, rhs = np.zeros_like(t), np.zeros_like(t), np.zeros_like(t), np.zeros_like(y)
    lower[1:-1], diag[1:-1], upper[1:-1] = h[:-1], 2 * (h[:-1] + h[1:]), h[1:]
    rhs[1:-1] = 6 * np.diff(slope, axis=0)
    # end conditions eliminated into the first and last inner equation
    diag[1] += h[0] + h[0] ** 2 / h[1]
    upper[1] -= h[0] ** 2 / h[1]
    diag[-2] += h[-1] + h[-1] ** 2 / h[-2]
    lower[-2] -= h[-1] ** 2 / h[-2]
    m = np.zeros_like(y)
    for i in range(2, n - 1):
        w = lower[i] / diag[i - 1]
        diag[i] -= w * upper[i - 1]
        rhs[i] -= w * rhs[i - 1]
    m[-2] = rhs[-2] / diag[-2]
    for i in range(n - 3, 0, -1):
        m[i] = (rhs[i] - upper[i] * m[i + 1]) / diag[i]
    m[0] = m[1] * (1 + h[0] / h[1]) - m[2] * h[0] / h[1]
    m[-1] = m[-2] * (1 + h[-1] / h[-2]) - m[-3] * h[-1] / h[-2]
    return m


def spline_value(t: np.ndarray, y: np.ndarray, m: np.ndarray, q: np.ndarray) -> np.ndarray:
    i = np.clip(np.searchsorted(t, q, side="right") - 1, 0, len(t) - 2)
    h, u = (t[i + 1] - t[i])[:, None], (q - t[i])[:, None]
    a = h - u
    out = (m[i] * a**3 + m[i + 1] * u**3) / (6 * h) + (y[i] / h - m[i] * h / 6) * a + (y[i + 1] / h - m[i + 1] * h / 6) * u
    out[(q < t[0]) | (q > t[-1])] = np.nan
    return out


def range_residuals(observations: DataFrame, arc_states: DataFrame, by: Sequence[str], *, width_us: int = DAY_US) -> DataFrame:
    """Observed minus computed range with two light-time steps on the spline of each arc.

    ``observations``: by, obs_id, t, range_m, sx, sy, sz. ``arc_states``: by, arc, t, x, y, z. Arcs are
    cut into row chunks with halos; a spline forgets its ends within a few rows, so chunk
    results equal the whole-arc spline to machine precision. Points within one median
    step of the arc ends are left out.
    """
    by = list(by)
    arc_key = [*by, "arc"]
    idx = row_index(arc_states, arc_key, ["t"], slot("t", width_us), "_pos").withColumn("_c0", F.floor((F.col("_pos") - 1) / SPLINE_CHUNK).cast("bigint"))
    idx = cut(idx)
    inside = F.col("_pos") - 1 - F.col("_c0") * SPLINE_CHUNK
    homes = F.array_compact(F.array(F.col("_c0"), F.when((inside < HALO) & (F.col("_c0") > 0), F.col("_c0") - 1), F.when(inside >= SPLINE_CHUNK - HALO, F.col("_c0") + 1)))
    chunks = idx.withColumn("_chunk", F.explode(homes))
    bounds = idx.groupBy(*arc_key, F.col("_c0").alias("_chunk")).agg(F.min("t").alias("_lo"))
    ends = arc_states.groupBy(*arc_key).agg(F.min("t").alias("_a"), F.max("t").alias("_z"), F.count(F.lit(1)).alias("_n"))
    margin = (F.col("_z") - F.col("_a")) / F.greatest(F.col("_n") - 1, F.lit(1))
    home = asof_probes(observations, bounds.join(ends, arc_key), ["obs_id"], by, "_lo", ["arc", "_chunk", "_a", "_z", "_n"], {"_h": Probe("t")}, width_us=width_us)
    obs = home.where("_h is not null").select(*observations.columns, "_h.*").where((F.col("t") >= F.col("_a") + margin) & (F.col("t") <= F.col("_z") - margin))
    schema = "obs_id bigint, computed_m double"

    def solve(states: pd.DataFrame, o: pd.DataFrame) -> pd.DataFrame:
        if len(states) < 4 or o.empty:
            return pd.DataFrame({"obs_id": pd.Series(dtype="int64"), "computed_m": pd.Series(dtype="float64")})
        states = states.sort_values("t").drop_duplicates("t")
        base = states["t"].iloc[0]
        t, y = (states["t"].to_numpy() - base) / 1e6, states[["x", "y", "z"]].to_numpy()
        m = spline_coefficients(t, y)
        q, st = (o["t"].to_numpy() - base) / 1e6, o[["sx", "sy", "sz"]].to_numpy()
        dist = o["range_m"].to_numpy()
        for _ in range(2):
            dist = np.linalg.norm(spline_value(t, y, m, q - dist / LIGHT) - st, axis=1)
        return pd.DataFrame({"obs_id": o["obs_id"].to_numpy(), "computed_m": dist})

    keys = [*arc_key, "_chunk"]
    solved = chunks.groupBy(*keys).cogroup(obs.groupBy(*keys)).applyInPandas(solve, schema)
    return observations.join(solved, "obs_id").where(~F.isnan("computed_m")).withColumn("oc_m", F.col("range_m") - F.col("computed_m"))


def holdout_errors(states: DataFrame, by: Sequence[str], per_file: int = 5, *, width_us: int = DAY_US) -> DataFrame:
    """Interpolate held-out odd rows of each file from its even rows; up to ``per_file`` hash-ranked points each."""
    from orrery.operators.labels import top_k

    by = list(by)
    x = row_index(states, by, ["t"], slot("t", width_us), "_no")
    n = states.groupBy(*by).agg(F.count(F.lit(1)).alias("_rows")).where("_rows >= 24")
    x = cut(x.join(n, by))
    even, odd = x.where("_no % 2 = 1"), x.where("_no % 2 = 0 AND _no > 4 AND _no < _rows - 4")
    picks = cut(top_k(odd.withColumn("_h", F.md5(F.concat_ws("|", *by, "t"))), by, ["_h", "t"], per_file).select(*by, F.col("t").alias("t0"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("z").alias("az")))
    got = interpolated_states(picks, even, [*by, "t0"], by, "t0", width_us=width_us).where("orbit_x_m is not null")
    return got.withColumn("error_m", norm3(F.col("orbit_x_m") - F.col("ax"), F.col("orbit_y_m") - F.col("ay"), F.col("orbit_z_m") - F.col("az")))
