"""Quantiles, tests, resampling and interpolation against direct computation."""

import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators import interpolate, quantiles, state, statistics
from orrery.operators.dedup import prioritised
from orrery.operators.quantiles import exact_quantiles
from orrery.operators.series import period_mean
from orrery.operators.windows import pick_evenly
from orrery.session import cut


@pytest.mark.parametrize("bound", [5, 100_000])
def test_quantiles_with_outliers_and_ties(spark, bound):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 900), "v": np.round(rng.lognormal(0, 5, 900), 3)})
    pdf.loc[:200, "v"] = 1.5
    pdf.loc[0, "v"] = 1e30
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], {"a": (F.col("v"), 0.5), "b": (F.col("v"), 0.95), "c": (-F.col("v"), 0.25)}, bound=bound).toPandas().set_index("g")
    for g, x in pdf.groupby("g"):
        assert np.allclose(got.loc[g, ["a", "b", "c"]].astype(float), [x.v.quantile(0.5), x.v.quantile(0.95), (-x.v).quantile(0.25)], rtol=1e-12)


def test_large_groups_are_never_in_one_task(spark, monkeypatch):
    """A heavy-tailed group ends in cells under the bound, and no shuffle on the group alone carries values."""
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"g": np.repeat([1, 2], 60_000), "v": np.concatenate([rng.lognormal(0, 14, 60_000), rng.normal(size=60_000)])})
    made = []
    monkeypatch.setattr(quantiles, "cut", lambda df: made.append(cut(df)) or made[-1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for bound, rounds in ((10_000, 2), (30, 3)):
            made.clear()
            got = exact_quantiles(spark.createDataFrame(pdf), ["g"], {"m": (F.col("v"), 0.5), "q": (F.col("v"), 0.99)}, bound=bound)
            assert len(made) == rounds
            path = [c for c in made[-1].columns if c in ("g", "_m") or c.startswith("_c")]
            assert made[-1].groupBy(*path).count().agg(F.max("count")).first()[0] <= bound
            assert {(r.g, r.m, r.q) for r in got.collect()} == {(g, x.v.quantile(0.5), x.v.quantile(0.99)) for g, x in pdf.groupby("g")}
        values = spark.createDataFrame(pdf).select("g", F.lit(0).alias("_m"), F.col("v").alias("_v"), F.lit(1).alias("_n"))
        plan = quantiles._assign(values, ["g", "_m"], 100)._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        alone = re.findall(r"Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(g#\d+L, (?:_m#\d+, )?\d+\)", plan)
        assert not [columns for columns in alone if "_v#" in columns]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_wanted_ranks_are_bracketed_without_dealing_the_values(spark, monkeypatch):
    """Groups of both sizes, one without a key, a value that fills a bracket: no value looks for its cell among many."""
    rng = np.random.default_rng(6)
    v = np.concatenate([rng.lognormal(0, 14, 20_000), np.where(rng.random(20_000) < 0.6, 0.0, rng.normal(size=20_000)), rng.normal(size=40)])
    pdf = pd.DataFrame({"g": np.repeat([1, 2, 3], [20_000, 20_000, 40]), "h": np.arange(40_040) % 20 == 0, "v": v})
    df = spark.createDataFrame(pdf).select(F.nullif("g", F.lit(2)).alias("g"), "h", "v", F.when(F.col("h"), F.col("v")).alias("w"))
    monkeypatch.setattr(quantiles, "_assign", lambda *_: pytest.fail("values dealt to cells"))
    got = exact_quantiles(df, ["g"], {"m": (F.col("v"), 0.5), "q": (F.col("v"), 0.99), "w": (F.col("w"), 0.25)}, bound=1000)
    want = {(None if g == 2 else g, x.v.quantile(0.5), x.v.quantile(0.99), x.v[x.h].quantile(0.25)) for g, x in pdf.groupby("g")}
    assert {tuple(r) for r in got.collect()} - {r for r in want if r[0] is None} == {r for r in want if r[0] is not None}
    reached, plain = [], quantiles._bracketed
    # brackets that miss their ranks are widened
    monkeypatch.setattr(quantiles, "_bracketed", lambda *a: reached.append(a[-1]) or plain(*a[:-1], a[-1] if len(reached) > 1 else 1e-9))
    got = exact_quantiles(df.dropna(subset=["g"]), ["g"], {"m": (F.col("v"), 0.5), "q": (F.col("v"), 0.99), "w": (F.col("w"), 0.25)}, bound=1000)
    assert {tuple(r) for r in got.collect()} == {r for r in want if r[0] is not None} and len(reached) == 2


def test_small_groups_move_once_and_are_never_built_in_parts(spark):
    pdf = pd.DataFrame({"g": np.arange(4000) % 1000, "v": np.random.default_rng(8).random(4000)})
    got = exact_quantiles(spark.createDataFrame(pdf), ["g"], {"a": (F.col("v"), 0.5), "b": (F.col("v"), 0.75)})
    plan = got._jdf.queryExecution().executedPlan().toString().splitlines()
    exchange = [i for i, x in enumerate(plan) if "Exchange" in x]
    assert len(exchange) == 1 and not [x for x in plan[exchange[0]:] if "Aggregate" in x]
    want = pdf.groupby("g").v.quantile([0.5, 0.75]).unstack()
    got = got.toPandas().set_index("g").sort_index()
    assert np.allclose(got[["a", "b"]], want, rtol=1e-15)


def test_student_t():
    # fixed table values
    assert np.allclose(statistics.student_t_cdf(np.array([0.0, 1.812461, -2.228139, 12.7062]), np.array([5.0, 10.0, 10.0, 1.0])), [0.5, 0.95, 0.025, 0.975], atol=1e-6)


def test_benjamini_hochberg_monotone(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.random(200) ** 3, 4)
    df = spark.createDataFrame(pd.DataFrame({"i": range(200), "p": p}))
    got = statistics.benjamini_hochberg(df, "p", ["i"], rows=7).orderBy("p", "i").toPandas()
    q = np.minimum(np.minimum.accumulate((got.p.to_numpy() * 200 / np.arange(1, 201))[::-1])[::-1], 1)
    assert np.allclose(got.p_adjusted, q) and (np.diff(got.p_adjusted) >= 0).all()


def test_bootstrap_is_independent_of_partitioning(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(0, 50, 300)
    df = spark.createDataFrame(pd.DataFrame({"key": range(300), "x": x, "y": 0.6 * x + rng.normal(0, 2, 300)}))
    a = statistics.bootstrap_slopes(df.coalesce(1), "key", replicates=50).orderBy("replicate").toPandas()
    b = statistics.bootstrap_slopes(df.repartition(5), "key", replicates=50).orderBy("replicate").toPandas()
    assert np.allclose(a.ols_slope, b.ols_slope) and abs(a.ols_slope.mean() - 0.6) < 0.01


def test_resampled_medians_are_those_of_the_repeated_rows(spark):
    rng = np.random.default_rng(9)
    for n in (0, 1, 2, 3, 40, 3000):
        keys, v = rng.integers(0, 2**60, n), np.round(rng.normal(size=n) ** 3, 1)
        df = spark.createDataFrame([(int(k), float(x)) for k, x in zip(keys, v, strict=True)] + [(5, None)], "key long, m double")
        got = {r.replicate: r.median for r in statistics.bootstrap_medians(df, "key", "m", replicates=60, blocks=7).collect()}
        w = statistics.replicate_weights(keys, np.arange(60))
        assert got == {r: float(np.median(np.repeat(v, w[:, r]))) for r in range(60) if w[:, r].sum()}


def test_replicate_weights_are_poisson(spark):
    for keys in (np.arange(4000), np.random.default_rng(1).integers(0, 2**60, 4000)):
        w = statistics.replicate_weights(keys, np.arange(300)).astype(float)
        assert abs(w.mean() - 1) < 0.005 and abs(w.var() - 1) < 0.01 and np.abs(np.corrcoef(w.T) - np.eye(300)).max() < 0.12 and abs(w.sum(axis=0).std() / np.sqrt(4000) - 1) < 0.15


def test_deming_limits(spark):
    r = spark.sql("select 1").select(
        statistics.deming(F.lit(4.0), F.lit(1.0), F.lit(1.0), 1.0, 1e-6).alias("x_errs"), statistics.deming(F.lit(4.0), F.lit(1.0), F.lit(1.0), 1e-6, 1.0).alias("y_errs"), statistics.deming(F.lit(4.0), F.lit(1.0), F.lit(0.0)).alias("none")
    ).first()
    assert math.isclose(r.x_errs, 1.0, rel_tol=1e-5) and math.isclose(r.y_errs, 0.25, rel_tol=1e-5) and r.none is None


def test_fused_sigma_below_both(spark):
    f = state.fuse([F.lit(1.0)] * 3, [F.lit(2.0)] * 3, F.lit(0.3), F.lit(True), F.lit(True))
    r = spark.sql("select 1").select(f["fused_sigma_m"].alias("s"), f["fusion_status"].alias("k")).first()
    assert r.s < 0.1 and r.k == "fused"


def test_spline_reproduces_a_cubic():
    t = np.sort(np.random.default_rng(0).random(30)) * 10
    y = np.column_stack([t**3 - t, 2 * t**2, t])
    q = np.linspace(t[0], t[-1], 50)
    v = interpolate.spline_value(t, y, interpolate.spline_coefficients(t, y), q)
    assert np.allclose(v, np.column_stack([q**3 - q, 2 * q**2, q]), atol=1e-8)


def test_polynomial_states(spark):
    t = np.arange(0, 40) * 60_000_000
    s = spark.createDataFrame(pd.DataFrame({"e": 1, "t": t, "x": (t / 1e6) ** 2, "y": t / 1e6, "z": 1.0}))
    ev = spark.createDataFrame([(1, 1, 630_000_000), (2, 1, -600_000_000), (3, 1, -950_000_000)], "id long, e long, q long")
    got = {r.id: r for r in interpolate.interpolated_states(ev, s, ["id"], ["e"], "q").collect()}
    assert math.isclose(got[1].orbit_x_m, 630.0**2, rel_tol=1e-9) and math.isclose(got[1].orbit_vx_mps, 1260.0, rel_tol=1e-6)
    assert got[2].extrapolation_s == 600.0 and got[3].orbit_state_status == "insufficient_coverage"


def spline_of(t, y, q):
    """Value and slope of the not-a-knot spline by a dense linear system: cubic on each step, smooth across rows."""
    n = len(t) - 1
    a, b = np.zeros((4 * n, 4 * n)), np.zeros(4 * n)
    row = 0
    for i in range(n):
        for x, v in ((t[i], y[i]), (t[i + 1], y[i + 1])):
            a[row, 4 * i : 4 * i + 4], b[row] = [(x - t[i]) ** k for k in range(4)], v
            row += 1
    for i in range(n - 1):
        h = t[i + 1] - t[i]
        a[row, 4 * i : 4 * i + 4], a[row, 4 * i + 5] = [0, 1, 2 * h, 3 * h * h], -1
        a[row + 1, 4 * i : 4 * i + 4], a[row + 1, 4 * i + 6] = [0, 0, 2, 6 * h], -2
        row += 2
    for i in (0, n - 2):
        a[row, 4 * i + 3], a[row, 4 * i + 7] = 1, -1
        row += 1
    c = np.linalg.solve(a, b).reshape(n, 4)
    i = int(np.clip(np.searchsorted(t, q, side="right") - 1, 0, n - 1))
    u = q - t[i]
    return c[i] @ [1, u, u * u, u**3], c[i] @ [0, 1, 2 * u, 3 * u * u]


def test_short_and_dense_series_take_the_spline(spark):
    rng = np.random.default_rng(8)
    series = {1: np.arange(300) * 1.0, 2: np.r_[0.0, np.sort(rng.random(6)) * 4000], 3: np.array([0.0, 100, 250, 300]), 4: np.array([0.0, 1, 2]), 5: np.array([0.0, 1, 1, 2, 3, 4]), 6: np.arange(20) * 60.0}
    values = {e: np.sin(t / 40) * 1000 + t for e, t in series.items()}
    s = spark.createDataFrame([(e, int(x * 1e6), float(v), float(2 * v), 1.0) for e, t in series.items() for x, v in zip(t, values[e], strict=True)], "e long, t long, x double, y double, z double")
    ask = [(e, q) for e, t in series.items() for q in (0.0, t[-1] * 0.37, t[-1], t[-1] + 30, -20.5, t[-1] * 0.99, t[-1] + 901)]
    ev = spark.createDataFrame([(i, e, int(round(q * 1e6))) for i, (e, q) in enumerate(ask)], "id long, e long, q long")
    got = {r.id: r for r in interpolate.interpolated_states(ev, s, ["id"], ["e"], "q").collect()}
    for i, (e, q) in enumerate(ask):
        r, t = got[i], series[e]
        if e in (4, 5) or q > t[-1] + 900:
            assert r.orbit_state_status == "insufficient_coverage" and r.method is None
            continue
        assert r.method == ("polynomial" if e == 6 else "spline") and r.extrapolation_s == round(max(0, -q, q - t[-1]), 6)
        if r.method == "spline":
            v, k = spline_of(t, values[e], round(q, 6))
            assert math.isclose(r.orbit_x_m, v, rel_tol=1e-7, abs_tol=1e-5) and math.isclose(r.orbit_vx_mps, k, rel_tol=1e-6, abs_tol=1e-6) and math.isclose(r.orbit_y_m, 2 * v, rel_tol=1e-7, abs_tol=1e-5)


def test_the_median_step_decides_where_half_the_steps_are_short(spark):
    for steps, want in (([1.0] * 5 + [9.2] * 5, "polynomial"), ([1.0] * 5 + [8.8] * 5, "spline"), ([1.0] * 5 + [9.0] * 5, "spline"), ([1.0] * 6 + [99.0] * 5, "spline"), ([1.0] * 5 + [99.0] * 6, "polynomial")):
        t = np.concatenate([[0.0], np.cumsum(steps)])
        s = spark.createDataFrame([(1, int(x * 1e6), float(x), 0.0, 0.0) for x in t], "e long, t long, x double, y double, z double")
        got = interpolate.interpolated_states(spark.createDataFrame([(1, 1, 3_500_000)], "id long, e long, q long"), s, ["id"], ["e"], "q").first()
        assert got.method == want and math.isclose(got.orbit_x_m, 3.5, rel_tol=1e-6) and math.isclose(got.orbit_vx_mps, 1.0, rel_tol=1e-5)


def test_the_next_candidate_steps_in(spark):
    rows = [("a", i * 1_000_000) for i in (0, 1, 1, 2, 3)] + [("b", i * 60_000_000) for i in range(-10, 11)] + [("c", i * 1_000_000) for i in range(-50, 50)]
    s = spark.createDataFrame([(arc, t, t / 1e6, 0.0, 0.0) for arc, t in rows], "arc string, t long, x double, y double, z double")
    ev = spark.createDataFrame([(i, 500_000) for i in range(1, 6)], "id long, q long")
    c = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (1, "c", 3), (2, "c", 2), (2, "b", 5), (3, "a", 1), (4, "nowhere", 1)], "id long, arc string, rank int")
    got = {r.id: (r.orbit_state_status, r.candidates, r.arc, r.method) for r in interpolate.best_states(ev, c, s, ["id"], "arc", "q").collect()}
    assert got == {1: ("computed", 3, "b", "polynomial"), 2: ("computed", 2, "c", "spline"), 3: ("insufficient_coverage", 1, None, None), 4: ("insufficient_coverage", 1, None, None), 5: ("missing_data", 0, None, None)}


def test_period_mean_matches_pandas_across_chunks(spark, monkeypatch):
    from orrery.operators import series

    monkeypatch.setattr(series, "CHUNK_ROWS", 50)
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"e": 1, "t": np.arange(400) * 60_000_000, "v": 7e6 + rng.random(400)})
    for w in (10, 11):
        got = period_mean(spark.createDataFrame(pdf), ["e"], ["t"], "v", period_s=F.lit(w * 60.0)).orderBy("t").toPandas()
        assert np.allclose(got.period_mean, pdf.v.rolling(w, center=True, min_periods=max(2, w // 2)).mean(), equal_nan=True)


def test_even_picks(spark):
    c = spark.createDataFrame([(1, i) for i in range(10)], "e long, ws long")
    for quota, want in ((1, [4]), (3, [0, 4, 9]), (10, list(range(10))), (0, [4])):
        q = spark.createDataFrame([(1, quota)], "e long, quota long")
        assert sorted(r.ws for r in pick_evenly(c, q, ["e"]).collect()) == want


def test_five_dedup_rules(spark):
    rows = [(1, 0, 0, 9, "SWOT_POR_b"), (1, 1, 1, -1, "seed"), (1, 0, 1, 9, "SWOT_VOR_a"), (1, 0, 0, 5, "SWOT_POR_a"), (1, 0, 0, 9, "SWOT_POR_c"), (2, 0, 0, 1, "POEORB"), (2, 0, 1, 1, "MOEORB")]
    best, dropped = prioritised(spark.createDataFrame(rows, "t long, origin int, family int, arc long, name string"), ["t"])
    assert {r.t: r.name for r in best.collect()} == {1: "SWOT_POR_b", 2: "POEORB"}
    assert {(r.t, r.rule): r.dropped for r in dropped.collect()} == {(1, "parsed_over_published"): 1, (1, "por_beats_vor"): 1, (1, "later_arc_start"): 1, (1, "same_arc_tiebreak"): 1, (2, "poeorb_beats_moeorb"): 1}


def test_large_ids_add_no_noise_to_the_smooth_truth(spark):
    from orrery.operators import interpolate
    from orrery.plans.statistics import on_slow_orbit

    x, y, z = on_slow_orbit("t")
    step = F.when(F.col("i") % 7 == 0, F.col("i") * 86_400).otherwise(F.col("i") * 86_400 + F.col("i") * 7919 % 80_000)
    s = spark.range(60).select(F.explode(F.array(F.lit(3), F.lit(90_003))).alias("entity_id"), F.col("id").alias("i"))
    s = s.select("entity_id", ((1_700_000_000 + step) * 1_000_000).cast("bigint").alias("t")).select("entity_id", "t", x.alias("x"), y.alias("y"), z.alias("z"))
    worst = {r[0]: r[1] for r in interpolate.holdout_errors(s, ["entity_id"]).groupBy("entity_id").agg(F.max("error_m")).collect()}
    assert set(worst) == {3, 90_003} and max(worst.values()) < 1e-5, worst


def test_arcs_of_entities_without_events_are_left_out(spark):
    from orrery.plans.statistics import with_events

    rows = spark.range(40).select((F.col("id") % 8).alias("entity_id"), F.col("id").alias("t"))
    events = spark.createDataFrame([(3, 1), (3, 2), (5, 1), (77, 1)], "entity_id long, t0 long")
    assert sorted(r.entity_id for r in with_events(rows, events).collect()) == [3] * 5 + [5] * 5


def test_state_rows_are_never_broadcast(spark):
    """Spark takes rows that an explode made for as few as they came from; a hash table of all of them filled every task."""
    s = spark.range(40).select((F.col("id") % 4).alias("e"), F.explode(F.sequence(F.lit(0), F.lit(200))).alias("i"))
    a = F.col("i") * 0.01
    s = s.select("e", (F.col("i").cast("long") * 60_000_000 + F.col("e") * 10).alias("t"), F.cos(a).alias("x"), F.sin(a).alias("y"), a.alias("z")).distinct()
    ev = spark.createDataFrame([(i, i % 4, 3_000_000_000 + i) for i in range(8)], "id long, e long, q long")
    got = interpolate.interpolated_states(ev, s, ["id"], ["e"], "q")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"SortMergeJoin \[e#\d+L, _pos#\d+L?\], \[e#\d+L, _pos#\d+L?\]", plan)
    assert all(abs(r.orbit_z_m - 0.5) < 1e-6 and r.method == "polynomial" for r in got.collect())


def test_polynomial_at_zero_matches_numpy():
    rng = np.random.default_rng(3)
    t, y = np.sort(rng.normal(size=(5, 10)), axis=1), rng.normal(size=(5, 10, 3))
    got = interpolate.polynomial_at_zero(t, y)
    for k in range(5):
        for a in range(3):
            c = np.linalg.solve(np.vander(t[k], increasing=True), y[k, :, a])
            assert np.allclose([got[k, a], got[k, 3 + a]], c[:2], rtol=1e-6, atol=1e-6)


@pytest.mark.parametrize("most", [1_000, 30, 2])
def test_short_series_travel_as_lists(spark, monkeypatch, most):
    """The rows of all products were stored with their numbers and shuffled twice; only those of long series are now."""
    rng, made = np.random.default_rng(4), []
    monkeypatch.setattr(interpolate, "LIST_ROWS", most)
    monkeypatch.setattr(interpolate, "cut", lambda df: made.append(cut(df)) or made[-1])
    sizes = [2, 4, 5, 9, 10, 11, 30, 31, 60, 200]
    rows = [(f"a{n}", int(t * 1e6)) for n in sizes for t in (np.arange(n) * 1.0 if n % 3 else np.cumsum(rng.integers(3, 90, n)))] + [("twice", 0), *[("twice", i * 60_000_000) for i in range(20)]]
    s = spark.createDataFrame([(a, t, 7e6 * math.cos(t / 9e8), 7e6 * math.sin(t / 9e8), t / 1e6) for a, t in rows], "arc string, t long, x double, y double, z double")
    ev = spark.createDataFrame([(i, int(q * 1e6)) for i, q in enumerate((-901.0, -3.0, 0.5, 7.25, 31.0, 400.0, 2_000.0))], "id long, q long")
    c = ev.select("id", F.explode(F.array(*[F.lit(f"a{n}") for n in sizes], F.lit("twice"))).alias("arc")).withColumn("rank", F.lit(1))
    key = ["id", "arc"]
    got = interpolate.interpolated_states(c.join(ev, "id"), s, key, ["arc"], "q", short=True).toPandas().sort_values(key, ignore_index=True)
    stored = max(df.count() for df in made)
    want = interpolate.interpolated_states(c.join(ev, "id"), s, key, ["arc"], "q").toPandas().sort_values(key, ignore_index=True)
    pd.testing.assert_frame_equal(got, want)
    assert (got.orbit_state_status == "computed").any() and (got.method == "polynomial").any() and (got.method == "spline").any()
    assert stored <= max(sum(n for n in [*sizes, 21] if n > most), len(c.collect()))


def test_products_of_events_are_dealt_once(spark):
    from orrery.plans import statistics as plans

    arcs = plans.orbit_arcs(spark, "/root/testdata/sf0.001")
    lists = arcs.groupBy("arc").agg(F.collect_list("t"))
    assert lists._jdf.queryExecution().executedPlan().toString().count("Exchange") == arcs._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1


def test_crowded_points_magnify_no_rounding():
    evenly = np.arange(10)[None] * 60.0 - 1440.0  # an event 900 s beyond the last row keeps all ten
    y = np.cos(evenly / 5400 * 2 * np.pi)[..., None] * 7e6
    c = np.polynomial.polynomial.Polynomial.fit(evenly[0], y[0, :, 0], 9)
    assert np.allclose(interpolate.polynomial_at_zero(evenly, y)[0], [c(0), c.deriv()(0)], rtol=0, atol=0.1)
    days = np.array([0, 2, 4, 6, 8, 8, 8, 14, 16, 18])
    for gaps in ([0, 1, 2], [0, 1, 3], [0, 0, 1]):  # the last ones two rows a microsecond apart
        t = (days * 86_400.0)[None] - 1e6
        t[0, 4:7] += gaps
        t[0, 5] += 1e-6
        angle = lambda s: s / (86_400 * 40_000) * 2 * np.pi + 3.7
        got = interpolate.polynomial_at_zero(t, np.stack([7e6 * np.cos(angle(t)), 7e6 * np.sin(angle(t))], axis=-1))[0]
        speed = 7e6 * 2 * np.pi / (86_400 * 40_000)
        assert np.allclose(got, [7e6 * np.cos(angle(0)), 7e6 * np.sin(angle(0)), -speed * np.sin(angle(0)), speed * np.cos(angle(0))], rtol=0, atol=0.1)


def test_window_state_estimates_between_crowded_epochs(spark, tmp_path):
    import duckdb
    from __spark_entry__ import oracle_sql, queries

    days = [0, 2, 4, 6, 8, 8 + 2 / 86_400, 8 + 3 / 86_400, 8 + 5 / 86_400, 14, 16, 18, 20]
    rows = [("click", d) for d in days] + [("error", d) for d in (1, 7.2, 11.3, 17)] + [("view", 3), ("purchase", 5)]
    events = pd.DataFrame({"event_id": range(len(rows)), "ts": pd.to_datetime("2024-01-01") + pd.to_timedelta([d for _, d in rows], unit="D").round("us"), "user_id": 7, "event_type": [k for k, _ in rows], "value": 1.5, "props": '{"k": 3}'})
    events["ts"] = events["ts"].astype("datetime64[us]")
    con = duckdb.connect()
    con.execute(f"COPY events TO '{tmp_path}/events.parquet'")
    for t in ("customer", "supplier", "part", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '/root/testdata/sf0.001/{t}.parquet'")
    want = con.execute(oracle_sql()["t15_window_state_estimates"]).df()
    got = queries()["t15_window_state_estimates"](spark, str(tmp_path)).toPandas()[list(want.columns)]
    key = "annotation_id"
    assert got.orbit_within_1m.all() and len(got) == 4
    pd.testing.assert_frame_equal(got.sort_values(key, ignore_index=True), want.sort_values(key, ignore_index=True), check_dtype=False)


def test_spans_on_a_decimal_tie_are_rounded_as_in_sql(spark):
    import duckdb
    from orrery.roles import rnd_span, rsql

    spans = [527_480_948_500, 500, 1_500, 2_500, 1_005_000, 604_799_999_500, 86_399_000_500, 0]
    got = spark.createDataFrame([(s,) for s in spans], "s long").select("s", rnd_span(F.col("s") / 1e6), rnd_span(F.col("s") / 60e6)).collect()
    for s, second, minute in got:
        assert (second, minute) == duckdb.execute(f"SELECT {rsql(f'{s}::BIGINT/1e6', 3)}, {rsql(f'{s}::BIGINT/60e6', 3)}").fetchone()


def test_injected_copies_are_columns(spark, monkeypatch):
    """One row for each row of the series goes through the windows, whatever the number of amounts; an entity without a row in a band stays."""
    from orrery.operators import series

    rng = np.random.default_rng(8)
    hour = 3_600_000_000
    pdf = pd.DataFrame({"e": 1, "t": np.arange(-200, 201) * hour, "v": 7e6 + rng.random(401)})
    pdf = pd.concat([pdf, pd.DataFrame({"e": 2, "t": [0, 10_000 * hour], "v": [7e6, 7e6]})])
    made = []
    monkeypatch.setattr(series, "cut", lambda df: made.append(cut(df)) or made[-1])
    got = series.injected_responses(spark.createDataFrame(pdf), ["e"], "v", amounts=(10.0, 100.0, 1000.0), spacings_h=(12.0, 72.0), hour_us=hour, ramp_h=40.0, period_s=F.lit(5 * 3600.0)).toPandas()
    assert max(df.count() for df in made) <= len(pdf)
    one, h = pdf[pdf.e == 1], pdf[pdf.e == 1].t.to_numpy() / hour
    for r in got[got.e == 1].itertuples():
        m = [(one.v + a * np.clip(h / 40.0, 0, 1)).rolling(5, center=True, min_periods=2).mean().to_numpy() for a in (0.0, r.amount)]
        orbit = [np.median(x[(h > 24) & (h <= 36)]) - np.median(x[(h >= -18) & (h < -6)]) for x in m]
        q0, q1 = (-6, 24) if r.spacing_h == 12 else (-27, 45)
        catalog = [x[(h >= q1 - 24) & (h <= q1)].mean() - x[(h >= q0 - 24) & (h <= q0)].mean() for x in m]
        assert np.allclose([r.orbit_estimate, r.catalog_estimate], [orbit[1] - orbit[0], catalog[1] - catalog[0]], atol=1e-6)
    assert len(got) == 12 and got[got.e == 2][["orbit_estimate", "catalog_estimate"]].isna().all().all()


def test_resampling_spreads_rows_and_draws_the_same_weights(spark):
    """A table in one split was resampled by one task."""
    df = spark.range(300).select(F.col("id").alias("key"), (F.col("id") * 0.5).alias("x"), (F.col("id") % 7).cast("double").alias("y")).coalesce(1)
    plan = statistics.bootstrap_slopes(df, "key", replicates=20)._jdf.queryExecution().executedPlan().toString()
    assert f"{4 * spark.sparkContext.defaultParallelism}), REPARTITION_BY_NUM" in plan
    keys, low = np.random.default_rng(5).integers(0, 1 << 60, 400), 0xFFFFFFFF
    got = statistics.replicate_weights(keys, np.arange(0, 2000, 97))
    for i, key in enumerate(keys.tolist()):
        for j, r in enumerate(range(0, 2000, 97)):
            h = (((key >> 30) + 1) * ((2 * r + 1) * statistics.LANE & low) + (key & ((1 << 30) - 1))) & low
            h = (h ^ (h >> 16)) * statistics.MIX_1 & low
            h = (h ^ (h >> 13)) * statistics.MIX_2 & low
            assert got[i, j] == sum((h ^ (h >> 16)) >= int(step) for step in statistics.POISSON_STEPS)
