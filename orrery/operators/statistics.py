"""Statistics on aggregates: slopes, bootstrap, KS, equivalence tests, uncertainty model."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.cells import ROWS, even_cells
from orrery.operators.scan import prefix_scan
from orrery.session import cut, deal

# Noise floors (m), uncertainty fit bins (days), coverage references, tolerances.
SIGMA_X_M, SIGMA_Y_M = 24.0, 1.1
FIT_EDGES_DAYS = (0.0, 0.25, 0.5, 1.0, 2.0, 4.0)
FIT_MIN_SAMPLES = 5
VALIDITY_S = 48 * 3600.0
NOMINAL = {1: 0.6827, 2: 0.9545, 3: 0.9973}
MAXWELL = {1: 0.1987, 2: 0.7385, 3: 0.9707}


def deming(sxx: Column, syy: Column, sxy: Column, sigma_x: float = SIGMA_X_M, sigma_y: float = SIGMA_Y_M) -> Column:
    """Errors-in-both slope; the conjugate form avoids cancellation when the leading term is negative."""
    lam = (sigma_y / sigma_x) ** 2
    a = syy - lam * sxx
    root = F.sqrt(a * a + 4.0 * lam * sxy * sxy)
    return F.when((sxy == 0) | (sxx == 0), None).when((a >= 0) | (root == 0), (a + root) / (2.0 * sxy)).otherwise(2.0 * lam * sxy / (root - a))


def slopes(pairs: DataFrame, by: Sequence[str], x: str = "x", y: str = "y", *, median_ratio: bool = False) -> DataFrame:
    """OLS, attenuation-corrected and Deming slopes, intercepts and r per group of >= 3 pairs, from one aggregate;
    ``median_ratio`` adds the exact median of y / x, which takes passes of its own."""
    p = pairs.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    aggs = [F.count(F.lit(1)).alias("n"), F.var_samp(x).alias("sxx"), F.var_samp(y).alias("syy"), F.covar_samp(x, y).alias("sxy"), F.avg(x).alias("mx"), F.avg(y).alias("my")]
    ratio = F.when(F.col(x) != 0, F.col(y) / F.col(x))
    s = (with_quantiles(p, list(by), aggs, {"median_ratio": (ratio, 0.5)}) if median_ratio else p.groupBy(*by).agg(*aggs)).where("n >= 3")
    k = F.col("sxy") / F.nullif(F.col("sxx"), F.lit(0.0))
    d = deming(F.col("sxx"), F.col("syy"), F.col("sxy"))
    return s.withColumns({"ols_slope": k, "deming_slope": d}).withColumns({
        "ols_intercept": F.col("my") - F.col("ols_slope") * F.col("mx"), "deming_intercept": F.col("my") - F.col("deming_slope") * F.col("mx"),
        "corrected_slope": F.col("ols_slope") * (1.0 + SIGMA_X_M**2 / F.nullif(F.col("sxx"), F.lit(0.0))),
        "pearson_r": F.col("sxy") / F.sqrt(F.nullif(F.col("sxx") * F.col("syy"), F.lit(0.0))),
    })


REPLICATES = 2000
#: Fixed values of the replicates' hash: odd 32-bit multipliers of a lane and of the two mixing rounds.
LANE, MIX_1, MIX_2 = 0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35
#: Weights are Poisson of mean 1: the weight is the number of these that a uniform 32-bit number reaches.
POISSON_STEPS = np.array([math.ceil(float(c) * 2**32) for c in np.cumsum([math.exp(-1.0) / math.factorial(k) for k in range(12)])], np.uint64)


#: The weight by the upper half of the number; ``SPLIT`` where a step lies within.
SPLIT = 255
HALVES = np.arange(1 << 16, dtype=np.uint64) << np.uint64(16)
BY_HALF = np.where(
    np.searchsorted(POISSON_STEPS, HALVES, side="right") == np.searchsorted(POISSON_STEPS, HALVES + np.uint64(0xFFFF), side="right"),
    np.searchsorted(POISSON_STEPS, HALVES, side="right"), SPLIT,
).astype(np.uint8)
#: Rows to a task, each drawing its weights.
RESAMPLED = 500_000


def replicate_weights(keys: np.ndarray, replicates: np.ndarray) -> np.ndarray:
    """Poisson(1) weight of each row (key of 60 bits) in each replicate, from the two numbers alone: independent of partitioning and retries."""
    keys, lanes = keys.astype(np.uint64)[:, None], (2 * replicates.astype(np.uint64) + np.uint64(1)).astype(np.uint32) * np.uint32(LANE)
    # numbers of 32 bits wrap by themselves
    h = ((keys >> np.uint64(30)) + np.uint64(1)).astype(np.uint32) * lanes
    h += (keys & np.uint64((1 << 30) - 1)).astype(np.uint32)
    for shift, mix in ((16, MIX_1), (13, MIX_2)):
        h ^= h >> np.uint32(shift)
        h *= np.uint32(mix)
    h ^= h >> np.uint32(16)
    w = BY_HALF[h >> np.uint32(16)]
    split = w == SPLIT
    w[split] = np.searchsorted(POISSON_STEPS, h[split].astype(np.uint64), side="right")
    return w


def bootstrap_slopes(pairs: DataFrame, key: str, *, replicates: int = REPLICATES) -> DataFrame:
    """OLS and Deming slope of each bootstrap replicate.

    Every row draws a Poisson(1) weight per replicate from its ``key``. A task keeps
    only six sums per replicate and emits one row each; rows are neither repeated nor gathered.
    """
    every = np.arange(replicates)

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = np.zeros((6, replicates))
        for pdf in batches:
            for lo in range(0, len(pdf), 256):
                part = pdf.iloc[lo : lo + 256]
                x, y = part["x"].to_numpy(), part["y"].to_numpy()
                sums += np.vstack([np.ones_like(x), x, y, x * x, y * y, x * y]) @ replicate_weights(part[key].to_numpy(), every).astype(float)
        yield pd.DataFrame(dict(zip(("n", "sx", "sy", "qxx", "qyy", "qxy"), sums), replicate=every))

    clean = pairs.where("x is not null and y is not null").select(key, "x", "y")
    # shift by the means first: sums of squares of raw values would cancel
    mean = clean.agg(F.avg("x").alias("_mx"), F.avg("y").alias("_my"))
    centred = clean.join(F.broadcast(mean)).select(key, (F.col("x") - F.col("_mx")).alias("x"), (F.col("y") - F.col("_my")).alias("y"))  # one-row side
    part = deal(centred, RESAMPLED, key).mapInPandas(partial, "n double, sx double, sy double, qxx double, qyy double, qxy double, replicate int")
    s = part.groupBy("replicate").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "qxx", "qyy", "qxy")]).where("n > 2")
    cov = lambda q, a, b: (F.col(q) - F.col(a) * F.col(b) / F.col("n")) / (F.col("n") - 1)
    sxx, syy, sxy = cov("qxx", "sx", "sx"), cov("qyy", "sy", "sy"), cov("qxy", "sx", "sy")
    return s.select("replicate", F.when(sxx > 0, sxy / sxx).alias("ols_slope"), F.when(sxx > 0, deming(sxx, syy, sxy)).alias("deming_slope"))


def bootstrap_medians(values: DataFrame, key: str, column: str, *, replicates: int = REPLICATES, blocks: int = 25) -> DataFrame:
    """(replicate, median) of ``replicates`` bootstrap resamples, exact.

    A resampled median stays within a few times sqrt(n) ranks of the middle. So one pass over all rows sums, for each replicate, the weights
    of all rows and of those under a central interval of 8 standard deviations; only the rows inside, some 8 sqrt(n), are
    ordered, by blocks of replicates in as many tasks. A median outside the interval stops the job.
    """
    every = np.arange(replicates)
    clean = values.where(F.col(column).isNotNull()).select(F.col(key).cast("long").alias("key"), F.col(column).cast("double").alias("v"))
    n = clean.count()
    half = min(0.5, 4.0 / math.sqrt(max(n, 1)))
    bounds = exact_quantiles(clean, [], {"lo": (F.col("v"), 0.5 - half), "hi": (F.col("v"), 0.5 + half)})
    lo, hi = bounds.first() if n else (0.0, 0.0)

    def totals(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total, under = np.zeros(replicates, np.int64), np.zeros(replicates, np.int64)
        for pdf in batches:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                both = np.stack([np.ones(len(part)), part["v"] < lo]) @ replicate_weights(part["key"].to_numpy(), every).astype(float)
                total += both[0].astype(np.int64)
                under += both[1].astype(np.int64)
        yield pd.DataFrame({"replicate": every, "total": total, "under": under})

    sums = deal(clean, RESAMPLED, "key").mapInPandas(totals, "replicate int, total long, under long").groupBy("replicate").agg(F.sum("total").alias("total"), F.sum("under").alias("under"))
    sums = sums.withColumn("block", F.col("replicate") % blocks)
    inside = clean.where(F.col("v").between(lo, hi)).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def medians(rows: pd.DataFrame, sums: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("v", kind="stable")
        v, keys, out = rows["v"].to_numpy(), rows["key"].to_numpy(), []
        for r, total, under in zip(sums["replicate"], sums["total"], sums["under"], strict=True):
            upto = under + np.cumsum(replicate_weights(keys, np.array([r]))[:, 0], dtype=np.int64)
            if total:
                at = np.searchsorted(upto, [(total - 1) // 2, total // 2], side="right")
                if under > (total - 1) // 2 or at[1] == len(v):
                    raise ValueError(f"the median of replicate {r} lies outside the central interval")
                out.append((r, v[at].mean()))
        return pd.DataFrame(out, columns=["replicate", "median"]).astype({"replicate": "int32", "median": "float64"})

    return inside.groupBy("block").cogroup(sums.groupBy("block")).applyInPandas(medians, "replicate int, median double")


def ks_pairs(df: DataFrame, by: Sequence[str], group: str, value: str, bucket: Column, min_group: int = 5) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic (and asymptotic p) for every pair of labels per ``by``.

    ``bucket`` is a monotone function of the value column ``_v``. Work is linear in the
    distinct values times the (few) labels.
    """
    by = list(by)
    v = df.where(F.col(value).isNotNull()).groupBy(*by, F.col(value).alias("_v"), F.col(group).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    sizes = v.groupBy(*by, "_g").agg(F.sum("_n").alias("_size")).where(F.col("_size") >= min_group)
    a = sizes.select(*by, F.col("_g").alias("left"), F.col("_size").alias("n_left"))
    b = sizes.select(*by, F.col("_g").alias("right"), F.col("_size").alias("n_right"))
    pairs = (a.join(b, by) if by else a.join(b)).where(F.col("left") < F.col("right"))  # labels per group, not rows
    x = v.join(pairs, by) if by else v.join(F.broadcast(pairs))
    x = x.where((F.col("_g") == F.col("left")) | (F.col("_g") == F.col("right")))
    keys = [*by, "left", "right"]
    x = x.groupBy(*keys, "n_left", "n_right", "_v").agg(F.sum(F.when(F.col("_g") == F.col("left"), F.col("_n")).otherwise(0)).alias("_a"), F.sum(F.when(F.col("_g") == F.col("right"), F.col("_n")).otherwise(0)).alias("_c"))
    run = prefix_scan(x, keys, ["_v"], bucket, {"_ca": ("sum", F.col("_a")), "_cc": ("sum", F.col("_c"))})
    d = F.max(F.abs(F.col("_ca") / F.col("n_left") - F.col("_cc") / F.col("n_right")))
    out = run.groupBy(*keys, "n_left", "n_right").agg(d.alias("ks_statistic"))
    en = F.sqrt(F.col("n_left") * F.col("n_right") / (F.col("n_left") + F.col("n_right")))
    lam = (en + 0.12 + 0.11 / en) * F.col("ks_statistic")
    series = sum(((-1) ** (j - 1)) * F.exp(-2.0 * j * j * lam * lam) for j in range(1, 21))
    return out.withColumn("ks_pvalue", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(lam < 0.2, 1.0).otherwise(2.0 * series))))


def student_t_cdf(t: np.ndarray, df: np.ndarray) -> np.ndarray:
    """Student-t distribution function through the incomplete beta continued fraction."""
    from math import lgamma

    t, df = np.asarray(t, float), np.asarray(df, float)
    x = df / (df + t * t)
    a, b = df / 2, np.full_like(df, 0.5)
    flip = x > (a + 1) / (a + b + 2)
    p, q, z = np.where(flip, b, a), np.where(flip, a, b), np.where(flip, 1 - x, x)
    front = np.exp(np.vectorize(lgamma)(p + q) - np.vectorize(lgamma)(p) - np.vectorize(lgamma)(q) + p * np.log(np.maximum(z, 1e-300)) + q * np.log1p(-np.minimum(z, 1 - 1e-16))) / p
    c, d = np.ones_like(z), 1 / (1 - (p + q) * z / (p + 1))
    h = d.copy()
    for m in range(1, 200):
        for num in (m * (q - m) * z / ((p + 2 * m - 1) * (p + 2 * m)), -(p + m) * (p + q + m) * z / ((p + 2 * m) * (p + 2 * m + 1))):
            d = 1 / (1 + num * d)
            c = 1 + num / c
            h = h * c * d
    inc = np.where(z <= 0, 0.0, front * h)
    inc = np.where(flip, 1 - inc, inc)
    return np.where(t >= 0, 1 - inc / 2, inc / 2)


@F.pandas_udf(T.DoubleType())
def _t_cdf(t: pd.Series, df: pd.Series) -> pd.Series:
    ok = t.notna() & df.notna()
    out = pd.Series(np.nan, index=t.index)
    if ok.any():
        out[ok] = student_t_cdf(t[ok].to_numpy(), df[ok].to_numpy())
    return out


def equivalence(df: DataFrame, by: Sequence[str], group: str, value: str, tolerance: Column, *, min_group: int = 5, alpha: float = 0.05) -> DataFrame:
    """Two one-sided Welch tests per pair of labels: effect sizes, p-values and verdict."""
    by = list(by)
    g = with_quantiles(df.where(F.col(value).isNotNull()), [*by, group], [F.count(F.lit(1)).alias("n"), F.avg(value).alias("m"), F.var_samp(value).alias("v")], {"md": (F.col(value), 0.5)}).where(F.col("n") >= min_group)
    g = cut(g)
    side = lambda s: g.select(*by, F.col(group).alias(s), *[F.col(c).alias(f"{c}_{s}") for c in ("n", "m", "v", "md")])
    p = side("left").join(side("right"), by).where(F.col("left") < F.col("right")).withColumn("tolerance", tolerance)
    ea, eb = F.col("v_left") / F.col("n_left"), F.col("v_right") / F.col("n_right")
    p = p.withColumns({"se2": ea + eb, "mean_delta": F.col("m_left") - F.col("m_right"), "median_delta": F.col("md_left") - F.col("md_right")})
    dof = F.col("se2") * F.col("se2") / (ea * ea / (F.col("n_left") - 1) + eb * eb / (F.col("n_right") - 1))
    flat = F.col("se2") <= 0
    se, d, tol = F.sqrt("se2"), F.col("mean_delta"), F.col("tolerance")
    pooled = F.sqrt(((F.col("n_left") - 1) * F.col("v_left") + (F.col("n_right") - 1) * F.col("v_right")) / (F.col("n_left") + F.col("n_right") - 2))
    p = p.withColumns({"welch_df": F.when(~flat, dof), "t_low": F.when(~flat, (d + tol) / se), "t_high": F.when(~flat, (d - tol) / se), "cohens_d": F.when(pooled > 0, d / pooled).otherwise(0.0)})
    p = p.withColumns({"_cl": _t_cdf("t_low", "welch_df"), "_ch": _t_cdf("t_high", "welch_df")})
    p_low = F.when(flat, F.when(d > -tol, 0.0).otherwise(1.0)).otherwise(1 - F.col("_cl"))
    p_high = F.when(flat, F.when(d < tol, 0.0).otherwise(1.0)).otherwise(F.col("_ch"))
    exceeds = F.when(flat, F.when(F.abs(d) > tol, 0.0).otherwise(1.0)).when(d > 0, 1 - F.col("_ch")).otherwise(F.col("_cl"))
    p = p.withColumns({"p_tost": F.greatest(p_low, p_high), "p_exceeds": exceeds})
    verdict = F.when(F.col("p_tost") < alpha, "equivalent").when(F.abs("median_delta") >= tol, "exceeds_tolerance").otherwise("inconclusive")
    return p.withColumn("verdict", verdict).drop("_cl", "_ch")


def benjamini_hochberg(df: DataFrame, p: str, tie: Sequence[str], name: str = "p_adjusted", rows: int = ROWS) -> DataFrame:
    """Adjusted p-values: rank by a two-level scan, then the running minimum from the far end.

    Cells follow the values, so p-values that crowd at 0 spread over as many tasks as any others.
    """
    cell = F.col("_even")
    order = [p, *tie]
    x = even_cells(df, [], F.col(p), "_even", rows=rows)
    x = prefix_scan(x, [], order, cell, {"_rank": ("sum", F.lit(1).cast("bigint"))})
    m = df.agg(F.count(F.lit(1)).alias("_m"))
    x = x.join(F.broadcast(m))  # one-row side
    x = prefix_scan(x, [], order, cell, {name: ("min", F.col(p) * F.col("_m") / F.col("_rank"))}, descending=True)
    return x.withColumn(name, F.least(F.col(name), F.lit(1.0))).drop("_rank", "_m", "_even")


def sigma_model(estimates: DataFrame) -> DataFrame:
    """One row: base and daily growth from a line through bin medians.

    ``estimates`` has residual ``res`` (km) and ``prop_s``, fit targets only. Bins are
    [lo, hi) days with at least five samples; fewer than two bins give the overall median and no growth.
    """
    e = estimates.withColumn("_d", F.abs("prop_s") / 86400.0)
    b = F.lit(None).cast("double")
    for lo, hi in zip(FIT_EDGES_DAYS, FIT_EDGES_DAYS[1:]):
        b = F.when((F.col("_d") >= lo) & (F.col("_d") < hi), (lo + hi) / 2).otherwise(b)
    bins = with_quantiles(e.withColumn("centre", b).where("centre is not null"), ["centre"], [F.count(F.lit(1)).alias("n")], {"med": (F.col("res"), 0.5)}).where(F.col("n") >= FIT_MIN_SAMPLES)
    line = bins.agg(F.count(F.lit(1)).alias("_bins"), F.regr_slope("med", "centre").alias("_k"), F.avg("med").alias("_mm"), F.avg("centre").alias("_mc"))
    overall = with_quantiles(e, [], [F.count(F.lit(1)).alias("fit_sample_count")], {"_all": (F.col("res"), 0.5)})
    x = line.join(F.broadcast(overall))  # two one-row tables
    two = F.col("_bins") >= 2
    return x.select(
        F.greatest(F.when(two, F.col("_mm") - F.col("_k") * F.col("_mc")).otherwise(F.col("_all")), F.lit(0.0)).alias("base_km"),
        F.greatest(F.when(two, F.col("_k")).otherwise(0.0), F.lit(0.0)).alias("growth_km_per_day"), "fit_sample_count",
    )


def calibration(estimates: DataFrame, model: DataFrame, group: Column) -> DataFrame:
    """Empirical coverage at 1, 2, 3 sigma per group and overall, inside the validity domain."""
    x = estimates.join(F.broadcast(cut(model)))  # one-row side
    bound = F.col("base_km") + F.col("growth_km_per_day") * F.abs("prop_s") / 86400.0
    x = x.select(F.explode(F.array(F.lit("all"), group)).alias("grp"), "res", bound.alias("_b"), (F.abs("prop_s") <= VALIDITY_S).alias("_in"))
    hits = [F.avg(F.when(F.col("_in"), (F.col("res") <= k * F.col("_b")).cast("double"))).alias(f"_k{k}") for k in NOMINAL]
    q = with_quantiles(x, ["grp"], [*hits, F.count_if("_in").alias("sample_count"), F.count_if(~F.col("_in")).alias("beyond_validity")], {"median_residual_km": (F.when(F.col("_in"), F.col("res")), 0.5)})
    rows = F.array(*[F.struct(F.lit(k).alias("k_sigma"), F.lit(NOMINAL[k]).alias("nominal"), F.lit(MAXWELL[k]).alias("nominal_norm"), F.col(f"_k{k}").alias("empirical")) for k in NOMINAL])
    return q.select("grp", "sample_count", "beyond_validity", "median_residual_km", F.explode(rows).alias("r")).select("grp", "sample_count", "beyond_validity", "median_residual_km", "r.*")
