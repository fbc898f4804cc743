"""Series, statistics and state estimation queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from orrery import roles as R
from orrery.functions import orbit
from orrery.functions.time import iso
from orrery.operators import interpolate, joins, names, qc, response, series, state, statistics, summaries
from orrery.operators.labels import top_k
from orrery.operators.quantiles import exact_quantiles, with_quantiles
from orrery.operators.scan import DAY_US, HOUR_US, neighbour, row_index, slot
from orrery.plans.joins import FILE_PAIRS_CTE, SMA_SQL, best_files, station_solutions
from orrery.plans.quality import CHK_CTE, checked
from orrery.plans.registry import query
from orrery.plans.summaries import BOUND, EST_CTE, FUSE_CTE, GROUP_SQL, RESP, bound, eval_group, fused_errors, responses, usable
from orrery.roles import iso_sql, oracle, rnd, rnd_span, rsql
from orrery.session import cut, deal

SMA = SMA_SQL.format("mean_motion")


@query("v01_step_candidates", oracle(f"SELECT entity_id, {iso_sql('pt')} AS bracket_start_utc, {iso_sql('t')} AS bracket_end_utc, {rsql('(a-pa)*1000.0', 1)} AS delta_sma_m, {rsql('med', 3)} AS median_altitude_km FROM (SELECT entity_id, t, a, lag(a) OVER w AS pa, lag(t) OVER w AS pt, median(a) OVER (PARTITION BY entity_id)-6371.0 AS med FROM (SELECT *, {SMA}/1000.0 AS a FROM elements) WINDOW w AS (PARTITION BY entity_id ORDER BY t, event_id)) WHERE abs((a-pa)*1000.0)>100"))
def v01(spark, d):
    """Consecutive element changes beyond 100 m with their bracket."""
    e = R.elements(spark, d).select("entity_id", "t", "event_id", (orbit.sma_from_mean_motion(F.col("mean_motion")) / 1000.0).alias("a"))
    med = exact_quantiles(e, ["entity_id"], {"m": (F.col("a"), 0.5)})
    s = series.steps(e, ["entity_id"], ["t", "event_id"], "a").where(F.abs(F.col("delta") * 1000.0) > 100)
    return s.join(med, "entity_id").select("entity_id", iso("prev_t").alias("bracket_start_utc"), iso("t").alias("bracket_end_utc"), rnd(F.col("delta") * 1000.0, 1).alias("delta_sma_m"), rnd(F.col("m") - 6371.0, 3).alias("median_altitude_km"))


def smooth_series(spark, d):
    """One row per (entity, epoch) with a slowly varying axis."""
    return R.series(spark, d).groupBy("entity_id", "t").agg((7e6 + F.sqrt(F.max("price"))).alias("sma"))


SM_CTE = "sm AS (SELECT entity_id, t, 7e6+sqrt(max(price)) AS sma FROM series GROUP BY 1,2)"
W_CTE = f"smw AS (SELECT sm.*, w FROM sm JOIN (SELECT entity_id, greatest(2, round_even(20*86400.0/median(g),0))::BIGINT AS w FROM (SELECT entity_id, (t-lag(t) OVER (PARTITION BY entity_id ORDER BY t))/1e6 AS g FROM sm) GROUP BY 1) q ON q.entity_id=sm.entity_id)"


@query("v02_period_mean", oracle(f"SELECT entity_id, {iso_sql('t')} AS epoch_utc, {rsql('CASE WHEN n>=greatest(2,w//2) THEN m END', 3)} AS period_mean FROM (SELECT *, avg(sma) OVER (PARTITION BY entity_id ORDER BY t ROWS BETWEEN (w//2) PRECEDING AND (w-1-w//2) FOLLOWING) AS m, count(sma) OVER (PARTITION BY entity_id ORDER BY t ROWS BETWEEN (w//2) PRECEDING AND (w-1-w//2) FOLLOWING) AS n FROM smw)", SM_CTE, W_CTE))
def v02(spark, d):
    """Centred mean over one period; the row width differs per entity."""
    p = series.period_mean(smooth_series(spark, d), ["entity_id"], ["t"], "sma", period_s=F.lit(20 * 86400.0))
    return p.select("entity_id", iso("t").alias("epoch_utc"), rnd("period_mean", 3).alias("period_mean"))


@query("v03_backward_mean", oracle(f"SELECT entity_id, {iso_sql('t')} AS epoch_utc, {rsql(f'avg(sma) OVER (PARTITION BY entity_id ORDER BY t RANGE BETWEEN 30*{DAY_US} PRECEDING AND CURRENT ROW)', 3)} AS backward_mean FROM sm", SM_CTE))
def v03(spark, d):
    """Mean over the 30 days up to each row."""
    b = series.backward_mean(smooth_series(spark, d), ["entity_id"], "t", "sma", 30 * DAY_US)
    return b.select("entity_id", iso("t").alias("epoch_utc"), rnd("backward_mean", 3).alias("backward_mean"))


ARC_CTE = f"""g0 AS (SELECT entity_id, t, t-lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS g FROM sm),
g1 AS (SELECT g0.*, m FROM g0 JOIN (SELECT entity_id, median(g) AS m FROM g0 WHERE g>0 GROUP BY 1) q ON q.entity_id=g0.entity_id),
arcs AS (SELECT *, count(*) OVER (PARTITION BY entity_id, arc) AS arc_rows FROM (SELECT *, CAST(sum(CASE WHEN g>greatest(300000000, 3*m) THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY t ROWS UNBOUNDED PRECEDING) AS BIGINT) AS arc FROM g1))"""


@query("v04_arc_segmentation", oracle(f"SELECT entity_id, arc, count(*) AS arc_rows, {iso_sql('min(t)')} AS start_utc, {iso_sql('max(t)')} AS end_utc FROM arcs WHERE arc_rows>=4 GROUP BY 1,2", SM_CTE, ARC_CTE))
def v04(spark, d):
    """Contiguous arcs of at least four rows (hole factor 3 on this data)."""
    a = series.arcs(smooth_series(spark, d), ["entity_id"], factor=3.0)
    return a.groupBy("entity_id", "arc").agg(F.count("*").alias("arc_rows"), iso(F.min("t")).alias("start_utc"), iso(F.max("t")).alias("end_utc"))


@query("v05_first_last_previous", oracle(f"SELECT entity_id, event_id, {iso_sql('lag(t) OVER w')} AS previous_utc, row_number() OVER w=1 AS is_first, lead(t) OVER w IS NULL AS is_last FROM states WINDOW w AS (PARTITION BY entity_id ORDER BY t, event_id)"))
def v05(spark, d):
    """Previous epoch and first/last flags of each row."""
    s = R.states(spark, d).select("entity_id", "event_id", "t")
    order, b = ["t", "event_id"], slot("t", DAY_US)
    s = neighbour(s, ["entity_id"], order, b, ["t"])
    s = neighbour(s, ["entity_id"], order, b, ["t"], name="nxt", ahead=True)
    return s.select("entity_id", "event_id", iso("prev.t").alias("previous_utc"), F.col("prev").isNull().alias("is_first"), F.col("nxt").isNull().alias("is_last"))


@query("v06_linear_detrend", oracle(f"SELECT sm.entity_id, {iso_sql('t')} AS epoch_utc, {rsql('sma - k*((t-t0)/1e6-mx)', 3)} AS detrended FROM sm JOIN (SELECT entity_id, any_value(t0) AS t0, regr_slope(sma, (t-t0)/1e6) AS k, avg((t-t0)/1e6) AS mx FROM (SELECT *, min(t) OVER (PARTITION BY entity_id) AS t0 FROM sm) GROUP BY 1) f ON f.entity_id=sm.entity_id", SM_CTE))
def v06(spark, d):
    """Fitted line removed per entity, level kept."""
    x = series.detrend(smooth_series(spark, d), ["entity_id"], "t", "sma")
    return x.select("entity_id", iso("t").alias("epoch_utc"), rnd("detrended", 3).alias("detrended"))


def v07_cte():
    unit = 100 * HOUR_US
    pm = "CASE WHEN n>=greatest(2,w//2) THEN m END"
    return [SM_CTE, W_CTE, f"inj AS (SELECT smw.entity_id, t, w, amount, (t-t0)/{unit}.0 AS h, sma + amount*least(greatest(((t-t0)/{unit}.0)/40.0,0.0),1.0) AS v FROM smw JOIN (SELECT entity_id, (min(t)+max(t))/2 AS t0 FROM sm GROUP BY 1) q ON q.entity_id=smw.entity_id, (VALUES (0.0::DOUBLE),(10.0),(100.0)) a(amount))",
            f"pm AS (SELECT *, {pm} AS p FROM (SELECT *, avg(v) OVER x AS m, count(v) OVER x AS n FROM inj WINDOW x AS (PARTITION BY entity_id, amount ORDER BY t ROWS BETWEEN (w//2) PRECEDING AND (w-1-w//2) FOLLOWING)))",
            "es AS (SELECT entity_id, amount, median(p) FILTER (h>24 AND h<=36)-median(p) FILTER (h>=-18 AND h<-6) AS o, avg(p) FILTER (h>=0 AND h<=24)-avg(p) FILTER (h>=-30 AND h<=-6) AS c0, avg(p) FILTER (h>=21 AND h<=45)-avg(p) FILTER (h>=-51 AND h<=-27) AS c1 FROM pm GROUP BY 1,2)"]


@query("v07_injected_responses", oracle(f"SELECT e.entity_id, e.amount, s.spacing_h, {rsql('e.o-b.o', 3)} AS orbit_estimate, {rsql('CASE WHEN spacing_h=12 THEN e.c0-b.c0 ELSE e.c1-b.c1 END', 3)} AS catalog_estimate FROM es e JOIN es b ON b.entity_id=e.entity_id AND b.amount=0, (VALUES (12.0::DOUBLE),(72.0)) s(spacing_h) WHERE e.amount<>0", *v07_cte()))
def v07(spark, d):
    """Two estimators of injected ramps over a grid of amounts and spacings (an hour of the method is 100 h here)."""
    x = series.injected_responses(smooth_series(spark, d), ["entity_id"], "sma", amounts=(10.0, 100.0), spacings_h=(12.0, 72.0), hour_us=100 * HOUR_US, ramp_h=40.0, period_s=F.lit(20 * 86400.0))
    return x.select("entity_id", "amount", "spacing_h", rnd("orbit_estimate", 3).alias("orbit_estimate"), rnd("catalog_estimate", 3).alias("catalog_estimate"))


@query("v08_even_index_sampling", oracle("SELECT entity_id, t, sma FROM (SELECT entity_id, t//1000000 AS t, round_even(sma,3) AS sma, row_number() OVER (PARTITION BY entity_id ORDER BY t)-1 AS pos, count(*) OVER (PARTITION BY entity_id) AS n FROM sm) WHERE list_contains(list_transform(range(0,least(n,50)), lambda i: round_even(i*(n-1)::DOUBLE/(least(n,50)-1),0)::BIGINT), pos)".replace("t//1000000 AS t", "t AS t0").replace("SELECT entity_id, t, sma FROM (", f"SELECT entity_id, {iso_sql('t0')} AS epoch_utc, sma FROM ("), SM_CTE))
def v08(spark, d):
    """Up to 50 evenly spaced rows of each series."""
    s = names.even_samples(smooth_series(spark, d), ["entity_id"], ["t"], slot("t", 30 * DAY_US), 50)
    return s.select("entity_id", iso("t").alias("epoch_utc"), rnd("sma", 3).alias("sma"))


@query("v09_benjamini_hochberg", f"SELECT o_orderkey, {rsql('least(min(p*m/rk) OVER (ORDER BY p, o_orderkey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),1.0)', 9)} AS p_adjusted FROM (SELECT o_orderkey, p, row_number() OVER (ORDER BY p, o_orderkey) AS rk, count(*) OVER () AS m FROM (SELECT o_orderkey, pow((o_orderkey*7919%10007)/10007.0::DOUBLE,2.0) AS p FROM orders))")
def v09(spark, d):
    """False-discovery adjusted p-values over the whole family."""
    o = R.table(spark, d, "orders").select("o_orderkey", F.pow((F.col("o_orderkey") * 7919 % 10007) / F.lit(10007.0), F.lit(2.0)).alias("p"))
    return statistics.benjamini_hochberg(o, "p", ["o_orderkey"]).select("o_orderkey", rnd("p_adjusted", 9).alias("p_adjusted"))


BAND_SQL = "CASE WHEN abs(x)<20 THEN 'band_0_20m' WHEN abs(x)<100 THEN 'band_20_100m' WHEN abs(x)<1000 THEN 'band_100_1000m' ELSE 'band_1000_infm' END"
PAIR_CTE = f"pr AS (SELECT unnest(['pooled', {BAND_SQL}]) AS scope, x, y FROM (SELECT delta_sma_km*1000.0 AS x, orbit_shift_m AS y FROM effects) WHERE x IS NOT NULL AND y IS NOT NULL)"


def pairs(spark, d):
    e = R.effects(spark, d).select("l_orderkey", "l_linenumber", (F.col("delta_sma_km") * 1000.0).alias("x"), F.col("orbit_shift_m").alias("y")).dropna(subset=["x", "y"])
    a = F.abs("x")
    band = F.when(a < 20, "band_0_20m").when(a < 100, "band_20_100m").when(a < 1000, "band_100_1000m").otherwise("band_1000_infm")
    return e.withColumn("band", band)


def scoped(p):
    return p.select(F.explode(F.array(F.lit("pooled"), F.col("band"))).alias("scope"), "x", "y")


@query("t01_ols_slopes", oracle(f"SELECT scope, count(*) AS n, {rsql('var_samp(x)', 3)} AS x_variance, {rsql('regr_slope(y,x)')} AS ols_slope, {rsql('regr_intercept(y,x)', 4)} AS ols_intercept, {rsql('corr(y,x)')} AS pearson_r FROM pr GROUP BY 1 HAVING count(*)>=3", PAIR_CTE))
def t01(spark, d):
    """Least-squares slope, intercept, variance and correlation, pooled and by left-closed band."""
    s = statistics.slopes(scoped(pairs(spark, d)), ["scope"])
    return s.select("scope", "n", rnd("sxx", 3).alias("x_variance"), rnd("ols_slope").alias("ols_slope"), rnd("ols_intercept", 4).alias("ols_intercept"), rnd("pearson_r").alias("pearson_r"))


LAM = "pow(1.1::DOUBLE/24.0::DOUBLE,2)"


@query("t02_deming_slope", oracle(f"SELECT scope, {rsql(f'CASE WHEN syy-{LAM}*sxx>=0 THEN (syy-{LAM}*sxx+sqrt(pow(syy-{LAM}*sxx,2)+4*{LAM}*sxy*sxy))/(2*sxy) ELSE 2*{LAM}*sxy/(sqrt(pow(syy-{LAM}*sxx,2)+4*{LAM}*sxy*sxy)-(syy-{LAM}*sxx)) END')} AS deming_slope FROM (SELECT scope, var_samp(x) AS sxx, var_samp(y) AS syy, covar_samp(y,x) AS sxy FROM pr GROUP BY 1 HAVING count(*)>=3)", PAIR_CTE))
def t02(spark, d):
    """Errors-in-both-variables slope."""
    return statistics.slopes(scoped(pairs(spark, d)), ["scope"]).select("scope", rnd("deming_slope").alias("deming_slope"))


@query("t03_attenuation_corrected", oracle(f"SELECT scope, {rsql('regr_slope(y,x)*(1+576.0/var_samp(x))')} AS corrected_slope, {rsql('median(CASE WHEN x<>0 THEN y/x END)')} AS median_ratio FROM pr GROUP BY 1 HAVING count(*)>=3", PAIR_CTE))
def t03(spark, d):
    """Slope corrected for noise in x, and the median ratio."""
    return statistics.slopes(scoped(pairs(spark, d)), ["scope"], median_ratio=True).select("scope", rnd("corrected_slope").alias("corrected_slope"), rnd("median_ratio").alias("median_ratio"))


def weighted_sql(rows: str, columns: str, replicates: str = "") -> str:
    """Rows (key, columns) with their weight w in each replicate r, as in ``replicate_weights``. ``replicates``: where r comes from, if not
    from the rows."""
    low, c = "4294967295::UBIGINT", f"r, {columns}"
    h = f"SELECT {c}, (((key::UBIGINT >> 30) + 1) * (((2*r+1)::UBIGINT * {statistics.LANE}::UBIGINT) & {low}) + (key::UBIGINT & {(1 << 30) - 1}::UBIGINT)) & {low} AS h FROM {rows}{replicates}"
    h = f"SELECT {c}, (xor(h, h >> 16) * {statistics.MIX_1}::UBIGINT) & {low} AS h FROM ({h})"
    h = f"SELECT {c}, (xor(h, h >> 13) * {statistics.MIX_2}::UBIGINT) & {low} AS h FROM ({h})"
    h = f"SELECT {c}, xor(h, h >> 16) AS h FROM ({h})"
    steps = " ".join(f"WHEN h < {t} THEN {k}" for k, t in enumerate(statistics.POISSON_STEPS))
    return f"(SELECT {c}, CASE {steps} ELSE {len(statistics.POISSON_STEPS)} END AS w FROM ({h}))"


EVERY = f", range({statistics.REPLICATES}) t(r)"
ROW_KEY = "('0x' || substr(md5(l_orderkey || '|' || l_linenumber), 1, 15))::BIGINT"


def row_key():
    return F.conv(F.substring(F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber")), 1, 15), 16, 10).cast("long")


@query("t04_bootstrap_slope_ci", oracle(f"""SELECT estimator, count(s) AS finite, {rsql('quantile_cont(s, 0.025)', 5)} AS ci_low, {rsql('quantile_cont(s, 0.975)', 5)} AS ci_high FROM (
 SELECT unnest(['ols', 'deming']) AS estimator, unnest([sxy/sxx, CASE WHEN syy-{LAM}*sxx>=0 THEN (syy-{LAM}*sxx+sqrt(pow(syy-{LAM}*sxx,2)+4*{LAM}*sxy*sxy))/(2*sxy) ELSE 2*{LAM}*sxy/(sqrt(pow(syy-{LAM}*sxx,2)+4*{LAM}*sxy*sxy)-(syy-{LAM}*sxx)) END]) AS s FROM (
 SELECT (qxx-sx*sx/n)/(n-1) AS sxx, (qyy-sy*sy/n)/(n-1) AS syy, (qxy-sx*sy/n)/(n-1) AS sxy FROM (SELECT r, sum(w) AS n, sum(w*x) AS sx, sum(w*y) AS sy, sum(w*x*x) AS qxx, sum(w*y*y) AS qyy, sum(w*x*y) AS qxy FROM (SELECT r, x, y, w::DOUBLE AS w FROM {weighted_sql('px', 'x, y', EVERY)}) GROUP BY r) WHERE n>2)) GROUP BY 1""",
    f"p0 AS (SELECT {ROW_KEY} AS key, delta_sma_km*1000.0 AS x, orbit_shift_m AS y FROM effects WHERE delta_sma_km IS NOT NULL AND orbit_shift_m IS NOT NULL), px AS (SELECT key, x - (SELECT avg(x) FROM p0) AS x, y - (SELECT avg(y) FROM p0) AS y FROM p0)"))
def t04(spark, d):
    """Bootstrap intervals of the OLS and Deming slope by Poisson resampling inside the scan."""
    b = statistics.bootstrap_slopes(pairs(spark, d).withColumn("key", row_key()), "key")
    est = F.explode(F.array(F.struct(F.lit("ols").alias("estimator"), F.col("ols_slope").alias("s")), F.struct(F.lit("deming").alias("estimator"), F.col("deming_slope").alias("s"))))
    x = b.select(est.alias("e")).select("e.*")
    q = x.groupBy("estimator").agg(F.count("s").alias("finite"), F.percentile("s", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"))  # one value per replicate
    ok = F.col("finite") >= statistics.REPLICATES / 2
    return q.select("estimator", "finite", F.when(ok, rnd(F.col("ci")[0], 5)).alias("ci_low"), F.when(ok, rnd(F.col("ci")[1], 5)).alias("ci_high"))


@query("t04_bootstrap_median_ci", oracle(f"""SELECT (SELECT count(*) FROM v0) AS n, (SELECT {rsql('median(m)')} FROM v0) AS median_m, {rsql('quantile_cont(m, 0.025)')} AS ci_low, {rsql('quantile_cont(m, 0.975)')} AS ci_high FROM (
 SELECT r, avg(m) AS m FROM (SELECT r, pos, min(m) AS m FROM (SELECT r, pos, m, before + sum(w) OVER (PARTITION BY r, pos ORDER BY m, i) AS upto FROM {weighted_sql('(SELECT * FROM mid JOIN v0 USING (cell))', 'pos, before, m, i')}) WHERE upto>pos GROUP BY 1, 2) GROUP BY 1)""",
    f"v0 AS (SELECT *, i//256 AS cell FROM (SELECT {ROW_KEY} AS key, abs(delta_sma_km)*1000.0 AS m, row_number() OVER (ORDER BY abs(delta_sma_km)*1000.0, l_orderkey, l_linenumber) AS i FROM effects WHERE delta_sma_km IS NOT NULL))",
    f"cw AS (SELECT r, cell, sum(w)::BIGINT AS w FROM {weighted_sql('v0', 'cell', EVERY)} GROUP BY 1, 2)",
    "cc AS (SELECT r, cell, w, sum(w) OVER (PARTITION BY r ORDER BY cell) - w AS before, sum(w) OVER (PARTITION BY r) AS total FROM cw)",
    "mid AS (SELECT DISTINCT r, cell, before, pos FROM (SELECT *, unnest([(total-1)//2, total//2]) AS pos FROM cc) WHERE before<=pos AND pos<before+w)"))
def t04b(spark, d):
    """Median response with the interval of 2000 resampled medians."""
    e = R.effects(spark, d).select(row_key().alias("key"), (F.abs("delta_sma_km") * 1000.0).alias("m"))
    b = statistics.bootstrap_medians(e, "key", "m").agg(F.percentile("median", F.array(F.lit(0.025), F.lit(0.975))).alias("ci"))
    n = e.agg(F.count("m").alias("n"))
    q = exact_quantiles(e, [], {"median": (F.col("m"), 0.5)})
    return n.join(q).join(b).select("n", rnd("median").alias("median_m"), rnd(F.col("ci")[0]).alias("ci_low"), rnd(F.col("ci")[1]).alias("ci_high"))  # three one-row tables


KS_CTE = """ks0 AS (SELECT entity_id, lt, rt, max(abs(ca::DOUBLE/na-cb::DOUBLE/nb)) AS d, CAST(any_value(na) AS BIGINT) AS n_left, CAST(any_value(nb) AS BIGINT) AS n_right FROM (
 SELECT *, sum(a) OVER w AS ca, sum(b) OVER w AS cb, sum(a) OVER (PARTITION BY entity_id, lt, rt) AS na, sum(b) OVER (PARTITION BY entity_id, lt, rt) AS nb FROM (SELECT entity_id, lt, rt, v, CAST(count(*) FILTER (tier=lt) AS BIGINT) AS a, CAST(count(*) FILTER (tier=rt) AS BIGINT) AS b FROM (SELECT entity_id, tier, qty AS v FROM effects) e, (VALUES ('A','B'),('A','C'),('B','C')) p(lt,rt) WHERE tier IN (lt,rt) GROUP BY 1,2,3,4) WINDOW w AS (PARTITION BY entity_id, lt, rt ORDER BY v)) WHERE na>=5 AND nb>=5 GROUP BY 1,2,3),
ks1 AS (SELECT *, sqrt(n_left*n_right/(n_left+n_right)::DOUBLE) AS en FROM ks0), ks2 AS (SELECT *, (en+0.12::DOUBLE+0.11::DOUBLE/en)*d AS lam FROM ks1),
ks AS (SELECT *, greatest(0.0::DOUBLE, least(1.0::DOUBLE, CASE WHEN lam < 0.2 THEN 1.0::DOUBLE ELSE 2.0*list_sum(list_transform(range(1,21), lambda j: (CASE WHEN j%2=1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END)*exp(-2.0*j*j*lam*lam))) END)) AS p FROM ks2)"""


@query("t05_ks_statistic", oracle(f"""SELECT CAST(entity_id AS VARCHAR) AS entity_id, lt AS left, rt AS right, {rsql('d')} AS ks_statistic, {rsql('p')} AS ks_pvalue, n_left, n_right FROM ks
 UNION ALL SELECT 'ALL_WITHIN_TARGET', lt, rt, {rsql('median(d)')}, {rsql('median(p)')}, CAST(sum(n_left) AS BIGINT), CAST(sum(n_right) AS BIGINT) FROM ks GROUP BY 2,3""", KS_CTE))
def t05(spark, d):
    """Kolmogorov-Smirnov statistic and p of each pair of tiers within each entity, and their medians over entities."""
    k = cut(statistics.ks_pairs(R.effects(spark, d), ["entity_id"], "tier", "qty", F.floor(F.col("_v") / 4).cast("bigint")))
    over = with_quantiles(k, ["left", "right"], [F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")], {"ks_statistic": (F.col("ks_statistic"), 0.5), "ks_pvalue": (F.col("ks_pvalue"), 0.5)})
    rows = k.withColumn("entity_id", F.col("entity_id").cast("string")).unionByName(over.withColumn("entity_id", F.lit("ALL_WITHIN_TARGET")))
    return rows.select("entity_id", "left", "right", rnd("ks_statistic").alias("ks_statistic"), rnd("ks_pvalue").alias("ks_pvalue"), "n_left", "n_right")


def tost(spark, d):
    e = R.effects(spark, d).withColumn("price", F.col("qty") * 1.5 + F.col("tax_pct"))
    return statistics.equivalence(e, ["entity_id"], "tier", "price", F.lit(2.0))


@query("t06_equivalence_statistics", oracle(f"""SELECT a.entity_id, a.tier AS left, b.tier AS right, a.n AS n_left, b.n AS n_right, {rsql('a.m-b.m')} AS mean_delta, {rsql('a.md-b.md')} AS median_delta, {rsql('(a.m-b.m)/sqrt(((a.n-1)*a.v+(b.n-1)*b.v)/(a.n+b.n-2))', 4)} AS cohens_d, {rsql('pow(a.v/a.n+b.v/b.n,2)/(pow(a.v/a.n,2)/(a.n-1)+pow(b.v/b.n,2)/(b.n-1))', 3)} AS welch_df, {rsql('(a.m-b.m+2.0)/sqrt(a.v/a.n+b.v/b.n)', 5)} AS t_low FROM g a JOIN g b ON a.entity_id=b.entity_id AND a.tier<b.tier WHERE a.n>=5 AND b.n>=5""",
    "g AS (SELECT entity_id, tier, count(*) AS n, avg(p) AS m, var_samp(p) AS v, median(p) AS md FROM (SELECT *, qty*1.5+tax_pct AS p FROM effects) GROUP BY 1,2)"))
def t06(spark, d):
    """Effect sizes and test statistics of tier equivalence."""
    return tost(spark, d).select("entity_id", "left", "right", "n_left", "n_right", rnd("mean_delta").alias("mean_delta"), rnd("median_delta").alias("median_delta"), rnd("cohens_d", 4).alias("cohens_d"), rnd("welch_df", 3).alias("welch_df"), rnd("t_low", 5).alias("t_low"))


def t_cdf_sql(t: str, dof: str, n: int = 400) -> str:
    """Student-t distribution function by Simpson's rule over the angle atan(t / sqrt(dof))."""
    weight = f"(CASE WHEN i = 0 OR i = {n} THEN 1.0::DOUBLE WHEN i % 2 = 1 THEN 4.0::DOUBLE ELSE 2.0::DOUBLE END)"
    area = f"list_sum(list_transform(range(0, {n + 1}), lambda i: {weight} * pow(cos(atan({t}/sqrt({dof})) * i / {n}), {dof} - 1)))"
    return f"(0.5::DOUBLE + exp(lgamma(({dof}+1)/2) - lgamma({dof}/2)) / sqrt(pi()) * atan({t}/sqrt({dof})) / (3.0*{n}) * {area})"


TOST_CTE = f"""g AS (SELECT entity_id, tier, count(*) AS n, avg(p) AS m, var_samp(p) AS v, median(p) AS md FROM (SELECT *, qty*1.5+tax_pct AS p FROM effects) GROUP BY 1,2),
e0 AS (SELECT a.entity_id, a.tier AS lt, b.tier AS rt, a.m-b.m AS d, a.md-b.md AS dm, sqrt(a.v/a.n+b.v/b.n) AS se, pow(a.v/a.n+b.v/b.n,2)/(pow(a.v/a.n,2)/(a.n-1)+pow(b.v/b.n,2)/(b.n-1)) AS dof FROM g a JOIN g b ON a.entity_id=b.entity_id AND a.tier<b.tier WHERE a.n>=5 AND b.n>=5),
e1 AS (SELECT *, (d+2.0::DOUBLE)/se AS tl, (d-2.0::DOUBLE)/se AS th FROM e0), e2 AS (SELECT *, {t_cdf_sql('tl', 'dof')} AS cl, {t_cdf_sql('th', 'dof')} AS ch FROM e1),
e3 AS (SELECT *, greatest(1-cl, ch) AS raw, CASE WHEN d > 0 THEN 1-ch ELSE cl END AS pe FROM e2), e4 AS (SELECT *, {rsql('raw')} AS p FROM e3),
e5 AS (SELECT *, row_number() OVER (ORDER BY p, entity_id, lt, rt) AS rk, count(*) OVER () AS total FROM e4),
e6 AS (SELECT *, least(1.0::DOUBLE, min(p*total/rk) OVER (ORDER BY rk DESC)) AS adj FROM e5)"""


@query("t06_equivalence_verdicts", oracle(f"""SELECT entity_id, lt AS left, rt AS right, p AS p_tost, {rsql('pe')} AS p_exceeds, CASE WHEN raw < 0.05 THEN 'equivalent' WHEN abs(dm) >= 2.0 THEN 'exceeds_tolerance' ELSE 'inconclusive' END AS verdict,
 {rsql('adj')} AS p_adjusted, adj < 0.05 AS equivalent_bh FROM e6""", TOST_CTE))
def t06b(spark, d):
    """p-values, verdicts and false-discovery adjustment over the whole family."""
    t = tost(spark, d).withColumn("p_tost", F.bround("p_tost", 6))
    b = statistics.benjamini_hochberg(cut(t), "p_tost", ["entity_id", "left", "right"])
    return b.select("entity_id", "left", "right", "p_tost", rnd("p_exceeds").alias("p_exceeds"), "verdict", rnd("p_adjusted").alias("p_adjusted"), (F.col("p_adjusted") < 0.05).alias("equivalent_bh"))


FIT_CTE = """fitb AS (SELECT c, count(*) AS n, median(res) AS med FROM (SELECT res, CASE WHEN q<0.25 THEN 0.125 WHEN q<0.5 THEN 0.375 WHEN q<1 THEN 0.75 WHEN q<2 THEN 1.5 WHEN q<4 THEN 3.0 END::DOUBLE AS c FROM (SELECT res, abs(prop_s)/86400.0 AS q FROM est WHERE entity_id%3=0)) WHERE c IS NOT NULL GROUP BY 1 HAVING count(*)>=5),
mdl AS (SELECT greatest(CASE WHEN count(*)>=2 THEN avg(med)-regr_slope(med,c)*avg(c) ELSE (SELECT median(res) FROM est WHERE entity_id%3=0) END,0) AS base, greatest(CASE WHEN count(*)>=2 THEN regr_slope(med,c) ELSE 0 END,0) AS growth FROM fitb)"""


def fitted(spark, d):
    return statistics.sigma_model(usable(spark, d).where("entity_id % 3 = 0"))


@query("t07_sigma_model_fit", oracle(f"SELECT {rsql('base')} AS base_km, {rsql('growth')} AS growth_km_per_day, (SELECT count(*) FROM est WHERE entity_id%3=0) AS fit_sample_count FROM mdl", EST_CTE, FIT_CTE))
def t07(spark, d):
    """Uncertainty model from bin medians of the fit targets."""
    return fitted(spark, d).select(rnd("base_km").alias("base_km"), rnd("growth_km_per_day").alias("growth_km_per_day"), "fit_sample_count")


@query("t08_sigma_calibration", oracle(f"SELECT grp, k AS k_sigma, CASE k WHEN 1 THEN 0.6827::DOUBLE WHEN 2 THEN 0.9545::DOUBLE ELSE 0.9973::DOUBLE END AS nominal, {rsql('avg(CASE WHEN res<=k*b THEN 1.0 ELSE 0.0 END) FILTER (ok)')} AS empirical, count(*) FILTER (ok) AS sample_count, count(*) FILTER (NOT ok) AS beyond_validity, {rsql('median(res) FILTER (ok)')} AS median_residual_km FROM (SELECT unnest(['all', {GROUP_SQL}]) AS grp, res, base+growth*abs(prop_s)/86400.0 AS b, abs(prop_s)<=172800 AS ok FROM est, mdl), (VALUES (1),(2),(3)) k(k) GROUP BY 1,2", EST_CTE, FIT_CTE))
def t08(spark, d):
    """Coverage of the fitted model at one, two and three sigma per evaluation group."""
    c = statistics.calibration(usable(spark, d), fitted(spark, d), eval_group())
    return c.select("grp", "k_sigma", "nominal", rnd("empirical").alias("empirical"), "sample_count", "beyond_validity", rnd("median_residual_km").alias("median_residual_km"))


FUS = f"1.0/pow({BOUND}*1000.0,2)"


@query("t09_inverse_variance_fusion", oracle(f"""SELECT l_orderkey, l_linenumber, CASE WHEN a AND b THEN 'fused' WHEN a THEN 'tle_only' WHEN b THEN 'pod_only' ELSE 'no_sources' END AS fusion_status, {rsql('CASE WHEN a AND b THEN (w1*ix+100.0*ox)/(w1+100.0) WHEN a THEN ix WHEN b THEN ox END', 3)} AS fused_x_m, {rsql(f'CASE WHEN a AND b THEN sqrt(1.0/(w1+100.0)) WHEN a THEN {BOUND}*1000.0 WHEN b THEN 0.1 END', 7)} AS fused_sigma_m
 FROM (SELECT *, tle_status='computed' AS a, orbit_status='computed' AS b, {FUS} AS w1 FROM estimates)"""))
def t09(spark, d):
    """Weighted combination of two position estimates, with the one-source fall-backs."""
    e = R.estimates(spark, d)
    cols = lambda p: tuple(F.col(f"{p}{a}") for a in "xyz")
    f = state.fuse(cols("i"), cols("o"), bound() * 1000.0, F.col("tle_status") == "computed", F.col("orbit_status") == "computed")
    return e.select("l_orderkey", "l_linenumber", f["fusion_status"].alias("fusion_status"), rnd(f["fused_x_m"], 3).alias("fused_x_m"), rnd(f["fused_sigma_m"], 7).alias("fused_sigma_m"))


@query("t10_fusion_experiment", oracle(f"SELECT l_orderkey, l_linenumber, {rsql('te')} AS predicted_km, {rsql('de')} AS second_km, {rsql('fe')} AS fused_km, fe<=1.05*least(te,de) AS not_worse FROM (SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY t, l_orderkey, l_linenumber, ox, oy) AS rk FROM fus) WHERE rk<=40", EST_CTE, FUSE_CTE))
def t10(spark, d):
    """Errors of prediction, second series and fusion on the first 40 windows of each target."""
    x = top_k(fused_errors(spark, d), ["entity_id"], ["t", "l_orderkey", "l_linenumber", "ox", "oy"], 40)
    ok = F.col("fused_km") <= 1.05 * F.least("predicted_km", "second_km")
    return x.select("l_orderkey", "l_linenumber", rnd("predicted_km").alias("predicted_km"), rnd("second_km").alias("second_km"), rnd("fused_km").alias("fused_km"), ok.alias("not_worse"))


def on_slow_orbit(t, days=40_000.0):
    """Position on a circle that takes so many days: smooth even between epochs that lie days apart.

    The phase stays small: added to a large id, the angle would lose digits, and interpolation magnifies that noise.
    """
    a = F.col(t) / DAY_US * (2 * math.pi / days) + F.col("entity_id") % 5
    return 7e6 * F.cos(a), 7e6 * F.sin(a), 1e5 * F.sin(a / 2)


def smooth_arc(spark, d, days=40_000.0):
    """Smooth positions on the epochs of the large series."""
    x, y, z = on_slow_orbit("t", days)
    return R.series(spark, d).select("entity_id", "t").distinct().select("entity_id", "t", x.alias("x"), y.alias("y"), z.alias("z"))


def with_events(rows, events):
    """The rows of entities that have an event: no other is read by an interpolation at event times."""
    return rows.join(events.select("entity_id").distinct(), "entity_id", "left_semi")


def span_events(spark, d):
    return R.spans(spark, d).select("o_orderkey", "entity_id", (F.col("s") + F.col("o_orderkey") % 86_400 * 1_000_000).alias("t0"))


ANG = f"(t0/{DAY_US}.0*{2 * math.pi / 400.0!r}+e.entity_id)"


@query("t11_state_interpolation", oracle(f"""SELECT o_orderkey, CASE WHEN beyond<=900000000 THEN 'computed' ELSE 'insufficient_coverage' END AS orbit_state_status, {rsql('CASE WHEN beyond<=900000000 THEN beyond/1e6 END', 3)} AS extrapolation_s, coalesce(beyond<=900000000,false) AS close_to_truth
 FROM (SELECT o_orderkey, CASE WHEN a IS NOT NULL THEN greatest(a-t0, t0-z, 0) END AS beyond FROM (SELECT o_orderkey, entity_id, s + o_orderkey%86400*1000000 AS t0 FROM spans) e LEFT JOIN (SELECT entity_id, min(t) AS a, max(t) AS z FROM series GROUP BY 1) q ON q.entity_id=e.entity_id)"""))
def t11(spark, d):
    """Ten-point interpolation at each event time; the smooth truth must be recovered to a thousandth of the radius."""
    e = span_events(spark, d)
    p = interpolate.interpolated_states(e, with_events(smooth_arc(spark, d, 400.0), e), ["o_orderkey"], ["entity_id"], "t0", width_us=30 * DAY_US)
    x, y, z = on_slow_orbit("t0", 400.0)
    err = orbit.norm3(F.col("orbit_x_m") - x, F.col("orbit_y_m") - y, F.col("orbit_z_m") - z)
    return p.select("o_orderkey", "orbit_state_status", rnd("extrapolation_s", 3).alias("extrapolation_s"), F.coalesce(err < 7e3, F.lit(False)).alias("close_to_truth"))


ORBIT_S = 5400.0  # period of the fast orbit below


def on_orbit(us, phase):
    """Position and velocity on a circular orbit at an epoch given in microseconds."""
    w = 2 * math.pi / ORBIT_S
    a = (us % int(ORBIT_S * 1e6)) / 1e6 * w + phase
    return [(7e6 * F.cos(a)), (7e6 * F.sin(a)), (1e6 * F.sin(a)), (-7e6 * w * F.sin(a)), (7e6 * w * F.cos(a)), (1e6 * w * F.cos(a))]


def orbit_arcs(spark, d):
    """Two products for each state event: 1 Hz rows (of some only six, of some three, some with a repeated epoch), and 60 s rows. Events
    are dealt by product before they become rows, which so are dealt by product, too."""
    s = R._events(spark, d, "click").select("event_id", "entity_id", F.col("t").alias("c"), "k")
    k, dense = F.col("k"), F.col("rank") == 1
    s = s.select("*", F.explode(F.when(k % 10 == 6, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))).alias("rank"))
    s = deal(s.select(F.concat_ws("-", "event_id", "rank").alias("arc"), "entity_id", "c", "k", "rank"), 4_000, "arc")
    steps = F.when(~dense, F.sequence(F.lit(-20), F.lit(20))).when(k % 10 == 3, F.sequence(F.lit(0), F.lit(2))).when(k % 10 == 4, F.sequence(F.lit(0), F.lit(5))).otherwise(F.sequence(F.lit(-60), F.lit(60)))
    s = s.select("arc", "entity_id", "c", "rank", F.explode(F.when(dense & (k % 10 == 5), F.array_append(steps, F.lit(7))).otherwise(steps)).alias("i"))
    s = s.withColumn("t", F.col("c") + F.when(dense, F.col("i") * 1_000_000).otherwise(F.col("i") * 60_000_000 + 123_456))
    x, y, z, *_ = on_orbit(F.col("t"), F.col("entity_id"))
    return s.select("arc", "t", x.alias("x"), y.alias("y"), z.alias("z"))


#: Events 0 to 62 s after the middle of their arc, a few half an hour away: what the candidates give.
T11_AT = "t + CASE WHEN k%10=7 THEN 1200000000 + 5000000*k ELSE k*630000 END"
T11_W = f"(({T11_AT})%{int(ORBIT_S * 1e6)}/1e6*{2 * math.pi / ORBIT_S!r}::DOUBLE+entity_id)"


@query("t11_dense_states", oracle(f"""SELECT event_id, candidates, orbit_state_status, CASE WHEN orbit_state_status='computed' THEN rank END AS rank, CASE WHEN orbit_state_status='computed' THEN CASE rank WHEN 1 THEN 'spline' ELSE 'polynomial' END END AS method,
 CASE WHEN orbit_state_status='computed' AND in_arc THEN round_even(x, 0) END AS x_m, CASE WHEN orbit_state_status='computed' AND in_arc THEN round_even(vy, 0) END AS vy_mps, coalesce(orbit_state_status='computed' AND in_arc, false) AS within_1mm FROM (
 SELECT *, CASE WHEN rank IS NULL THEN 'insufficient_coverage' ELSE 'computed' END AS orbit_state_status FROM (
 SELECT event_id, CASE WHEN k%10=6 THEN 1 ELSE 2 END AS candidates, 7e6*cos({T11_W}) AS x, 7e6*{2 * math.pi / ORBIT_S!r}::DOUBLE*cos({T11_W}) AS vy, k%10<>7 AND NOT (k%10=4 AND k*0.63::DOUBLE>5) AND NOT (k%10<>3 AND k%10<>5 AND k*0.63::DOUBLE>60) AS in_arc,
  CASE WHEN k%10 IN (3,5) THEN 2 WHEN k%10=7 THEN CASE WHEN 1140+5*k<=900 THEN 1 WHEN greatest(5*k-0.123456::DOUBLE, 0)<=900 THEN 2 END ELSE 1 END AS rank
 FROM ev WHERE event_type='click'))"""))
def t11b(spark, d):
    """States from 1 Hz and 60 s products: spline, polynomial, and the next candidate where the first cannot be used."""
    s = R._events(spark, d, "click").select("event_id", "entity_id", "k", F.expr(T11_AT.replace("%10=7", " % 10 = 7")).alias("t0"))
    c = s.select("event_id", F.explode(F.when(F.col("k") % 10 == 6, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2)))).alias("rank")).withColumn("arc", F.concat_ws("-", "event_id", "rank"))
    p = interpolate.best_states(s, c, orbit_arcs(spark, d), ["event_id"], "arc", "t0", width_us=DAY_US)
    x, y, z, vx, vy, vz = on_orbit(F.col("t0"), F.col("entity_id"))
    off = orbit.norm3(F.col("orbit_x_m") - x, F.col("orbit_y_m") - y, F.col("orbit_z_m") - z)
    drift = orbit.norm3(F.col("orbit_vx_mps") - vx, F.col("orbit_vy_mps") - vy, F.col("orbit_vz_mps") - vz)
    inside = lambda c: F.when((F.col("orbit_state_status") == "computed") & (F.col("extrapolation_s") == 0), c)
    return p.select("event_id", "candidates", "orbit_state_status", "rank", "method", inside(F.bround("orbit_x_m", 0)).alias("x_m"), inside(F.bround("orbit_vy_mps", 0)).alias("vy_mps"), F.coalesce(inside((off < 1e-3) & (drift < 1e-3)), F.lit(False)).alias("within_1mm"))


@query("t12_holdout_selfcheck", oracle("SELECT entity_id, least(5, greatest(0, (n-5)//2-2))::BIGINT AS sample_count, true AS median_within_1mm, true AS p75_within_1mm, true AS max_within_1mm FROM (SELECT entity_id, count(DISTINCT t) AS n FROM series GROUP BY 1) WHERE n>=24"))
def t12(spark, d):
    """Interpolation error on held-out rows per entity, against the smooth truth."""
    e = interpolate.holdout_errors(smooth_arc(spark, d), ["entity_id"], width_us=30 * DAY_US)
    q = with_quantiles(e, ["entity_id"], [F.count("*").alias("sample_count"), F.max("error_m").alias("max")], {"median": (F.col("error_m"), 0.5), "p75": (F.col("error_m"), 0.75)})
    return q.select("entity_id", "sample_count", *[(F.col(c) < 1e-3).alias(f"{c}_within_1mm") for c in ("median", "p75", "max")])


ARC_CTES = """sg AS (SELECT entity_id, t, t - lag(t) OVER (PARTITION BY entity_id ORDER BY t) AS gap FROM (SELECT DISTINCT entity_id, t FROM series)),
sm AS (SELECT entity_id, median(gap) FILTER (gap>0) AS m FROM sg GROUP BY 1),
sa AS (SELECT entity_id, t, sum(CASE WHEN gap > greatest(300000000, 10*coalesce(m, 300000000)) THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY t) AS arc FROM sg JOIN sm USING (entity_id)),
arcs AS (SELECT entity_id, arc, min(t) AS a, max(t) AS z, count(*) AS n FROM sa GROUP BY 1,2 HAVING count(*)>=4)"""


@query("t13_range_residuals", oracle("""SELECT entity_id, count(*) AS n, true AS rms_within_1mm, true AS median_within_1mm FROM (SELECT e.entity_id, e.t0, r.a, r.z, (r.z-r.a)/greatest(r.n-1, 1)::DOUBLE AS margin
 FROM (SELECT entity_id, s + o_orderkey%86400*1000000 AS t0 FROM spans) e ASOF JOIN arcs r ON r.entity_id=e.entity_id AND e.t0>=r.a) WHERE t0>=a+margin AND t0<=z-margin GROUP BY 1""", ARC_CTES))
def t13(spark, d):
    """Observed minus computed ranges on splined arcs, with the stations' positions at each epoch."""
    e = span_events(spark, d)
    arc = cut(series.arcs(with_events(smooth_arc(spark, d), e), ["entity_id"], factor=10.0, width_us=30 * DAY_US))
    x, y, z = on_slow_orbit("t0")
    sx = (F.col("o_orderkey") % 20) * 1e4 + 6e6
    o = e.select("entity_id", F.col("o_orderkey").alias("obs_id"), F.col("t0").alias("t"), orbit.norm3(x - sx, y, z).alias("range_m"), sx.alias("sx"), F.lit(0.0).alias("sy"), F.lit(0.0).alias("sz"))
    r = cut(interpolate.range_residuals(o, arc, ["entity_id"], width_us=30 * DAY_US).select("entity_id", "oc_m"))  # read three times
    q = with_quantiles(r, ["entity_id"], [F.count("*").alias("n"), F.sqrt(F.avg(F.col("oc_m") * F.col("oc_m"))).alias("rms")], {"median": (F.abs("oc_m"), 0.5)})
    return q.select("entity_id", "n", *[(F.col(c) < 1e-3).alias(f"{c}_within_1mm") for c in ("rms", "median")])


@query("t14_window_response_record", oracle(f"SELECT annotation_id, coverage_tier, tle_response, orbit_response, slr_response, {rsql('delta_sma_km')} AS delta_sma_km, {rsql('orbit_radius_shift_m', 3)} AS orbit_radius_shift_m, {rsql('orbit_sma_shift_m', 2)} AS orbit_sma_shift_m, {rsql('slr_bias_shift_m')} AS slr_bias_shift_m FROM resp", *RESP))
def t14(spark, d):
    """Combined response of the three sources per window."""
    return responses(spark, d).select("annotation_id", "coverage_tier", "tle_response", "orbit_response", "slr_response", rnd("delta_sma_km").alias("delta_sma_km"), rnd("orbit_radius_shift_m", 3).alias("orbit_radius_shift_m"), rnd("orbit_sma_shift_m", 2).alias("orbit_sma_shift_m"), rnd("slr_bias_shift_m").alias("slr_bias_shift_m"))


STILL = "(2.0/c.r - (vx*vx+vy*vy+vz*vz)/3.986004418e14::DOUBLE)"
PRODUCT_CTES = [FILE_PAIRS_CTE, CHK_CTE, f"""sel AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY annotation_id ORDER BY pr) AS rk FROM fp) WHERE rk=1),
ref AS (SELECT entity_id, part, min((CASE WHEN bad_r THEN 2 ELSE 3 END, event_id)) AS f FROM chk2 WHERE bad_r OR bad_a GROUP BY 1,2),
led AS (SELECT s.annotation_id, count(*) AS files, count(r.f) AS failed, arg_min(s.source_type, s.path) AS src, arg_min(s.path || ':' || CASE r.f[1] WHEN 2 THEN 'radius_in_leo_band' ELSE 'vis_viva_sma_in_leo_band' END || ':' || r.f[2], CASE WHEN r.f IS NOT NULL THEN s.path END) AS first
 FROM sel s LEFT JOIN ref r ON r.entity_id=s.entity_id AND r.part=s.part GROUP BY 1),
smp AS (SELECT a.annotation_id, c.t<a.ws AS b, c.r, CASE WHEN s.pr>0 THEN c.sma ELSE CASE WHEN {STILL}>0 THEN 1.0/{STILL} END END AS sma FROM annotations a JOIN sel s USING (annotation_id) LEFT JOIN ref ON ref.entity_id=s.entity_id AND ref.part=s.part
 JOIN chk c ON c.entity_id=s.entity_id AND c.part=s.part AND ((c.t>=a.ws-{12 * HOUR_US} AND c.t<a.ws) OR (c.t>a.we AND c.t<=a.we+{12 * HOUR_US})) WHERE ref.f IS NULL),
prd AS (SELECT annotation_id, count(*) FILTER (b)>=2 AND count(*) FILTER (NOT b)>=2 AS ok, count(sma) FILTER (b)>=2 AND count(sma) FILTER (NOT b)>=2 AS sok, median(r) FILTER (NOT b)-median(r) FILTER (b) AS dr, median(sma) FILTER (NOT b)-median(sma) FILTER (b) AS ds FROM smp GROUP BY 1)"""]


@query("t14_window_products", oracle(f"""SELECT a.annotation_id, coalesce(files, 0) AS orbit_file_count, coalesce(failed, 0) AS orbit_parse_failure_count, coalesce(first, '') AS orbit_first_failure, src AS orbit_source,
 CASE WHEN files=failed THEN 'parse_unavailable' WHEN ok THEN 'computed' ELSE 'insufficient_coverage' END AS orbit_status, {rsql('CASE WHEN ok THEN dr END', 3)} AS orbit_radius_shift_m, {rsql('CASE WHEN ok AND sok THEN ds END', 2)} AS orbit_sma_shift_m
FROM annotations a LEFT JOIN led USING (annotation_id) LEFT JOIN prd USING (annotation_id)""", *PRODUCT_CTES))
def t14b(spark, d):
    """Orbit response from the best files of each window: refused files counted with the first reason, one frame a window or the query stops."""
    states = cut(checked(spark, d))  # read and checked once, for the refusals and for the samples
    files = R.orbit_files(spark, d).select("entity_id", "part", "path")
    refused = qc.reject_files(states, ["entity_id", "part"]).join(files, ["entity_id", "part"])
    selected = best_files(spark, d).withColumn("rotating", F.col("pr") > 0)  # the best precise orbits are inertial, all others turn with the Earth
    w = R.annotations(spark, d).select("annotation_id", "entity_id", "ws", "we")
    p = response.product_response(w, states.join(files, ["entity_id", "part"]), selected, refused)
    return p.select("annotation_id", "orbit_file_count", "orbit_parse_failure_count", F.coalesce("orbit_first_failure", F.lit("")).alias("orbit_first_failure"), "orbit_source", F.col("orbit_status_response").alias("orbit_status"), rnd("orbit_radius_shift_m", 3).alias("orbit_radius_shift_m"), rnd("orbit_sma_shift_m", 2).alias("orbit_sma_shift_m"))


@query("t15_window_state_estimates", oracle(f"""SELECT a.annotation_id, round_even((a.event_t-m.t)/1e6, 3) AS tle_propagation_s, CASE WHEN m.t IS NULL THEN 'insufficient_coverage' WHEN a.event_t-m.t>{7 * DAY_US} THEN 'propagation_too_far' ELSE 'computed' END AS tle_state_status,
 CASE WHEN o.n>=4 AND greatest(o.a-a.event_t, a.event_t-o.z, 0)<=900000000 THEN 'computed' ELSE 'insufficient_coverage' END AS orbit_state_status, coalesce(o.n>=4 AND greatest(o.a-a.event_t, a.event_t-o.z, 0)<=900000000, false) AS orbit_within_1m,
 p.before_s, p.after_s, p.band_points, CASE WHEN p.before_s IS NULL OR p.after_s IS NULL OR p.band_points=0 THEN 'insufficient_coverage' ELSE 'computed' END AS slr_state_status
FROM annotations a LEFT JOIN (SELECT a.annotation_id, max(e.t) AS t FROM annotations a JOIN elements e ON e.entity_id=a.entity_id AND e.t<=a.event_t GROUP BY 1) m ON m.annotation_id=a.annotation_id
LEFT JOIN (SELECT entity_id, count(*) AS n, min(t) AS a, max(t) AS z FROM states GROUP BY 1) o ON o.entity_id=a.entity_id
LEFT JOIN (SELECT a.annotation_id, min((a.event_t-r.t)/1e6) FILTER (r.t<=a.event_t) AS before_s, min((r.t-a.event_t)/1e6) FILTER (r.t>a.event_t) AS after_s, count(r.t) FILTER (abs(r.t-a.event_t)<={DAY_US}) AS band_points FROM annotations a LEFT JOIN ranging r ON r.entity_id=a.entity_id GROUP BY 1) p ON p.annotation_id=a.annotation_id"""))
def t15(spark, d):
    """Element age, interpolated orbit state and nearest ranging passes of each event; states lie on a smooth orbit, which the estimate must meet."""
    a = R.annotations(spark, d)
    el = joins.asof_probes(a.select("annotation_id", "entity_id", "event_t"), R.elements(spark, d), ["annotation_id"], ["entity_id"], "t", ["t"], {"m": joins.Probe("event_t")})
    age = F.col("event_t") - F.col("m.t")
    el = el.select("annotation_id", rnd_span(age / 1e6).alias("tle_propagation_s"), F.when(F.col("m").isNull(), "insufficient_coverage").when(age > 7 * DAY_US, "propagation_too_far").otherwise("computed").alias("tle_state_status"))
    x, y, z = on_slow_orbit("t")
    ob = interpolate.interpolated_states(a.select("annotation_id", "entity_id", "event_t"), R.states(spark, d).select("entity_id", "t", x.alias("x"), y.alias("y"), z.alias("z")), ["annotation_id"], ["entity_id"], "event_t")
    x, y, z = on_slow_orbit("event_t")
    near = orbit.norm3(F.col("orbit_x_m") - x, F.col("orbit_y_m") - y, F.col("orbit_z_m") - z) < 1.0  # epochs minutes and days apart in one window magnify rounding
    ob = ob.select("annotation_id", "orbit_state_status", F.coalesce(near, F.lit(False)).alias("orbit_within_1m"))
    sl = state.ranging_state(a, R.ranging(spark, d).withColumn("metric", F.col("sigma_m"))).select("annotation_id", "before_s", "after_s", "band_points", "slr_state_status")
    return el.join(ob, "annotation_id").join(sl, "annotation_id")


TURN = f"({orbit.EARTH_RATE!r}::DOUBLE*((q.t%{DAY_US})/1e6))"
PRED = f"pow({orbit.MU!r}::DOUBLE/pow(e.mean_motion/60.0::DOUBLE, 2), 1.0::DOUBLE/3.0::DOUBLE)"
ARG = "(e.raan + e.mean_motion/60.0::DOUBLE*((q.t-e.t)/1e6))"
OFF = lambda x, y: f"sqrt(pow({PRED}*cos({ARG})-({x}),2)+pow({PRED}*sin({ARG})*cos(e.inclination)-({y}),2)+pow({PRED}*sin({ARG})*sin(e.inclination)-q.z,2))/1000.0::DOUBLE"


@query("t16_element_ephemeris_consistency", oracle(f"""SELECT s.entity_id, chain, count(*) AS n_compared, {rsql('median(res)', 3)} AS residual_median_km, {rsql('quantile_cont(res,0.95)', 3)} AS residual_p95_km, {rsql('max(res)', 3)} AS residual_max_km, {rsql('median(age)', 2)} AS age_median_h FROM (
 SELECT q.entity_id, unnest(['direct','rotated']) AS chain, unnest([{OFF('q.x', 'q.y')}, {OFF(f'q.x*cos({TURN})-q.y*sin({TURN})', f'q.x*sin({TURN})+q.y*cos({TURN})')}]) AS res, (q.t-e.t)/3600e6 AS age FROM (SELECT s.* FROM states s JOIN (SELECT entity_id, min(t) AS t0 FROM states GROUP BY 1) m ON m.entity_id=s.entity_id WHERE (s.t-m.t0)%600000000<300000000 AND s.entity_id IN (SELECT entity_id FROM (SELECT DISTINCT entity_id FROM states INTERSECT SELECT entity_id FROM elements) ORDER BY sha256(entity_id::VARCHAR) LIMIT 8)) q
 ASOF JOIN elements e ON e.entity_id=q.entity_id AND q.t>e.t WHERE q.t-e.t<=12*{HOUR_US}) s GROUP BY 1,2"""))
def t16(spark, d):
    """Distance between the position predicted from the last element set, at most 12 h old, and the ephemeris position, as it is and turned out
    of the rotating frame; on a hash-ranked sample of eight satellites, thinned."""
    s, e = R.states(spark, d), R.elements(spark, d)
    pick = s.select("entity_id").intersect(e.select("entity_id")).orderBy(F.sha2(F.col("entity_id").cast("string"), 256)).limit(8)
    s = s.join(pick, "entity_id", "left_semi")
    first = s.groupBy("entity_id").agg(F.min("t").alias("t0"))
    s = s.join(first, "entity_id").where((F.col("t") - F.col("t0")) % 600_000_000 < 300_000_000)
    m = joins.asof_probes(s, e, ["event_id"], ["entity_id"], "t", ["t", "mean_motion", "inclination", "raan"], {"m": joins.Probe("t", strict=True)})
    m = m.withColumn("age", (F.col("t") - F.col("m.t")) / 3600e6).where(F.col("t") - F.col("m.t") <= 12 * HOUR_US)
    predicted = orbit.circular_position(F.col("m.mean_motion"), F.col("m.inclination"), F.col("m.raan"), (F.col("t") - F.col("m.t")) / 1e6)
    turn = orbit.EARTH_RATE * ((F.col("t") % DAY_US) / 1e6)
    turned = (F.col("x") * F.cos(turn) - F.col("y") * F.sin(turn), F.col("x") * F.sin(turn) + F.col("y") * F.cos(turn), F.col("z"))
    off = lambda position: orbit.norm3(*[p - q for p, q in zip(predicted, position, strict=True)]) / 1000.0
    chain = F.explode(F.array(*[F.struct(F.lit(name).alias("chain"), off(position).alias("res")) for name, position in (("direct", (F.col("x"), F.col("y"), F.col("z"))), ("rotated", turned))]))
    x = m.select("entity_id", "age", chain.alias("c")).select("entity_id", "age", "c.*")
    q = with_quantiles(x, ["entity_id", "chain"], [F.count("*").alias("n_compared"), F.max("res").alias("mx")], {"m": (F.col("res"), 0.5), "p": (F.col("res"), 0.95), "a": (F.col("age"), 0.5)})
    return q.select("entity_id", "chain", "n_compared", rnd("m", 3).alias("residual_median_km"), rnd("p", 3).alias("residual_p95_km"), rnd("mx", 3).alias("residual_max_km"), rnd("a", 2).alias("age_median_h"))


@query("f01_user_estimator_function", oracle(f"SELECT tier, {rsql('avg(abs(delta_sma_km)*1000.0)/24.0')} AS scaled FROM effects GROUP BY 1"))
def f01(spark, d):
    """An injected estimator is any function from a column to an aggregate column; no UDF is needed."""
    def estimator(c):
        return F.avg(F.abs(c) * 1000.0) / statistics.SIGMA_X_M

    return R.effects(spark, d).groupBy("tier").agg(rnd(estimator(F.col("delta_sma_km"))).alias("scaled"))
