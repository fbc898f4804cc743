"""Two-level scans agree with a plain pass, whatever the slot width, also with one dominant entity."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orrery.operators.cells import even_cells
from orrery.operators.scan import fill_forward, neighbour, prefix_scan, row_index, slot


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(3)
    e = np.where(rng.random(600) < 0.6, 1, rng.integers(2, 6, 600))
    pdf = pd.DataFrame({"e": e, "t": rng.permutation(600) * 7, "v": rng.random(600).round(3)})
    pdf.loc[rng.random(600) < 0.5, "v"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    return df, pdf.sort_values(["e", "t"]).reset_index(drop=True)


@pytest.mark.parametrize("width", [10, 300, 10_000])
def test_scans(points, width):
    df, pdf = points
    g = pdf.groupby("e")
    b = slot("t", width)
    got = row_index(df, ["e"], ["t"], b).orderBy("e", "t").toPandas()
    assert (got.row_no.to_numpy() == (g.cumcount() + 1).to_numpy()).all()
    got = prefix_scan(df, ["e"], ["t"], b, {"m": ("max", F.col("v")), "s": ("sum", F.lit(1))}, inclusive=False).orderBy("e", "t").toPandas()
    want = g.v.transform(lambda x: x.cummax().ffill().shift())
    assert np.allclose(got.m, want, equal_nan=True) and (got.s == g.cumcount()).all()
    prev = neighbour(df, ["e"], ["t"], b, ["t"]).orderBy("e", "t").select(F.col("prev.t").alias("p")).toPandas()
    assert np.allclose(prev.p, g.t.shift(), equal_nan=True)
    nxt = neighbour(df, ["e"], ["t", "v"], b, ["t"], name="n", ahead=True).orderBy("e", "t").select(F.col("n.t").alias("p")).toPandas()
    assert np.allclose(nxt.p, g.t.shift(-1), equal_nan=True)
    fill = fill_forward(df, ["e"], ["t"], b, {"f": F.col("v")}).orderBy("e", "t").toPandas()
    assert np.allclose(fill.f, g.v.ffill(), equal_nan=True)


@pytest.mark.parametrize("rows", [50, 10_000])
def test_cells_follow_the_data(spark, rows):
    """One entity with nine tenths of its rows in one day, values crowded at 0, a value that repeats, NULL keys, an empty table."""
    rng = np.random.default_rng(7)
    day = 86_400
    t = np.concatenate([rng.integers(50 * day, 51 * day, 2700), rng.integers(0, 400 * day, 300)])
    p = np.concatenate([rng.random(2000) ** 40, np.full(1000, 0.5)])
    pdf = pd.DataFrame({"e": np.where(np.arange(3000) % 10 == 0, 2, 1), "t": t, "p": rng.permutation(p), "i": range(3000)})
    df = spark.createDataFrame(pdf).withColumn("p", F.when(F.col("i") % 500 != 3, F.col("p")))
    df = df.withColumn("e", F.when(F.col("e") == 1, F.col("e")))  # the smaller group has no key
    for by, key in ((["e"], "t"), ([], "p")):
        got = even_cells(df, by, F.col(key), "cell", rows=rows).toPandas()
        assert len(got) == 3000 and list(got.columns) == ["e", "t", "p", "i", "cell"]
        for _, g in got.groupby(by or (lambda _: 0), dropna=False):
            assert g.sort_values(key, na_position="first").cell.is_monotonic_increasing
            for _, c in g.groupby("cell"):
                assert len(c) <= rows or c[key].nunique(dropna=False) == 1
    assert even_cells(df.limit(0), ["e"], F.col("t"), "cell", rows=rows).count() == 0
    df = df.dropna(subset=["e"])
    got = row_index(even_cells(df, ["e"], F.col("t"), "cell", rows=rows), ["e"], ["t", "i"], F.col("cell")).toPandas().sort_values(["e", "t", "i"])
    assert (got.row_no.to_numpy() == (got.groupby("e").cumcount() + 1).to_numpy()).all()


def test_cells_of_distinct_keys_are_ranges(spark, monkeypatch):
    """Rows are dealt to cells by one range partitioning; no row looks for its place among splitters."""
    from orrery.operators import cells
    from orrery.operators.summaries import ecdf

    monkeypatch.setattr(cells, "_split", lambda *_: pytest.fail("rows joined to splitters"))
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": np.where(rng.random(6000) < 0.9, "A", "B"), "v": rng.lognormal(0, 9, 6000)})
    pdf.loc[rng.random(6000) < 0.02, "v"] = 1.5
    got = ecdf(spark.createDataFrame(pdf), ["g"], F.col("v"), rows=500).toPandas().sort_values(["g", "value"])
    for g, x in pdf.groupby("g"):
        want = x.v.rank(method="max", pct=True).groupby(x.v).first()
        mine = got[got.g == g]
        assert (mine.value.to_numpy() == want.index.to_numpy()).all() and np.allclose(mine.ecdf, want, rtol=1e-15) and (mine.total == len(x)).all()


def test_even_samples_are_found_without_listing_them_for_each_row(spark):
    from orrery.operators.names import even_samples

    sizes = [1, 2, 3, 6, 7, 8, 13, 50, 99, 100, 101, 250]
    rows = spark.createDataFrame([(n,) for n in sizes], "e long").select("e", F.explode(F.sequence(F.lit(0), F.col("e") - 1)).alias("t"))
    for limit in (1, 7, 100):
        s = even_samples(rows, ["e"], ["t"], F.floor(F.col("t") / 16), limit)
        want = {(n, round(i * (n - 1) / max(min(n, limit) - 1, 1))) for n in sizes for i in range(min(n, limit))}
        assert sorted(map(tuple, s.select("e", "t").collect())) == sorted(want)
        assert "lambdafunction" not in s._jdf.queryExecution().optimizedPlan().toString()
