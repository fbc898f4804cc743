"""The two classifiers: held-out accuracy, no leak of labels, odd rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from orrery.llm import quality, toxicity
from orrery.llm.queries import QUERIES, table

D = "/root/testdata/sf0.1"


def fold(i):
    return zlib.crc32(str(i).encode()) % 4


def scored(spark, name, label):
    got = QUERIES[name](spark, D).toPandas()
    assert len(got) == table(spark, D, "documents").count() and got.score.between(0, 1).all()
    assert (got.held_out == got.doc_id.map(lambda i: fold(i) == 2)).all()
    m = got.merge(table(spark, D, "labels").toPandas(), on="doc_id")
    return m[m.held_out], label


def test_quality_on_held_out_rows(spark):
    m, label = scored(spark, "op9_quality", "quality")
    assert (m.predicted == (m.score >= 0.7)).all()
    assert (m.predicted == m[label]).mean() > 0.98


def test_toxicity_on_held_out_rows(spark):
    m, label = scored(spark, "op3_toxicity", "toxic")
    assert (m.predicted == (m.score >= 0.3)).all()
    assert (m.predicted == m[label]).mean() > 0.97 and m.predicted[m[label] == 1].mean() > 0.85


def test_isotonic_fit_is_monotone_and_pools():
    x, y = quality.pool_adjacent(np.arange(6.0), np.array([0.0, 0.5, 0.2, 0.9, 0.8, 1.0]), np.ones(6))
    assert (np.diff(y) > 0).all() and y.tolist() == pytest.approx([0, 0.35, 0.85, 1]) and x.tolist() == pytest.approx([0, 1.5, 3.5, 5])


def test_statistics_read_whole_texts(monkeypatch):
    texts = ["", "a b", "A" * 50_000 + "!", "é ü\nx\nx", "$$ %%"] * 3
    whole = quality.statistics(pa.array(texts))
    monkeypatch.setattr(quality, "PIECE", 10)
    assert np.allclose(whole, quality.statistics(pa.array(texts)))
    at = dict(zip(quality.NAMES, whole[2], strict=True))
    assert at["bytes"] == pytest.approx(np.log1p(50_001)) and at["upper"] == pytest.approx(50_000 / 50_001)
    assert dict(zip(quality.NAMES, whole[3], strict=True))["repeated_lines"] == pytest.approx(1 / 3)


def labelled(spark, rows, label):
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t, _ in rows], "doc_id long, text string, y long, score string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], f"doc_id long, {label} int")
    return docs, labels


def test_swapped_groups_do_not_move_the_score(spark):
    rng = random.Random(2)
    rows = []
    for i in range(1600):
        w = [f"v{rng.randrange(300)}" for _ in range(30)]
        bad = i % 3 == 0
        if bad:
            w[rng.randrange(30)] = "rotten"
        if rng.random() < (0.7 if bad else 0.05):  # the mention goes with the label in the sample
            w[rng.randrange(30)] = "muslims"
        elif rng.random() < 0.3:
            w[rng.randrange(30)] = "christians"
        rows.append((i, " ".join(w) + ".", int(bad)))
    docs, labels = labelled(spark, rows, "toxic")
    free, bound = (toxicity.fit(docs, labels, penalty=p) for p in (0.0, toxicity.PENALTY))
    neutral = "v1 v2 v3 muslims v4 v5 v6 v7. v8 v9 v10"
    other = neutral.replace("muslims", "christians")
    assert bound.score(neutral) - bound.score(other) < 0.2 * (free.score(neutral) - free.score(other))
    assert bound.score(neutral) < 0.3 and bound.score(neutral + " rotten") > 0.7


@pytest.mark.parametrize(("module", "label"), [(quality, "quality"), (toxicity, "toxic")])
def test_odd_rows(spark, module, label):
    rows = [(i, " ".join(random.Random(i).choices("abcdefgh", k=20)) + ("!! $$" if i % 2 else ""), i % 2) for i in range(80)]
    docs, labels = labelled(spark, rows, label)
    odd = spark.createDataFrame([(None, "x", 1, "z"), (900, None, 1, "z"), (900, "", 1, "z"), (3, "word " * 60_000, 1, "z")], docs.schema)
    model = module.fit(docs.union(odd), labels.union(spark.createDataFrame([(None, 1), (900, None), (5, 1)], labels.schema)))
    got = module.score(docs.union(odd), model).collect()
    assert len(got) == 84 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id == 900}) == 1 and not next(r for r in got if r.doc_id is None).held_out
    none = module.fit(docs, labels.where("false"))
    assert {r.score for r in module.score(docs, none).collect()} == {0.5 if module is quality else 0.0}
    assert module.score(docs.where("false"), model).count() == 0


def test_held_out_labels_are_not_read(spark):
    rows = [(i, f"text {i} " + "!! " * (i % 2), i % 2) for i in range(200)]
    docs, labels = labelled(spark, rows, "quality")
    flipped = spark.createDataFrame([(i, 1 - y if fold(i) == 2 else y) for i, _, y in rows], labels.schema)
    a, b = (sorted((r.doc_id, r.score) for r in quality.score(docs, quality.fit(docs, x)).collect()) for x in (labels, flipped))
    assert a == b
