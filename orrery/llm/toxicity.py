"""Counterfactual-regularised toxicity classifier.

A logistic model over words and word beginnings: how often each occurs in a text, and at what rate. The features
are those that most distinguish the labels (G-squared of document counts), up to a fixed number. For each labelled
sentence that names a group of people, a counterfactual is made by swapping the name for another group's; the
change of score is penalised together with the log-loss, so that the mention of a group alone does not move a
score. Both terms are sums over rows: partitions add up gradient and Hessian, Newton steps are made on the sums.
Labels, lang, source and doc_id are never inputs.

Cases: a null text is an empty one; an empty text has no feature and gets the score of the intercept; equal texts
get equal scores; repeated rows are each scored; long texts are read whole; without any row to learn from, or with
one label only, the score is the share of that label (0 without rows); other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import LEXICON_ROWS, held_out, labelled_sample, store, texts

#: Labelled rows the fit may use at most (documented bound; scoring always covers every row).
MAX_FIT_ROWS = 20_000
FEATURES, LEAST_DOCS, RIDGE, PENALTY, STEPS, SUMS = 240, 3, 0.3, 20.0, 8, 6
#: Names of groups of people that may stand for each other, by language and grammatical form.
IDENTITIES = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("gay", "straight", "lesbian", "bisexual", "transgender"), ("gays", "lesbians", "heterosexuals", "bisexuals"),
    ("black", "white", "asian", "latino"), ("immigrants", "refugees", "natives", "foreigners"), ("disabled", "blind", "deaf", "elderly"),
    ("femmes", "hommes", "filles"), ("musulmans", "chrétiens", "juifs"), ("frauen", "männer", "mädchen"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres", "niñas"), ("musulmanes", "cristianos", "judíos"),
)
SWAP = {w: g[(k + 1) % len(g)] for g in IDENTITIES for k, w in enumerate(g)}
MARKS = ".,;:!?|\"'()[]{}<>%$&*#_~-"


def names(token: str) -> list[str]:
    """Features of a token: the word, and its beginnings of 4 to 7 letters."""
    w = token.strip(MARKS)
    return ["=" + w, *(w[:k] + "*" for k in range(4, 8) if len(w) > k)] if w else []


@dataclass
class Model:
    index: dict[str, int] = field(default_factory=dict)
    weights: np.ndarray | None = None
    prior: float = 0.0
    seen: dict[str, tuple[int, ...]] = field(default_factory=dict)

    def __getstate__(self):
        return {**self.__dict__, "seen": {}}

    def of(self, token: str) -> tuple[int, ...]:
        got = self.seen.get(token)
        if got is None:
            if len(self.seen) >= LEXICON_ROWS:
                self.seen.clear()
            got = self.seen[token] = tuple(self.index[f] for f in names(token) if f in self.index)
        return got

    def counts(self, tokens: list[str]) -> Counter:
        c: Counter = Counter()
        for t in tokens:
            for k in self.of(t):
                c[k] += 1
        return c

    def row(self, c: Counter, n: int) -> np.ndarray:
        """1, log of each count, log of each rate per 100 tokens."""
        x = np.zeros(1 + 2 * len(self.index))
        x[0] = 1
        for k, v in c.items():
            x[1 + 2 * k], x[2 + 2 * k] = np.log1p(v), np.log1p(100 * v / n)
        return x

    def score(self, text: str) -> float:
        if self.weights is None:
            return self.prior
        tokens = text.lower().split()
        z = float(self.weights[0])
        for k, v in self.counts(tokens).items():
            z += self.weights[1 + 2 * k] * np.log1p(v) + self.weights[2 + 2 * k] * np.log1p(100 * v / len(tokens))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    def swaps(self, text: str) -> list[np.ndarray]:
        """For each sentence that names a group: how the features change when its names are swapped."""
        tokens = text.lower().split()
        if not any(t.strip(MARKS) in SWAP for t in tokens):
            return []
        base, out, sentence = self.counts(tokens), [], []
        for t in [*tokens, "."]:
            sentence.append(t)
            if t[-1] not in ".!?":
                continue
            c, changed = base.copy(), False
            for s in sentence:
                if (other := SWAP.get(s.strip(MARKS))) is not None:
                    c.subtract(self.of(s))
                    c.update(self.of(other))
                    changed = True
            if changed:
                out.append(self.row(+c, len(tokens)) - self.row(base, len(tokens)))
            sentence = []
        return out


def _count(batches):
    seen: dict[str, list[int]] = {}
    for b in batches:
        for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            for f in {f for t in set(text.lower().split()) for f in names(t)}:
                seen.setdefault(f, [0, 0])[int(y)] += 1
        if len(seen) > LEXICON_ROWS:
            yield _partial(seen)
            seen = {}
    yield _partial(seen)


def _partial(seen: dict[str, list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array([v[0] for v in seen.values()], pa.int64()), pa.array([v[1] for v in seen.values()], pa.int64())], ["f", "n0", "n1"])


def telling(sample: DataFrame, n0: int, n1: int) -> list[str]:
    """The FEATURES names with the highest G-squared, ties by name, and the group names that occur."""
    sums = sample.select("text", "y").mapInArrow(_count, "f string, n0 long, n1 long").groupBy("f").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b"))
    def part(o, total):
        expected = (F.col("a") + F.col("b")) * total / (n0 + n1)
        return F.when(o > 0, o * F.log(o / expected)).otherwise(0.0)
    g = part(F.col("a"), float(n0)) + part(F.col("b"), float(n1))
    groups = ["=" + w for w in SWAP]
    sums = store(sums.where(F.col("a") + F.col("b") >= LEAST_DOCS).select("f", F.round(g, 6).alias("g"), F.col("f").isin(groups).alias("named")), "features")
    best = sums.orderBy(F.desc("g"), "f").limit(FEATURES).collect()
    return sorted({r.f for r in best} | {r.f for r in sums.where("named").collect()})  # at most FEATURES + len(SWAP) rows


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", max_rows: int = MAX_FIT_ROWS, penalty: float = PENALTY) -> Model:
    """Learn from labelled rows outside the held-out fold."""
    sample = store(labelled_sample(docs, labels, label, max_rows).select("text", F.when(F.col("y") > 0, 1).otherwise(0).alias("y")), "labelled")
    by = {r.y: r.n for r in sample.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = by.get(0, 0), by.get(1, 0)
    if not n0 or not n1:
        return Model(prior=float(n1 > 0))
    model = Model({f: k for k, f in enumerate(telling(sample, n0, n1))})
    width = 1 + 2 * len(model.index)

    def measure(batches):
        def sparse(x):
            at = np.flatnonzero(x)
            return at, x[at]

        for b in batches:
            rows = []
            for text, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                tokens = text.lower().split()
                rows.append((y, *sparse(model.row(model.counts(tokens), max(1, len(tokens))))))
                rows += [(-1, *sparse(d)) for d in model.swaps(text)]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.int64())), pa.array([r[2] for r in rows], pa.list_(pa.float64()))], ["y", "at", "x"])

    data = store(sample.select("text", "y").mapInArrow(measure, "y int, at array<long>, x array<double>").repartition(SUMS), "rows")
    swaps = data.where("y < 0").count()
    w = np.zeros(width)
    w[0] = np.log(n1 / n0)
    ridge = np.full(width, RIDGE)
    ridge[0] = 1e-6
    for _ in range(STEPS):

        def add_up(batches, w=w):
            g, h = np.zeros(width), np.zeros((width, width))
            for b in batches:
                for start in range(0, b.num_rows, 512):
                    part = b.slice(start, 512)
                    y = part.column(0).to_numpy(zero_copy_only=False)
                    x = np.zeros((len(y), width))
                    for i, (at, v) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)):
                        x[i, at] = v
                    z = x @ w
                    p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
                    share = penalty * (n0 + n1) / max(swaps, 1)
                    slope = np.where(y < 0, share * z, p - y)
                    curve = np.where(y < 0, share, p * (1 - p))
                    g += x.T @ slope
                    h += (x * curve[:, None]).T @ x
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(g), pa.array(list(h))], ["i", "g", "h"])

        g, h = np.zeros(width), np.zeros((width, width))
        for r in data.mapInArrow(add_up, "i long, g double, h array<double>").collect():  # a matrix of fixed size from each of SUMS parts
            g[r.i] += r.g
            h[r.i] += r.h
        step = np.linalg.solve(h + np.diag(ridge), g + ridge * w)
        w = w - step
        if np.abs(step).max() < 1e-4:
            break
    model.weights = w
    return model


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score of every row."""

    def rate(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([model.score(t) for t in b.column(2).to_pylist()], pa.float64())], ["doc_id", "held_out", "score"])

    return texts(docs).select("doc_id", held_out("doc_id").alias("held_out"), "text").mapInArrow(rate, "doc_id long, held_out boolean, score double")
