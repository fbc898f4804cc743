"""Quality classifier: a Gaussian kernel over document statistics by random Fourier features, ridge, isotonic calibration.

Each text gives a short vector of statistics (lengths, character classes, repetition). Random Fourier features
turn a linear ridge fit into a kernel machine; its normal equations are sums over rows, so partitions add up
their share and only their sums travel. An isotonic fit on rows left out of the ridge maps scores to
probabilities. Labels, lang, source and doc_id are never inputs.

Cases: a null text is scored as an empty one; an empty text has all statistics 0 and gets the score the model
gives there; equal texts get equal scores; repeated rows are each scored; long texts are read whole; without any
row to learn from the score is 0.5; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import fold, giving_back, held_out, labelled_sample, texts

#: Labelled rows the fit may use at most (documented bound; scoring always covers every row).
MAX_FIT_ROWS = 200_000
FOURIER, RIDGE, GRID, SUMS = 256, 1.0, 1000, 16
#: Bytes of text measured at once (a longer text is measured alone).
PIECE = 4 << 20

_CLASSES = np.full(256, 8, np.uint8)
_CLASSES[97:123] = 0  # lower case
_CLASSES[65:91] = 1  # upper case
_CLASSES[48:58] = 2  # digits
_CLASSES[[9, 11, 12, 13, 32]] = 3  # blanks
_CLASSES[10] = 4  # line ends
_CLASSES[[44, 46, 58, 59]] = 5  # stops
_CLASSES[[33, 63]] = 6  # ! and ?
_CLASSES[128:] = 7  # bytes of letters beyond ASCII
NAMES = ["bytes", "words", "upper", "digits", "blanks", "lines", "stops", "calls", "beyond", "symbols", "symbol_runs", "word_length", "distinct_words", "repeated_lines", "line_length", "longest_word"]


def statistics(column: pa.Array) -> np.ndarray:
    """One row of statistics for each text of an Arrow string column without nulls."""
    if column.nbytes > PIECE and len(column) > 1:
        half = len(column) // 2
        return np.concatenate([statistics(column.slice(0, half)), statistics(column.slice(half))])
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.empty(0, np.uint8)
    at = offsets - offsets[0]
    kinds = _CLASSES[data]

    def total(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=sums[1:])
        return (sums[at[1:]] - sums[at[:-1]]).astype(float)

    symbol = kinds == 8
    runs = symbol.copy()
    runs[1:] &= symbol[:-1]
    runs[:1] = False
    size = np.maximum(at[1:] - at[:-1], 1).astype(float)
    by = [total(kinds == k) for k in range(1, 8)]
    n, distinct, repeated, longest = (np.zeros(len(column)) for _ in range(4))
    for i, text in enumerate(column.to_pylist()):
        words, lines = text.split(), text.split("\n")
        n[i], distinct[i] = len(words), len(set(words))
        repeated[i] = 1 - len(set(lines)) / len(lines)
        longest[i] = len(max(words, key=len, default=""))
    per = np.maximum(n, 1)
    return np.column_stack([
        np.log1p(at[1:] - at[:-1]), np.log1p(n), by[0] / size, by[1] / size, by[2] / size, by[3] / per, by[4] / per, by[5] / per,
        by[6] / size, total(symbol) / size, total(runs) / size, np.minimum(size / per, 50), distinct / per, repeated, np.log1p(per / (1 + by[3])), np.log1p(longest),
    ])


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray | None = None
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def features(self, x: np.ndarray) -> np.ndarray:
        x = np.clip((x - self.mean) / self.scale, -6, 6)
        z = np.cos(x @ self.frequencies + self.phases) * np.sqrt(2 / len(self.phases))
        return np.column_stack([np.ones(len(x)), x, z])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = self.raw(x)
        return raw.clip(0, 1) if self.steps is None else np.interp(raw, *self.steps)


def pool_adjacent(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Isotonic least squares: the centre and level of each pooled block."""
    blocks: list[list[float]] = []
    for block in zip(x * weight, y * weight, weight, strict=True):
        blocks.append(list(block))
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last, strict=True)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", max_rows: int = MAX_FIT_ROWS, seed: int = 11) -> Model | None:
    """Learn from labelled rows outside the held-out fold; None where there are none."""
    rows = labelled_sample(docs, labels, label, max_rows).select("text", "y", (fold("doc_id") == 3).alias("calibrate"))

    def measure(batches):
        for b in batches:
            x = statistics(b.column(0))
            yield pa.RecordBatch.from_arrays([pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64())), b.column(1), b.column(2)], ["x", "y", "calibrate"])

    from orrery.llm.common import store

    data = store(rows.mapInArrow(measure, "x array<double>, y double, calibrate boolean"), "quality")
    d = len(NAMES)
    sums = data.agg(F.count(F.lit(1)), F.count(F.when(~F.col("calibrate"), 1)), *(f for i in range(d) for f in (F.avg(F.col("x")[i]), F.stddev_pop(F.col("x")[i])))).first()
    if not sums[0]:
        return None
    rng = np.random.default_rng(seed)
    model = Model(np.array(sums[2::2]), np.maximum(np.array(sums[3::2]), 1e-3), rng.normal(size=(d, FOURIER)) / np.sqrt(d), rng.uniform(0, 2 * np.pi, FOURIER))
    learn = data if sums[1] in (0, sums[0]) else data.where(~F.col("calibrate"))
    width = 1 + d + FOURIER

    def add_up(batches):
        a = np.zeros((width, width + 1))
        for b in batches:
            z = model.features(np.stack(b.column(0).to_numpy(zero_copy_only=False))) if b.num_rows else np.zeros((0, width))
            y = b.column(1).to_numpy(zero_copy_only=False)
            a += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width)), pa.array(list(a))], ["i", "row"])

    parts = learn.select("x", "y").repartition(SUMS).mapInArrow(add_up, "i long, row array<double>").collect()  # SUMS matrices of fixed size
    a = np.zeros((width, width + 1))
    for r in parts:
        a[r.i] += np.array(r.row)
    penalty = np.full(width, RIDGE)
    penalty[0] = 1e-9
    model.weights = np.linalg.solve(a[:, :-1] + np.diag(penalty), a[:, -1])

    def rate(batches):
        for b in batches:
            x = np.stack(b.column(0).to_numpy(zero_copy_only=False)) if b.num_rows else np.zeros((0, d))
            yield pa.RecordBatch.from_arrays([pa.array(np.round(model.raw(x).clip(-1, 2) * GRID).astype(np.int64)), b.column(1)], ["g", "y"])

    hold = data.where("calibrate") if sums[1] not in (0, sums[0]) else data
    steps = hold.select("x", "y").mapInArrow(rate, "g long, y double").groupBy("g").agg(F.avg("y").alias("y"), F.count(F.lit(1)).alias("n")).orderBy("g").collect()  # 3 * GRID rows at most
    model.steps = pool_adjacent(np.array([r.g / GRID for r in steps]), np.array([r.y for r in steps]), np.array([float(r.n) for r in steps]))
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score of every row."""
    rows = texts(docs).select("doc_id", held_out("doc_id").alias("held_out"), "text")
    if model is None:
        return rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))

    def rate(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(model.score(statistics(b.column(2))).clip(0, 1))], ["doc_id", "held_out", "score"])

    return rows.mapInArrow(giving_back(rate), "doc_id long, held_out boolean, score double")


def keep_good(docs: DataFrame, model: Model | None, at_least: float = 0.7) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose text scores at least ``at_least``. Nothing is rejected without a model."""
    if model is None:
        return docs
    k = docs.columns.index("text")

    def keep(batches):
        for b in batches:
            text = b.column(k).fill_null("")
            yield b.filter(pa.array(model.score(statistics(text)) >= at_least))

    return docs.mapInArrow(giving_back(keep), docs.schema)
