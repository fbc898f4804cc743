"""What the operators of this subpackage share: input shape, the hold-out rule, stored intermediates, word hashes."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.session import scratch_dir

#: Words a worker keeps hashed; the table is emptied when full, so memory stays bounded whatever the vocabulary.
LEXICON_ROWS = 200_000


def texts(docs: DataFrame) -> DataFrame:
    """(doc_id, text) alone, so that other columns of any name cannot clash. A null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def fold(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4. Null for a null id."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 4


def held_out(doc_id: Column | str) -> Column:
    """Rows of remainder 2 are never learned from. A row without id carries no label; it counts as not held out."""
    return F.coalesce(fold(doc_id) == 2, F.lit(False))


def store(df: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def giving_back(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task whose worker returns freed memory to the system when it ends. Workers live on and serve later stages, next
    to a heap that never shrinks; what one stage's tables took would add to what the next one needs."""

    @wraps(task)
    def run(batches):
        try:
            yield from task(batches)
        finally:
            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the C library, where it has it
            if trim is not None:
                trim(0)

    return run


def running_total(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """``df`` with the sum of ``value`` up to and with every row in ``order``, distributed: each partition of a range sort
    sums its own rows, and one row a partition carries on. ``order`` should tell rows apart, so that no hot key stays whole."""
    at = df.columns.index(value)

    def run(batches):
        total, part = 0, TaskContext.get().partitionId()
        for b in batches:
            sums = total + np.cumsum(b.column(at).to_numpy(zero_copy_only=False).astype(np.int64))
            yield b.append_column("_part", pa.array(np.full(len(sums), part), pa.int64())).append_column("_sum", pa.array(sums, pa.int64()))
            total = int(sums[-1]) if len(sums) else total

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", _part long, _sum long"
    sorted_ = store(df.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, schema), "running")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carry = sorted_.groupBy("_part").agg(F.max("_sum").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_carry"))
    return sorted_.join(F.broadcast(carry), "_part").withColumn(name, F.col("_sum") + F.col("_carry")).drop("_part", "_sum", "_carry")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, max_rows: int) -> DataFrame:
    """Texts and labels (0.0/1.0) of rows that may be learned from, at most about ``max_rows`` of them by id hash.

    Only (id, label) pairs of the bounded sample are broadcast. Repeated labels of an id are averaged and
    rounded; rows whose id or label is null teach nothing.
    """
    one = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("double").alias("y")).dropna()
    one = one.where(fold("doc_id") != 2).groupBy("doc_id").agg(F.round(F.avg("y")).alias("y"))
    n = one.count()
    if n > max_rows:
        one = one.where(F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    return texts(docs).join(F.broadcast(one), "doc_id")


class Lexicon(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: str) -> int:
        if len(self) >= LEXICON_ROWS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h

    def hashes(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit words so that all bits depend on all bits."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def combine(h: np.ndarray, offsets: list[int]) -> np.ndarray:
    """One hash for each start position i from the words at i + offset."""
    n = len(h) - offsets[-1]
    if n <= 0:
        return np.empty(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for o in offsets:
        out = (out + h[o : o + n]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out)


def shingles(h: np.ndarray, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of runs of ``width`` words; of the whole text where it is shorter; none if it is empty."""
    if len(h) == 0:
        return h
    return np.unique(combine(h, list(range(min(width, len(h))))))
