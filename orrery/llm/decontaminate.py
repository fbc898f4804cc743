"""Benchmark decontamination by spaced seeds.

A seed is a fixed mask over a run of words: positions marked 1 are hashed, others ignored, so a hit survives
substitutions at the ignored positions. Test and training text are hashed at every position and joined on
(seed, hash). Around each hit the texts are compared word by word on that diagonal: the longest stretch through the
hit with a share of ``MIN_SHARE`` of equal words is the overlap. Words beyond it are sought anew.

The test side is a query set: it is cut into blocks of bounded size, each block is broadcast, and the training
texts are scanned against it. Any number of blocks gives the same rows; none of the training text is shuffled.

Cases: null and empty texts, on either side, overlap with nothing; a null id is carried as null; a test item
shorter than the seeds is sought whole, from ``SHORTEST`` words on, and shorter items are too common to seek;
repeated rows each give their own overlaps; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import Lexicon, combine, giving_back, texts

#: 1: the word counts, 0: any word. Every stretch of 12 words or more with a fifth of them substituted, in any
#: pattern, holds one of these (enumerated in the tests), so no overlap within the limits below is missed.
SEEDS = ("11111", "1110011")
#: Words an overlap needs that are equal, and their least share of its length. Shorter items must be found whole.
MIN_EQUAL, MIN_SHARE, SHORTEST = 10, 0.8, 5
#: Words of test text in a block: with its hashes a block stays under about 40 MB.
BLOCK_WORDS = 400_000
_LOW = np.uint64((1 << 20) - 1)

SCHEMA = "doc_id long, item_id long, doc_start int, doc_end int, item_start int, item_end int, equal int, share double"


def tokens(text: str) -> list[str]:
    """Lower-case words; marks at the ends of a word do not count."""
    return [w.strip(".,;:!?\"'()[]") for w in text.lower().split()]


class Block:
    """Hashed test items: sorted seed hashes with the places they come from."""

    def __init__(self, items: list[tuple[int, str]]):
        lexicon = Lexicon()
        self.ids = [i for i, _ in items]
        words = [lexicon.hashes(tokens(t)) for _, t in items]
        self.starts = np.cumsum([0, *map(len, words)])
        self.words = np.concatenate([*words, np.empty(0, np.uint64)])
        shortest = min(map(len, SEEDS))
        self.lengths = sorted({len(w) for w in words if SHORTEST <= len(w) < shortest})
        hashes, places = [], []
        for n, w in enumerate(words):
            masks = SEEDS if len(w) >= shortest else ("1" * len(w),) if len(w) >= SHORTEST else ()
            for mask in masks:
                h = seed(w, mask)
                hashes.append(h)
                places.append(self.starts[n] + np.arange(len(h)))
        h, at = np.concatenate([*hashes, np.empty(0, np.uint64)]), np.concatenate([*places, np.empty(0, np.int64)])
        order = np.argsort(h, kind="stable")
        self.hashes, self.places = h[order], at[order].astype(np.int64)
        self.filter = np.zeros(1 << 20, bool)
        self.filter[(self.hashes & _LOW).astype(np.int64)] = True

    def masks(self) -> list[str]:
        return [*SEEDS, *("1" * n for n in self.lengths)]


def seed(h: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the marked words at each start; the mask is part of it."""
    kept = [k for k, c in enumerate(mask) if c == "1"]
    n = len(h) - len(mask) + 1
    return combine(h, kept)[: max(n, 0)] + np.uint64(int(mask, 2)) if n > 0 else np.empty(0, np.uint64)


def longest_stretch(equal: np.ndarray, hit: int) -> tuple[int, int]:
    """Ends [a, b) of the longest stretch through ``hit`` with a share of MIN_SHARE of equal words, less different ends."""
    score = np.where(equal, 1 - MIN_SHARE, -MIN_SHARE)
    right, left = np.cumsum(score[hit:]), np.cumsum(score[hit::-1]) - score[hit]
    reach = np.maximum.accumulate(right[::-1])[::-1]  # best score of any end from here on
    ahead = np.searchsorted(-reach, left + 1e-9, "right") - 1  # the last end that makes up for each beginning
    size = np.where(ahead >= 0, np.arange(len(left)) + ahead, -1)
    k = int(size.argmax())
    a, b = hit - k, hit + int(ahead[k]) + 1
    while b > a and not equal[b - 1]:
        b -= 1
    while a < b and not equal[a]:
        a += 1
    return a, b


def overlaps(block: Block, h: np.ndarray) -> list[tuple[int, int, int, int, int, int, float]]:
    """(item index, doc_start, doc_end, item_start, item_end, equal, share) of one text, each stretch once."""
    hits: set[tuple[int, int]] = set()
    for mask in block.masks():
        s = seed(h, mask)
        at = np.flatnonzero(block.filter[(s & _LOW).astype(np.int64)])
        if not len(at):
            continue
        lo, hi = np.searchsorted(block.hashes, s[at]), np.searchsorted(block.hashes, s[at], "right")
        for p, a, b in zip(at[hi > lo].tolist(), lo[hi > lo].tolist(), hi[hi > lo].tolist(), strict=True):
            hits.update((p, q) for q in block.places[a:b].tolist())
    found, done = [], {}
    for p, q in sorted(hits):
        item = int(np.searchsorted(block.starts, q, "right")) - 1
        first, last = int(block.starts[item]), int(block.starts[item + 1])
        if p < done.get((item, p - q), -1):
            continue
        back, ahead = min(p, q - first), min(len(h) - p, last - q)
        equal = h[p - back : p + ahead] == block.words[q - back : q + ahead]
        if np.count_nonzero(equal) < min(MIN_EQUAL, last - first):  # nothing on this diagonal can do
            done[(item, p - q)] = len(h)
            continue
        a, b = longest_stretch(equal, back)
        n = int(equal[a:b].sum())
        if b > a and n >= min(MIN_EQUAL, last - first) and n >= MIN_SHARE * (b - a) - 1e-9:
            done[(item, p - q)] = p - back + b
            found.append((item, p - back + a, p - back + b, q - back + a - first, q - back + b - first, n, n / (b - a)))
    return sorted(set(found))


def find_overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each overlap of a text with a test item: word positions on both sides, equal words and their share."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).dropna(subset=["text"])
    spark, out = docs.sparkSession, None
    for rows in _blocks(items):
        shared = spark.sparkContext.broadcast(Block(rows))

        def scan(batches, shared=shared):
            block, lexicon = shared.value, Lexicon()
            for b in batches:
                found = []
                for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                    found += [(doc_id, block.ids[o[0]], *o[1:]) for o in overlaps(block, lexicon.hashes(tokens(text)))]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 2 + [pa.int32()] * 5 + [pa.float64()], strict=True)], ["doc_id", "item_id", "doc_start", "doc_end", "item_start", "item_end", "equal", "share"])

        part = texts(docs).mapInArrow(giving_back(scan), SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame([], SCHEMA)


def _blocks(items: DataFrame):
    """The test side in pieces of bounded size, streamed to the driver partition by partition."""
    rows, size = [], 0
    for r in items.toLocalIterator():
        rows.append((r.item_id, r.text))
        size += len(r.text) // 2 + 1
        if size >= BLOCK_WORDS:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def keep_clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that overlap with no test item. No shuffle."""
    k = docs.columns.index("text")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text")).dropna(subset=["text"])
    for rows in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(Block(rows))

        def keep(batches, shared=shared):
            block, lexicon = shared.value, Lexicon()
            for b in batches:
                yield b.filter(pa.array([not overlaps(block, lexicon.hashes(tokens(t or ""))) for t in b.column(k).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(giving_back(keep), docs.schema)
    return docs
