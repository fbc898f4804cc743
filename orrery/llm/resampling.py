"""Importance resampling towards a target distribution of hashed n-grams.

Features of a text are its runs of 1 to ``width`` words; a feature's bucket is the crc32 of its bytes. What a bucket
gains is the log ratio of its share in the target and in the source, in thousandths; a document weighs the mean
gain of its features, Gumbel noise from its id makes a weighted draw without replacement of the highest scores.

Words are found on the bytes of many texts at once. Features are interned in an open-addressed NumPy table: xxhash64
keys, linear probing, and a comparison of the bytes themselves before a slot is shared. A slot holds
the bucket and the count of its feature; occurrences keep their slot numbers, through which they gather gains. A table
serves one block of ``BLOCK`` occurrences, so memory is bounded whatever the vocabulary.

Counts of buckets are summed per partition and then by bucket: ``buckets`` numbers at most reach the driver. Ranks come
without a sort on one task: scores are whole thousandths within some 150,000 values, so a histogram of them gives the
score at which the draw ends; only rows from there on are range-sorted, by (score, doc_id, row number), which splits
any number of equal rows, and a rank is the position in the partition plus the rows of the partitions before it.

Cases: a null or wordless text has no features, weighs 0 and, with under ``LEAST_WORDS`` words, is never drawn; a
null doc_id is hashed as empty text and ranks last among equal scores; rows of equal doc_id share their noise and rank in a fixed order;
an empty target gives every bucket a gain from its source count alone; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import giving_back, running_total, store, texts

BUCKETS = 10_000
WIDTH = 1
LEAST_WORDS, PER_CENT, SEED = 20, 10, 2024
#: Occurrences a table takes, and bytes of text that are looked at together (a longer text alone).
BLOCK, GROUP_BYTES = 1 << 17, 1 << 21

#: Fixed values of XXH64.
P1, P2, P3, P4, P5 = (np.uint64(p) for p in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261))

#: Byte to folded byte; 32 for what parts words. Bytes of other scripts belong to words.
FOLD = np.full(256, 32, np.uint8)
FOLD[0x30:0x3A] = np.arange(0x30, 0x3A)
FOLD[0x41:0x5B] = FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
FOLD[0x80:] = np.arange(0x80, 0x100)


def _rotate(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


def _load(data: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
    """Little-endian integers of ``width`` bytes at these offsets."""
    out = data[at].astype(np.uint64)
    for k in range(1, width):
        out |= data[at + k].astype(np.uint64) << np.uint64(8 * k)
    return out


def xxhash64(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of each stretch of bytes. Up to 31 bytes in NumPy, one step of all stretches at a time; longer ones one by one."""
    h = P5 + size.astype(np.uint64)
    at, left = start.copy(), np.where(size < 32, size, 0)
    i = np.flatnonzero(left >= 8)
    while len(i):
        lane = _rotate(_load(data, at[i], 8) * P2, 31) * P1
        h[i] = _rotate(h[i] ^ lane, 27) * P1 + P4
        at[i] += 8
        left[i] -= 8
        i = i[left[i] >= 8]
    i = np.flatnonzero(left >= 4)
    h[i] = _rotate(h[i] ^ (_load(data, at[i], 4) * P1), 23) * P2 + P3
    at[i] += 4
    left[i] -= 4
    i = np.flatnonzero(left > 0)
    while len(i):
        h[i] = _rotate(h[i] ^ (data[at[i]].astype(np.uint64) * P5), 11) * P1
        at[i] += 1
        left[i] -= 1
        i = i[left[i] > 0]
    h = (h ^ (h >> np.uint64(33))) * P2
    h = (h ^ (h >> np.uint64(29))) * P3
    h ^= h >> np.uint64(32)
    for i in np.flatnonzero(size >= 32).tolist():
        h[i] = xxhash.xxh64_intdigest(data[start[i] : start[i] + size[i]].tobytes())
    return h


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether the stretches of these lengths at a and b are equal."""
    same, i, k = np.ones(len(a), bool), np.flatnonzero(a != b), 0
    while len(i := i[same[i] & (size[i] > k)]):
        if k == 64:  # long ones: whole at a time
            for j in i.tolist():
                same[j] = np.array_equal(data[a[j] : a[j] + size[j]], data[b[j] : b[j] + size[j]])
            break
        same[i] = data[a[i] + k] == data[b[i] + k]
        k += 1
    return same


class Interner:
    """Open-addressed table of the features of one block; arrays by slot."""

    def __init__(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, buckets: int):
        bits = max(4, (2 * len(start) - 1).bit_length())
        self.first = np.full(1 << bits, -1, np.int64)  # the occurrence that owns the slot
        key, mask = xxhash64(data, start, size), (1 << bits) - 1
        self.slot = np.empty(len(start), np.int64)  # by occurrence
        seek, at = np.arange(len(start)), (key & np.uint64(mask)).astype(np.int64)
        while len(seek):
            free = self.first[at] < 0
            self.first[at[free]] = seek[free]  # of several the last one stays; the others look again
            owner = self.first[at]
            hit = (key[owner] == key[seek]) & (size[owner] == size[seek])
            i = np.flatnonzero(hit)
            hit[i] = same_bytes(data, start[owner[i]], start[seek[i]], size[seek[i]])
            self.slot[seek[hit]] = at[hit]
            seek, at = seek[~hit], (at[~hit] + 1) & mask
        self.used = np.flatnonzero(self.first >= 0)
        self.count = np.bincount(self.slot, minlength=1 << bits)
        self.bucket = np.zeros(1 << bits, np.int64)
        own = self.first[self.used]
        self.bucket[self.used] = [zlib.crc32(data[s : s + n].data) % buckets for s, n in zip(start[own].tolist(), size[own].tolist(), strict=True)]


def groups(batches, columns: int):
    """Rows of Arrow batches in groups of about ``GROUP_BYTES`` of text (first column), longer texts alone."""
    rows, held = [], 0
    for b in batches:
        for row in zip(*(b.column(c).to_pylist() for c in range(columns)), strict=True):
            if rows and held + len(row[0]) > GROUP_BYTES:
                yield rows
                rows, held = [], 0
            rows.append(row)
            held += len(row[0])
    if rows:
        yield rows


def features(texts_of_group: list[bytes], width: int):
    """(bytes of all texts, folded and with one space between words; start, size and text number of every feature), in blocks."""
    raw = np.frombuffer(b" ".join(texts_of_group) + b" ", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts_of_group])
    folded = FOLD[raw]
    word = folded != 32
    keep = word | np.concatenate(([False], word[:-1]))  # a word's bytes and one blank after it
    data = folded[keep]
    position = np.cumsum(keep)[ends - 1]  # where each text ends in the packed bytes
    stop = np.flatnonzero(data == 32)
    start = np.concatenate((np.zeros(1, np.int64), stop[:-1] + 1))[: len(stop)]
    text = np.searchsorted(position, start, side="right")
    for n in range(1, width + 1):
        whole = np.flatnonzero(text[: len(text) - n + 1] == text[n - 1 :]) if len(text) >= n else np.empty(0, np.int64)
        for i in range(0, len(whole), BLOCK):
            w = whole[i : i + BLOCK]
            yield data, start[w], stop[w + n - 1] - start[w], text[w]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS, width: int = WIDTH) -> np.ndarray:
    """Occurrences of features by bucket, over all texts."""

    def run(batches):
        total = np.zeros(buckets, np.int64)
        for rows in groups(batches, 1):
            for data, start, size, _ in features([r[0] for r in rows], width):
                table = Interner(data, start, size, buckets)
                np.add.at(total, table.bucket[table.used], table.count[table.used])
        i = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": i, "n": total[i]})

    parts = docs.select(F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(giving_back(run), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for row in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket, in doubles."""
    S, T, B = float(source.sum()), float(target.sum()), float(len(source))
    ratio = lambda s, t: (t + 1.0) * (S + B) / ((s + 1.0) * (T + B))
    return np.array([math.floor(1000 * math.log(ratio(float(s), float(t)))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_features and weight of every document; ``row`` numbers them."""
    buckets = len(gain)

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        for rows in groups(batches, 2):
            n, words, total = (np.zeros(len(rows), np.int64) for _ in range(3))
            for data, start, size, text in features([r[0] for r in rows], width):
                table = Interner(data, start, size, buckets)
                value = gain[table.bucket][table.slot]
                first = np.flatnonzero(np.diff(text, prepend=-1))
                n[text[first]] += np.diff(np.append(first, len(text)))
                total[text[first]] += np.add.reduceat(value, first)
            if width == 1:
                words = n
            else:
                for _, _, _, text in features([r[0] for r in rows], 1):
                    words += np.bincount(text, minlength=len(rows))
            weight = np.where(n > 0, total // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_pydict({"doc_id": pa.array([r[1] for r in rows], pa.int64()), "n_words": words, "n_features": n, "weight": weight, "row": row + np.arange(len(rows))})
            row += len(rows)

    rows = texts(docs).select(F.col("text").cast("binary").alias("text"), "doc_id")
    return rows.mapInArrow(giving_back(run), "doc_id long, n_words long, n_features long, weight long, row long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the id alone."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(docs: DataFrame, target: DataFrame, per_cent: int = PER_CENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, width: int = WIDTH, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document; ``rank`` is null where it is not drawn."""
    gain = gains(bucket_counts(docs, buckets, width), bucket_counts(target, buckets, width))
    scored = weigh(docs, gain, width).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = store(scored.select("doc_id", "n_features", "weight", "score", "row", (F.col("n_words") >= least_words).alias("able")), "scored")
    levels = scored.where("able").groupBy("score").agg(F.count("*").alias("n"))  # bounded: scores are thousandths of logarithms of counts
    above = Window.orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    levels = levels.select("score", F.sum("n").over(above).alias("upto"), F.sum("n").over(Window.partitionBy()).alias("every"))
    want = F.expr(f"{per_cent} * every div 100")
    last = levels.agg(F.max(F.when(F.col("upto") >= want, F.col("score"))).alias("last"), F.max(want).alias("want")).first()
    columns = ["doc_id", "n_features", "weight", "score"]
    if not last.want:
        return scored.select(*columns, F.lit(None).cast("long").alias("rank"))
    chosen = F.col("able") & (F.col("score") >= last.last)
    ranked = scored.where(chosen).select(*columns, "row", F.lit(1).alias("one"))
    ranked = running_total(ranked, [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("row")], "one", "rank")
    ranked = ranked.select(*columns, F.when(F.col("rank") <= last.want, F.col("rank")).alias("rank"))
    return scored.where(~chosen).select(*columns, F.lit(None).cast("long").alias("rank")).union(ranked)


ORACLE_SQL = rf"""
WITH w AS (SELECT 1 AS src, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM documents
  UNION ALL SELECT 0, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
k AS (SELECT w, (xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(octet_length(encode(w))), lambda i: ('0x' || hex(encode(w))[2 * i + 1:2 * i + 2])::BIGINT)),
  lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda a, z: xor(a >> 1, 3988292384::BIGINT * (a & 1)))), 4294967295::BIGINT) % {BUCKETS})::BIGINT AS bucket FROM (SELECT DISTINCT w FROM w)),
n AS (SELECT bucket, count(*) FILTER (src = 1) AS s, count(*) FILTER (src = 0) AS t FROM w JOIN k USING (w) GROUP BY 1),
a AS (SELECT (count(*) FILTER (src = 1))::DOUBLE AS s, (count(*) FILTER (src = 0))::DOUBLE AS t FROM w),
g AS (SELECT bucket, floor(1000 * ln((n.t + 1.0::DOUBLE) * (a.s + {BUCKETS}) / ((n.s + 1.0::DOUBLE) * (a.t + {BUCKETS}))))::BIGINT AS gain FROM n, a),
d AS (SELECT id AS doc_id, count(*)::BIGINT AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM w JOIN k USING (w) JOIN g USING (bucket) WHERE src = 1 GROUP BY 1),
s AS (SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || sha256('{SEED}:' || doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM documents LEFT JOIN d USING (doc_id)),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r, count(*) OVER () AS n FROM s WHERE n_features >= {LEAST_WORDS})
SELECT s.doc_id, n_features, weight, score, CASE WHEN r <= {PER_CENT} * n // 100 THEN r END AS rank FROM s LEFT JOIN r USING (doc_id)
"""
