"""N-gram Jaccard join with Bayesian pruning of candidates.

1. Every text gives its set of five-word shingles, a MinHash signature of it and one key for each band of the
   signature. Equal word sequences form one class at once; only its smallest id goes on.
2. Classes that share a band key are linked to the smallest id of that key; connected links make a candidate
   set. Sets are cut into blocks of bounded rows and characters, and each pair of blocks is one unit of work, so
   a set of any size spreads over tasks. Each text is shipped once for each block its set has.
3. Within a unit, signatures are compared a few values at a time. With a uniform prior on the similarity, the
   posterior after m equal values of n is Beta(m + 1, n - m + 1); a pair goes when the chance that its similarity
   reaches the threshold falls below ``tolerance``. Survivors are verified on the exact sets.
4. A unit returns one row for each linked text (how many it links to, and one text it hangs on), never the pairs.

Cases: a null text is an empty one; empty texts are copies of each other and have no other link; a text under
five words is one shingle; rows with a null id link to nothing and get a null class; equal rows are copies; where
an id repeats with different texts, its rows share a class and their links are added; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import Lexicon, giving_back, shingles, store, texts
from orrery.llm.components import components

#: Bands of ROWS values: a pair at 0.8 shares no band with a chance of 6e-5, one at 0.85 of 3e-7.
BANDS, ROWS = 32, 6
#: A pair goes once its chance of reaching the threshold is below this.
TOLERANCE = 1e-6
#: Rows and characters of a block; a unit holds two blocks.
BLOCK_ROWS, BLOCK_CHARS = 256, 4_000_000
STEP = 16

_FACTORS = np.random.default_rng(5).integers(1, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def tokens(text: str) -> list[str]:
    return text.lower().split()


def signature(s: np.ndarray) -> np.ndarray:
    """MinHash values of a non-empty set of hashes; long sets go piece by piece."""
    best = np.full(len(_FACTORS), 2**64 - 1, np.uint64)
    for i in range(0, len(s), 2048):
        np.minimum(best, (s[i : i + 2048, None] * _FACTORS).min(axis=0), out=best)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    h = np.arange(BANDS, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for column in sig.reshape(BANDS, ROWS).T:
        h = (h ^ column) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(32)
    return h


@lru_cache
def least_equal(threshold: float, tolerance: float) -> tuple[int, ...]:
    """For n = STEP, 2 STEP, ...: the fewest equal values of n at which a pair stays.

    P(similarity >= t | m of n) = P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(STEP, BANDS * ROWS + 1, STEP):
        tail, m = 0.0, 0
        for m in range(n + 1):
            tail += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance:
                break
        out.append(m)
    return tuple(out)


def candidate_pairs(left: np.ndarray, right: np.ndarray, same: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of two signature blocks that survive the incremental comparison. ``same``: one block with itself, i < j."""
    found_i, found_j = [], []
    least = least_equal(threshold, tolerance)
    for i in range(len(left)):
        j = np.arange(i + 1 if same else 0, len(right))
        equal = np.zeros(len(j), np.int32)
        for k, need in enumerate(least):
            if not len(j):
                break
            at = slice(k * STEP, (k + 1) * STEP)
            equal += (right[j, at] == left[i, at]).sum(axis=1, dtype=np.int32)
            stay = equal >= need
            j, equal = j[stay], equal[stay]
        found_i.append(np.full(len(j), i))
        found_j.append(j)
    return np.concatenate(found_i or [np.empty(0, int)]), np.concatenate(found_j or [np.empty(0, int)])


def linked(sets_left: list[np.ndarray], sets_right: list[np.ndarray], same: bool, threshold: float, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) whose exact Jaccard similarity reaches the threshold."""
    sig_left = np.array([signature(s) for s in sets_left])
    sig_right = sig_left if same else np.array([signature(s) for s in sets_right])
    i, j = candidate_pairs(sig_left, sig_right, same, threshold, tolerance)
    if not len(i):
        return i, j
    ids = np.unique(np.concatenate([*sets_left, *([] if same else sets_right)]), return_inverse=True)[1]
    ends = np.cumsum([len(s) for s in sets_left] + ([] if same else [len(s) for s in sets_right]))
    spans = np.split(ids, ends[:-1])
    right = spans if same else spans[len(sets_left) :]
    mark = np.zeros(int(ids.max()) + 1, bool)
    good = np.zeros(len(i), bool)
    sizes = np.array([len(s) for s in right])
    for row in np.unique(i):
        at = np.flatnonzero(i == row) if len(i) < 64 else np.arange(np.searchsorted(i, row), np.searchsorted(i, row, "right"))
        mark[spans[row]] = True
        members = [right[x] for x in j[at]]
        starts = np.concatenate([[0], np.cumsum([len(m) for m in members])[:-1]])
        both = np.add.reduceat(mark[np.concatenate(members)].astype(np.int64), starts)
        mark[spans[row]] = False
        good[at] = both >= threshold * (len(spans[row]) + sizes[j[at]] - both) - 1e-9
    return i[good], j[good]


def _fingerprint(batches):
    lexicon = Lexicon()
    for b in batches:
        keys, bands, chars = [], [], []
        for text in b.column(1).to_pylist():
            w = tokens(text)
            chars.append(len(text))
            keys.append(xxhash.xxh3_128_digest(" ".join(w).encode("utf-8", "surrogatepass")))
            s = shingles(lexicon.hashes(w))
            bands.append(band_keys(signature(s)).view(np.int64) if len(s) else np.empty(0, np.int64))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(chars, pa.int64())], ["doc_id", "key", "bands", "chars"])


def compare_units(units: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """units: (unit, side, id, weight, text), all rows of a unit in one partition, in order of unit.

    Returns (id, links, weight_links, root) for texts with a link: texts and weight they link to within the unit,
    and the smallest id they hang on. side 0 and 1 are two blocks to compare with each other; side 2 is a block to
    compare with itself.
    """

    def flush(rows, lexicon):
        rows = list(dict.fromkeys(rows))  # a row given twice is one text; its weight already counts both
        left = [r for r in rows if r[0] != 1]
        right = [r for r in rows if r[0] == 1]
        same = bool(left) and left[0][0] == 2
        right = left if same else right
        if not left or not right:
            return []
        sets = {id(r): shingles(lexicon.hashes(tokens(r[3]))) for r in rows}
        left, right = ([r for r in side if len(sets[id(r)])] for side in (left, right))
        if not left or not right:
            return []
        i, j = linked([sets[id(r)] for r in left], [sets[id(r)] for r in right], same, threshold, tolerance)
        links: dict[int, list[int]] = {}
        top: dict[int, int] = {}

        def find(x):
            while top.setdefault(x, x) != x:
                top[x] = x = top[top[x]]
            return x

        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            (_, a, wa, _), (_, c, wc, _) = left[x], right[y]
            if a == c:
                continue
            for me, other in ((a, wc), (c, wa)):
                got = links.setdefault(me, [0, 0])
                got[0] += 1
                got[1] += other
            p, q = find(a), find(c)
            top[max(p, q)] = min(p, q)
        return [(k, n, w, find(k)) for k, (n, w) in links.items()]

    def run(batches):
        lexicon, unit, rows = Lexicon(), None, []

        def out(found):
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*found, strict=True) if found else ([], [], [], []))], ["id", "links", "weight_links", "root"])

        for b in batches:
            for u, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if u != unit:
                    if rows:
                        yield out(flush(rows, lexicon))
                    unit, rows = u, []
                rows.append(tuple(row))
        if rows:
            yield out(flush(rows, lexicon))

    return units.mapInArrow(giving_back(run), "id long, links long, weight_links long, root long")


def verified_links(items: DataFrame, info: DataFrame, candidates: DataFrame, threshold: float, tolerance: float) -> DataFrame:
    """Exact links within candidate sets. items: (id, text); info: (id, weight, chars); candidates: links (a, b).

    Returns stored rows (id, links, weight_links, root), one for each item and unit where it has a link. How the
    sets are cut is settled on ids and lengths alone; texts then move once to their id and once to each unit.
    """
    members = store(components(candidates).join(info, "id"), "members")
    sizes = members.groupBy("root").agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_ROWS, F.sum("chars") / BLOCK_CHARS)).cast("int").alias("blocks"))
    plan = members.join(sizes, "root").select("id", "weight", "root", "blocks", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int").alias("mine"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    units = items.join(plan.hint("merge"), "id").select("id", "weight", "text", "root", "mine", other).select(
        F.concat_ws("-", "root", F.least("mine", "other"), F.greatest("mine", "other")).alias("unit"),
        F.when(F.col("mine") == F.col("other"), 2).when(F.col("mine") < F.col("other"), 0).otherwise(1).alias("side"), "id", "weight", "text",
    )
    units = units.repartition(F.col("unit")).sortWithinPartitions("unit")
    return store(compare_units(units, threshold, tolerance), "links")


def jaccard_join(docs: DataFrame, threshold: float = 0.8, tolerance: float = TOLERANCE) -> DataFrame:
    """doc_id, text_id, class_id, copies, links, text_links of every row.

    text_id: smallest id with the same word sequence. class_id: smallest id connected by links. copies: other rows
    of the same word sequence. text_links: different word sequences linked to it; links: rows of those, and copies.
    """
    rows = texts(docs)
    marks = store(rows.mapInArrow(giving_back(_fingerprint), "doc_id long, key binary, bands array<long>, chars long"), "bands")
    known = marks.where("doc_id is not null")
    same = store(known.groupBy("key").agg(F.min("doc_id").alias("text_id"), F.count(F.lit(1)).alias("n"), F.max("chars").alias("chars")), "classes")
    leads = known.join(same, (known.key == same.key) & (known.doc_id == same.text_id), "left_semi")
    exploded = leads.select("doc_id", F.explode("bands").alias("band"))
    shared = exploded.groupBy("band").agg(F.min("doc_id").alias("hub"), F.max("doc_id").alias("far")).where("hub != far")
    pairs = exploded.join(shared.select("band", "hub"), "band").where("doc_id != hub").select(F.col("doc_id").alias("a"), F.col("hub").alias("b"))
    info = same.groupBy(F.col("text_id").alias("id")).agg(F.sum("n").alias("weight"), F.sum("chars").alias("chars"))
    found = verified_links(rows.withColumnRenamed("doc_id", "id"), info, pairs, threshold, tolerance)
    classes = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy(F.col("id").alias("text_id")).agg(F.sum("links").alias("text_links"), F.sum("weight_links").alias("weight_links"))
    by_text = same.join(counts, "text_id", "left").join(classes.withColumnRenamed("id", "text_id"), "text_id", "left")
    per_row = marks.select("doc_id", "key").join(by_text, "key", "left")
    some = F.col("doc_id").isNotNull()
    none = F.lit(0).cast("long")
    return per_row.select(
        "doc_id", F.when(some, F.col("text_id")).alias("text_id"), F.when(some, F.coalesce("root", "text_id")).alias("class_id"),
        F.when(some, F.col("n") - 1).otherwise(none).alias("copies"),
        F.when(some, F.col("n") - 1 + F.coalesce("weight_links", none)).otherwise(none).alias("links"),
        F.when(some, F.coalesce("text_links", none)).otherwise(none).alias("text_links"),
    )


def keep_one(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs``, all columns, without those of a class that has a smaller id. Rows without id stay.

    Only the ids to remove are joined; they are few against the texts.
    """
    gone = store(jaccard_join(docs, threshold).where("doc_id != class_id").select(F.col("doc_id").alias("gone_id")).distinct(), "removed")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
