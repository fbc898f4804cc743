"""Token ids of every text, as files of range-coded blocks.

Texts are range-partitioned and sorted by doc_id; each partition becomes one file. A task tokenizes its texts,
appends the end id to each, packs the ids of whole groups of blocks with the adaptive range coder of
``rangecoder`` (each block independent and checksummed), and closes the file with an index of its documents.
Tokenizing goes by white-space-delimited piece, with a bounded table of pieces already seen: the tokenizer's own
rules never join ids across white space, so the ids are those of the whole text.

File: magic; groups (number of blocks, length of each, blocks); index (doc ids, null flags, ids of each document);
length and crc32 of the index, magic.

Cases: a null text is an empty one and gives the end id alone; a null doc_id sorts first and is kept as null;
rows of equal doc_id stay next to each other, ordered by text, each a document of its own; an empty table writes
no file and returns no rows; other columns are ignored; texts and documents of any length cross block and group
bounds freely.
"""

from __future__ import annotations

import os
import zlib
from functools import lru_cache
from operator import add
from string import punctuation
from unicodedata import normalize

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm import rangecoder, shards
from orrery.llm.common import giving_back, texts
from orrery.session import scratch_dir

MAGIC = b"IDRC0001"
END_ID = 1
#: Ids a group of blocks holds; the coder's memory goes with it.
GROUP_IDS = 1 << 22
#: A file should hold a 200th of all characters, within these bounds.
FILE_PART, FILE_LEAST, FILE_MOST = 200, 20_000_000, 2_000_000_000
#: Pieces a task remembers, as many stems, and the longest piece it does.
PIECES, PIECE_CHARS = 400_000, 64
#: Texts a task takes out of an Arrow batch at once, and characters of which it looks for new pieces at once.
TEXTS, CHARS = 128, 400_000


class Tokens:
    """Ids of a text as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.known: dict[str, bytes] = {"": b""}
        self.stems: dict[str, bytes] = {"": b""}
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def ids(self, pieces: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def words(self, words: list[str]) -> list[bytes]:
        """As ``ids``, for pieces of letters alone: each is one word to the tokenizer, so they go as one text, and the ids
        are parted behind those that end a word."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4") if words else np.empty(0, "<u4")
        end = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(end) != len(words):  # a letter that is more than one word once its case or form is changed
            return self.ids(words)
        flat = ids.tobytes()
        return [flat[4 * i : 4 * j] for i, j in zip([0, *end], end, strict=False)]

    def learn(self, pieces: list[str]) -> None:
        """Remember new pieces. The tokenizer lowers case and parts letters and digits from marks, so ``Word.`` is
        ``word`` and the mark, and many pieces share a stem."""
        if len(self.stems) + 2 * len(pieces) > PIECES:
            self.stems = {"": b""}
        stems, marks = [], []
        for p in pieces:
            stem = p.rstrip(punctuation)
            if stem.isascii() and stem.isalnum():
                stems.append(stem.lower())
            elif stem.isalpha() and normalize("NFC", stem).lower().isalpha():  # no accent of its own that the marks would join
                stems.append(stem)
            else:
                stem = p
                stems.append(p)
            marks.append(p[len(stem) :])
        new = {*stems, *marks} - self.stems.keys()
        letters = [s for s in new if s.isalpha()]
        rest = [s for s in new if not s.isalpha()]
        self.stems.update(zip(letters, self.words(letters), strict=True))
        self.stems.update(zip(rest, self.ids(rest), strict=True))
        self.known.update(zip(pieces, map(add, map(self.stems.__getitem__, stems), map(self.stems.__getitem__, marks)), strict=True))

    def some(self, texts: list[list[str]]):
        """The ids of each of some texts, given as pieces."""
        every = set().union(*texts)
        new = every - self.known.keys()
        if len(self.known) + len(new) > PIECES:
            self.known = {"": b""}
            new = every - {""}
        self.learn([p for p in new if len(p) <= PIECE_CHARS])
        whole = [p for p in new if len(p) > PIECE_CHARS]
        self.known.update(zip(whole, self.ids(whole), strict=True))
        for pieces in texts:
            yield b"".join(map(self.known.__getitem__, pieces))
        for p in whole:
            del self.known[p]

    def encode(self, batch: list[str]):
        """The ids of each text of a batch."""
        texts, chars = [], 0
        for text in batch:
            if texts and chars + len(text) > CHARS:
                yield from self.some(texts)
                texts, chars = [], 0
            texts.append(text.replace("\n", " ").replace("\t", " ").split(" "))
            chars += len(text)
        if texts:
            yield from self.some(texts)


@lru_cache(maxsize=1)
def tokens_of(path: str) -> Tokens:
    """One for all tasks of a worker, so that pieces stay known; its tables are bounded."""
    return Tokens(path)


class FileWriter:
    def __init__(self, base: str, name: str):
        self.name = name
        self.stream, self.temporary = shards.open_temporary(base, name)
        self.stream.write(MAGIC)
        self.parts: list[bytes] = []
        self.held = self.total = 0
        self.ids, self.nulls, self.counts = [], [], []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id or 0)
        self.nulls.append(doc_id is None)
        self.counts.append(len(ids) // 4)
        self.total += len(ids) // 4
        self.parts.append(ids)
        self.held += len(ids) // 4
        if self.held >= GROUP_IDS:
            self.flush()

    def flush(self) -> None:
        ids = np.frombuffer(b"".join(self.parts), "<u4")
        self.parts, self.held = [], 0
        for i in range(0, len(ids), GROUP_IDS):
            coded = rangecoder.encode(rangecoder.split(ids[i : i + GROUP_IDS]))
            self.stream.write(np.array([len(coded), *map(len, coded)], "<u4").tobytes())
            for c in coded:
                self.stream.write(c)

    def close(self) -> tuple:
        self.flush()
        self.stream.write(np.array([0], "<u4").tobytes())
        index = np.array(self.ids, "<i8").tobytes() + np.array(self.nulls, "u1").tobytes() + np.array(self.counts, "<u8").tobytes()
        self.stream.write(index + np.array([len(self.ids), len(index), zlib.crc32(index)], "<u8").tobytes() + MAGIC)
        size = self.stream.tell()
        self.stream.close()
        return self.name, self.temporary, TaskContext.get().partitionId(), len(self.ids), self.total, size


WRITTEN = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int64()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())])


def write(docs: DataFrame, base: str, tokenizer: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write the files under ``base`` and return the manifest (name, shard, documents, ids, bytes, start).

    ``start``: ids of all files before it, in order of doc_id.
    """
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    rows = texts(docs)
    chars = rows.agg(F.sum(F.length("text"))).first()[0]
    files = max(1, -(-(chars or 0) // min(max((chars or 0) // FILE_PART, FILE_LEAST), FILE_MOST)))
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        out, tokens = None, None
        for b in batches:
            if b.num_rows and out is None:
                out = FileWriter(base, f"ids-{TaskContext.get().partitionId():06d}.bin")
                tokens = tokens_of(tokenizer)
            for i in range(0, b.num_rows, TEXTS):
                some = b.slice(i, TEXTS)
                for doc_id, ids in zip(some.column(0).to_pylist(), tokens.encode(some.column(1).to_pylist()), strict=True):
                    out.add(doc_id, ids + end)
        if out is not None:
            yield shards.batch([out.close()], WRITTEN)

    written = rows.repartitionByRange(int(files), "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(giving_back(run), "name string, temporary string, shard long, documents long, ids long, bytes long")
    manifest = shards.commit(base, written)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return manifest.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def read_file(stream):
    """(doc_id, ids) of each document of a file; raises where a checksum fails."""
    size = stream.size()
    stream.seek(size - 32)
    n, length, crc = np.frombuffer(stream.read(24), "<u8").tolist()
    if stream.read(8) != MAGIC:
        raise ValueError("not a file of ids, or cut off")
    stream.seek(size - 32 - length)
    index = stream.read(length)
    if zlib.crc32(index) != crc:
        raise ValueError("the index is damaged")
    ids, nulls, counts = np.frombuffer(index[: 8 * n], "<i8").tolist(), np.frombuffer(index[8 * n : 9 * n], "u1"), np.frombuffer(index[9 * n :], "<u8").tolist()
    stream.seek(len(MAGIC))
    held, at = np.empty(0, "<u4"), 0
    for doc_id, null, count in zip(ids, nulls, counts, strict=True):
        parts = [held[at : at + count]]
        at += count
        while (missing := count - sum(map(len, parts))) > 0:
            (blocks,) = np.frombuffer(stream.read(4), "<u4").tolist()
            sizes = np.frombuffer(stream.read(4 * blocks), "<u4").tolist()
            held = np.concatenate(rangecoder.decode([stream.read(s) for s in sizes]))
            parts.append(held[:missing])
            at = missing
        yield (None if null else doc_id), np.concatenate(parts)


READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def read(base: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files that the manifest names."""

    def run(batches):
        for b in batches:
            for name, start in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = []
                with shards.open_final(base, name) as stream:
                    for doc_id, ids in read_file(stream):
                        rows.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
                        start += len(ids)
                        if len(rows) == 4096:
                            yield shards.batch(rows, READ)
                            rows = []
                yield shards.batch(rows, READ)

    return shards.spread(manifest.select("name", "start")).mapInArrow(giving_back(run), "doc_id long, start long, n_tokens long, ids_crc32 long")


def write_and_read(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    base = scratch_dir(docs.sparkSession, "ids")
    return read(base, write(docs, base, tokenizer))
