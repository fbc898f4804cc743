"""Deterministic sharded WARC writer and reader.

Pages are range-partitioned by shard and sorted by page_id, then digest. A shard starts where the running sum of html
bytes in that order passes the next multiple of the shard's size, so shards are even whatever the ids are, and the
files follow from the pages alone, not from the cluster. The running sum is a distributed one over short rows (id,
digest, bytes); html is moved once. Each record is a gzip member of its own; a shard rolls to its next file before a
record would take it past ``ROLL_BYTES`` of compressed data. Every header is made anew from the row: record id, date (a
parameter), digests, lengths. Of equal payloads of at least ``MIN_REVISIT`` bytes the one with the smallest page_id
is the response; others are revisits that name it. Files get their names by manifest commit (``shards``).

The page a revisit names comes from a combined aggregate by digest; short rows that mark revisits, by id and digest,
travel to the shard along with the pages.

Cases: a null html or an empty one is an empty payload and a response; null page_ids sort first, by digest, are written
without an id header and are responses always; rows of one page_id with one payload are all responses if it is the
smallest, else all revisits; of one page_id with several payloads each follows its own digest; an empty table writes no file and returns no rows; a null url is written as empty
URI; line ends in a url are percent-coded; other columns are ignored.
"""

from __future__ import annotations

import base64
from bisect import bisect_right
import hashlib
import io
import zlib

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm import shards
from orrery.llm.common import running_total, store
from orrery.session import scratch_dir

MIN_REVISIT = 100
ROLL_BYTES = 64 << 20
#: A shard should hold a 200th of the html, within these bounds in bytes.
SHARD_PART, SHARD_LEAST, SHARD_MOST = 200, 2 << 20, 512 << 20
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

WRITTEN = pa.schema([("name", pa.string()), ("temporary", pa.string()), ("shard", pa.int64()), ("part", pa.int64()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())])


def pages_of(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(F.col("url"), F.lit("")).alias("url"), payload.alias("payload"))
    return rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))


def revisits(marks: DataFrame) -> DataFrame:
    """(page_id, digest, refers_to) of the pages whose payload a smaller page_id has. marks: (page_id, digest, bytes)."""
    known = marks.where(f"page_id is not null and bytes >= {MIN_REVISIT}").select("page_id", "digest")
    first = known.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.max("page_id").alias("last")).where("refers_to != last").drop("last")
    return known.join(first, "digest").where("page_id != refers_to").select("page_id", "digest", "refers_to").distinct()


def shard_starts(marks: DataFrame, shard_bytes: int) -> list[tuple]:
    """First key (id given?, id or 0, digest) of each shard, in order: some total / shard_bytes of them."""
    sizes = marks.groupBy("page_id", "digest").agg(F.sum("bytes").alias("bytes"))
    running = running_total(sizes, [F.asc_nulls_first("page_id"), F.asc("digest")], "bytes", "upto")
    shard = F.floor((F.col("upto") - F.col("bytes")) / shard_bytes)
    key = F.struct(F.col("page_id").isNotNull().alias("given"), F.coalesce("page_id", F.lit(0)).alias("page_id"), "digest")
    return [(r.at.given, r.at.page_id, bytes(r.at.digest)) for r in running.groupBy(shard.alias("shard")).agg(F.min(key).alias("at")).orderBy("shard").collect()]


def _urn(page_id: int) -> str:
    return f"<urn:page:{page_id}>"


def record(page_id: int | None, url: str, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One record, uncompressed: WARC headers, then an HTTP response; a revisit has the HTTP headers alone."""
    digest = hashlib.sha256(payload).digest()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + (payload if refers_to is None else b"")
    uri = url.replace("\r", "%0D").replace("\n", "%0A")
    own = _urn(page_id) if page_id is not None else f"<urn:sha256:{hashlib.sha256(digest + uri.encode()).hexdigest()}>"
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {own}", f"WARC-Date: {date}", f"WARC-Target-URI: {uri}",
        "Content-Type: application/http;msgtype=response", f"WARC-Payload-Digest: sha256:{base64.b32encode(digest).decode()}",
        f"WARC-Block-Digest: sha256:{base64.b32encode(hashlib.sha256(block).digest()).decode()}", f"Content-Length: {len(block)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def gzip_member(data: bytes) -> bytes:
    """A gzip member without time or name: the same bytes on every run."""
    packer = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = packer.compress(data) + packer.flush()
    return b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\xff" + body + zlib.crc32(data).to_bytes(4, "little") + (len(data) & 0xFFFFFFFF).to_bytes(4, "little")


class ShardWriter:
    """Files of one shard, rolled by compressed size."""

    def __init__(self, base: str, shard: int, roll: int):
        self.base, self.shard, self.roll, self.part, self.stream, self.done = base, shard, roll, 0, None, []

    def add(self, member: bytes) -> None:
        if self.stream is not None and self.size + len(member) > self.roll:
            self.close()
        if self.stream is None:
            self.name = f"pages-{self.shard:08d}-{self.part:05d}.warc.gz"
            self.stream, self.temporary = shards.open_temporary(self.base, self.name)
            self.size = self.records = 0
            self.sha = hashlib.sha256()
        self.stream.write(member)
        self.sha.update(member)
        self.size += len(member)
        self.records += 1

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.done.append((self.name, self.temporary, self.shard, self.part, self.records, self.size, self.sha.hexdigest()))
            self.stream, self.part = None, self.part + 1


def write(pages: DataFrame, base: str, date: str = DATE, roll: int = ROLL_BYTES, shard_bytes: int | None = None) -> DataFrame:
    """Write the archives under ``base``; returns the manifest (name, shard, part, records, bytes, sha256)."""
    rows = pages_of(pages)
    marks = store(rows.select("page_id", "digest", F.length("payload").cast("long").alias("bytes")), "digests")
    total = marks.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    starts = shard_starts(marks, shard_bytes or min(max(total // SHARD_PART, SHARD_LEAST), SHARD_MOST))
    none = F.lit(None)
    both = rows.select("page_id", "digest", F.lit(1).alias("kind"), "url", "payload", none.cast("long").alias("refers_to")).union(
        revisits(marks).select("page_id", "digest", F.lit(0), none.cast("string"), none.cast("binary"), "refers_to")
    )

    @F.pandas_udf("long")
    def shard_of(given: pd.Series, page_id: pd.Series, digest: pd.Series) -> pd.Series:
        return pd.Series([bisect_right(starts, key) - 1 for key in zip(given, page_id, digest, strict=True)], dtype="int64")

    both = both.withColumn("shard", shard_of(F.col("page_id").isNotNull(), F.coalesce("page_id", F.lit(0)), F.col("digest")))

    def run(batches):
        writer, target = None, (None, None, None)
        for b in batches:
            for shard, page_id, digest, kind, url, payload, refers_to in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if kind == 0:
                    target = (page_id, digest, refers_to)
                    continue
                if writer is None or writer.shard != shard:
                    if writer is not None:
                        writer.close()
                        yield shards.batch(writer.done, WRITTEN)
                    writer = ShardWriter(base, shard, roll)
                mine = target[2] if target[:2] == (page_id, digest) else None
                writer.add(gzip_member(record(page_id, url, payload, mine, date)))
        if writer is not None:
            writer.close()
            yield shards.batch(writer.done, WRITTEN)

    tasks = min(max(1, len(starts)), 10_000)
    dealt = both.select("shard", "page_id", "digest", "kind", "url", "payload", "refers_to").repartitionByRange(tasks, "shard").sortWithinPartitions("shard", "page_id", "digest", "kind", "url")
    written = dealt.mapInArrow(run, "name string, temporary string, shard long, part long, records long, bytes long, sha256 string")
    return shards.commit(base, written)


def records(stream):
    """(headers, block) of each record of an open gzip archive, member by member."""
    rest = b""
    while True:
        unpacker, parts = zlib.decompressobj(31), []
        while not unpacker.eof:
            rest = rest or stream.read(1 << 20)
            if not rest:
                if parts:
                    raise ValueError("the archive is cut off")
                return
            parts.append(unpacker.decompress(rest))
            rest = unpacker.unused_data
        data = io.BytesIO(b"".join(parts))
        if not data.readline().startswith(b"WARC/"):
            raise ValueError("no record where one should start")
        headers = {}
        for line in iter(data.readline, b"\r\n"):
            name, _, value = line.decode("utf-8", "surrogatepass").rstrip("\r\n").partition(": ")
            headers[name] = value
        block = data.read(int(headers["Content-Length"]))
        if headers["WARC-Block-Digest"] != f"sha256:{base64.b32encode(hashlib.sha256(block).digest()).decode()}":
            raise ValueError(f"block digest of {headers['WARC-Record-ID']}")
        yield headers, block


READ = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def _page(urn: str | None) -> int | None:
    return int(urn[len("<urn:page:") : -1]) if urn and urn.startswith("<urn:page:") else None


def read(base: str, manifest: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every record of the files in the manifest."""

    def run(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                rows = []
                with shards.open_final(base, name) as stream:
                    for h, block in records(stream):
                        head, _, payload = block.partition(b"\r\n\r\n")
                        size = int(head.rpartition(b"Content-Length: ")[2].split(b"\r\n")[0])
                        digest = base64.b32decode(h["WARC-Payload-Digest"].partition(":")[2]).hex()
                        kind = h["WARC-Type"]
                        if kind == "response" and (len(payload) != size or hashlib.sha256(payload).hexdigest() != digest):
                            raise ValueError(f"payload of {h['WARC-Record-ID']}")
                        rows.append((_page(h["WARC-Record-ID"]), size, digest, kind, _page(h.get("WARC-Refers-To"))))
                        if len(rows) == 4096:
                            yield shards.batch(rows, READ)
                            rows = []
                yield shards.batch(rows, READ)

    return shards.spread(manifest.select("name")).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def write_and_read(pages: DataFrame) -> DataFrame:
    base = scratch_dir(pages.sparkSession, "warc")
    return read(base, write(pages, base))


ORACLE_SQL = f"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN n >= {MIN_REVISIT} AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN n >= {MIN_REVISIT} AND page_id > first THEN first END AS refers_to FROM f
"""
