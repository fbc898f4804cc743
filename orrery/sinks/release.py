"""Release outputs: snapshots, CSV and JSON tables, manifest, name map, dictionary, label bundle."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orrery.functions.time import normalise_iso_text

#: Bytes hashed at a time.
PIECE = 4 << 20


#: Hash buckets of a snapshot: folders stay few however many entities there are.
BUCKETS = 64


def bucket_of(entity: str = "entity_id", buckets: int = BUCKETS) -> Column:
    """Bucket of an entity, from the first 60 bits of an md5 of its text."""
    return (F.conv(F.substring(F.md5(F.col(entity).cast("string")), 1, 15), 16, 10).cast("bigint") % buckets).cast("int")


def write_snapshot(df: DataFrame, path: str, entity: str = "entity_id", t: str = "t", *, max_rows: int = 5_000_000, buckets: int = BUCKETS) -> None:
    """zstd parquet in hash buckets of the entity, each file in order of entity and time.

    Range partitioning on (bucket, entity, time) splits a dominant entity over many tasks and files; readers prune
    by ``bucket`` and, within files, by the row groups' bounds of the entity.
    """
    x = df.withColumn("bucket", bucket_of(entity, buckets))
    x.repartitionByRange("bucket", entity, t).sortWithinPartitions("bucket", entity, t).write.partitionBy("bucket").option("maxRecordsPerFile", max_rows).option("compression", "zstd").mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str, *, gzip: bool = False, by: Sequence[str] = ()) -> None:
    """Header CSV, optionally gzipped and split by target."""
    w = df.write.mode("overwrite").option("header", True).option("compression", "gzip" if gzip else "none")
    (w.partitionBy(*by) if by else w).csv(path)


def sorted_json(df: DataFrame) -> Column:
    """One JSON text per row with keys in sorted order."""
    return F.to_json(F.struct(*sorted(df.columns)))


def write_jsonl(df: DataFrame, path: str) -> None:
    df.select(sorted_json(df).alias("value")).write.mode("overwrite").text(path)


def manifest(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """Name, bytes, SHA-256 and row count of every file below a folder.

    Files are listed without their content and hashed piece by piece, so they may have any size. Row counts come
    from a column-free scan.
    """
    inside = lambda c: F.substring_index(c, path.rstrip("/") + "/", -1)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("bytes"))

    def digest(batches):
        for b in batches:
            hashes = []
            for uri in b.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(uri)
                h = hashlib.sha256()
                with fs.open_input_stream(name, compression=None) as stream:
                    while piece := stream.read(PIECE):
                        h.update(piece)
                hashes.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(hashes, pa.string())], ["path", "bytes", "sha256"])

    hashed = listed.mapInArrow(digest, "path string, bytes bigint, sha256 string").withColumn("path", inside(F.col("path")))
    rows = spark.read.option("recursiveFileLookup", True).parquet(path).groupBy(inside(F.col("_metadata.file_path")).alias("path")).agg(F.count(F.lit(1)).alias("rows"))
    return hashed.join(rows, "path", "left").na.fill(0, ["rows"])


def verify(copy: DataFrame, original: DataFrame) -> DataFrame:
    """Files missing or different in a copy, by relative path."""
    a = original.select("path", F.col("sha256").alias("want"))
    b = copy.select("path", F.col("sha256").alias("got"))
    return a.join(b, "path", "full_outer").where(~F.col("want").eqNullSafe(F.col("got")))


def flat_names(paths: DataFrame, path: str = "path") -> DataFrame:
    """Logical path -> flat name; ``collision`` marks names that two paths share."""
    flat = paths.withColumn("flat", F.array_join(F.split(path, "/"), "__"))
    twice = flat.groupBy("flat").agg((F.count(F.lit(1)) > 1).alias("collision"))
    return flat.join(twice, "flat")


def first_entities(df: DataFrame, n: int = 25, entity: str = "entity_id") -> DataFrame:
    """Rows of the n alphabetically first entities (a sample table of the release)."""
    ids = df.select(F.col(entity).cast("string").alias("_e")).distinct().orderBy("_e").limit(n)
    return df.withColumn("_e", F.col(entity).cast("string")).join(ids, "_e", "left_semi").drop("_e")


def data_dictionary(tables: dict[str, DataFrame]) -> DataFrame:
    """Table x field x type x unit with row and non-null counts, from the live schemas."""
    out = None
    for name, df in tables.items():
        n = df.agg(F.count(F.lit(1)).alias("rows"), *[F.count(c).alias(f"n_{i}") for i, c in enumerate(df.columns)])
        unit = lambda f: next((u for s, u in (("_m", "m"), ("_mps", "m/s"), ("_rad", "rad"), ("_s", "s"), ("_km", "km")) if f.name.endswith(s)), "")
        time = lambda f: "ISO-8601 UTC" if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) else ""
        rows = F.array(*[F.struct(F.lit(name).alias("table"), F.lit(f.name).alias("field"), F.lit(f.dataType.simpleString()).alias("type"), F.lit(unit(f)).alias("unit"), F.lit(time(f)).alias("time_format"), F.col(f"n_{i}").alias("non_null"), F.col("rows")) for i, f in enumerate(df.schema.fields)])
        part = n.select(F.explode(rows).alias("r")).select("r.*")
        out = part if out is None else out.unionByName(part)
    return out


def canonicalise_csv(spark: SparkSession, path: str, time_columns: Sequence[str]) -> None:
    """Rewrite the time columns of a CSV table to ISO form: staged write, then the folder is swapped by rename.

    Staged and set-aside folders get a name of their own on every run. A rename that fails raises, and the table
    is put back; the old table is deleted only once the new one is in place.
    """
    df = spark.read.csv(path, header=True)
    missing = set(time_columns) - set(df.columns)
    if missing:
        raise ValueError(f"time columns not in the table: {sorted(missing)}")
    run = uuid.uuid4().hex
    new, keep, old = (spark._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + end) for end in (f"_staged_{run}", f"_previous_{run}", ""))
    df.withColumns({c: normalise_iso_text(F.col(c)) for c in time_columns}).write.option("header", True).csv(new.toString())
    fs = new.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.rename(old, keep):
        raise OSError(f"{path} cannot be set aside")
    if not fs.rename(new, old):
        back = fs.rename(keep, old)
        raise OSError(f"the new table cannot take the place of {path}; the old one is {'back' if back else 'at ' + keep.toString()}")
    fs.delete(keep, True)


def label_bundle(parts: Sequence[DataFrame], targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-target label tables in one, without ``split``, and the targets that had no input."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    out = out.drop("split")
    return out, targets.join(out.select("entity_id"), "entity_id", "left_anti")
