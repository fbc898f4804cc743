"""Tabular provider files: alias-tolerant CSV, constellation tables, configuration, bounds and pruning."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyarrow import fs as pafs
from pyarrow import parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.ids import clean_entity_id
from orrery.functions.time import micros, parse_utc
from orrery.operators.dedup import keep_one
from orrery.operators.names import canonical, melt


def read_aliased_csv(spark: SparkSession, path: str, aliases: dict[str, str], schema: dict[str, str]) -> DataFrame:
    """CSV with provider headings brought to the canonical schema; read as text, so nothing is inferred."""
    return canonical(spark.read.csv(path, header=True), aliases, schema)


def read_ephemeris_csv(spark: SparkSession, path: str, name_filter: str, start_us: int, end_us: int, ids: DataFrame | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Constellation ephemerides in SI units, their auxiliary fields as long rows, and the coercion failures.

    Repeated (entity, epoch) rows keep the first by file name.
    """
    raw = spark.read.csv(path, header=True).withColumn("source_file", F.col("_metadata.file_name"))
    raw = raw.where(F.upper("Satellite_Name").contains(name_filter)).withColumns({"entity_id": clean_entity_id(F.col("Satellite_Number")), "t": micros(parse_utc(F.col("Timestamp")))})
    raw = raw.where((F.col("t") >= start_us) & (F.col("t") <= end_us))
    if ids is not None:
        raw = raw.join(ids.select("entity_id"), "entity_id", "left_semi")
    fields = {"X": "x_m", "Y": "y_m", "Z": "z_m", "Vx": "vx_mps", "Vy": "vy_mps", "Vz": "vz_mps"}
    failed = [F.count_if((F.trim(c) != "") & F.col(c).try_cast("double").isNull()) for c in fields]
    total = failed[0]
    for f in failed[1:]:
        total = total + f
    failures = raw.groupBy("source_file").agg(total.alias("numeric_failures"))
    states = raw.select("entity_id", "t", "source_file", *[(F.col(c).try_cast("double") * 1000.0).alias(n) for c, n in fields.items()])
    states = keep_one(states, ["entity_id", "t"], ["source_file", "x_m", "y_m", "z_m"])
    aux = [c for c in raw.columns if c.startswith("High_Order_")]
    long = melt(raw.select("entity_id", "t", "source_file", *[F.col(c).try_cast("double").alias(c) for c in aux]), ["entity_id", "t", "source_file"], "High_Order_")
    return states, keep_one(long, ["entity_id", "t", "auxiliary_field"], ["source_file", "auxiliary_value"]), failures


def element_csv(raw: DataFrame, name_filter: str, *, release: bool) -> DataFrame:
    """Constellation elements. Interim: name contains, text id. Release: name starts with, integer id, NULL ids dropped."""
    up = F.upper("Satellite_Name")
    ident = clean_entity_id(F.col("Satellite_Number"))
    x = raw.where(up.startswith(name_filter) if release else up.contains(name_filter)).withColumn("entity_id", ident.try_cast("bigint") if release else ident)
    if release:
        x = x.where("entity_id is not null")
    x = x.select("entity_id", micros(parse_utc(F.col("Timestamp"))).alias("t"), F.col("Mean_Motion").try_cast("double").alias("mean_motion"), F.col("Inclination").try_cast("double").alias("inclination"), "source_file")
    return keep_one(x, ["entity_id", "t"], ["source_file", "mean_motion"])


def read_config_targets(spark: SparkSession, path: str, batches: Sequence[str], *, multi_line: bool = True) -> DataFrame:
    """Targets of the wanted batches with their enabled sources."""
    raw = spark.read.json(path, multiLine=multi_line)
    t = raw.select(F.explode("targets").alias("t")).select("t.*").where(F.col("batch").isin(*batches))
    return t.withColumn("sources", F.transform(F.filter("sources", lambda s: s["enabled"]), lambda s: s["name"]))


def read_time_lists(spark: SparkSession, path: str) -> DataFrame:
    """External event times: one document per target with a list of moments."""
    raw = spark.read.json(path)
    return raw.select("entity_id", F.explode("timestamps").alias("x")).select("entity_id", micros(parse_utc(F.col("x"))).alias("xt"))


def footer_bounds(spark: SparkSession, path: str, t: str = "t", entity: str = "entity_id") -> DataFrame:
    """(path, entity, start_t, end_t, rows) for every file below a folder and every entity in it.

    A row group that holds one entity is answered by its footer's statistics; only a group where entities meet, or one
    without statistics, is read, its two columns alone. Files sorted by (entity, t) thus need no folder for each entity.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    schema = pa.schema([("path", pa.string()), (entity, pa.int64()), ("start_t", pa.int64()), ("end_t", pa.int64()), ("rows", pa.int64())])

    def group_rows(file, i: int) -> pa.Table:
        chunks = file.metadata.row_group(i)
        stats = {chunks.column(c).path_in_schema: chunks.column(c).statistics for c in range(chunks.num_columns)}
        e, s = stats[entity], stats[t]
        known = all(x is not None and x.has_min_max and x.has_null_count for x in (e, s))
        if known and e.null_count == 0 and e.min == e.max:
            return pa.table({entity: [e.min], "start_t": [s.min], "end_t": [s.max], "rows": [chunks.num_rows]})
        found = file.read_row_group(i, columns=[entity, t]).group_by(entity).aggregate([(t, "min"), (t, "max"), ([], "count_all")])
        return pa.table({entity: found[entity], "start_t": found[f"{t}_min"], "end_t": found[f"{t}_max"], "rows": found["count_all"]})

    def read(batches):
        for b in batches:
            for uri in b.column(0).to_pylist():
                fs, name = pafs.FileSystem.from_uri(uri)
                with fs.open_input_file(name) as f:
                    file = pq.ParquetFile(f)
                    for i in range(file.num_row_groups):
                        found = group_rows(file, i)
                        found = found.add_column(0, "path", pa.array([uri] * found.num_rows, pa.string()))
                        yield from found.cast(schema).to_batches()

    return listed.mapInArrow(read, f"path string, {entity} bigint, start_t bigint, end_t bigint, rows bigint")


def full_window(bounds: DataFrame, start_us: int, end_us: int) -> DataFrame:
    """Whether the files of an entity span the whole window."""
    return bounds.groupBy("entity_id").agg(F.min("start_t").alias("start_t"), F.max("end_t").alias("end_t"), F.sum("rows").alias("rows")).withColumn(
        "has_full_window", (F.col("start_t") <= start_us) & (F.col("end_t") >= end_us)
    )


def pruned_days(df: DataFrame, day: Column, start: Column, end: Column) -> DataFrame:
    """Day files from two days before the start to one day after the end: a partition filter."""
    return df.where((day >= F.date_sub(start, 2)) & (day <= F.date_add(end, 1)))
