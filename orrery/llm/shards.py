"""Files that tasks write to the shared folder: temporary names first, then a commit by manifest.

A task writes under a name of its own, so attempts that fail, repeat or race never touch each other's files. The
rows that Spark returns name the files of the successful attempts; only these are moved to their final names, and
only the manifest says what belongs to the output. Moving is idempotent, so a lost executor may repeat it.
"""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame

from orrery.llm.common import store


def system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder named by URI or absolute path."""
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def open_temporary(base: str, name: str):
    """(stream, temporary name) for a file that will be called ``name``."""
    fs, root = system(base)
    temporary = f"_temporary/{name}.{uuid.uuid4().hex}"
    fs.create_dir(os.path.dirname(f"{root}/{temporary}"), recursive=True)
    return fs.open_output_stream(f"{root}/{temporary}", compression=None), temporary


def open_final(base: str, name: str):
    fs, root = system(base)
    return fs.open_input_file(f"{root}/{name}")


def commit(base: str, written: DataFrame) -> DataFrame:
    """Move the files named by ``written`` (name, temporary, ...) into place; returns the stored manifest.

    ``written`` is stored first: from then on its files are settled, whatever is recomputed later.
    """
    settled = store(written, "written")
    k, t = settled.columns.index("name"), settled.columns.index("temporary")

    def move(batches):
        fs, root = system(base)
        for b in batches:
            for name, temporary in zip(b.column(k).to_pylist(), b.column(t).to_pylist(), strict=True):
                source, target = f"{root}/{temporary}", f"{root}/{name}"
                if fs.get_file_info(source).type == pafs.FileType.File:
                    fs.create_dir(os.path.dirname(target), recursive=True)
                    fs.move(source, target)
                elif fs.get_file_info(target).type != pafs.FileType.File:
                    raise FileNotFoundError(target)
            yield b

    done = settled.mapInArrow(move, settled.schema).drop("temporary")
    done.write.parquet(f"{base}/_manifest")
    return settled.sparkSession.read.schema(done.schema).parquet(f"{base}/_manifest")


def spread(manifest: DataFrame) -> DataFrame:
    """Manifest rows dealt out over tasks, a file each as far as the cluster goes."""
    return manifest.repartition(max(manifest.sparkSession.sparkContext.defaultParallelism, min(manifest.count(), 10_000)))


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
