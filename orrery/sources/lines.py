"""Text files as (file, line_no, value) rows, and helpers for fixed-width fields.

Files are read in splits like any other: plain ones of any size block by block, compressed ones one to a task. A line's
number is the lines of all earlier blocks of its file plus its position within its own block, so numbers run through
a file however it was split, and what parsers carry from line to line crosses block borders by number. LF, CRLF and CR
end a line; a byte order mark at the start of a file is not part of its first line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orrery.operators.scan import slot
from orrery.session import cut

CHUNK = 65_536
#: Blocks up to which their counts are broadcast to the lines; beyond, both sides are shuffled by block.
BROADCAST_BLOCKS = 1_000_000


def _positions(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, block, at, value): ``at`` grows with the position in a block; which block a task reads follows from the
    files and the settings alone, so two passes agree."""
    raw = spark.read.option("recursiveFileLookup", True).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")


def read_decoded(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value, note): numbered lines of all files below a path, undecodable bytes replaced, their file noted."""
    raw = _positions(spark, path)
    blocks = raw.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"), F.max(~F.is_valid_utf8("value")).alias("bad"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    note = F.when(F.max("bad").over(Window.partitionBy("file")), "non_utf8_sanitized_copy").otherwise("")
    blocks = cut(blocks.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"), note.alias("note")))
    blocks = F.broadcast(blocks) if blocks.count() <= BROADCAST_BLOCKS else blocks.hint("merge")
    return raw.join(blocks, ["file", "block"]).select("file", (F.col("at") + F.col("shift")).alias("line_no"), F.make_valid_utf8("value").alias("value"), "note")


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, line_no, value) of all lines of all files below a path."""
    return read_decoded(spark, path).drop("note")


def chunk_of(width: int = CHUNK) -> Column:
    return slot("line_no", width)


def cols(line: Column, first: int, last: int) -> Column:
    """1-based inclusive column slice."""
    return F.substring(line, first, last - first + 1)


def digits(c: Column) -> Column:
    return c.rlike(r"^\d+$")


def number(c: Column, kind: str = "double") -> Column:
    return F.trim(c).try_cast(kind)


def ledger(parsed: DataFrame, by: list[str], reason: str = "reject_reason") -> DataFrame:
    """Counts per file and reason; NULL means accepted."""
    return parsed.groupBy(*by, F.coalesce(F.col(reason), F.lit("accepted")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))
