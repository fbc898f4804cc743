"""From documents to token files: quality, near duplicates, decontamination, mixing, output.

Each stage works on all rows its predecessor kept. Stages but the last return the columns of ``documents``; their
results are written as Parquet to the shared folder and read back as the next stage's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.llm import decontaminate, jaccard, mixing, quality, tokens
from orrery.llm.common import store
from orrery.session import prepare


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the quality classifier rejects (score under 0.7) go."""
    return quality.keep_good(docs, quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies the smallest id stays."""
    return jaccard.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A draw of documents, half of the tokens, raked to source, language and topic."""
    return mixing.sample(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the documents, written to files and read back."""
    return tokens.write_and_read(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("n-gram jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("mixing to target weights", mix_sources),
    ("token files", write_tokens),
]

#: A classifier fit and a hash-based join have no SQL form; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
