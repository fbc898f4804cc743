"""Registered queries of the subpackage, with their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.llm import chat, decontaminate, fingerprint, htmltext, infill, jaccard, mixing, quality, resampling, substrings, tokens, toxicity, warc
from orrery.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprint.fingerprints(table(spark, sf_dir, "documents"))


ORACLES["op1_document_fingerprints"] = fingerprint.ORACLE_SQL


@query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class and number of links of every document: five-word shingles, similarity 0.8 or more."""
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"), 0.8)


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of documents that other documents repeat, and which of them go."""
    return substrings.repeats(table(spark, sf_dir, "documents"))


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of every document with benchmark items, tolerant of substituted words."""
    return decontaminate.find_overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query
def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, written as range-coded files and read back."""
    return tokens.write_and_read(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of the archives, read back from them."""
    return warc.write_and_read(table(spark, sf_dir, "pages"))


ORACLES["op7_warc"] = warc.ORACLE_SQL


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raked weight, sampling chance and draw of every document."""
    m = mixing.mix(table(spark, sf_dir, "documents"))
    return m.select("row.doc_id", "source", "lang", "topic", F.col("n").alias("tokens"), F.round("weight", 5).alias("weight"), F.round("p", 5).alias("p"), "kept")


ORACLES["op8_mixing"] = mixing.ORACLE_SQL


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.score(docs, model).withColumn("predicted", (F.col("score") >= 0.7).cast("int"))


@query
def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Visible text of every page."""
    return htmltext.extract(table(spark, sf_dir, "pages"))


@query
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut and rearranged text of every document, and the text restored from it, as digests."""
    return infill.digests(table(spark, sf_dir, "documents"))


ORACLES["op11_fill_in_middle"] = infill.ORACLE_SQL


@query
def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight, score and rank of every document in the draw towards the benchmark's words."""
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op12_importance_resampling"] = resampling.ORACLE_SQL


@query
def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation and one of control strings, formatted and read back."""
    return chat.read_back(chat.format_chats(chat.with_check(table(spark, sf_dir, "conversations"))))


ORACLES["op13_chat_formatting"] = chat.ORACLE_SQL
