"""Registered queries against their SQL, and the pipeline against a plain version of each stage."""

import duckdb
import pytest

import __spark_entry__
import corpus_pipeline
from orrery.llm import decontaminate, jaccard, mixing, quality, tokens
from orrery.llm.common import store
from orrery.llm.queries import ORACLES, QUERIES
from tests.llm.test_near_duplicates import brute
from tools.check import TABLES, rows_of

D = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{D}/{t}.parquet'")
    assert rows_of(QUERIES[name](spark, D).toPandas()) == rows_of(con.execute(ORACLES[name]).df())


def test_every_operator_is_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14)) and set(QUERIES) <= names


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{D}/documents.parquet")
    bench = spark.read.parquet(f"{D}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality classifier", "n-gram jaccard join", "benchmark decontamination", "mixing to target weights", "token files"]
    before = docs
    for name, stage in corpus_pipeline.STAGES:
        after = store(stage(spark, before, D), "stage")
        rows, kept = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
        if name != "token files":
            assert after.schema.names == docs.schema.names and all(kept[i] == rows[i] for i in kept)
        if name == "quality classifier":
            model = quality.fit(before, spark.read.parquet(f"{D}/labels.parquet"))
            assert set(kept) == {r.doc_id for r in quality.score(before, model).collect() if r.score >= 0.7}
        elif name == "n-gram jaccard join":
            ids = sorted(rows)
            top = brute([rows[i].text for i in ids])[1]
            assert set(kept) == {ids[k] for k, t in enumerate(top) if k == t}
        elif name == "benchmark decontamination":
            grams = {tuple(w[k : k + 8]) for r in bench.collect() for w in [decontaminate.tokens(r.text)] for k in range(len(w) - 7)}
            dirty = {i for i, r in rows.items() for w in [decontaminate.tokens(r.text)] if any(tuple(w[k : k + 8]) in grams for k in range(len(w) - 7))}
            assert set(rows) - set(kept) == {r.doc_id for r in decontaminate.find_overlaps(before, bench).collect()} and dirty <= set(rows) - set(kept)
        elif name == "mixing to target weights":
            assert set(kept) == {r.row.doc_id for r in mixing.mix(before).collect() if r.kept} and 0 < len(kept) < len(rows)
        else:
            ids = tokens.Tokens(tokens.public_tokenizers.path("word_bpe_49k.json"))
            start = 0
            for i in sorted(rows):
                n = len(next(ids.encode([rows[i].text]))) // 4 + 1
                assert (kept[i].start, kept[i].n_tokens) == (start, n)
                start += n
        before = after
    assert sorted(map(str, corpus_pipeline.run(spark, D).select("doc_id", "start", "n_tokens").collect())) == sorted(map(str, before.select("doc_id", "start", "n_tokens").collect()))


def test_classes_of_the_join_are_those_of_brute_force(spark):
    rows = sorted(spark.read.parquet(f"{D}/documents.parquet").select("doc_id", "text").collect())
    links, top = brute([r.text for r in rows])
    got = {r.doc_id: r for r in jaccard.jaccard_join(spark.read.parquet(f"{D}/documents.parquet")).collect()}
    assert [(got[r.doc_id].class_id, got[r.doc_id].links) for r in rows] == [(rows[top[k]].doc_id, links[k]) for k in range(len(rows))]
