"""The pipeline, stage by stage, and the queries as a whole."""

from __future__ import annotations

import re

import corpus_pipeline
import __spark_entry__ as spec
from starmart.llm import minhash, queries, tables, winnow

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, found = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = tables.written(stage(spark, docs, SF_DIR), f"stage-{name}")
        found[name] = (docs, out)
        docs = out
    assert [out.columns for _, out in found.values()] == [columns] * 4 + [[*columns, "slot", "shard"]]
    before, after = found["language"]
    lettered = [r.doc_id for r in before.collect() if r.text and re.search("[a-z\\x80-\\U0010ffff]", r.text.lower())]
    assert sorted(r.doc_id for r in after.collect()) == sorted(lettered)
    before, after = found["near_copies"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in minhash.near_copies(before).where("kept").collect()}
    before, after = found["contamination"]
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in winnow.contamination(before, bench).where("NOT contaminated").collect()}
    before, after = found["mixture"]
    assert {r.doc_id for r in after.collect()} <= {r.doc_id for r in before.collect()}
    before, after = found["shards"]
    assert after.count() == before.count()
    assert [tuple(r) for r in corpus_pipeline.run(spark, SF_DIR).orderBy("doc_id", "shard").select("doc_id", "shard").collect()] == [
        tuple(r) for r in after.orderBy("doc_id", "shard").select("doc_id", "shard").collect()
    ]


def test_every_operator_is_registered_once():
    numbers = sorted(int(re.match(r"op(\d+)_", name)[1]) for name in queries.QUERIES)
    assert numbers == list(range(1, 14)) and {*queries.QUERIES, "pipeline"} <= set(spec.queries())
