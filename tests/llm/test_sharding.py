"""Rendezvous sharding."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from docsentinel.llm.sharding import assign_shards, op9_rendezvous


def test_edge_rows(edge_docs, edge_rows):
    rows = assign_shards(edge_docs, [1.0] * 5).collect()
    want = Counter((k, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t, *_ in edge_rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    for s in range(5):
        slots = sorted(r["slot"] for r in rows if r["shard"] == s)
        assert slots == list(range(len(slots)))


def test_more_shards_take_rows_only_into_the_new_one(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    rows = assign_shards(docs, [1.0] * 7).collect()
    assert all(r["grown_shard"] in (r["shard"], 7) for r in rows)
    assert 350 < sum(r["grown_shard"] == 7 for r in rows) < 650
    again = {r["doc_id"]: r["shard"] for r in assign_shards(docs, [1.0] * 8).collect()}
    assert all(again[r["doc_id"]] == r["grown_shard"] for r in rows)


def test_weights_null_keys_and_empty_table(spark, null_key_docs, no_docs):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    count = Counter(r["shard"] for r in assign_shards(docs, [1.0, 3.0]).collect())
    assert 0.72 < count[1] / 6000 < 0.78
    assert len({r["shard"] for r in assign_shards(null_key_docs, [1.0] * 9).collect() if r["doc_id"] is None}) == 1
    assert assign_shards(no_docs, [1.0]).collect() == []
    with pytest.raises(ValueError):
        assign_shards(no_docs, [1.0, 0.0])


def test_query_uses_no_python_on_the_executors(spark):
    from tests.conftest import SF_SMALL

    plan = op9_rendezvous(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
