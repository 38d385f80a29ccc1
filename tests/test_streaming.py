"""Streaming ingest vs. the batch high-water mark on a late-arriving event."""

import datetime as dt

from docsentinel.plans import incremental as INC
from docsentinel.plans.fixture_queries import CFG
from docsentinel.session import work_path
from docsentinel.sources.schemas import RAW_CONTROLLED
from docsentinel.streaming import ingest_controlled

CTL = '[{"identifier":"Document.DateValidation","status":"OK"}]'
FACE = '[{"id":"f1","type":"recto","domain":"kyc","organizationId":"client 1"}]'


def _raw(spark, rows):
    data = [(i, d, CTL, FACE, "APPLIED", t, "standard", t) for i, d, t in rows]
    return spark.createDataFrame(data, RAW_CONTROLLED)


def test_stream_loads_late_file_that_the_mark_skips(spark):
    t = [dt.datetime(2001, 7, d) for d in (1, 2, 3)]
    first = [("e1", "d1", t[0]), ("e2", "d1", t[2])]
    late = [("e3", "d2", t[1]), ("e4", "d2", dt.datetime(2001, 7, 4))]  # e3 is older than the loaded maximum
    root = work_path(spark, "test", "stream", unique=True)

    _raw(spark, first).write.parquet(f"{root}/landing/part=1")
    ingest_controlled(spark, f"{root}/landing", f"{root}/stream_table", f"{root}/_ckpt", CFG)
    _raw(spark, late).write.parquet(f"{root}/landing/part=2")
    ingest_controlled(spark, f"{root}/landing", f"{root}/stream_table", f"{root}/_ckpt", CFG)
    streamed = INC.read_without_partition(INC.controlled_table(spark, f"{root}/stream_table"))
    assert sorted(r["event_id"] for r in streamed.collect()) == ["e1", "e2", "e3", "e4"]
    # a rerun with nothing new landed changes nothing
    ingest_controlled(spark, f"{root}/landing", f"{root}/stream_table", f"{root}/_ckpt", CFG)
    assert INC.read_without_partition(INC.controlled_table(spark, f"{root}/stream_table")).count() == 4

    batch_path = f"{root}/batch_table"
    INC.load_controlled(spark, batch_path, _raw(spark, first), CFG)
    INC.load_controlled(spark, batch_path, _raw(spark, first + late), CFG)
    batched = INC.read_without_partition(INC.controlled_table(spark, batch_path))
    assert sorted(r["event_id"] for r in batched.collect()) == ["e1", "e2", "e4"]  # strict mark skips e3


def test_only_repeated_events_are_grouped(spark):
    from docsentinel.operators.dedupe import latest_per_key, latest_where_repeated, repeated_hashes

    rows = [("a", 1), ("a", 3), ("b", 2), (None, 1), (None, 2), ("c", None), ("c", None), ("d", 5)]
    df = spark.createDataFrame(rows, "k string, v int")
    repeated = spark.createDataFrame(repeated_hashes(df, ["k"]).collect(), "_hash long")
    assert repeated.count() == 3
    found = latest_where_repeated(df, ["k"], ["v"], repeated)
    assert sorted(map(str, found.collect())) == sorted(map(str, latest_per_key(df, ["k"], ["v"]).collect()))
    # equal hashes of other keys change nothing
    every = df.selectExpr("xxhash64(k) AS _hash").distinct()
    assert sorted(map(str, latest_where_repeated(df, ["k"], ["v"], every).collect())) == sorted(map(str, found.collect()))


def test_stream_of_single_events_groups_no_whole_rows(spark, monkeypatch):
    from docsentinel.sources.tables import VersionedTable

    plans, upsert = [], VersionedTable.upsert

    def seen(self, batch, *args):
        plans.append(batch._jdf.queryExecution().optimizedPlan().toString())
        return upsert(self, batch, *args)

    monkeypatch.setattr(VersionedTable, "upsert", seen)
    t = dt.datetime(2001, 7, 1)
    root = work_path(spark, "test", "stream", unique=True)
    for part, rows in enumerate(([("e1", "d1", t), ("e2", "d1", t)], [("e3", "d2", t), ("e3", "d3", t + dt.timedelta(1))])):
        _raw(spark, rows).write.parquet(f"{root}/landing/part={part}")
        ingest_controlled(spark, f"{root}/landing", f"{root}/table", f"{root}/_ckpt", CFG)
    assert ["Aggregate" in p for p in plans] == [False, True]
    got = INC.read_without_partition(INC.controlled_table(spark, f"{root}/table")).select("event_id", "document_id").collect()
    assert sorted(map(tuple, got)) == [("e1", "d1"), ("e2", "d1"), ("e3", "d3")]
