"""Readers and versioned tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from docsentinel.session import work_path
from docsentinel.sources import RAW_CONTROLLED, RAW_CREATED, read_raw_controlled, read_raw_created
from docsentinel.sources import tables as TB

D1, D2 = dt.date(2001, 1, 1), dt.date(2001, 1, 2)
SCHEMA = "k string, v int, d date"


@pytest.fixture
def table(spark):
    path = work_path(spark, "test", "versioned", unique=True)
    return TB.VersionedTable(spark, path, key="k", partition_col="d")


def rows(table):
    return sorted(((r["k"], r["v"], r["d"]) for r in table.read().collect()), key=str)


def test_readers_use_the_declared_schemas(spark):
    root = work_path(spark, "test", "raw", unique=True)
    spark.createDataFrame([], RAW_CONTROLLED).write.parquet(f"{root}/co")
    spark.createDataFrame([], RAW_CREATED).write.parquet(f"{root}/cr")
    assert read_raw_controlled(spark, f"{root}/co").schema.names == RAW_CONTROLLED.names
    assert read_raw_created(spark, f"{root}/cr").schema.names == RAW_CREATED.names


def test_upsert_moves_a_key_across_partitions(spark, table):
    """A re-delivered key in another day replaces its old copy (lookup by key)."""
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 2, D1)], SCHEMA))
    table.upsert(spark.createDataFrame([("a", 3, D2)], SCHEMA))
    assert rows(table) == [("a", 3, D2), ("b", 2, D1)]
    table.upsert(spark.createDataFrame([], SCHEMA))  # empty batch: no change
    assert table.read().count() == 2
    table.upsert(spark.createDataFrame([("b", 4, D2)], SCHEMA))
    assert rows(table) == [("a", 3, D2), ("b", 4, D2)]
    assert table.partition_values() == [str(D2)]


def test_null_partition_is_kept_and_left_out_of_the_mark(spark, table):
    table.upsert(spark.createDataFrame([("n1", 1, None), ("a", 9, D1)], SCHEMA))
    table.upsert(spark.createDataFrame([("n2", 2, None)], SCHEMA))
    assert rows(table) == [("a", 9, D1), ("n1", 1, None), ("n2", 2, None)]
    assert table.max_in_last_partition("v") == 9
    table.upsert(spark.createDataFrame([("n1", 3, D2)], SCHEMA))
    assert rows(table) == [("a", 9, D1), ("n1", 3, D2), ("n2", 2, None)]


def test_empty_first_load_is_a_table(spark, table):
    assert table.read() is None and not table.exists() and table.max_in_last_partition("v") is None
    table.upsert(spark.createDataFrame([], SCHEMA))
    assert table.exists() and rows(table) == [] and table.max_in_last_partition("v") is None
    table.upsert(spark.createDataFrame([("a", 1, D1)], SCHEMA))
    assert rows(table) == [("a", 1, D1)]


@pytest.mark.parametrize("step", ["stage", "_create_manifest"])
def test_a_job_lost_before_the_swap_changes_nothing(spark, table, monkeypatch, step):
    """The write is killed before or after the data is staged; a rerun reaches the same table."""
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 2, D2)], SCHEMA))
    batch = spark.createDataFrame([("a", 5, D2), ("c", 6, D1)], SCHEMA)
    real = getattr(TB.VersionedTable, step)

    def lost(self, *args):
        if step == "stage":
            real(self, *args)
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(TB.VersionedTable, step, lost)
        with pytest.raises(RuntimeError, match="lost"):
            table.upsert(batch)
    assert rows(table) == [("a", 1, D1), ("b", 2, D2)]
    table.upsert(batch)
    assert rows(table) == [("a", 5, D2), ("b", 2, D2), ("c", 6, D1)]


def test_schema_change_rewrites_only_touched_partitions(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 2, D2)], SCHEMA))
    before = table._manifest()["folders"]
    table.upsert(spark.createDataFrame([("c", "x", D2)], "k string, w string, d date"), "sync_all_columns")
    after = table._manifest()["folders"]
    assert after[str(D1)] == before[str(D1)] and after[str(D2)] != before[str(D2)]
    assert sorted(map(tuple, table.read().select("k", "w").collect())) == [("a", None), ("b", None), ("c", "x")]
    assert sorted(table.read().columns) == ["d", "k", "w"]
    # a column that comes back does not bring its old values back
    table.upsert(spark.createDataFrame([("c", "y", 7, D2)], "k string, w string, v int, d date"), "append_new_columns")
    assert sorted(map(tuple, table.read().select("k", "v").collect())) == [("a", None), ("b", None), ("c", 7)]


def test_only_one_job_can_write_a_version(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, D1)], SCHEMA))
    other = TB.VersionedTable(spark, table.path, key="k", partition_col="d")
    late = table.merge(spark.createDataFrame([("c", 3, D1)], SCHEMA), "ignore", table.version())
    other.upsert(spark.createDataFrame([("b", 2, D1)], SCHEMA))
    with pytest.raises(TB.ConcurrentWrite):
        table.publish(late)
    with pytest.raises(TB.ConcurrentWrite, match="another job"):
        table._create_manifest(2, "{}")
    assert rows(other) == [("a", 1, D1), ("b", 2, D1)]


def test_interleaved_upserts_keep_both_jobs_rows(spark, table):
    """Each job publishes between the other's read and its commit."""
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 1, D1)], SCHEMA))
    other = TB.VersionedTable(spark, table.path, key="k", partition_col="d")
    batches = iter([[("b", 2, D1), ("x", 2, D2)], [("y", 3, D1)]])
    tried = []

    def merge(version):
        change = table.merge(spark.createDataFrame([("a", 9, D1), ("c", 9, D2)], SCHEMA), "ignore", version)
        tried.append(version)
        for batch in [next(batches, None)]:
            if batch:
                other.upsert(spark.createDataFrame(batch, SCHEMA))
        return change

    table.change(merge)
    assert tried == [1, 2, 3]
    assert rows(table) == [("a", 9, D1), ("b", 2, D1), ("c", 9, D2), ("x", 2, D2), ("y", 3, D1)]


def test_writers_in_threads_lose_no_row(spark, table):
    from concurrent.futures import ThreadPoolExecutor

    def job(n):
        mine = TB.VersionedTable(spark, table.path, key="k", partition_col="d")
        mine.upsert(spark.createDataFrame([(f"k{n}", n, D1 if n % 2 else D2)], SCHEMA))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(job, range(4)))
    assert rows(table) == [(f"k{n}", n, D1 if n % 2 else D2) for n in range(4)]


def test_a_reader_of_a_replaced_version_still_ends(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, D1)], SCHEMA))
    early = table.read()
    for n in range(2, 5):
        table.upsert(spark.createDataFrame([("a", n, D1)], SCHEMA))
    assert [r["v"] for r in early.collect()] == [1]
    assert rows(table) == [("a", 4, D1)]
    assert [r["v"] for r in table.read(version=2).collect()] == [2]


def test_a_staged_folder_that_is_gone_is_an_error(spark, table):
    table.upsert(spark.createDataFrame([("a", 1, D1)], SCHEMA))
    late = table.merge(spark.createDataFrame([("c", 3, D1)], SCHEMA), "ignore", 1)
    table.discard(late.folder)
    with pytest.raises(RuntimeError, match="is gone"):
        table.publish(late)
    assert rows(table) == [("a", 1, D1)]


def test_versions_older_than_the_lease_go(spark):
    path = work_path(spark, "test", "refresh", unique=True)
    kept = TB.VersionedTable(spark, path)
    for n in range(3):
        assert kept.replace(spark.range(n).withColumn("v", F.lit(n))).count() == n
    assert len(TB.list_names(spark, f"{path}/data")) == 3
    short = TB.VersionedTable(spark, path, lease_hours=-1.0)
    assert short.replace(spark.range(5).withColumn("v", F.lit(5))).count() == 5
    assert len(TB.list_names(spark, f"{path}/data")) == 1
    assert TB.list_names(spark, f"{path}/versions") == ["v0000000004.json"]
    assert short.folder().endswith(short._manifest()["folders"][""])


def test_stores_that_overwrite_on_rename_are_refused(spark, table, monkeypatch):
    monkeypatch.setattr(TB, "_EXCLUSIVE_RENAME", ("hdfs",))
    with pytest.raises(ValueError, match="overwrite"):
        table.upsert(spark.createDataFrame([("a", 1, D1)], SCHEMA))


def test_checkpoint_folder_must_be_named_off_local_mode(spark, monkeypatch):
    from types import SimpleNamespace

    from docsentinel.session import ensure_checkpoint_dir

    conf = SimpleNamespace(get=lambda k, d=None: d)
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="yarn")
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=conf, sparkContext=context))


def test_row_groups_outside_a_lookback_are_skipped(spark):
    """Rows sorted by issue_at: each row group covers a narrow span of it, and a lookback reads the last ones only."""
    import glob

    import pyarrow.parquet as pq

    from docsentinel.functions.exprs import lookback

    path = work_path(spark, "test", "sorted", unique=True)
    before = spark.conf.get("parquet.block.size", None)
    rows = spark.range(200_000).select(
        F.col("id").cast("string").alias("k"), F.lit(D1).alias("d"),
        F.expr("TIMESTAMP_NTZ '2001-01-01 00:00:00' - make_dt_interval(cast(pmod(xxhash64(id), 2000) as int))").alias("issue_at"),
    ).repartition(1)
    groups = {}
    try:
        spark.conf.set("parquet.block.size", str(64 << 10))
        for name, by in (("sorted", ["issue_at"]), ("dealt", [])):
            t = TB.VersionedTable(spark, f"{path}/{name}", key="k", partition_col="d", sort_by=by)
            t.replace(rows)
            spans = []
            for file in glob.glob(f"{t._leaf(str(D1), t._manifest()['folders'][str(D1)])}/*.parquet".removeprefix("file:")):
                meta = pq.ParquetFile(file).metadata
                for g in range(meta.num_row_groups):
                    column = next(meta.row_group(g).column(c) for c in range(meta.num_columns)
                                  if meta.row_group(g).column(c).path_in_schema == "issue_at")
                    spans.append(column.statistics.max)
            edge = dt.date(2001, 1, 1) - dt.timedelta(days=100)
            groups[name] = (len(spans), sum(x >= dt.datetime.combine(edge, dt.time()) for x in spans))
            assert t.read().filter(lookback("issue_at", dt.date(2001, 1, 1), 100)).count() > 5000
    finally:
        spark.conf.unset("parquet.block.size") if before is None else spark.conf.set("parquet.block.size", before)
    total, read = groups["sorted"]
    assert total >= 4 and read <= total // 3 and groups["dealt"][1] == groups["dealt"][0]


def test_rows_without_an_older_copy_are_added(spark, table):
    """An upsert writes again only the partitions that hold old copies of its keys."""
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 2, D2)], SCHEMA))
    before = table._manifest()["folders"]
    table.upsert(spark.createDataFrame([("c", 3, D1), (None, 9, D1), ("b", 4, D2)], SCHEMA))
    after = table._manifest()["folders"]
    assert after[str(D1)][0] == before[str(D1)] and len(after[str(D1)]) == 2
    assert isinstance(after[str(D2)], str) and after[str(D2)] != before[str(D2)]
    assert sorted(rows(table), key=str) == sorted([("a", 1, D1), ("c", 3, D1), (None, 9, D1), ("b", 4, D2)], key=str)
    # a NULL key has no older copy; a key that moves leaves its old partition
    table.upsert(spark.createDataFrame([(None, 9, D1), ("a", 5, D2)], SCHEMA))
    assert sorted(rows(table), key=str) == sorted(
        [("c", 3, D1), (None, 9, D1), (None, 9, D1), ("b", 4, D2), ("a", 5, D2)], key=str)


def test_a_partition_of_many_folders_is_put_together(spark, table, monkeypatch):
    monkeypatch.setattr(TB, "_MOST_FOLDERS", 3)
    held = []
    for n in range(7):
        table.upsert(spark.createDataFrame([(f"k{n}", n, D1)], SCHEMA))
        held.append(len(TB._listed(table._manifest()["folders"][str(D1)])))
    assert held == [1, 2, 3, 1, 2, 3, 1]
    assert sorted(rows(table)) == [(f"k{n}", n, D1) for n in range(7)]


def test_first_rows_of_an_empty_table_are_written_once(spark, table, monkeypatch):
    empty = spark.createDataFrame([], SCHEMA)
    table.upsert(empty)
    table.upsert(empty)
    assert table.version() == 1
    monkeypatch.setattr(TB, "checkpoint_table", lambda *a: pytest.fail("the batch was written twice"))
    table.upsert(spark.createDataFrame([("a", 1, D1), ("b", 2, None)], SCHEMA))
    assert sorted(rows(table), key=str) == sorted([("a", 1, D1), ("b", 2, None)], key=str)


def test_fixture_rows_are_dealt_out_only_where_the_scan_is_uneven(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    from docsentinel.sources.fixtures import dealt

    rows_ = pa.table({"k": list(range(60_000)), "v": [str(x * 7919 % 60_000) for x in range(60_000)]})
    tasks = spark.sparkContext.defaultParallelism
    for n in range(tasks):
        pq.write_table(rows_.slice(n * (60_000 // tasks), 60_000 // tasks), tmp_path / f"even-{n}.parquet")
    pq.write_table(rows_, tmp_path / "one.parquet")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))  # a task a file
    try:
        even = spark.read.parquet(*[str(p) for p in tmp_path.glob("even-*")])
        one = spark.read.parquet(str(tmp_path / "one.parquet"))
        plans = [dealt(t, "k")._jdf.queryExecution().optimizedPlan().toString() for t in (even, one)]
        assert "Repartition" not in plans[0] and (tasks <= 2 or "Repartition" in plans[1])
        assert dealt(one, "k").count() == 60_000 and dealt(one.limit(0), "k").count() == 0
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
