"""History infrastructure: migrate, verify, rollback; JSON output keeps NULL members."""

import datetime as dt
import json
import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from docsentinel.functions.exprs import to_json_keep_nulls
from docsentinel.plans import history as H
from docsentinel.plans import models as M
from docsentinel.plans.fixture_queries import CFG, staged
from docsentinel.session import work_path
from docsentinel.sources.tables import VersionedTable, path_exists


def test_migrate_verify_rollback(spark):
    co, cr = staged(spark, SF_SMALL)
    root = work_path(spark, "test", "migration", unique=True)
    stored = VersionedTable(spark, f"{root}/results")
    results = stored.replace(M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG))
    hist = H.SnapshotHistory(spark, f"{root}/{H.HISTORY_TABLE}", CFG)
    H.migrate(spark, hist, stored, "t_")
    H.migrate(spark, hist, stored, "t_")  # idempotent
    before = {r["objet"]: r["existe"] for r in H.verify(spark, hist, stored, "t_").collect()}
    assert before["Partitions (0)"] is False and all(v for k, v in before.items() if not k.startswith("Partitions"))
    hist.archive(results)
    after = {r["objet"]: r["existe"] for r in H.verify(spark, hist, stored, "t_").collect()}
    assert after["Partitions (1)"] is True
    parts = {p["partition_name"]: p["row_count"] for p in hist.partitions().collect()}
    assert len(parts) == 19 and parts["results_control_score_2_history_2001_08"] == results.count()
    assert sum(n > 0 for n in parts.values()) == 1
    latest, summary = H.view_names("t_")
    assert spark.table(latest).count() == results.count()
    H.rollback(spark, hist, "t_")
    assert not path_exists(spark, hist.path)
    assert not spark.catalog.tableExists(latest) and not spark.catalog.tableExists(summary)
    gone = {r["objet"]: r["existe"] for r in H.verify(spark, hist, stored, "t_").collect()}
    assert gone["Table historique"] is False and gone["Vue v_results_control_latest"] is False


def test_json_keeps_null_members(spark):
    df = spark.createDataFrame([(None, 2)], "a int, b int")
    text = df.select(to_json_keep_nulls(F.struct(F.struct("a", "b").alias("inner")))).first()[0]
    assert json.loads(text) == {"inner": {"a": None, "b": 2}}


def test_results_columns_and_json_shape(spark):
    co, cr = staged(spark, SF_SMALL)
    m7 = M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG)
    assert tuple(m7.columns) == M.RESULTS_SCORE_2_COLUMNS
    row = m7.first()
    doc = json.loads(row["metrics_json"])
    assert set(doc) == {"metrics", "dates", "dimensions"}
    assert doc["metrics"]["document_count"] == row["document_count"]
    assert doc["metrics"]["total_for_score"] == row["total_documents"]
    assert set(doc["dates"]["score_date_range"]) == {"first", "last"}
    m6 = M.results_control_score(M.latest_control_base(co, cr, CFG), CFG)
    assert tuple(m6.columns) == M.RESULTS_SCORE_COLUMNS
    assert set(json.loads(m6.first()["metrics_json"])) == {"counts", "percentages", "metadata"}


def test_statistics_change_a_plan(spark):
    """With the column statistics of the table behind the views, a selective filter makes a side small enough to broadcast."""
    root = work_path(spark, "test", "stats", unique=True)
    results, prefix = VersionedTable(spark, f"{root}/r"), f"st_{uuid.uuid4().hex}_"
    names = [f"score{n}" for n in range(50)]
    rows = [(n, s, 1, dt.date(2001, 8, 1)) for n in names for s in ("OK", "KO")]
    results.replace(spark.createDataFrame(rows, "control_score string, control_status string, document_count int, snapshot_date date"))
    H.migrate(spark, H.SnapshotHistory(spark, f"{root}/h", CFG), results, prefix)
    before = {k: spark.conf.get(k) for k in ("spark.sql.cbo.enabled", "spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    facts = spark.range(1000).selectExpr("concat('score', id % 50) AS control_score", "id")

    def joined():
        one = spark.table(H.view_names(prefix)[0]).filter("control_score = 'score7'")
        return facts.join(one, "control_score")._jdf.queryExecution().executedPlan().toString()

    try:
        spark.conf.set("spark.sql.cbo.enabled", "true")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
        assert "BroadcastHashJoin" not in joined()
        stats = H.analyze_results(spark, results, prefix)
        assert {r["column_name"] for r in stats.collect()} == {"control_score", "control_status", "document_count", "snapshot_date"}
        assert "BroadcastHashJoin" in joined()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_views_are_readable_during_a_refresh(spark, monkeypatch):
    """A refresh moves the table's location; at no moment is there no table."""
    root = work_path(spark, "test", "refresh", unique=True)
    results, prefix = VersionedTable(spark, f"{root}/r"), f"rf_{uuid.uuid4().hex}_"
    schema = "control_score string, control_status string, document_count int, snapshot_date date"
    results.replace(spark.createDataFrame([("a", "OK", 1, dt.date(2001, 8, 1))], schema))
    history = H.SnapshotHistory(spark, f"{root}/h", CFG)
    H.migrate(spark, history, results, prefix)
    open_reader = spark.table(H.view_names(prefix)[1])
    results.replace(spark.createDataFrame([("a", "OK", 7, dt.date(2001, 8, 2))], schema))
    sql, seen = type(spark).sql, []

    def watched(self, text, *args, **kw):
        out = sql(self, text, *args, **kw)
        seen.append(spark.catalog.tableExists(f"{prefix}{H.RESULTS_TABLE.lower()}"))
        return out

    with monkeypatch.context() as m:
        m.setattr(type(spark), "sql", watched)
        H.migrate(spark, history, results, prefix)
    assert seen and all(seen)
    assert [r["total_documents"] for r in open_reader.collect()] == [1]  # its files are kept for the lease
    assert [r["total_documents"] for r in spark.table(H.view_names(prefix)[1]).collect()] == [7]
