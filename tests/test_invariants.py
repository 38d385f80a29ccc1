"""Invariants across models, and idempotency of the writing operators."""

import dataclasses
import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from docsentinel.functions.exprs import ts_ntz
from docsentinel.plans import history as H
from docsentinel.plans import incremental as INC
from docsentinel.plans import models as M
from docsentinel.plans.fixture_queries import CFG, staged
from docsentinel.session import work_path


def test_score_percentages_sum_to_100(spark):
    co, cr = staged(spark, SF_SMALL)
    m7 = M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG)
    for score, total in m7.groupBy("control_score").agg(F.sum("percentage")).collect():
        assert abs(float(total) - 100.0) <= 0.05, score


def test_summary_totals_equal_results_totals(spark):
    co, cr = staged(spark, SF_SMALL)
    m7 = M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG)
    per_score = {r[0]: r[1] for r in m7.select("control_score", "total_documents").distinct().collect()}
    m9 = {r["control_score"]: r["total_documents"] for r in M.control_score_summary(m7).collect()}
    assert m9 == per_score


def test_over_time_is_dense(spark):
    co, cr = staged(spark, SF_SMALL)
    n = M.control_spine(spark, CFG).count()
    m5 = M.ctl_control_results_over_time(spark, co, cr, CFG)
    assert m5.count() == n == 25 * 3 * 10
    assert m5.select("unique_key").distinct().count() == n


def test_document_count_bounded_by_status_counts(spark):
    co, cr = staged(spark, SF_SMALL)
    for r in M.control_results(co, cr, CFG).collect():
        assert r["count_document"] <= r["count_ok"] + r["count_ko"] + r["count_na"] + r["count_null"] + 0


def test_two_incremental_loads_equal_one_full_load(spark):
    co, cr = staged(spark, SF_SMALL)
    path = work_path(spark, "test", "incremental", unique=True)
    cut = ts_ntz(dt.datetime(2001, 1, 1))
    INC.load_detailed(spark, path, co.filter(F.col("issue_at") <= cut), cr, CFG)
    INC.load_detailed(spark, path, co, cr, CFG)
    got = INC.read_without_partition(INC.detailed_table(spark, path))
    full = M.documents_controlled_detailed(co, cr, CFG)
    assert got.exceptAll(full).count() == 0 and full.exceptAll(got).count() == 0
    # a second identical run adds nothing (strict high-water mark)
    INC.load_detailed(spark, path, co, cr, CFG)
    assert INC.read_without_partition(INC.detailed_table(spark, path)).count() == full.count()


def test_late_window_reload_is_idempotent(spark):
    co, cr = staged(spark, SF_SMALL)
    cfg = dataclasses.replace(CFG, late_days=30)
    path = work_path(spark, "test", "late", unique=True)
    INC.load_detailed(spark, path, co, cr, cfg)
    before = sorted(map(tuple, INC.read_without_partition(INC.detailed_table(spark, path)).collect()), key=repr)
    INC.load_detailed(spark, path, co, cr, cfg)  # re-reads the last 30 days, replaces them by key
    after = sorted(map(tuple, INC.read_without_partition(INC.detailed_table(spark, path)).collect()), key=repr)
    assert after == before


def test_archive_twice_is_idempotent_and_keeps_first_dates(spark):
    co, cr = staged(spark, SF_SMALL)
    path = work_path(spark, "test", "history", unique=True)
    hist = H.SnapshotHistory(spark, path, CFG)
    m7 = M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG)
    hist.archive(m7)
    first = hist.read().drop("created_at").collect()
    hist.archive(m7)
    again = hist.read().drop("created_at").collect()
    assert sorted(map(tuple, first), key=repr) == sorted(map(tuple, again), key=repr)
    narrower = dataclasses.replace(CFG, lookback_days=200)
    hist.archive(M.results_control_score_2(M.latest_control_base(co, cr, narrower), narrower))
    new = {(r["control_score"], r["control_status"]): r for r in hist.read().collect()}
    old = {(r["control_score"], r["control_status"]): r for r in first}
    changed = [k for k in old if k in new and new[k]["document_count"] != old[k]["document_count"]]
    assert changed, "the narrower window must change some counts"
    for k in changed:
        assert new[k]["first_issue_date"] == old[k]["first_issue_date"]
        assert new[k]["unique_key"] == old[k]["unique_key"]


def test_archive_rejects_dates_outside_window(spark):
    co, cr = staged(spark, SF_SMALL)
    hist = H.SnapshotHistory(spark, work_path(spark, "test", "history_guard", unique=True), CFG)
    window = H.partition_window(CFG)
    assert (len(window), window[0], window[-1]) == (19, dt.date(2000, 8, 1), dt.date(2002, 2, 1))
    for day in (dt.date(2000, 7, 31), dt.date(2002, 3, 1)):
        late = dataclasses.replace(CFG, as_of=day)
        m7 = M.results_control_score_2(M.latest_control_base(co, cr, late), late)
        with pytest.raises(ValueError, match="outside the history window"):
            hist.archive(m7, day)
    assert not hist.table.exists()
    # results of another day hold no row of the archived snapshot
    other = dataclasses.replace(CFG, as_of=dt.date(2001, 7, 1))
    hist.archive(M.results_control_score_2(M.latest_control_base(co, cr, other), other))
    assert hist.read().count() == 0


def test_last_partition_mark_equals_full_max(spark):
    co, cr = staged(spark, SF_SMALL)
    for gran in ("day", "month"):
        cfg = dataclasses.replace(CFG, partition_granularity=gran)
        path = work_path(spark, "test", f"mark_{gran}", unique=True)
        INC.load_detailed(spark, path, co, cr, cfg)
        table = INC.detailed_table(spark, path)
        full = table.read().agg(F.max("control_controled_issue_at")).first()[0]
        assert table.max_in_last_partition("control_controled_issue_at") == full
    empty = INC.detailed_table(spark, work_path(spark, "test", "absent", unique=True))
    assert empty.max_in_last_partition("control_controled_issue_at") is None
