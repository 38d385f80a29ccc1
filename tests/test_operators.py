"""Operators: dedupe, two-phase counts, unpivot, trend, pivot/spine, upserts, schema evolution."""

import datetime as dt
import random

import pytest

from docsentinel.functions.exprs import status_counts
from docsentinel.operators.dedupe import latest_per_key
from docsentinel.operators.incremental import delete_insert, evolve_columns, merge_on_conflict
from docsentinel.operators.spine import densify_pivot, month_spine
from docsentinel.operators.status import distinct_status_counts
from docsentinel.operators.trend import month_over_month


def test_latest_per_key_total_order(spark):
    t1, t2 = dt.datetime(2001, 1, 1), dt.datetime(2001, 1, 2)
    rows = [("d1", "s", t1, "e1", "OK"), ("d1", "s", t2, "e2", "KO"), ("d1", "s", t2, "e3", "NA"),
            ("d1", None, t1, "e4", "OK"), ("d2", "s", t1, "e5", None)]
    df = spark.createDataFrame(rows, "doc string, score string, ts timestamp_ntz, eid string, status string")
    out = {(r["doc"], r["score"]): r for r in latest_per_key(df, ["doc", "score"], ["ts", "eid"]).collect()}
    assert out[("d1", "s")]["eid"] == "e3"  # tie on ts broken by the greater event id
    assert out[("d1", None)]["eid"] == "e4"  # NULL key is its own group
    assert out[("d2", "s")]["status"] is None
    assert len(out) == 3


def test_two_phase_counts_equal_count_distinct(spark):
    rnd = random.Random(7)
    statuses = ["OK", "KO", "NA", None, "XX"]
    rows = [(rnd.choice("abc"), f"d{rnd.randrange(60)}", rnd.choice(statuses)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "g string, document_id string, control_status string")
    two = {r["g"]: r.asDict() for r in distinct_status_counts(df, ["g"]).collect()}
    one = {r["g"]: r.asDict() for r in df.groupBy("g").agg(*status_counts()).collect()}
    assert two == one


def test_month_over_month_golden(spark):
    rows = [("s", dt.date(2001, 1, 1), 40), ("s", dt.date(2001, 3, 1), 50), ("t", dt.date(2001, 1, 1), 0),
            ("t", dt.date(2001, 2, 1), 5)]
    df = spark.createDataFrame(rows, "score string, m date, total long")
    out = {(r["score"], r["m"]): r for r in month_over_month(df, "score", "m", "total").collect()}
    first, second = out[("s", dt.date(2001, 1, 1))], out[("s", dt.date(2001, 3, 1))]
    assert first["prev_month_count"] is None and first["mom_growth_pct"] is None
    assert first["mom_growth_pct_literal"] is None
    assert second["prev_month_count"] == 40 and second["mom_change"] == 10
    assert float(second["mom_growth_pct"]) == 25.0
    assert float(second["mom_growth_pct_literal"]) == 4999.0  # 100*50 - 40/greatest(40,1)
    t2 = out[("t", dt.date(2001, 2, 1))]
    assert float(t2["mom_growth_pct"]) == 500.0 and float(t2["mom_growth_pct_literal"]) == 500.0


def test_spine_and_densify(spark):
    spine = month_spine(spark, dt.date(2001, 1, 1), dt.date(2001, 3, 15), ch=["a", "b"])
    assert spine.count() == 6
    facts = spark.createDataFrame(
        [(dt.date(2001, 2, 1), "a", "x", 3), (dt.date(2001, 2, 1), "a", "y", 4), (dt.date(2001, 2, 1), "a", "z", 9),
         (dt.date(2001, 9, 1), "a", "x", 1)],
        "issue_date date, ch string, name string, n long")
    dense = densify_pivot(spine, facts, ["issue_date", "ch"], "name", ["x", "y"], ["n"], ["c1", "c2"])
    rows = {(r["issue_date"], r["ch"]): r for r in dense.collect()}
    assert len(rows) == 6
    assert (rows[(dt.date(2001, 2, 1), "a")]["c1_n"], rows[(dt.date(2001, 2, 1), "a")]["c2_n"]) == (3, 4)
    assert rows[(dt.date(2001, 1, 1), "b")]["c1_n"] == 0
    assert dense.columns == ["issue_date", "ch", "c1_n", "c2_n"]


def test_delete_insert_replaces_whole_key_groups(spark):
    target = spark.createDataFrame([("k1", 1), ("k1", 2), ("k2", 3), (None, 4)], "k string, v int")
    batch = spark.createDataFrame([("k1", 10), (None, 11)], "k string, v int")
    out = sorted((r["k"] or "", r["v"]) for r in delete_insert(target, batch, "k").collect())
    assert out == [("", 4), ("", 11), ("k1", 10), ("k2", 3)]  # NULL keys never match


@pytest.mark.parametrize("policy,expected", [
    ("ignore", ["a", "b", "c"]),
    ("append_new_columns", ["a", "b", "c", "d"]),
    ("sync_all_columns", ["a", "c", "d"]),
])
def test_evolve_columns(policy, expected):
    assert evolve_columns(["a", "b", "c"], ["d", "c", "a"], policy) == expected


def test_evolve_columns_fail():
    with pytest.raises(ValueError):
        evolve_columns(["a"], ["a", "b"], "fail")


def test_merge_on_conflict_partial_update(spark):
    existing = spark.createDataFrame([("s", "OK", 10, "2001-01-01", "old"), ("s", "KO", 5, "2001-01-02", "keep")],
                                     "score string, status string, n int, first string, js string")
    batch = spark.createDataFrame([("s", "OK", None, "2000-12-01", "new"), ("t", "OK", 7, "2001-02-01", "ins")],
                                  "score string, status string, n int, first string, js string")
    out = {(r["score"], r["status"]): r for r in
           merge_on_conflict(existing, batch, ["score", "status"], ["n", "js"]).collect()}
    assert out[("s", "OK")]["n"] is None  # a NULL in the batch still overwrites
    assert out[("s", "OK")]["js"] == "new"
    assert out[("s", "OK")]["first"] == "2001-01-01"  # not in the update list: first value kept
    assert out[("s", "KO")]["js"] == "keep"
    assert out[("t", "OK")]["n"] == 7


def test_after_mark(spark):
    from docsentinel.operators.incremental import after_mark

    t = [dt.datetime(2001, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(x,) for x in t], "ts timestamp_ntz")
    mark = t[1]
    assert [r[0] for r in after_mark(df, "ts", mark).collect()] == [t[2]]  # strict: the mark itself is not re-read
    assert sorted(r[0] for r in after_mark(df, "ts", mark, dt.timedelta(days=1)).collect()) == t[1:]
    assert after_mark(df, "ts", None).count() == 3


def _final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_status_models_have_no_expand_and_one_scan_an_input(spark):
    """On stored staging tables: one scan of each input for M4, no row multiplied for M6 and M7."""
    from docsentinel.plans import models as M
    from docsentinel.plans.fixture_queries import CFG, staged
    from docsentinel.sources.tables import checkpoint_table
    from conftest import SF_SMALL

    co, cr = (checkpoint_table(spark, df, "stored")[0] for df in staged(spark, SF_SMALL))
    final = _final_plan(M.control_results(co, cr, CFG)).split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet") == 2
    base = M.latest_control_base(co, cr, CFG)
    for model in (M.results_control_score, M.results_control_score_2):
        assert "Expand" not in _final_plan(model(base, CFG))


def test_status_counts_move_each_side_to_its_documents_once(spark):
    from docsentinel.plans import models as M
    from docsentinel.plans.fixture_queries import CFG, staged
    from docsentinel.sources.tables import checkpoint_table
    from conftest import SF_SMALL

    co, cr = staged(spark, SF_SMALL)
    stored, _ = checkpoint_table(spark, M.control_flags(co, CFG), "stored")
    creations, _ = checkpoint_table(spark, cr, "stored")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as on large tables
    try:
        for model in (M.control_results_from_flags(stored, creations, CFG), M.monthly_control_facts(spark, stored, creations, CFG)):
            final = _final_plan(model).split("== Initial Plan ==")[0]
            moved = [line for line in final.splitlines() if "Exchange hashpartitioning" in line]
            assert len([line for line in moved if "document_id" in line]) == 2
            assert len(moved) == 3  # and the counts
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_status_counts_of_repeated_and_missing_values(spark):
    """A document with the same value in several months and creation events counts once, with all its flags."""
    from docsentinel.plans import models as M
    from docsentinel.plans.fixture_queries import CFG

    flags = "document_id string, issue_date date, channel_acquisition_id string, control_name string, "
    flags = spark.createDataFrame(
        [("d1", dt.date(2001, 1, 1), "c", "n", 1, 0, 0, 0), ("d1", dt.date(2001, 2, 1), "c", "n", 0, 1, 0, 0),
         ("d2", dt.date(2001, 1, 1), None, "n", 0, 0, 0, 1), ("d3", dt.date(2001, 1, 1), "c", "n", 1, 0, 0, 0)],
        flags + "is_ok int, is_ko int, is_na int, is_null int")
    cr = spark.createDataFrame(
        [("d1", "p", "fr", None), ("d1", "p", "be", None), ("d1", "p", "fr", None), ("d2", "p", "fr", "2001"), (None, "p", "x", "y")],
        "document_id string, document_category string, document_issuing_country string, document_issue_year string")
    rows = M.control_results_from_flags(flags, cr, CFG).collect()
    found = {(r["dimension_name"], r["control_client_document"]): tuple(r[f"count_{k}"] for k in ("document", "ok", "ko", "na", "null"))
             for r in rows}
    assert found == {
        ("control_name", "n"): (2, 1, 1, 0, 1), ("channel_acquisition_id", "c"): (1, 1, 1, 0, 0),
        ("channel_acquisition_id", None): (1, 0, 0, 0, 1), ("document_category", "p"): (2, 1, 1, 0, 1),
        ("document_issuing_country", "fr"): (2, 1, 1, 0, 1), ("document_issuing_country", "be"): (1, 1, 1, 0, 0),
        ("document_issue_year", None): (1, 1, 1, 0, 0), ("document_issue_year", "2001"): (1, 0, 0, 0, 1),
    }


def test_presentation_orders(spark):
    from docsentinel.plans import fixture_queries as Q
    from conftest import SF_SMALL

    rank = {"OK": 1, "KO": 2, "NA": 3, None: 4}
    rows = Q.q_results_control_score_2(spark, SF_SMALL).collect()
    keys = [(r["control_score"], rank.get(r["control_status"], 5)) for r in rows]
    assert keys == sorted(keys)
    for query, key in (
        (Q.q_results_control_score, lambda r: r["control_score"]),
        (Q.q_results_control_summary, lambda r: r["control_score"]),
        (Q.q_control_monthly_trends, lambda r: (r["control_score"], -r["issue_month_date"].toordinal())),
        (Q.q_ctl_control_results_over_time,
         lambda r: (-r["issue_date"].toordinal(), r["channel_acquisition_id"], r["document_category"])),
    ):
        found = [key(r) for r in query(spark, SF_SMALL).collect()]
        assert found == sorted(found) and len(found) > 5
