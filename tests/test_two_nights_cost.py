"""What the cost of two nights at size depends on: rows moved once, ids met as hashes, expressions computed once."""

import datetime as dt
import itertools
import re

from pyspark.sql import functions as F

from docsentinel.functions import exprs as X
from docsentinel.plans import latest_rows as LR
from docsentinel.plans import models as M
from docsentinel.plans.fixture_queries import CFG
from docsentinel.plans.staging import stage_controlled
from docsentinel.session import work_path
from docsentinel.sources import fixtures as FX
from docsentinel.sources.tables import checkpoint_table

DAY = dt.datetime(2001, 5, 5)
LINEITEM = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_returnflag string, l_linestatus string, "
            "l_shipdate timestamp_ntz")


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def lineitem(spark):
    flags = [("A", "F"), ("R", "O"), ("N", "O"), ("N", "F"), (None, None), (None, "O")]
    keys = itertools.product([*range(97), None], [0, 9, 11, None], flags)
    return spark.createDataFrame([(1, part, supp, 3, *f, DAY) for supp, part, f in keys], LINEITEM)


def test_payload_with_one_item_is_the_oracles_text(spark):
    rows = lineitem(spark)
    same = rows.select(F.expr(FX.CONTROL_PAYLOAD).alias("now"), F.expr(FX.CONTROLLED_EXPRS[FX.PAYLOAD]).alias("oracle"))
    assert same.count() == 98 * 4 * 6 and same.filter("NOT now <=> oracle").count() == 0
    assert plan(FX.raw_controlled_from_lineitem(rows)).count('{"identifier":", ') == 1


def test_json_is_parsed_from_a_column_not_an_expression(spark):
    path = work_path(spark, "test", "lineitem", unique=True)
    lineitem(spark).write.parquet(path)
    staged = plan(stage_controlled(FX.raw_controlled_from_lineitem(spark.read.parquet(path))))
    assert re.search(rf"from_json\(ArrayType\(StringType,true\), {FX.PAYLOAD}#", staged)


def test_subtype_patterns_keep_their_wildcards(spark):
    words = ["ADDRESS", "PROOF", "ID", "CARD", "DRIVING", "LICENSE", "XYZ", "PASSPORT", "FRA", "2013", "PAYSLIP"]
    texts = [a + s + b + s + c for a, b, c in itertools.product(words, repeat=3) for s in ("_", "-", "")] + [None, "", "é_\nID_CARD_FRA_2013"]
    rows = spark.createDataFrame([(t,) for t in texts], "s string")
    patterns = [*X.COUNTRY_SUFFIX_PATTERNS, *X.YEAR_PATTERNS, X.UNKNOWN_COUNTRY_PATTERN, "%DRIVING_LICENSE_%"]
    for p in patterns:
        assert rows.filter(f"NOT ({X._like('s', p)} <=> (s LIKE '{p}'))").count() == 0, p
    assert rows.filter(X._like("s", "%ID_CARD%")).filter("s LIKE '%ID-CARD%'").count() > 0


def test_score_models_do_not_move_a_marked_base(spark):
    """A raw NULL and a literal score of one document, with one status and with two: one document each."""
    schema = "document_id string, control_status string, issue_at timestamp_ntz, control_score string, control_name string, " \
             "channel_acquisition_id string, document_category string, document_issuing_country string, document_issue_year string"
    rest = ("n", "c", "id_card", "fr", "2001")
    rows = [("d1", "OK", DAY, "controlna", *rest), ("d1", "OK", DAY, "controlna", *rest), ("d2", "KO", DAY, "controlna", *rest),
            ("d2", None, DAY, "controlna", *rest), ("d2", "KO", DAY, "advanced", *rest), (None, "OK", DAY, "advanced", *rest)]
    base = spark.createDataFrame(rows, schema)
    stored, _ = checkpoint_table(spark, M.marked_base(base), "marked")
    drop = ("created_at", "metrics_json")
    for model in (M.results_control_score, M.results_control_score_2):
        assert "document_id" not in plan(model(stored, CFG)).replace(" ", "").split("Relation")[0]
        got, plain = (sorted(map(tuple, model(b, CFG).drop(*drop).collect()), key=repr) for b in (stored, base))
        assert got == plain
    totals = {r["control_score"]: (r["total_documents"], r["count_ok"], r["count_ko"], r["count_null"])
              for r in M.results_control_score(stored, CFG).collect()}
    assert totals == {"controlna": (2, 1, 1, 1), "advanced": (1, 0, 1, 0)}


def test_status_counts_group_no_row_by_document_and_value(spark):
    """A document with many channels, controls and statuses, counted as by the definition."""
    flags = [("d1", None, f"ch{i % 3}" if i % 4 else None, f"n{i % 5}", *(int(i % 7 == k) for k in range(4))) for i in range(60)]
    flags += [("d2", None, "ch1", "n1", 0, 0, 0, 0), ("d3", None, "ch1", "n1", 1, 0, 0, 0)]
    flags = spark.createDataFrame(flags, "document_id string, issue_date date, channel_acquisition_id string, control_name string, "
                                         "is_ok int, is_ko int, is_na int, is_null int")
    cr = spark.createDataFrame([("d1", "a", "fr", None), ("d1", "b", "fr", "2001"), ("d2", "a", None, None)],
                               "document_id string, document_category string, document_issuing_country string, document_issue_year string")
    counts = M.control_results_from_flags(flags, cr, CFG)
    assert not re.search(r"Aggregate \[document_id#\d+, dimension_name", plan(counts))
    joined, want = flags.join(cr, "document_id"), set()
    for name in (*M.CONTROL_SIDE_DIMENSIONS, *M.CREATION_SIDE_DIMENSIONS):
        of = lambda f: F.count_distinct(F.when(F.col(f) == 1, F.col("document_id")))
        rows = joined.groupBy(name).agg(F.count_distinct("document_id"), *[of(f) for f in ("is_ok", "is_ko", "is_na", "is_null")])
        want |= {(name, *r) for r in rows.collect()}
    names = ("dimension_name", "control_client_document", "count_document", "count_ok", "count_ko", "count_na", "count_null")
    assert {tuple(r[n] for n in names) for r in counts.collect()} == want


def test_no_kept_row_is_moved_for_events_that_came_once(spark, monkeypatch):
    """Only the ids' hashes of the kept rows meet the batch; an event that comes again is still found."""
    path = work_path(spark, "test", "latest", unique=True)
    schema = ("event_id string, document_id string, control_score string, issue_at timestamp_ntz, receipt_at timestamp_ntz, "
              "control_status string, control_name string, channel_acquisition_id string")
    first = [("e1", "d", "s", DAY, DAY, "OK", "a", "c"), (None, "d2", "s", DAY, DAY, "OK", "a", "c")]
    LR.update_latest(spark, path, spark.createDataFrame(first, schema), CFG)
    later = DAY + dt.timedelta(days=1)
    plans, real = {}, LR.checkpoint_table
    monkeypatch.setattr(LR, "checkpoint_table", lambda s, df, name, *a: (plans.setdefault(name, plan(df)), real(s, df, name, *a))[1])
    again = [("e1", "d", "t", DAY, later, "KO", "a", "c"), (None, "d3", "s", later, later, "OK", "a", "c"), first[1]]
    LR.update_latest(spark, path, spark.createDataFrame(again, schema), CFG)
    assert "xxhash64" in plans["met"] and "document_id" not in plans["met"].split("Relation")[0]
    kept = {(r["document_id"], r["control_score"], r["control_status"]) for r in LR.read_latest(spark, path, CFG).collect()}
    assert kept == {("d", "t", "KO"), ("d2", "s", "OK"), ("d3", "s", "OK")}
