"""Queries over the benchmark tables, one per implemented operator group.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame. Raw events are
derived from ``lineitem`` / ``orders`` (``sources.fixtures``), staged, and fed to
the models with the fixture run date. Output conventions for comparison with
an independent SQL oracle: decimal columns become DOUBLE, the wall-clock
``created_at`` is left out, and JSON text is exposed as its typed leaves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import dataclasses
import datetime as dt
import uuid

from docsentinel.config import Config
from docsentinel.functions.exprs import ts_ntz
from docsentinel.plans import history as H
from docsentinel.plans import incremental as INC
from docsentinel.operators.quality import REPORT_COLUMNS, accepted_values, freshness, not_null, run_checks, unique
from docsentinel.plans import latest_rows as LR
from docsentinel.plans import models as M
from docsentinel.plans import nightly as P
from docsentinel.plans import quality_checks as QC
from docsentinel.plans.staging import stage_controlled, stage_created
from docsentinel.session import work_path
from docsentinel.sources.fixtures import FIXTURE_AS_OF, fixture_sources
from docsentinel.sources.tables import VersionedTable, checkpoint_table

CFG = Config(as_of=FIXTURE_AS_OF, partition_granularity="month")
# The source "as it was" at the first of two incremental runs.
FIRST_RUN_CUT = dt.datetime(2001, 1, 1)


def staged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    raw_co, raw_cr = fixture_sources(spark, sf_dir)
    return stage_controlled(raw_co), stage_created(raw_cr)


def comparable(df: DataFrame) -> DataFrame:
    """Decimals -> double, drop ``created_at`` (wall clock)."""
    cols = []
    for f in df.schema.fields:
        if f.name == "created_at":
            continue
        c = F.col(f.name)
        cols.append(c.cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType) else c)
    return df.select(*cols)


def json_leaves(df: DataFrame, column: str, schema: T.StructType, prefix: str = "mj") -> DataFrame:
    """Replace a JSON text column by its leaves, parsed with ``schema``.

    Leaf ``a.b.c`` becomes column ``{prefix}_a_b_c``; JSON text is compared by
    value, never as a string (key order and number spelling vary by engine).
    """
    parsed = F.from_json(F.col(column), schema)

    def leaves(st: T.StructType, path: list[str]):
        for f in st.fields:
            if isinstance(f.dataType, T.StructType):
                yield from leaves(f.dataType, path + [f.name])
            else:
                yield path + [f.name]

    out = [parsed.getField(p[0]) if len(p) == 1 else _get_path(parsed, p) for p in leaves(schema, [])]
    names = [f"{prefix}_" + "_".join(p) for p in leaves(schema, [])]
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, *[c.alias(n) for c, n in zip(out, names)])


def _get_path(c, path):
    for p in path:
        c = c.getField(p)
    return c


M7_JSON = T.StructType([
    T.StructField("metrics", T.StructType([
        T.StructField("document_count", T.LongType()),
        T.StructField("percentage", T.DoubleType()),
        T.StructField("total_for_score", T.LongType()),
    ])),
    T.StructField("dates", T.StructType([
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("days_span", T.IntegerType()),
        T.StructField("score_date_range", T.StructType([
            T.StructField("first", T.DateType()),
            T.StructField("last", T.DateType()),
        ])),
    ])),
    T.StructField("dimensions", T.StructType([
        T.StructField("categories", T.LongType()),
        T.StructField("countries", T.LongType()),
        T.StructField("control_names", T.LongType()),
        T.StructField("channels", T.LongType()),
    ])),
])

M6_JSON = T.StructType([
    T.StructField("counts", T.StructType([
        T.StructField(k, T.LongType()) for k in ("ok", "ko", "na", "null", "total")
    ])),
    T.StructField("percentages", T.StructType([
        T.StructField(f"{k}_pct", T.DoubleType()) for k in ("ok", "ko", "na", "null")
    ])),
    T.StructField("metadata", T.StructType([
        T.StructField("first_date", T.DateType()),
        T.StructField("last_date", T.DateType()),
        T.StructField("days_span", T.IntegerType()),
        T.StructField("unique_categories", T.LongType()),
        T.StructField("unique_countries", T.LongType()),
    ])),
])


# -- queries --------------------------------------------------------------------------


def q_stg_documents_controlled(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, _ = staged(spark, sf_dir)
    return co


def q_stg_documents_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, cr = staged(spark, sf_dir)
    return cr


def q_documents_controled_detailed(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    return M.documents_controlled_detailed(co, cr, CFG)


def q_control_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    return comparable(M.control_results(co, cr, CFG))


def q_ctl_control_results_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    return M.order_over_time(M.ctl_control_results_over_time(spark, co, cr, CFG))


def q_control_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    return M.control_aggregation(spark, co, cr, CFG, "date_validation", "ctl07")


def q_status_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, _ = staged(spark, sf_dir)
    return comparable(M.status_bundle(co, "control_name"))


def _m7(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    return M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG)


def q_results_control_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, cr = staged(spark, sf_dir)
    m6 = M.results_control_score(M.latest_control_base(co, cr, CFG), CFG).orderBy("control_score")
    return json_leaves(comparable(m6), "metrics_json", M6_JSON)


def q_results_control_score_2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_leaves(comparable(M.order_results_score_2(_m7(spark, sf_dir))), "metrics_json", M7_JSON)


#: Receipt times after which the kept rows are brought up to date, the last time on everything.
KEPT_CUTS = (dt.datetime(2000, 9, 1), dt.datetime(2001, 6, 1))


def q_results_score_2_from_kept_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M7 from the kept latest rows: three runs, each on a later lookback window, some events delivered again."""
    co, cr = staged(spark, sf_dir)
    path = work_path(spark, "fixture", "latest_rows", unique=True)
    early = F.col("event_id").isNotNull() & (F.col("document_id").cast("long") % 5 == 0)
    for n, cut in enumerate(KEPT_CUTS):
        # Until they come again, some events have another score and a later time.
        other = co.filter(F.col("receipt_at") <= ts_ntz(cut)).withColumns({
            "control_score": F.when(early, F.lit("interim")).otherwise(F.col("control_score")),
            "issue_at": F.when(early, F.expr("issue_at + INTERVAL '3' DAY")).otherwise(F.col("issue_at")),
        })
        LR.update_latest(spark, path, other, dataclasses.replace(CFG, as_of=cut.date(), late_days=400))
    LR.update_latest(spark, path, co, dataclasses.replace(CFG, late_days=800))
    LR.expire(spark, path, CFG)
    base = M.base_of_latest(LR.read_latest(spark, path, CFG), cr)
    return json_leaves(comparable(M.results_control_score_2(base, CFG)), "metrics_json", M7_JSON)


def q_control_monthly_trends(spark: SparkSession, sf_dir: str) -> DataFrame:
    co, _ = staged(spark, sf_dir)
    m8 = M.control_monthly_trends(co, CFG).orderBy("control_score", F.col("issue_month_date").desc())
    return comparable(m8)


def q_control_score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(M.control_score_summary(_m7(spark, sf_dir)))


def q_results_control_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return json_leaves(comparable(M.results_control_latest(_m7(spark, sf_dir))), "metrics_json", M7_JSON)


def q_results_control_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return comparable(M.results_control_summary(_m7(spark, sf_dir)))


def q_documents_detailed_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full load of the source as of the cut, then one high-water-mark run on everything."""
    co, cr = staged(spark, sf_dir)
    path = work_path(spark, "fixture", "documents_detailed", unique=True)
    cut = ts_ntz(FIRST_RUN_CUT)
    INC.load_detailed(spark, path, co.filter(F.col("issue_at") <= cut), cr.filter(F.col("issue_at") <= cut), CFG)
    INC.load_detailed(spark, path, co, cr, CFG)
    return INC.read_without_partition(INC.detailed_table(spark, path))


def q_stg_controlled_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_co, _ = fixture_sources(spark, sf_dir)
    path = work_path(spark, "fixture", "stg_controlled", unique=True)
    INC.load_controlled(spark, path, raw_co.filter(F.col("data_eventdate") <= ts_ntz(FIRST_RUN_CUT)), CFG)
    INC.load_controlled(spark, path, raw_co, CFG)
    return INC.read_without_partition(INC.controlled_table(spark, path))


def q_concurrent_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two jobs upsert into one staged table from the same version; the one that comes second merges again."""
    co, _ = staged(spark, sf_dir)
    number = F.col("document_id").cast("long")
    # Both jobs' batches are merged more than once: they are taken from events decoded once.
    co, _ = checkpoint_table(spark, co.withColumn(INC.CONTROLLED_PARTITION, INC.partition_value("receipt_at", CFG)), "decoded")
    table = INC.controlled_table(spark, work_path(spark, "fixture", "concurrent", unique=True))
    table.upsert(co.filter(number % 3 == 0))
    revised = co.filter(number % 6 == 0).withColumn("control_score", F.lit("revised"))
    first_job = revised.unionByName(co.filter(number % 3 == 1))
    second_job = INC.controlled_table(spark, table.path)

    def merged_late(version: int):
        change = table.merge(first_job, "ignore", version)
        if version == 1:  # between this job's read and its commit
            second_job.upsert(co.filter(number % 3 == 2))
        return change

    table.change(merged_late)
    return INC.read_without_partition(table)


def q_schema_evolution_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older fact version lacking two columns, then a run under ``append_new_columns``."""
    co, cr = staged(spark, sf_dir)
    path = work_path(spark, "fixture", "evolution_append", unique=True)
    table = INC.detailed_table(spark, path)
    cut = ts_ntz(FIRST_RUN_CUT)
    old = M.documents_controlled_detailed(co.filter(F.col("issue_at") <= cut), cr.filter(F.col("issue_at") <= cut), CFG)
    table.upsert(old.drop("control_subject", "control_name")
                 .withColumn(INC.DETAILED_PARTITION, INC.partition_value("control_controled_issue_at", CFG)))
    INC.load_detailed(spark, path, co, cr, CFG, policy="append_new_columns")
    return INC.read_without_partition(table)


def q_schema_evolution_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An older staging version (one extra, one missing column), then ``sync_all_columns``."""
    raw_co, _ = fixture_sources(spark, sf_dir)
    path = work_path(spark, "fixture", "evolution_sync", unique=True)
    table = INC.controlled_table(spark, path)
    old = stage_controlled(raw_co.filter(F.col("data_eventdate") <= ts_ntz(FIRST_RUN_CUT)))
    table.upsert(old.drop("control_subject").withColumn("legacy_score", F.col("control_score"))
                 .withColumn(INC.CONTROLLED_PARTITION, INC.partition_value("receipt_at", CFG)))
    INC.load_controlled(spark, path, raw_co, CFG, policy="sync_all_columns")
    return INC.read_without_partition(table)


# Fixed check time of the freshness report.
FRESHNESS_NOW = dt.datetime(2001, 8, 2, 12, 0, 0)


def q_quality_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks but freshness, over every relation they are declared on."""
    raw_co, raw_cr = fixture_sources(spark, sf_dir)
    # What several checks read is written first, as the nightly run stores it.
    co, _ = checkpoint_table(spark, stage_controlled(raw_co), "checked_controlled")
    cr, _ = checkpoint_table(spark, stage_created(raw_cr), "checked_created")
    base, _ = checkpoint_table(spark, M.latest_control_base(co, cr, CFG), "checked_base")
    m7, _ = checkpoint_table(spark, M.results_control_score_2(base, CFG), "checked_results")
    relations = {
        "raw_controlled": raw_co, "raw_created": raw_cr,
        "stg_documents_controlled": co, "stg_documents_created": cr,
        "documents_controled_detailed": M.documents_controlled_detailed(co, cr, CFG),
        "control_results": M.control_results(co, cr, CFG),
        "ctl_control_results_over_time": M.ctl_control_results_over_time(spark, co, cr, CFG),
        "results_control_score": M.results_control_score(base, CFG), "results_control_score_2": m7,
        "control_monthly_trends": M.control_monthly_trends(co, CFG), "control_score_summary": M.control_score_summary(m7),
    }
    checks = QC.source_checks(CFG) + QC.staging_checks(CFG) + QC.detailed_checks(CFG) + QC.model_checks(CFG)
    return run_checks(relations, checks, FRESHNESS_NOW)


def seeded_violations(co: DataFrame) -> DataFrame:
    """Staged control events with repeated and missing keys and a control name that is not declared."""
    number = F.col("document_id").cast("long")
    seeded = co.select(
        F.when(number % 11 == 0, F.lit(None)).when(number % 13 == 0, F.col("document_id")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(number % 17 == 0, F.lit(None)).otherwise(F.col("document_id")).alias("document_id"),
        F.when(number % 19 == 0, F.concat(F.lit("undeclared_"), (number % 3).cast("string")))
        .otherwise(F.col("control_name")).alias("control_name"),
        "issue_at",
    )
    return seeded


VIOLATION_CHECKS = [
    unique("seeded", "event_id"), unique("seeded", "event_id", "control_name", severity="warn"),
    *not_null("seeded", "event_id", "document_id"), *not_null("seeded", "document_id", severity="warn"),
    accepted_values("seeded", "control_name", CFG.control_names),
    accepted_values("seeded", "control_name", CFG.control_names, "warn"),
    freshness("seeded", "issue_at", 24, 48),
]


def q_quality_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every type of check over seeded violations: each row fails or warns."""
    co, _ = staged(spark, sf_dir)
    return run_checks({"seeded": seeded_violations(co)}, VIOLATION_CHECKS, dt.datetime(2002, 1, 1))


def q_freshness_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_co, raw_cr = fixture_sources(spark, sf_dir)
    return run_checks({"raw_controlled": raw_co, "raw_created": raw_cr}, QC.freshness_checks(CFG), FRESHNESS_NOW)


ARCHIVE_RUNS = (
    CFG,
    dataclasses.replace(CFG, lookback_days=365),  # same day, changed results: a re-archive
    dataclasses.replace(CFG, as_of=dt.date(2001, 7, 31)),  # previous day, same month partition
)


def q_archive_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archive the results three times into a fresh history; return the history."""
    co, cr = staged(spark, sf_dir)
    path = work_path(spark, "fixture", "history", unique=True)
    for cfg in ARCHIVE_RUNS:
        m7 = M.results_control_score_2(M.latest_control_base(co, cr, cfg), cfg)
        H.SnapshotHistory(spark, path, cfg).archive(m7)
    hist = H.SnapshotHistory(spark, path, CFG).read()
    return json_leaves(comparable(hist), "metrics_json", M7_JSON)


def q_partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 months of the history window, two of them with archived snapshots."""
    co, cr = staged(spark, sf_dir)
    path = work_path(spark, "fixture", "history_layout", unique=True)
    history = H.SnapshotHistory(spark, path, CFG)
    for cfg in (CFG, dataclasses.replace(CFG, as_of=dt.date(2001, 6, 30))):
        history.archive(M.results_control_score_2(M.latest_control_base(co, cr, cfg), cfg), cfg.as_of)
    return history.partitions()


def _migrated(spark: SparkSession, sf_dir: str, name: str):
    """Results table, migrated and archived history, and the prefix of their catalog objects."""
    co, cr = staged(spark, sf_dir)
    root = work_path(spark, "fixture", name, unique=True)
    results = VersionedTable(spark, f"{root}/results_control_score_2")
    written = results.replace(M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG))
    history = H.SnapshotHistory(spark, f"{root}/{H.HISTORY_TABLE}", CFG)
    prefix = f"fx_{uuid.uuid4().hex}_"
    H.migrate(spark, history, results, prefix)
    history.archive(written)
    return results, history, prefix


def _with_rows(spark: SparkSession, report: DataFrame, results, history, prefix: str) -> DataFrame:
    """The existence report with each object's rows (partitions: their number), NULL where it is missing."""
    counts = {H.VERIFY_LABELS[0]: results.read().count()}
    if history.table.exists():
        counts[H.VERIFY_LABELS[1]] = history.read().count()
    for label, view in zip(H.VERIFY_LABELS[2:], H.view_names(prefix)):
        if spark.catalog.tableExists(view):
            counts[label] = spark.table(view).count()
    sizes = spark.createDataFrame(list(counts.items()), "objet string, n_rows long")
    return report.join(sizes, "objet", "left")


def q_verify_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Migrate + archive over the results table, then the existence report."""
    results, history, prefix = _migrated(spark, sf_dir, "verify")
    return _with_rows(spark, H.verify(spark, history, results, prefix), results, history, prefix)


def q_rollback_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The existence report after a rollback: the results table alone is left, with all its rows."""
    results, history, prefix = _migrated(spark, sf_dir, "rollback")
    H.rollback(spark, history, prefix)
    return _with_rows(spark, H.verify(spark, history, results, prefix), results, history, prefix)


def q_summary_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's summary view, read by name."""
    _, _, prefix = _migrated(spark, sf_dir, "views")
    return comparable(spark.table(H.view_names(prefix)[1]))


def q_latest_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The catalog's view of the latest snapshot, read by name."""
    _, _, prefix = _migrated(spark, sf_dir, "views")
    return json_leaves(comparable(spark.table(H.view_names(prefix)[0])), "metrics_json", M7_JSON)


def q_column_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NULL counts of the score results' columns as ANALYZE stored them in the catalog."""
    co, cr = staged(spark, sf_dir)
    table = VersionedTable(spark, work_path(spark, "fixture", "analyzed", unique=True))
    table.replace(M.results_control_score_2(M.latest_control_base(co, cr, CFG), CFG))
    stats = H.analyze(spark, f"fx_{uuid.uuid4().hex}_results", table).filter("statistic = 'num_nulls'")
    return stats.select("column_name", F.col("value").cast("long").alias("num_nulls"))


def _two_nights(spark: SparkSession, sf_dir: str) -> tuple[str, P.NightlyResult]:
    """The nightly run on the events received by a day, then on all of them; the second one's root and result."""
    raw_co, raw_cr = fixture_sources(spark, sf_dir)
    root = work_path(spark, "fixture", "nightly", unique=True)
    prefix = f"fx_{uuid.uuid4().hex}_"
    until = dt.datetime(2001, 7, 15)
    early = raw_co.filter(F.col("data_eventdate") < ts_ntz(until))
    P.run_nightly(spark, CFG, early, raw_cr, root, until, analyze=False, prefix=prefix)
    return root, P.run_nightly(spark, CFG, raw_co, raw_cr, root, prefix=prefix)


def q_nightly_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole nightly run on the derived sources; returns the archived history."""
    raw_co, raw_cr = fixture_sources(spark, sf_dir)
    root = work_path(spark, "fixture", "nightly", unique=True)
    P.run_nightly(spark, CFG, raw_co, raw_cr, root, prefix=f"fx_{uuid.uuid4().hex}_")
    hist = H.SnapshotHistory(spark, f"{root}/{H.HISTORY_TABLE}", CFG).read()
    return json_leaves(comparable(hist), "metrics_json", M7_JSON)


def q_nightly_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second night's report, most of it counted while the tables were written."""
    _, res = _two_nights(spark, sf_dir)
    schema = "relation string, test string, column_name string, severity string, failures long, status string, observed_hours double"
    return spark.createDataFrame([tuple(r[c] for c in REPORT_COLUMNS) for r in res.quality], schema).filter("test <> 'freshness'")


def q_nightly_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and documents of every model that the second night stored."""
    root, _ = _two_nights(spark, sf_dir)
    counted = {
        "control_results": "count_document", "ctl_control_results_over_time": "ctl07_count_document",
        "results_control_score": "total_documents", "results_control_score_2": "document_count",
    }
    out = None
    for name, column in counted.items():
        rows = VersionedTable(spark, f"{root}/{name}").read().agg(
            F.lit(name).alias("model"), F.count(F.lit(1)).alias("n_rows"), F.sum(column).cast("long").alias("n_documents"))
        out = rows if out is None else out.unionByName(rows)
    fact = INC.detailed_table(spark, f"{root}/documents_controled_detailed").read().agg(
        F.lit("documents_controled_detailed").alias("model"), F.count(F.lit(1)).alias("n_rows"),
        F.count("document_id").alias("n_documents"))
    return out.unionByName(fact)


def q_incremental_null_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two upserts into the NULL partition; the second moves some of the first's rows out of it."""
    co, _ = staged(spark, sf_dir)
    number = F.col("document_id").cast("long")
    blank = co.withColumn("receipt_at", F.when(number % 7 != 0, F.col("receipt_at")))
    table = INC.controlled_table(spark, work_path(spark, "fixture", "null_partition", unique=True))
    second = blank.filter(number % 2 == 1).unionByName(co.filter(number % 6 == 0))
    for batch in (blank.filter(number % 2 == 0), second):
        table.upsert(batch.withColumn(INC.CONTROLLED_PARTITION, INC.partition_value("receipt_at", CFG)))
    return INC.read_without_partition(table)


def q_incremental_empty_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first load without rows, then one with all of them."""
    raw_co, _ = fixture_sources(spark, sf_dir)
    path = work_path(spark, "fixture", "empty_first", unique=True)
    INC.load_controlled(spark, path, raw_co.filter("doc_id = 'none'"), CFG)
    INC.load_controlled(spark, path, raw_co, CFG)
    return INC.read_without_partition(INC.controlled_table(spark, path))


def q_stg_controlled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stream runs, some files a trigger, over files that land out of order; returns the staged table."""
    from docsentinel.streaming import ingest_controlled

    raw_co, _ = fixture_sources(spark, sf_dir)
    root = work_path(spark, "fixture", "stream", unique=True)
    landing, table, ckpt = f"{root}/landing", f"{root}/stg_documents_controlled", f"{root}/_checkpoint"
    part_of = F.coalesce(F.year("data_eventdate") % 3, F.lit(0))  # events without a date land last
    for part, rows in enumerate((part_of == 1, part_of == 2, part_of == 0)):
        raw_co.filter(rows).write.parquet(f"{landing}/part={part}")
        if part:
            ingest_controlled(spark, landing, table, ckpt, CFG, max_files_per_trigger=6)
    return INC.read_without_partition(INC.controlled_table(spark, table))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "stg_documents_controlled": q_stg_documents_controlled,
    "stg_documents_created": q_stg_documents_created,
    "documents_controled_detailed": q_documents_controled_detailed,
    "control_results": q_control_results,
    "ctl_control_results_over_time": q_ctl_control_results_over_time,
    "control_aggregation": q_control_aggregation,
    "status_bundle": q_status_bundle,
    "results_control_score": q_results_control_score,
    "results_control_score_2": q_results_control_score_2,
    "results_score_2_from_kept_rows": q_results_score_2_from_kept_rows,
    "control_monthly_trends": q_control_monthly_trends,
    "control_score_summary": q_control_score_summary,
    "results_control_latest": q_results_control_latest,
    "results_control_summary": q_results_control_summary,
    "documents_detailed_incremental": q_documents_detailed_incremental,
    "stg_controlled_incremental": q_stg_controlled_incremental,
    "concurrent_loads": q_concurrent_loads,
    "schema_evolution_append": q_schema_evolution_append,
    "schema_evolution_sync": q_schema_evolution_sync,
    "archive_upsert": q_archive_upsert,
    "quality_report": q_quality_report,
    "freshness_report": q_freshness_report,
    "partition_layout": q_partition_layout,
    "verify_objects": q_verify_objects,
    "rollback_report": q_rollback_report,
    "summary_view": q_summary_view,
    "latest_view": q_latest_view,
    "column_statistics": q_column_statistics,
    "quality_violations": q_quality_violations,
    "incremental_null_partition": q_incremental_null_partition,
    "incremental_empty_first_load": q_incremental_empty_first_load,
    "nightly_run": q_nightly_run,
    "nightly_quality": q_nightly_quality,
    "nightly_models": q_nightly_models,
    "stg_controlled_stream": q_stg_controlled_stream,
}
