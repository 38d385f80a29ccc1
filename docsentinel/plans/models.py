"""Analytic models over the staged events (M3-M9 and the history views H1, H2).

Every model joins control events (``co``) to creation events (``cr``) on
``document_id``. A document can have many events on both sides, so a plain join
fans out, and a single hot document would land, multiplied, in one task. The
plans below therefore reduce each side to what the model needs per document
*before* the join (map-side partial aggregation shrinks hot keys first), and
join the reduced sides. Results equal the row-level formulation.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from docsentinel.config import CHANNEL_NA, SCORE_NA, STATUS_NULL_LABEL, Config
from docsentinel.functions import exprs as X
from docsentinel.operators.dedupe import latest_per_key
from docsentinel.operators.snapshot import latest_snapshot
from docsentinel.operators.spine import densify_pivot, month_spine
from docsentinel.operators.status import COUNT_COLUMNS, FLAGS, count_flagged, distinct_status_counts, document_flags
from docsentinel.operators.trend import month_over_month

DOC = "document_id"
STATUS = "control_status"

DETAILED_COLUMNS = (
    "event_creation_document_id", "document_id", "document_receipt_at", "document_channel_acquisition_id",
    "acquisition_type", "document_subtype", "document_category", "document_issuing_country",
    "document_issue_year", "event_control_id", "control_applied_status", "control_receipt_at", "control_score",
    "control_controled_issue_at", "control_status", "document_face_id", "document_type", "control_domain",
    "control_channel_acquisition_id", "control_subject", "control_name", "unique_key",
)


def _date_text(d: dt.date) -> F.Column:
    return F.lit(d.isoformat())


def _created_at() -> F.Column:
    # ``now() at time zone 'UTC'``: wall-clock build time, never compared.
    return F.current_timestamp().cast("timestamp_ntz")


# -- M3 ---------------------------------------------------------------------------


def documents_controlled_detailed(co: DataFrame, cr: DataFrame, cfg: Config,
                                  issue_after: dt.datetime | None = None) -> DataFrame:
    """M3: each control event with every creation event of its document (left join).

    Full load: lookback window on ``issue_at``. Incremental load: only events
    strictly after ``issue_after`` (the target's high-water mark). This is the
    detailed fact, so the fan-out is the output itself; a hot document is
    handled by AQE's skew-join split of the larger (control) side.
    ``document_id`` is the creation side's: NULL, and empty in the key, for a
    control event of a document that was never created.
    """
    control_doc = "control_document_id"
    keep = co.filter(X.lookback("issue_at", cfg.as_of, cfg.lookback_days)) if issue_after is None else co.filter(
        F.col("issue_at") > X.ts_ntz(issue_after)
    )
    controls = keep.select(
        F.col(DOC).alias(control_doc),
        F.col("event_id").alias("event_control_id"),
        "control_applied_status",
        F.col("receipt_at").alias("control_receipt_at"),
        "control_score",
        F.col("issue_at").alias("control_controled_issue_at"),
        STATUS, "document_face_id", "document_type", "control_domain",
        F.col("channel_acquisition_id").alias("control_channel_acquisition_id"),
        "control_subject", "control_name",
    )
    creations = cr.select(
        DOC,
        F.col("event_id").alias("event_creation_document_id"),
        F.col("receipt_at").alias("document_receipt_at"),
        F.col("channel_acquisition_id").alias("document_channel_acquisition_id"),
        "acquisition_type", "document_subtype", "document_category", "document_issuing_country",
        "document_issue_year",
    )
    joined = controls.join(creations, F.col(control_doc) == F.col(DOC), "left")
    key = X.surrogate_key("event_control_id", DOC, F.col("control_controled_issue_at").cast("string"))
    return joined.select(*[c for c in DETAILED_COLUMNS if c != "unique_key"], key.alias("unique_key"))


# -- M4 ---------------------------------------------------------------------------

CONTROL_SIDE_DIMENSIONS = ("control_name", "channel_acquisition_id")
CREATION_SIDE_DIMENSIONS = ("document_category", "document_issuing_country", "document_issue_year")


FLAG_KEYS = ("issue_date", "channel_acquisition_id", "control_name")


def control_flags(co: DataFrame, cfg: Config) -> DataFrame:
    """Status flags per (document, month, channel, control) of the lookback: what M4 and M5 both need."""
    # A NULL document never joins a creation event.
    rows = co.filter(X.lookback("issue_at", cfg.as_of, cfg.lookback_days) & F.col(DOC).isNotNull()).select(
        DOC, STATUS, X.month_start("issue_at").alias("issue_date"), "channel_acquisition_id", "control_name"
    )
    return document_flags(rows, FLAG_KEYS)


def control_results(co: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    return control_results_from_flags(control_flags(co, cfg), cr, cfg)


def control_results_from_flags(flags: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    """M4: distinct-document status counts per value of five dimensions.

    Row-level definition: ``co ⋈ cr`` (inner, on document) within the lookback,
    unpivoted to ``(dimension_name, dimension_value)`` and counted. Because the
    join is on the document alone, a document counts for a creation-side value
    iff it has that value on some creation event and a control event in the
    window; and for a control-side value iff it has that value on a control
    event and any creation event.

    Each side is moved once, to its documents: the flags as they are (a row a document, month
    and value), the creation events as sets of their distinct values, which tasks collect
    before. Each document then yields its distinct values where it lies, from its lists: a
    creation value once with the document's flags, a control value once for the document and
    once for each flag it has (at once, if it is the only one). So no row is grouped by
    document and value again. The lists are bounded by a document's distinct values, not by its
    events, and are gone through once a flag.
    ``dimension_name`` is appended last: without it the output is ambiguous.
    """

    # A document's flags travel as the bits of one number; one more bit is the document itself.
    bits = {f: 1 << i for i, f in enumerate((*FLAGS, "is_document"))}
    whole = bits["is_document"]

    def entry(name: str, value: F.Column, mask: F.Column) -> F.Column:
        return F.struct(F.lit(name).alias("dimension_name"), value.alias("dimension_value"), mask.cast("int").alias("mask"))

    def distinct(items: F.Column, name: str, mask: F.Column) -> F.Column:
        values = F.array_distinct(F.transform(items, lambda c: c[name]))
        return F.transform(values, lambda v: entry(name, v, mask))

    def flagged(bit: int) -> F.Column:
        return F.filter("controls", lambda c: c["mask"].bitwiseAND(F.lit(bit)) != 0)

    def of_controls(name: str) -> list[F.Column]:
        whole_rows = distinct(F.col("controls"), name, F.lit(whole))
        return [whole_rows, *[distinct(flagged(bits[f]), name, F.lit(bits[f])) for f in FLAGS]]

    only = F.col("controls")[0]
    of_one = F.array(*[entry(n, only[n], only["mask"].bitwiseOR(F.lit(whole))) for n in CONTROL_SIDE_DIMENSIONS])
    of_several = F.concat(*[part for n in CONTROL_SIDE_DIMENSIONS for part in of_controls(n)])
    doc_mask = F.col("doc_mask").bitwiseOR(F.lit(whole))
    mask = sum((F.col(f) * bits[f] for f in FLAGS), F.lit(0)).cast("int").alias("mask")
    controls = flags.select(DOC, *CONTROL_SIDE_DIMENSIONS, mask).repartition(DOC).groupBy(DOC).agg(
        F.collect_set(F.struct(*CONTROL_SIDE_DIMENSIONS, "mask")).alias("controls"), F.bit_or("mask").alias("doc_mask")
    )
    creations = cr.filter(F.col(DOC).isNotNull()).groupBy(DOC).agg(
        F.collect_set(F.struct(*CREATION_SIDE_DIMENSIONS)).alias("creations")
    )
    # Both sides present: a control event in the window and a creation event.
    values = controls.join(creations, DOC, "inner").select(F.inline(F.concat(
        F.when(F.size("controls") == 1, of_one).otherwise(of_several),
        *[distinct(F.col("creations"), n, doc_mask) for n in CREATION_SIDE_DIMENSIONS],
    )))
    rows = values.select(
        "dimension_name", "dimension_value", *[F.getbit("mask", F.lit(i)).cast("int").alias(f) for i, f in enumerate(bits)],
    )
    counts = count_flagged(rows, ["dimension_name", "dimension_value"], documents="is_document")
    key = X.surrogate_key("dimension_name", "dimension_value", _date_text(cfg.as_of))
    return counts.select(
        F.col("dimension_value").alias("control_client_document"),
        "count_document",
        "count_ok", X.pct("count_ok", "count_document").alias("perc_ok"),
        "count_ko", X.pct("count_ko", "count_document").alias("perc_ko"),
        "count_na", X.pct("count_na", "count_document").alias("perc_na"),
        "count_null", X.pct("count_null", "count_document").alias("perc_null"),
        key.alias("unique_key"),
        "dimension_name",
    )


# -- M5 ---------------------------------------------------------------------------


def control_prefixes(cfg: Config) -> list[str]:
    return [f"ctl{i:02d}" for i in range(1, len(cfg.control_names) + 1)]


def monthly_control_facts(spark: SparkSession, flags: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    """Per (month, channel, category, control) distinct-document status counts.

    Row-level definition: ``co ⟕ cr`` in the lookback, month of ``issue_at``,
    NULL channel as ``client na``. Only spine values (configured channels,
    categories and controls, months up to ``as_of``) can survive the spine
    join, so each side is restricted to them first, by semi joins against the
    (fixed-size) value lists rather than by filters, which Catalyst
    would push below the JSON parsing of raw inputs and so evaluate it twice.
    A document counts for (month, channel, control, category) iff it has a
    control event there and a creation event of that category, so each side
    is reduced per document before the join, and moved to its documents once. The
    result has at most one row per (spine row, control).
    """
    named = flags.filter(F.col("issue_date") <= F.lit(cfg.as_of)).withColumn(
        "channel_acquisition_id", F.coalesce(F.col("channel_acquisition_id"), F.lit(CHANNEL_NA))
    )
    merged = named.repartition(DOC).groupBy(DOC, *FLAG_KEYS).agg(*[F.max(f).alias(f) for f in FLAGS])
    co_flags = in_values(spark, in_values(spark, merged, "channel_acquisition_id", cfg.channels),
                         "control_name", cfg.control_names)
    cr_sets = cr.filter(F.col(DOC).isNotNull()).groupBy(DOC).agg(F.collect_set("document_category").alias("categories"))
    cr_cat = in_values(spark, cr_sets.select(DOC, F.explode("categories").alias("document_category")), "document_category",
                       cfg.document_categories)
    return count_flagged(
        co_flags.join(cr_cat, DOC, "inner"), ["issue_date", "channel_acquisition_id", "document_category", "control_name"]
    )


def in_values(spark: SparkSession, df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose ``column`` is one of ``values``: a broadcast semi join on ``<=>``.

    Same rows as ``filter(col.isin(values))`` when ``values`` has no NULL, but
    not a predicate: an ``isin`` (or the ``isnotnull`` an equi-join infers)
    on a column derived from JSON text would be pushed by Catalyst down to
    the raw scan, re-parsing the JSON there.
    """
    lst = spark.createDataFrame([(v,) for v in values], f"`{column}` string").withColumnRenamed(column, "_value")
    return df.join(F.broadcast(lst), df[column].eqNullSafe(lst["_value"]), "left_semi")


SPINE_KEYS = ["issue_date", "channel_acquisition_id", "document_category"]


def control_spine(spark: SparkSession, cfg: Config) -> DataFrame:
    """Month x channel x category spine of the lookback window."""
    return month_spine(spark, cfg.lookback_start.replace(day=1), cfg.as_of, channel_acquisition_id=cfg.channels,
                       document_category=cfg.document_categories)


def ctl_control_results_over_time(spark: SparkSession, co: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    return over_time_from_flags(spark, control_flags(co, cfg), cr, cfg)


def over_time_from_flags(spark: SparkSession, flags: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    """M5: month x channel x category spine with 5 counts for each of the 11 controls.

    The facts are aggregated before the spine join: one pivot, not one join per control.
    """
    facts = monthly_control_facts(spark, flags, cr, cfg)
    dense = densify_pivot(
        control_spine(spark, cfg), facts, SPINE_KEYS, "control_name", cfg.control_names, COUNT_COLUMNS,
        control_prefixes(cfg),
    )
    key = X.surrogate_key(F.col("issue_date").cast("string"), "channel_acquisition_id", "document_category",
                          null_as_empty=False)
    return dense.select("*", key.alias("unique_key"))


def order_over_time(df: DataFrame) -> DataFrame:
    """Presentation order: newest month first, then channel and category."""
    return df.orderBy(F.col("issue_date").desc(), "channel_acquisition_id", "document_category")


def control_aggregation(spark: SparkSession, co: DataFrame, cr: DataFrame, cfg: Config, control: str,
                        prefix: str) -> DataFrame:
    """A14: status counts of one control per spine cell that has data (``{prefix}_count_*``).

    The source macro left-joins the spine to the base and then filters on the
    control name, which turns it into an inner join: cells without data do not
    appear. The spine has unique keys, so that join is a semi join.
    """
    facts = in_values(spark, monthly_control_facts(spark, control_flags(co, cfg), cr, cfg), "control_name", [control])
    on_spine = facts.join(control_spine(spark, cfg), SPINE_KEYS, "left_semi")
    return on_spine.select(*SPINE_KEYS, *[F.col(c).alias(f"{prefix}_{c}") for c in COUNT_COLUMNS])


# -- M6 / M7 shared base ------------------------------------------------------------


def latest_control_base(co: DataFrame, cr: DataFrame, cfg: Config) -> DataFrame:
    """Latest control event per (document, raw score) in the lookback, with its creation attributes.

    ``DISTINCT ON (document_id, control_score) ... ORDER BY issue_at DESC`` over
    ``co ⟕ cr``; ties are broken by control event id, then creation event id
    (both descending), which makes the kept row deterministic. With that order
    the kept joined row is the latest control row joined with the document's
    greatest creation event, so each side is reduced on its own first
    (one row per (document, score) and per document) and the join no longer
    fans out. The score is coalesced to ``controlna`` only after the dedupe:
    a raw NULL and a literal ``controlna`` remain two rows.
    """
    controls = co.filter(X.lookback("issue_at", cfg.as_of, cfg.lookback_days)).select(
        DOC, "control_score", "issue_at", "event_id", STATUS, "control_name", "channel_acquisition_id"
    )
    return base_of_latest(latest_per_key(controls, [DOC, "control_score"], ["issue_at", "event_id"]), cr)


def base_of_latest(latest: DataFrame, cr: DataFrame) -> DataFrame:
    """The score models' base from the latest control rows, computed or kept (``plans.latest_rows``)."""
    creations = latest_per_key(
        cr.select(DOC, "event_id", "document_category", "document_issuing_country", "document_issue_year"),
        [DOC], ["event_id"],
    ).drop("event_id")
    joined = latest.drop("event_id").join(creations, DOC, "left")
    return joined.select(
        DOC, STATUS, "issue_at",
        F.coalesce(F.col("control_score"), F.lit(SCORE_NA)).alias("control_score"),
        "control_name", "channel_acquisition_id", "document_category", "document_issuing_country",
        "document_issue_year",
    )


OF_SCORE, OF_STATUS = "_of_score", "_of_status"


def marked_base(base: DataFrame, marks: tuple[str, ...] = (OF_SCORE, OF_STATUS)) -> DataFrame:
    """The base with ``marks`` added if it lacks them: 1 on one row of each (document, score), or (document, score,
    status); 0 on the others and on rows without a document.

    A mark's sum counts distinct documents, so that one aggregate can take the attributes' sets
    and the dates from the same rows. The base has a row a (document, raw score): the sort
    under the windows meets no long group. One sort serves both marks, and a base that was just
    joined by document is not moved for them: stored with its marks, no score model moves it.
    """
    keys = {OF_SCORE: [DOC, "control_score"], OF_STATUS: [DOC, "control_score", STATUS]}
    sorts = {OF_SCORE: [STATUS, "issue_at"], OF_STATUS: ["issue_at"]}
    for mark in marks:
        if mark not in base.columns:
            place = F.row_number().over(Window.partitionBy(*keys[mark]).orderBy(*sorts[mark]))
            base = base.withColumn(mark, F.when(F.col(DOC).isNotNull() & (place == 1), 1).otherwise(0))
    return base


def _sizes(columns: dict[str, str]) -> list[F.Column]:
    """Numbers of distinct non-NULL values; the sets are small and are merged map-side."""
    return [F.size(F.collect_set(c)).cast("long").alias(n) for n, c in columns.items()]


RESULTS_SCORE_COLUMNS = (
    "control_score", "total_documents", "count_ok", "perc_ok", "count_ko", "perc_ko", "count_na", "perc_na",
    "count_null", "perc_null", "first_issue_date", "last_issue_date", "days_span", "unique_categories",
    "unique_countries", "metrics_json", "created_at", "snapshot_date", "unique_key",
)


def results_control_score(base: DataFrame, cfg: Config) -> DataFrame:
    """M6: per score, distinct documents overall and per status, dates, attributes, JSON."""
    marked = marked_base(base).select("*", *X.status_flags(STATUS))
    m = marked.groupBy("control_score").agg(
        F.sum(OF_SCORE).cast("long").alias("total_documents"),
        *[F.sum(F.col(OF_STATUS) * F.col(f)).cast("long").alias(f"count_{f[3:]}") for f in FLAGS],
        F.max("issue_at").cast("date").alias("last_issue_date"), F.min("issue_at").cast("date").alias("first_issue_date"),
        *_sizes({"unique_categories": "document_category", "unique_countries": "document_issuing_country"}),
    )
    pcts = {k: X.pct(f"count_{k}", "total_documents") for k in ("ok", "ko", "na", "null")}
    span = X.days_between("last_issue_date", "first_issue_date")
    metrics = F.struct(
        F.struct(
            F.col("count_ok").alias("ok"), F.col("count_ko").alias("ko"), F.col("count_na").alias("na"),
            F.col("count_null").alias("null"), F.col("total_documents").alias("total"),
        ).alias("counts"),
        F.struct(*[pcts[k].alias(f"{k}_pct") for k in ("ok", "ko", "na", "null")]).alias("percentages"),
        F.struct(
            F.col("first_issue_date").alias("first_date"), F.col("last_issue_date").alias("last_date"),
            span.alias("days_span"), F.col("unique_categories"), F.col("unique_countries"),
        ).alias("metadata"),
    )
    return m.select(
        "control_score", "total_documents",
        "count_ok", pcts["ok"].alias("perc_ok"), "count_ko", pcts["ko"].alias("perc_ko"),
        "count_na", pcts["na"].alias("perc_na"), "count_null", pcts["null"].alias("perc_null"),
        "first_issue_date", "last_issue_date", span.alias("days_span"), "unique_categories", "unique_countries",
        X.to_json_keep_nulls(metrics).alias("metrics_json"),
        _created_at().alias("created_at"),
        F.lit(cfg.as_of).alias("snapshot_date"),
        X.surrogate_key("control_score", _date_text(cfg.as_of), null_as_empty=False).alias("unique_key"),
    )


RESULTS_SCORE_2_COLUMNS = (
    "control_score", "control_status", "document_count", "total_documents", "percentage", "first_issue_date",
    "last_issue_date", "days_span", "unique_categories", "unique_countries", "unique_control_names",
    "unique_channels", "metrics_json", "created_at", "snapshot_date", "unique_key",
)


def results_control_score_2(base: DataFrame, cfg: Config) -> DataFrame:
    """M7 (flagship): per (score, status) counts, dates, attribute cardinalities and JSON.

    The per-score rollup (total, score date range) is a window over the small
    aggregated result rather than a self-join.
    """
    agg = marked_base(base, (OF_STATUS,)).groupBy("control_score", STATUS).agg(
        F.sum(OF_STATUS).cast("long").alias("document_count"),
        F.max("issue_at").cast("date").alias("last_issue_date"), F.min("issue_at").cast("date").alias("first_issue_date"),
        *_sizes({
            "unique_categories": "document_category", "unique_countries": "document_issuing_country",
            "unique_control_names": "control_name", "unique_channels": "channel_acquisition_id",
        }),
    )
    per_score = Window.partitionBy("control_score")
    rolled = agg.select(
        "*",
        F.sum("document_count").over(per_score).cast("long").alias("total_documents"),
        F.min("first_issue_date").over(per_score).alias("score_first_issue_date"),
        F.max("last_issue_date").over(per_score).alias("score_last_issue_date"),
    )
    percentage = X.pct("document_count", "total_documents")
    span = X.days_between("last_issue_date", "first_issue_date")
    metrics = F.struct(
        F.struct(
            F.col("document_count"), percentage.alias("percentage"), F.col("total_documents").alias("total_for_score")
        ).alias("metrics"),
        F.struct(
            F.col("first_issue_date").alias("first_date"), F.col("last_issue_date").alias("last_date"),
            span.alias("days_span"),
            F.struct(F.col("score_first_issue_date").alias("first"), F.col("score_last_issue_date").alias("last")).alias(
                "score_date_range"
            ),
        ).alias("dates"),
        F.struct(
            F.col("unique_categories").alias("categories"), F.col("unique_countries").alias("countries"),
            F.col("unique_control_names").alias("control_names"), F.col("unique_channels").alias("channels"),
        ).alias("dimensions"),
    )
    key = X.surrogate_key(
        "control_score", F.coalesce(F.col(STATUS), F.lit(STATUS_NULL_LABEL)), _date_text(cfg.as_of), null_as_empty=False
    )
    return rolled.select(
        "control_score", STATUS, "document_count", "total_documents", percentage.alias("percentage"),
        "first_issue_date", "last_issue_date", span.alias("days_span"), "unique_categories", "unique_countries",
        "unique_control_names", "unique_channels", X.to_json_keep_nulls(metrics).alias("metrics_json"),
        _created_at().alias("created_at"), F.lit(cfg.as_of).alias("snapshot_date"), key.alias("unique_key"),
    )


def order_results_score_2(df: DataFrame) -> DataFrame:
    """Presentation order: score, then OK, KO, NA, NULL, other."""
    return df.orderBy("control_score", X.status_rank(STATUS))


# -- M8 ---------------------------------------------------------------------------


def control_monthly_trends(co: DataFrame, cfg: Config) -> DataFrame:
    """M8: rolling-window monthly totals per score with month-over-month change.

    Control events only (no join, no dedupe): a document with two statuses in
    a month counts once per status in ``total_count``. Empty status buckets are
    NULL (``sum ... FILTER``), not 0.
    """
    start = dt.datetime.combine(cfg.trend_start, dt.time())
    monthly = (
        co.filter(F.col("issue_at") >= X.ts_ntz(start))
        .select(
            X.month_start("issue_at").alias("issue_month"),
            F.coalesce(F.col("control_score"), F.lit(SCORE_NA)).alias("control_score"),
            STATUS, DOC,
        )
        .groupBy("issue_month", "control_score", STATUS)
        .agg(F.count_distinct(DOC).alias("document_count"))
    )
    s = F.col(STATUS)
    summary = monthly.groupBy("issue_month", "control_score").agg(
        F.sum("document_count").cast("long").alias("total_count"),
        F.sum(F.when(s == "OK", F.col("document_count"))).cast("long").alias("count_ok"),
        F.sum(F.when(s == "KO", F.col("document_count"))).cast("long").alias("count_ko"),
        F.sum(F.when(s == "NA", F.col("document_count"))).cast("long").alias("count_na"),
        F.sum(F.when(s.isNull(), F.col("document_count"))).cast("long").alias("count_null"),
    )
    trend = month_over_month(summary, "control_score", "issue_month", "total_count")
    return trend.select(
        F.col("issue_month").alias("issue_month_date"), "control_score", "total_count",
        "count_ok", "count_ko", "count_na", "count_null",
        X.pct("count_ok", "total_count").alias("perc_ok"), X.pct("count_ko", "total_count").alias("perc_ko"),
        "prev_month_count", "mom_change", "mom_growth_pct", "mom_growth_pct_literal",
    )


# -- M9, H1, H2 -----------------------------------------------------------------------


def _status_sums(null_bucket: F.Column) -> list[F.Column]:
    s, n = F.col(STATUS), F.col("document_count")
    zero = F.lit(0).cast("long")
    return [
        F.sum(n).cast("long").alias("total_documents"),
        F.sum(F.when(s == "OK", n).otherwise(zero)).cast("long").alias("count_ok"),
        F.sum(F.when(s == "KO", n).otherwise(zero)).cast("long").alias("count_ko"),
        F.sum(F.when(s == "NA", n).otherwise(zero)).cast("long").alias("count_na"),
        F.sum(F.when(null_bucket, n).otherwise(zero)).cast("long").alias("count_null"),
    ]


def _latest_rollup(results: DataFrame, null_bucket: F.Column, date_name: str) -> DataFrame:
    """Status sums per score of the newest snapshot; rolled up per day first, so little is left to pick from."""
    daily = results.groupBy("snapshot_date", "control_score").agg(*_status_sums(null_bucket))
    return latest_snapshot(daily).withColumnRenamed("snapshot_date", date_name)


def control_score_summary(results: DataFrame) -> DataFrame:
    """M9: latest snapshot of M7 rolled up per score (NULL bucket: ``IS NULL``)."""
    rolled = _latest_rollup(results, F.col(STATUS).isNull(), "last_update")
    return rolled.select(
        "control_score", "total_documents", "count_ok", "count_ko", "count_na", "count_null",
        X.pct("count_ok", "total_documents").alias("perc_ok"), X.pct("count_ko", "total_documents").alias("perc_ko"),
        "last_update",
    )


def results_control_latest(results: DataFrame) -> DataFrame:
    """H1: all M7 columns of the latest snapshot."""
    return latest_snapshot(results)


def results_control_summary(results: DataFrame) -> DataFrame:
    """H2: like M9, but the NULL bucket also takes the ``'NULL'`` label; sorted by score."""
    s = F.col(STATUS)
    rolled = _latest_rollup(results, s.isNull() | (s == STATUS_NULL_LABEL), "last_snapshot")
    return rolled.select(
        "control_score", "total_documents", "count_ok", "count_ko", "count_na", "count_null",
        X.pct("count_ok", "total_documents").alias("perc_ok"), X.pct("count_ko", "total_documents").alias("perc_ko"),
        "last_snapshot",
    ).orderBy("control_score")


# -- A13 / E2 --------------------------------------------------------------------------


def status_bundle(co: DataFrame, by: str = "control_name") -> DataFrame:
    """A13 + E2: distinct-document status counts and their percentages per ``by``."""
    counts = distinct_status_counts(co, [by])
    return counts.select(by, *COUNT_COLUMNS, *X.status_percentages())
