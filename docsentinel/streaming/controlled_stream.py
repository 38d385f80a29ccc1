"""Streaming form of the incremental control-event staging (M1).

The batch form picks new rows by a high-water mark, so a row arriving late
(at or below the mark) is never loaded. Here the file source tracks which
files were processed, so any new file is read whatever its events' times: there
is no watermark and no state. Each micro-batch keeps the latest row of every
event and is delete+inserted by ``event_id`` into the same partitioned table,
which makes a replayed batch (after a failure) idempotent.
``trigger(availableNow=True)`` turns one run into "process everything that has
landed, then stop", i.e. a nightly job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsentinel.config import Config
from docsentinel.operators.dedupe import latest_where_repeated, repeated_hashes
from docsentinel.plans import incremental as INC
from docsentinel.plans.staging import stage_controlled
from docsentinel.sources.schemas import RAW_CONTROLLED
from docsentinel.sources.tables import checkpoint_table, delete_path


def ingest_controlled(spark: SparkSession, landing_path: str, table_path: str, checkpoint_location: str,
                      cfg: Config, max_files_per_trigger: int = 1000, policy: str = "sync_all_columns") -> None:
    """Run the stream until all landed files are processed.

    ``max_files_per_trigger`` only cuts a backlog into micro-batches; no row depends on it.
    Of several rows of one event in a micro-batch the one with the greatest receipt and
    issue time stays, then by the other columns. Which events have several rows is found from
    their ids' hashes alone, so that only those events' rows are grouped.
    """
    raw = (
        spark.readStream.schema(RAW_CONTROLLED)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .parquet(landing_path)
    )
    staged = stage_controlled(raw)
    columns = staged.columns
    order = ["receipt_at", "issue_at", *[c for c in columns if c not in ("event_id", "receipt_at", "issue_at")]]
    table = INC.controlled_table(spark, table_path)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        # Stored, so that Spark knows how small they are.
        repeated, path = checkpoint_table(spark, repeated_hashes(batch, ["event_id"]), "repeated")
        try:
            rows = latest_where_repeated(batch, ["event_id"], order, repeated if repeated.limit(1).collect() else None)
            table.upsert(rows.withColumn(INC.CONTROLLED_PARTITION, INC.partition_value("receipt_at", cfg)), policy)
        finally:
            delete_path(spark, path)

    query = (
        staged.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint_location)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
