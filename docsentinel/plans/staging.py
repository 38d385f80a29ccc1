"""Staging: raw events -> typed, renamed, decoded DataFrames (M1, M2).

Both are narrow projections (no shuffle); JSON is parsed once per column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsentinel.functions import exprs as X

CONTROLLED_COLUMNS = (
    "event_id",
    "control_applied_status",
    "receipt_at",
    "document_id",
    "control_score",
    "issue_at",
    "control_status",
    "control_scores",
    "document_face_id",
    "document_type",
    "control_domain",
    "channel_acquisition_id",
    "control_identifier",
    "control_subject",
    "control_name",
)

CREATED_COLUMNS = (
    "event_id",
    "receipt_at",
    "issue_at",
    "document_id",
    "channel_acquisition_id",
    "acquisition_type",
    "document_subtype",
    "document_category",
    "document_issuing_country",
    "document_issue_year",
)


def stage_controlled(raw: DataFrame) -> DataFrame:
    """M1: one row per control event; only the first control / face is read."""
    ctl = X.json_first("data_documentcontrolsdata_documentcontrols_anonymized", ["identifier", "status", "scores"])
    face = X.json_first("data_documentcontrolsdata_documentfaceids", ["id", "type", "domain", "organizationId"])
    staged = raw.select(
        F.col("id").alias("event_id"),
        F.col("data_documentcontrolsdata_status").alias("control_applied_status"),
        F.col("data_eventdate").alias("receipt_at"),
        F.col("doc_id").alias("document_id"),
        F.col("data_score").alias("control_score"),
        F.col("time").alias("issue_at"),
        ctl.alias("_ctl"),
        face.alias("_face"),
    )
    flat = staged.selectExpr(
        "event_id", "control_applied_status", "receipt_at", "document_id", "control_score", "issue_at",
        "_ctl.status AS control_status", "_ctl.scores AS control_scores", "_face.id AS document_face_id",
        "_face.type AS document_type", "_face.domain AS control_domain",
        "_face.organizationId AS channel_acquisition_id", "lower(trim(_ctl.identifier)) AS control_identifier",
    )
    return flat.select(
        "*",
        X.control_subject("control_identifier").alias("control_subject"),
        X.control_name("control_identifier").alias("control_name"),
    )


def stage_created(raw: DataFrame) -> DataFrame:
    """M2: one row per creation event, with category / country / year decoded."""
    subtype = "data_documentclass_documentsubtype"
    return raw.select(
        F.col("id").alias("event_id"),
        F.col("data_eventdate").alias("receipt_at"),
        F.col("time").alias("issue_at"),
        F.col("data_id_id").alias("document_id"),
        F.col("data_acquisitionid_organizationid").alias("channel_acquisition_id"),
        F.expr("lower(trim(data_acquisitionid_type))").alias("acquisition_type"),
        F.expr(f"lower(trim({subtype}))").alias("document_subtype"),
        F.expr("lower(trim(data_documentclass_documenttype))").alias("document_category"),
        X.lower_trim(X.issuing_country(subtype)).alias("document_issuing_country"),
        X.lower_trim(X.issue_year(subtype)).alias("document_issue_year"),
    )
