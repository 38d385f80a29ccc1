"""Batch readers for the raw event tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from docsentinel.sources.schemas import RAW_CONTROLLED, RAW_CREATED


def read_raw_controlled(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan with the declared schema; projections prune columns."""
    return spark.read.schema(RAW_CONTROLLED).parquet(path)


def read_raw_created(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_CREATED).parquet(path)
