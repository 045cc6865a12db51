"""Spark-side inputs of the named queries: role views and their first stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.fixtures import role_tables, role_view
from faultline.operators.clean import add_failed_flag, merge_failure_component, sanitize_physical
from faultline.operators.combine import combine


def combined(spark: SparkSession, sf_dir: str, dedup_events: bool = True) -> DataFrame:
    return combine(role_tables(spark, sf_dir), dedup_events=dedup_events)


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """combined -> comp_failure (P6) -> failed."""
    return add_failed_flag(merge_failure_component(combined(spark, sf_dir)))


def sanitized_maintenance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitize_physical(role_view(spark, sf_dir, "maintenance"))
