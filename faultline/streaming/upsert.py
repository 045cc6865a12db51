"""Keyed sink of a stream on plain Parquet.

A micro-batch is written to a folder of its own, ``<table>/stream=<s>/batch=<b>``, with its last write per key; a batch
that is delivered again overwrites its folder, so a replay changes nothing. Readers keep the last write per key
over all folders (``max_by`` on the order column, combined map-side). The order must be the
source's own (an offset, a file's time and place), so that it means the same in every stream: a new stream over the same
source writes under another name and its copies of old events are simply the same writes.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from faultline.operators.events import latest_per_key

ORDER_COLUMN = "_seq"


def upsert_batch(batch: DataFrame, batch_id: int, table_path: str, *, key: str = "event_id",
                 order_col: str = ORDER_COLUMN, stream: str = "main") -> None:
    """Write one micro-batch; the last write per ``key`` by ``order_col`` counts."""
    out = os.path.join(table_path, "writes", f"stream={stream}", f"batch={int(batch_id)}")
    latest_per_key(batch, key, order_col).write.mode("overwrite").parquet(out)


def read_table(spark: SparkSession, table_path: str, *, key: str = "event_id",
               order_col: str = ORDER_COLUMN) -> DataFrame | None:
    """The current rows, one per key (None before the first batch)."""
    try:
        writes = spark.read.parquet(os.path.join(table_path, "writes"))
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise
    return latest_per_key(writes.drop("stream", "batch"), key, order_col)
