"""Ranks and running totals over a global order, without a single-task window.

``Window.orderBy(x)`` without a partition puts every row into one task. Here the rows are
range-partitioned by the order, numbered or summed inside each partition, and written once; a
table with one row per partition (so its size is bounded by the number of tasks)
then gives what lies before each partition. Cost: one range shuffle and
one write, whatever the data. Ties are cut in any order, so callers
that need a repeatable result give a total order.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.session import materialize

_PART = "_part"


def _sorted(df: DataFrame, order: list) -> DataFrame:
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _earlier(parts: DataFrame, sizes: dict[str, str], totals: bool) -> DataFrame:
    """Per partition, what the partitions before it hold (one row per partition: small)."""
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    cols = [F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias(out) for size, out in sizes.items()]
    if totals:
        cols += [F.sum(size).over(Window.partitionBy()).alias(f"{out}_all") for size, out in sizes.items()]
    return F.broadcast(parts.select(_PART, *cols))


def global_rank(df: DataFrame, order: list[Column | str], out: str = "rank") -> DataFrame:
    """``df`` and the row's place (from 1) in ``order``. Rows with equal keys get different, consecutive ranks."""
    rows = (_sorted(df, order).withColumn("_at", F.monotonically_increasing_id())
            .withColumn(_PART, F.shiftright("_at", 33)))
    rows = materialize(rows, "ranked")
    parts = rows.groupBy(_PART).agg(F.count(F.lit(1)).alias("_n"))
    place = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.join(_earlier(parts, {"_n": "_before"}, False), _PART)
            .select(*[F.col(f"`{c}`") for c in df.columns], (F.col("_before") + place + 1).alias(out)))


def _within(at: list[int], fields: pa.Schema):
    """Sums of the rows before each row of the partition, carried from batch to batch."""
    def run(batches):
        carried = [0] * len(at)
        for b in batches:
            more = []
            for k, i in enumerate(at):
                v = np.asarray(b.column(i).fill_null(0)).astype(np.int64)
                upto = np.cumsum(v) + carried[k]
                more.append(pa.array(upto - v))
                if len(v):
                    carried[k] = int(upto[-1])
            yield pa.RecordBatch.from_arrays([*b.columns, *more], names=[*b.schema.names, *fields])
    return run


def running_totals(df: DataFrame, order: list[Column | str], values: list[str]) -> DataFrame:
    """``df`` with, per whole-number column ``v`` of ``values``, ``before_v`` and ``all_v``.

    ``before_v`` is the exact sum of ``v`` over the rows that come earlier in ``order``, ``all_v`` the sum
    over all rows; NULL counts as 0. Sums are 64-bit integers. An empty table stays empty.
    """
    local = [f"_in_{v}" for v in values]
    schema = T.StructType([*df.schema.fields, *[T.StructField(x, T.LongType()) for x in local]])
    rows = (_sorted(df, order).mapInArrow(_within([df.columns.index(v) for v in values], local), schema)
            .withColumn(_PART, F.spark_partition_id()))
    rows = materialize(rows, "running")
    parts = rows.groupBy(_PART).agg(*[F.sum(v).cast("bigint").alias(v) for v in values])
    sums = {v: f"_before_{v}" for v in values}
    return (rows.join(_earlier(parts, sums, True), _PART)
            .select(*[F.col(f"`{c}`") for c in df.columns],
                    *[(F.col(x) + F.col(f"_before_{v}")).alias(f"before_{v}") for v, x in zip(values, local)],
                    *[F.coalesce(F.col(f"_before_{v}_all"), F.lit(0)).alias(f"all_{v}") for v in values]))
