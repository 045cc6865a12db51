"""Combine telemetry with machine, failure, error and maintenance records.

Plan shape
----------
``telemetry LEFT JOIN machines ON machine_id`` is a fact-to-dimension lookup;
Spark broadcasts ``machines`` when its size estimate is under
``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with the real size,
otherwise it is a sort-merge join. The event tables are first reduced to one
row per ``(datetime, machine_id)`` with a partial (map-side) aggregate, so the
join cannot fan out and the shuffle carries at most one row per key per map
task. The three event joins share the same keys, so after the first exchange
the telemetry side stays partitioned and the later joins add no exchange on it.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.names import normalize_table_name, resolve_column

log = logging.getLogger(__name__)

EVENT_TABLES = ("failures", "errors", "maint")
REQUIRED_TABLES = ("telemetry", "machines")


def with_row_order(df: DataFrame, order_col: str = "seq") -> DataFrame:
    """Make sure a row-order column exists.

    Sources that carry an order (an offset, an id, a sequence) keep it. Otherwise
    ``monotonically_increasing_id`` of the scan is used: it follows file order
    within a file and file-split order across files.
    """
    if order_col in df.columns:
        return df
    return df.withColumn(order_col, F.monotonically_increasing_id())


def first_per_key(df: DataFrame, keys: list[str], order_col: str = "seq",
                  keep_order_col: bool = False) -> DataFrame:
    """Keep the first row (lowest ``order_col``) per key.

    ``min_by`` is an ordinary aggregate, so Spark pre-aggregates per map task
    before the shuffle: the exchange carries at most one row per key per task,
    and a hot key is reduced map-side before it reaches its reducer.
    """
    df = with_row_order(df, order_col)
    rest = [c for c in df.columns if c not in keys]
    picked = F.min_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_first")
    out = df.groupBy(*keys).agg(picked).select(*keys, "_first.*")
    if not keep_order_col:
        out = out.drop(order_col)
    return out.select(*[c for c in df.columns if c in out.columns])


def _rename_key(df: DataFrame, key: str) -> DataFrame:
    found = resolve_column(df, key)
    if found is None:
        raise ValueError(f"table has no '{key}' column: {df.columns}")
    return df if found == key else df.withColumnRenamed(found, key)


def combine(tables: dict[str, DataFrame], *, key: str = "machine_id", time_col: str = "datetime",
            order_col: str = "seq", dedup_events: bool = True) -> DataFrame | None:
    """Telemetry LEFT machines LEFT first(failures) LEFT first(errors) LEFT first(maint).

    Table names are normalised (``PdM_telemetry_ingested`` -> ``telemetry``).
    Telemetry and machines are required: without them a warning is logged and
    None is returned. Absent event tables are skipped. ``dedup_events=False``
    gives the fan-out join (J3). The event tables' own order column is dropped.
    Output columns: telemetry columns, machine columns, then the event columns.
    """
    tabs = {normalize_table_name(k): v for k, v in tables.items()}
    for t in REQUIRED_TABLES:
        if t not in tabs:
            log.warning("missing '%s' table, skipping the combine step", t)
            return None
    tel = _rename_key(tabs["telemetry"], key)
    mac = _rename_key(tabs["machines"], key)
    out = tel.join(mac, on=key, how="left")  # J1
    for name in EVENT_TABLES:  # J2 / J3
        if name not in tabs:
            continue
        ev = _rename_key(tabs[name], key)
        if dedup_events:
            ev = first_per_key(ev, [time_col, key], order_col=order_col)
        elif order_col in ev.columns:
            ev = ev.drop(order_col)
        out = out.join(ev, on=[time_col, key], how="left")
    return out
