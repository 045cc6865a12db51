"""Row-framed windows per key that stay balanced when one key is huge.

``Window.partitionBy(machine_id)`` sends every row of a machine to one task;
if one machine holds a third of the data that task holds a third of the data.
Rolling, lag and sequence features only look ``halo`` rows back, so the rows
can be cut into segments, and each segment only needs the last ``halo`` rows before it:

1. rows get their place in the order (key, order columns) by a range shuffle and one write
   (``ordered.global_rank``), so the input is computed once;
2. a segment is ``rows`` consecutive places, whatever keys, dates or gaps they hold: sparse stretches share a segment
   and a dense one is cut into many;
3. the last ``halo`` places of a segment are copied into the next one (a segment is at least ``HALO_SHARE``
   times as long as its halo, so copies add a sixteenth at most); windows run over
   ``partitionBy(key, segment)`` and the copies are dropped.

The result is identical to the plain per-key window for any data layout.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.ordered import global_rank

SEGMENT_ROWS = 4096  # rows of a segment at least
HALO_SHARE = 16


def ranked_segments(df: DataFrame, key: str, order_cols: list, rows: int) -> DataFrame:
    """``df`` with ``_at``, the row's place in (key, order columns), and ``_seg``, its segment of ``rows`` places."""
    ranked = global_rank(df, [F.col(key), *order_cols], "_at")
    return ranked.withColumn("_seg", F.expr(f"(_at - 1) div {int(rows)}"))


def keyed_row_windows(
    df: DataFrame,
    *,
    key: str,
    order_cols: list[str],
    halo: int,
    compute: Callable[[DataFrame, Window], DataFrame],
    segment_rows: int | None = None,
    skew_safe: bool = True,
) -> DataFrame:
    """Apply ``compute(frame, window)`` where ``window`` orders the rows of one key.

    ``compute`` must only use frames reaching at most ``halo`` rows back
    (``rowsBetween(-halo, 0)``, ``lag(n <= halo)``). ``order_cols`` must give
    a total order within a key (add a tie-break column). ``segment_rows`` (default: ``SEGMENT_ROWS`` or 16 halos)
    doesn't change the result. ``skew_safe=False`` gives the plain ``partitionBy(key)`` plan.
    """
    if halo < 0:
        raise ValueError("halo must be >= 0")
    if not skew_safe:
        w = Window.partitionBy(key).orderBy(*order_cols)
        return compute(df, w)
    rows = max(segment_rows or max(SEGMENT_ROWS, HALO_SHARE * halo), halo, 1)
    d = ranked_segments(df, key, order_cols, rows)
    last = (F.col("_at") - 1) % rows >= rows - halo
    into = F.when(last, F.array("_seg", F.col("_seg") + 1)).otherwise(F.array("_seg"))
    u = d.withColumn("_to", F.explode(into))
    w = Window.partitionBy(key, "_to").orderBy("_at")
    return compute(u, w).where("_to = _seg").drop("_at", "_seg", "_to")
