"""Sequence samples and failure labels per machine.

Both are per-machine ordered computations made skew-safe:

* W5 needs, for every row, the next failure at or after it -- an unbounded
  look-ahead. It is a two-level suffix minimum over segments of consecutive rows: the first
  failure of every (machine, segment) -> a small table gives the first failure
  after each segment -> a running minimum inside each segment finishes it.
* W4 windows look ``length - 1`` rows back, so they use the halo segments of
  :mod:`faultline.operators.segmented`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.segmented import SEGMENT_ROWS, keyed_row_windows, ranked_segments
from faultline.session import broadcast_if_small

# Fixed values of the label rule.
IMMINENT_HOURS = 72.0
NO_FAILURE_TTF = 168.0
SEQUENCE_LENGTH = 64
SENSORS = ("volt", "rotate", "pressure", "vibration")
STATIC = ("volt", "rotate", "pressure", "vibration", "age")


def failure_labels(df: DataFrame, *, key: str = "machine_id", time_col: str = "datetime",
                   failed_col: str = "failed", segment_rows: int = SEGMENT_ROWS,
                   horizon_hours: float = IMMINENT_HOURS, default_ttf: float = NO_FAILURE_TTF) -> DataFrame:
    """``ttf`` = hours to the next failure at or after the row when within the
    horizon, else ``default_ttf``; ``label`` = 1 when within the horizon."""
    failed = F.coalesce(F.col(failed_col) == 1, F.lit(False))
    fail_t = F.when(failed, F.col(time_col))
    # failures come last among rows of the same time, so every such row has them at or after it
    d = ranked_segments(df, key, [F.col(time_col), failed], segment_rows)
    firsts = d.groupBy(key, "_seg").agg(F.min(fail_t).alias("_ff"))
    later = Window.partitionBy(key).orderBy(F.col("_seg").desc()).rowsBetween(Window.unboundedPreceding, -1)
    after = firsts.select(F.col(key).alias("_k"), F.col("_seg").alias("_s"), F.min("_ff").over(later).alias("_after"))
    inside = Window.partitionBy(key, "_seg").orderBy(F.col("_at").desc()).rowsBetween(Window.unboundedPreceding, 0)
    own = d.withColumn("_own", F.min(fail_t).over(inside))
    after = broadcast_if_small(after.where(F.col("_after").isNotNull()))
    j = own.join(after, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_seg") == F.col("_s")), "left")
    nxt = F.least(F.col("_own"), F.col("_after"))
    hours = F.timestamp_diff("SECOND", F.col(time_col), nxt) / 3600.0
    within = hours.isNotNull() & (hours <= horizon_hours)
    return j.select(*df.columns,
                    F.when(within, hours).otherwise(F.lit(default_ttf)).alias("ttf"),
                    within.cast("int").alias("label"))


def sequences(df: DataFrame, *, key: str = "machine_id", order_cols=("datetime", "seq"),
              sensors=SENSORS, static=STATIC, length: int = SEQUENCE_LENGTH, stride: int = 1,
              skew_safe: bool = True) -> DataFrame:
    """For every row with ``length`` rows of history, the last ``length`` sensor
    vectors (``ts``: array<array<double>>, oldest first) and the row's static numbers
    (``num``). With a ``stride``, only the first window of a key and every ``stride``-th after it.
    """
    if stride < 1:
        raise ValueError("stride must be >= 1")
    order_cols = [c for c in order_cols if c in df.columns]
    sensors = [c for c in sensors if c in df.columns]
    static = [c for c in static if c in df.columns]

    def compute(frame, w):
        vec = F.array(*[F.col(c).cast("double") for c in sensors])
        ts = F.collect_list(vec).over(w.rowsBetween(-(length - 1), 0))
        if stride == 1:
            return frame.select("*", ts.alias("ts"))
        if skew_safe:  # place within the key: the place in the order less the key's first one
            first = frame.groupBy(F.col(key).alias("_k")).agg(F.min("_at").alias("_first"))
            frame = (frame.join(broadcast_if_small(first), F.col(key).eqNullSafe(F.col("_k")))
                     .withColumn("_n", F.col("_at") - F.col("_first")).drop("_k", "_first"))
        else:
            frame = frame.withColumn("_n", F.row_number().over(w) - 1)
        # windows that the stride skips are not built
        return frame.select("*", F.when((F.col("_n") - (length - 1)) % stride == 0, ts).alias("ts")).drop("_n")

    out = keyed_row_windows(df, key=key, order_cols=order_cols, halo=length - 1, compute=compute,
                            skew_safe=skew_safe)
    out = out.filter(F.size("ts") == length)
    return out.withColumn("num", F.array(*[F.col(c).cast("double") for c in static]))
