"""Presentation rules of the scoring output (P15, P16, P18) and ordering (O1-O3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.names import resolve_column
from faultline.operators.ordered import global_rank

# Fixed values that must equal the reference behaviour.
TREND_WORDS = ("sensor", "setting")
TREND_MAX_COLUMNS = 5
HIGH_RISK = "High Risk"
LOW_RISK = "Low Risk"
DEFAULT_HEALTH = 100
NO_RUL = "N/A"


def trend_columns(df: DataFrame) -> list[str]:
    """The first five columns whose name contains 'sensor' or 'setting' (any case)."""
    return [c for c in df.columns if any(w in c.lower() for w in TREND_WORDS)][:TREND_MAX_COLUMNS]


def sensor_trend(df: DataFrame, time_col: str | None = None) -> DataFrame:
    """The trend columns, in the order of the time column (which comes first) when one is given."""
    cols = trend_columns(df)
    out = df.select(*([time_col] if time_col else []), *[c for c in cols if c != time_col])
    return out.orderBy(time_col) if time_col else out


def assessment(df: DataFrame) -> DataFrame:
    """Risk label, remaining-life figure and health score of each result row.

    maintenance_required -> High Risk, else risk_level, else Low Risk;
    RUL from predicted_RUL, else rul, else "N/A"; health_score default 100.
    """
    def col(name):
        found = resolve_column(df, name)
        return F.col(found) if found else F.lit(None)

    req = F.coalesce(col("maintenance_required").cast("boolean"), F.lit(False))
    risk = F.when(req, F.lit(HIGH_RISK)).otherwise(F.coalesce(col("risk_level").cast("string"), F.lit(LOW_RISK)))
    rul = F.coalesce(col("predicted_RUL").cast("string"), col("rul").cast("string"), F.lit(NO_RUL))
    health = F.coalesce(col("health_score").cast("double"), F.lit(float(DEFAULT_HEALTH)))
    return df.select("*", risk.alias("risk_label"), rul.alias("rul_display"), health.alias("health_index"))


def chronological(df: DataFrame, time_col: str = "datetime", tie_cols=("machine_id",)) -> DataFrame:
    """O1: sort by time, ties by the given columns (range-partitioned global sort)."""
    return df.orderBy(time_col, *[c for c in tie_cols if c in df.columns])


def chronological_rank(df: DataFrame, time_col: str = "datetime", tie_cols=("machine_id",), out: str = "rank") -> DataFrame:
    """O1 with the place of every row, from 1: the order survives storage and can be compared."""
    return global_rank(df, [time_col, *[c for c in tie_cols if c in df.columns]], out)


def head(df: DataFrame, n: int = 5, order_cols=("datetime", "machine_id")) -> DataFrame:
    """O2: the first ``n`` rows in a stated order (top-n: each task keeps n, then one merge)."""
    return df.orderBy(*[c for c in order_cols if c in df.columns]).limit(n)


def top1(df: DataFrame, score: str, tie: str) -> DataFrame:
    """O3: the row with the highest ``score`` (ties: smallest ``tie``), one partial aggregate."""
    best = F.max_by(F.struct(*df.columns), F.struct(F.col(score), (-F.col(tie)).alias("_t")))
    return df.agg(best.alias("_b")).select("_b.*")
