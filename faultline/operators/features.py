"""Feature operators: one-hot (M1, M2), scaler fit/apply/inverse (A6, M3),
rolling mean/std and lag per machine (W1-W3), and the engineered table.

Fitting is separate from applying (no leakage by construction): the caller
chooses the rows a scaler or category list is fitted on. Fitted parameters are
a handful of values per column; they are brought to the driver and applied as
literals, so applying them is a narrow projection with no join or shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.functions.names import resolve_column
from faultline.operators.segmented import keyed_row_windows
from faultline.session import materialize

# Fixed values of the feature stage.
ONE_HOT_COLUMNS = ("model", "errorid", "comp_failure")
NUMERIC_FEATURES = ("volt", "rotate", "pressure", "vibration", "age")
ROLL_WINDOW = 3
LAG = 1


# ---------------------------------------------------------------- one-hot

def fit_categories(df: DataFrame, columns, max_categories: int = 1000) -> dict[str, list]:
    """Sorted distinct non-null values per column (one small aggregate per column).

    Raises when a column has more than ``max_categories`` values: thousands of
    dummy columns are a schema error, not a feature.
    """
    columns = list(columns)
    if not columns:
        return {}
    if len(columns) == 1:
        c = columns[0]
        pairs = df.select(F.lit(0).alias("i"), F.col(c).alias("v")).where(F.col("v").isNotNull())
    else:  # one pass for all columns: (column index, value) pairs, values as strings
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)
        ])).alias("p")).select("p.*").where(F.col("v").isNotNull())
    limit = len(columns) * (max_categories + 1)
    rows = pairs.distinct().limit(limit).collect()  # bounded by the guard
    types = dict(df.dtypes)
    out = {c: [] for c in columns}
    for r in rows:
        c = columns[r["i"]]
        v = r["v"]
        if isinstance(v, str) and types[c] in ("int", "bigint", "smallint", "tinyint"):
            v = int(v)
        elif isinstance(v, str) and types[c] in ("double", "float"):
            v = float(v)
        out[c].append(v)
    for c, vals in out.items():
        if len(vals) > max_categories:
            raise ValueError(f"column {c} has more than {max_categories} categories")
        vals.sort()  # natural order of the column type
    return out


def categories_frame(spark, cats: dict[str, list]) -> DataFrame:
    """Fitted categories as a table (column, category, position, place of the column) for saving."""
    rows = [(c, str(v), i, place) for place, (c, vs) in enumerate(cats.items()) for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "column string, category string, position int, place int")


def apply_one_hot(df: DataFrame, cats: dict[str, list], drop_first: bool = False) -> DataFrame:
    """Replace each categorical column by ``<col>_<value>`` 0/1 ints (NULL -> all 0).

    Dummy columns go after the other columns, in the order of ``cats``.
    """
    keep = [F.col(c) for c in df.columns if c not in cats]
    dummies = []
    for c, vals in cats.items():
        for v in (vals[1:] if drop_first else vals):
            dummies.append(F.when(F.col(c).cast("string") == F.lit(str(v)), 1).otherwise(0).alias(f"{c}_{v}"))
    return df.select(*keep, *dummies)


def one_hot(df: DataFrame, columns=ONE_HOT_COLUMNS, drop_first: bool = False,
            max_categories: int = 1000) -> DataFrame:
    """M1 (``drop_first=False``) / M2 (``drop_first=True``) on the columns present."""
    present = [resolve_column(df, c) for c in columns]
    present = [c for c in present if c]
    if not present:
        return df
    return apply_one_hot(df, fit_categories(df, present, max_categories), drop_first)


# ---------------------------------------------------------------- scaler

def fit_scaler(df: DataFrame, columns) -> DataFrame:
    """Per-column mean and population std (NULLs ignored), one global aggregate.

    Returns a params table (column, mean, std) with one row per column.
    """
    aggs = []
    for i, c in enumerate(columns):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").cast("double").alias("mean"),
                     F.col(f"s{i}").cast("double").alias("std")) for i, c in enumerate(columns)]
    return wide.select(F.explode(F.array(*rows)).alias("p")).select("p.*")


def scaler_params(params: DataFrame) -> dict[str, tuple[float, float]]:
    """Bring the (small, one row per column) params table to the driver."""
    return {r["column"]: (r["mean"], r["std"]) for r in params.collect()}


def _scale(std):
    return 1.0 if std is None or std == 0 else std


def apply_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    """M3: ``(x - mean) / std``; a zero std divides by 1."""
    def expr(c):
        m, s = params[c]
        return ((F.col(c) - F.lit(m if m is not None else 0.0)) / F.lit(_scale(s))).alias(c)
    return df.select(*[expr(c) if c in params else F.col(c) for c in df.columns])


def inverse_scaler(df: DataFrame, params: dict[str, tuple[float, float]]) -> DataFrame:
    def expr(c):
        m, s = params[c]
        return (F.col(c) * F.lit(_scale(s)) + F.lit(m if m is not None else 0.0)).alias(c)
    return df.select(*[expr(c) if c in params else F.col(c) for c in df.columns])


def standard_scale(df: DataFrame, columns) -> tuple[DataFrame, DataFrame]:
    """Fit on ``df`` and apply; returns (scaled, params table)."""
    params = fit_scaler(df, columns)
    return apply_scaler(df, scaler_params(params)), params


# ---------------------------------------------------------------- rolling / lag

def roll_columns(columns, window: int = ROLL_WINDOW, lag: int = LAG) -> list[str]:
    """Names in the order the engineered table lists them."""
    names = []
    for c in columns:
        names += [f"{c}_roll_mean_{window}", f"{c}_roll_std_{window}"]
    return names + [f"{c}_lag_{lag}" for c in columns]


def rolling_and_lag(df: DataFrame, columns, *, key: str = "machine_id",
                    order_cols=("datetime", "seq"), window: int = ROLL_WINDOW, lag: int = LAG,
                    skew_safe: bool = True, segment_rows: int | None = None) -> DataFrame:
    """W1-W3 per machine in time order.

    mean over the last ``window`` rows (at least one present value), sample std
    over the same rows with fewer than two values -> 0, and the value ``lag``
    rows back falling back to the current value.
    """
    order_cols = [c for c in order_cols if c in df.columns]

    def compute(frame: DataFrame, w):
        fw = w.rowsBetween(-(window - 1), 0)
        new = []
        for c in columns:
            new += [F.avg(c).over(fw).alias(f"{c}_roll_mean_{window}"),
                    F.coalesce(F.stddev_samp(c).over(fw), F.lit(0.0)).alias(f"{c}_roll_std_{window}")]
        new += [F.coalesce(F.lag(c, lag).over(w), F.col(c)).alias(f"{c}_lag_{lag}") for c in columns]
        return frame.select("*", *new)

    return keyed_row_windows(df, key=key, order_cols=order_cols, halo=max(window - 1, lag),
                             compute=compute, segment_rows=segment_rows, skew_safe=skew_safe)


def engineer_features(df: DataFrame, *, key: str = "machine_id", order_cols=("datetime", "seq"),
                      one_hot_columns=ONE_HOT_COLUMNS, numeric=NUMERIC_FEATURES,
                      window: int = ROLL_WINDOW, lag: int = LAG, keep_key: bool = False,
                      fit_filter: Column | None = None, skew_safe: bool = True,
                      max_categories: int = 1000) -> tuple[DataFrame, DataFrame]:
    """E1 step 4: one-hot, rolling mean/std, lag, standard scaling.

    The machine id orders and partitions the windows and is dropped at the end
    unless ``keep_key``. The scaler is fitted on all rows (default: all
    rows). Returns (model table, scaler params).
    """
    key = resolve_column(df, key) or key
    df = one_hot(df, one_hot_columns, max_categories=max_categories)
    nums = [c for c in numeric if c in df.columns]
    feat = rolling_and_lag(df, nums, key=key, order_cols=order_cols, window=window, lag=lag,
                           skew_safe=skew_safe)
    feat = materialize(feat, "features")  # fitted and applied from one computed copy
    eng = nums + roll_columns(nums, window, lag)
    params = fit_scaler(feat if fit_filter is None else feat.filter(fit_filter), eng)
    out = apply_scaler(feat, scaler_params(params))
    if not keep_key:
        out = out.drop(key)
    return out, params
