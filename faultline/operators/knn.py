"""Operators on the exact nearest-neighbour join (``knn_cells.knn_join``, J5): numeric imputation (M4)
and failure-component classification (M5).

Rows with equal features are one target, and its answer goes back to all of them by a null-safe
join on the features, so a repeated id never multiplies rows. Ids only break ties between donors at the same rounded
distance (the smaller one counts); several id columns are ranked in their order. Nothing is sampled or
capped, and no pair table is materialised.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.names import resolve_column
from faultline.operators.clean import add_failed_flag, error_column
from faultline.operators.features import apply_scaler, fit_categories, fit_scaler, scaler_params
from faultline.operators.knn_cells import CELL_ROWS, knn_join
from faultline.operators.ordered import global_rank
from faultline.session import materialize

# Fixed values that must equal the reference behaviour.
DEFAULT_SENSORS = ("temperature_c", "vibration_level_mm_per_s", "load_percentage", "operating_hours", "age")
DEFAULT_CATEGORICAL = ("model",)
COMPONENT_FEATURES = ("volt", "rotate", "pressure", "vibration", "temperature_c", "vibration_level_mm_per_s",
                      "load_percentage", "operating_hours", "model", "age")
N_NEIGHBORS = 5
def _encode(df: DataFrame, numeric: list[str], categorical: list[str], max_categories: int = 1000,
            fitted: dict | None = None):
    """Numeric columns + drop-first dummies (NULL category -> all zero), as doubles."""
    exprs, names = [F.col(c).cast("double") for c in numeric], list(numeric)
    if categorical:
        cats = fitted if fitted is not None else fit_categories(df, categorical, max_categories)
        for c in categorical:
            for v in cats[c][1:]:
                exprs.append(F.when(F.col(c).cast("string") == F.lit(str(v)), 1.0).otherwise(0.0))
                names.append(f"{c}_{v}")
    return exprs, names

_LAST_ID = 2 ** 63 - 1  # of rows without an id


def _with_id(df: DataFrame, id_col: str | list[str] | None, name: str) -> DataFrame:
    """The rows, written once, with a number that follows the id columns (their order where there are several)."""
    cols = [id_col] if isinstance(id_col, str) else list(id_col or [])
    if not cols or any(c not in df.columns for c in cols):
        return materialize(df.withColumn(name, F.monotonically_increasing_id()), "knn-rows")
    if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, T.IntegralType):
        return materialize(df.withColumn(name, F.coalesce(F.col(cols[0]).cast("long"), F.lit(_LAST_ID))), "knn-rows")
    return global_rank(df, cols, name)


def _any(conds: list[Column]) -> Column:
    out = F.lit(False)
    for c in conds:
        out = out | c
    return out


def _distinct_vectors(rows: DataFrame, vector: list[str]) -> DataFrame:
    """Each different vector once, numbered, as the join wants it."""
    one = rows.select(*[F.col(v).alias(f"_f{j}") for j, v in enumerate(vector)]).distinct()
    return materialize(one.withColumn("_tid", F.monotonically_increasing_id()), "knn-targets")


def _answers_to_rows(rows: DataFrame, vector: list[str], answers: DataFrame) -> DataFrame:
    """Rows with the answer of their vector, NULL-safe (one answer per vector, so no row is multiplied)."""
    on = F.lit(True)
    for j, v in enumerate(vector):
        on = on & F.col(v).eqNullSafe(F.col(f"_f{j}"))
    return rows.join(answers, on, "left")


# ---------------------------------------------------------------- M4

def knn_impute(df: DataFrame, *, columns=DEFAULT_SENSORS, categorical=DEFAULT_CATEGORICAL,
               k: int = N_NEIGHBORS, id_col: str | list[str] | None = "seq", scale: bool = True,
               block_rows: int = CELL_ROWS) -> DataFrame:
    """M4: fill NULLs of ``columns`` with the mean of the k nearest rows that have a value.

    Distance: nan-aware Euclidean over the (standard-scaled unless ``scale=False``)
    columns plus drop-first dummies of ``categorical``; only co-present coordinates
    count, scaled by total/present. Donors of a column are the rows where it is
    present. A row with no usable distance gets the column mean. Present values are
    left unchanged; a column with no value at all stays NULL. One row comes out per row that goes in.
    ``block_rows`` is the number of donors in a cell of the search; it doesn't change the result.
    """
    sensors = [c for c in columns if c in df.columns]
    cats = [c for c in categorical if c in df.columns]
    if not sensors:
        return df
    rows = _with_id(df, id_col, "_kid")
    missing = _any([F.col(c).isNull() for c in sensors])
    exprs, names = _encode(rows, sensors, cats)
    vector = [f"_v{j}" for j in range(len(names))]
    # one pass: scaler statistics of the features, fallback means, and whether there is anything to do
    stats = rows.agg(*[F.avg(e).alias(f"_a{j}") for j, e in enumerate(exprs)],
                     *[F.stddev_pop(e).alias(f"_s{j}") for j, e in enumerate(exprs)],
                     F.sum(missing.cast("long")).alias("_missing")).first()
    if not stats["_missing"]:  # nothing to impute (the reference skips the step too)
        return rows.select(*[F.col(f"`{c}`") for c in df.columns])
    enc = rows.select("*", *[e.alias(v) for e, v in zip(exprs, vector)])
    if scale:
        enc = apply_scaler(enc, {v: (stats[f"_a{j}"], stats[f"_s{j}"]) for j, v in enumerate(vector)})
    targets = _distinct_vectors(enc.where(missing), vector)
    donors = enc.where(_any([F.col(c).isNotNull() for c in sensors])).select(
        F.col("_kid").alias("_did"), *[F.col(v).alias(f"_f{j}") for j, v in enumerate(vector)],
        *[F.col(c).cast("double").alias(f"_r{i}") for i, c in enumerate(sensors)])
    est = knn_join(targets, donors, n_feat=len(names), k=k, nan_aware=True, impute_idx=list(range(len(sensors))),
                   cell_rows=block_rows, answer=lambda found: found.groupBy("_tid").agg(*[
                       F.avg(F.when(F.col("_task") == i, F.col("_val"))).alias(f"_e{i}") for i in range(len(sensors))]))
    solved = materialize(targets.join(est, "_tid").drop("_tid"), "knn-estimates")
    out = _answers_to_rows(enc.where(missing), vector, solved)
    fixed = {}
    for i, c in enumerate(sensors):
        fallback = F.lit(stats[f"_a{i}"]).cast("double")
        fixed[c] = F.coalesce(F.col(f"`{c}`").cast("double"), F.col(f"_e{i}"), fallback).alias(c)
    kept = rows.where(~missing).select(*[F.col(f"`{c}`").cast("double").alias(c) if c in fixed else F.col(f"`{c}`")
                                         for c in df.columns])
    return kept.unionByName(out.select(*[fixed.get(c, F.col(f"`{c}`")) for c in df.columns]))


# ---------------------------------------------------------------- M5

def knn_classify_component(df: DataFrame, *, feature_cols=COMPONENT_FEATURES, label: str = "comp_failure",
                           k: int = N_NEIGHBORS, id_col: str | list[str] | None = "seq",
                           block_rows: int = CELL_ROWS) -> DataFrame:
    """M5: predict the failure component of unresolved errors from the known ones.

    Targets: label NULL and an error logged (P8); donors: label known. Features:
    those of ``feature_cols`` present, ``model`` as drop-first dummies; NULL
    features are first filled with the unscaled M4 rule over all rows; then all
    rows are standard-scaled. Majority vote of the k nearest (Euclidean), ties
    to the smallest class name. Other rows are unchanged; ``failed`` is added.
    """
    if label not in df.columns:
        return df
    err = error_column(df)
    feats = [resolve_column(df, c) for c in feature_cols]
    feats = [c for c in feats if c]
    if err is None or not feats:
        return add_failed_flag(df)
    rows = _with_id(df, id_col, "_mid")
    cats = [c for c in feats if c == "model"]
    nums = [c for c in feats if c not in cats]
    fitted = fit_categories(rows, cats + [label])  # one pass for the dummies and the class list
    exprs, names = _encode(rows, nums, cats, fitted=fitted)
    vector = [f"_x{j}" for j in range(len(names))]
    classes = fitted[label]  # sorted, size-guarded
    asked = F.col(label).isNull() & F.col(err).isNotNull()
    todo = rows.agg(F.sum(asked.cast("long")), F.sum(F.col(label).isNotNull().cast("long"))).first()
    if not todo[0] or not todo[1]:  # nobody to ask for, or nobody to ask: labels stay
        return add_failed_flag(rows.select(*[F.col(f"`{c}`") for c in df.columns]))
    cls_arr = F.array(*[F.lit(c) for c in classes])
    enc = rows.select("*", *[e.alias(v) for e, v in zip(exprs, vector)],
                      (F.array_position(cls_arr, F.col(label)) - 1).cast("int").alias("_lab"))
    if rows.select(_any([e.isNull() for e in exprs]).alias("x")).where("x").take(1):
        enc = materialize(knn_impute(enc, columns=vector, categorical=(), k=k, id_col="_mid", scale=False,
                                      block_rows=block_rows), "knn-vote-input")
    enc = apply_scaler(enc, scaler_params(fit_scaler(enc, vector)))
    targets = _distinct_vectors(enc.where(asked), vector)
    donors = enc.where(F.col(label).isNotNull()).select(
        F.col("_mid").alias("_did"), *[F.col(v).alias(f"_f{j}") for j, v in enumerate(vector)], "_lab")
    # most votes, then the smallest class name (codes follow the sorted class names)
    pred = knn_join(targets, donors, n_feat=len(names), k=k, nan_aware=False, cell_rows=block_rows, answer=lambda found: (
        found.groupBy("_tid", F.col("_lab").alias("_code")).agg(F.count(F.lit(1)).alias("_v")).groupBy("_tid").agg(
            F.min_by("_code", F.struct((-F.col("_v")).alias("nv"), F.col("_code").alias("lab"))).alias("_code"))))
    solved = materialize(targets.join(pred, "_tid").select(
        *[f"_f{j}" for j in range(len(names))], F.element_at(cls_arr, F.col("_code") + 1).alias("_pred")), "knn-votes")
    out = _answers_to_rows(enc.where(asked), vector, solved)
    out = out.select(*[F.col("_pred").alias(label) if c == label else F.col(f"`{c}`") for c in df.columns])
    return add_failed_flag(rows.where(~asked).select(*[F.col(f"`{c}`") for c in df.columns]).unionByName(out))
