"""MLlib models and their artifacts.

* M7: random forest on the five event features with the rule label (P12).
* M9: the failure / time-to-failure model re-aimed to Spark: each sequence
  sample is summarised JVM-side with higher-order array functions (mean, std,
  min, max, last per sensor), weighted logistic regression for the failure
  probability (inverse class frequency weights, A5) and gradient-boosted trees
  for the hours to failure, clamped at 0 (P18).
* M10: batch scoring; M12: save only when F1 clears the gate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.operators.events import FEATURE_COLUMNS
from faultline.operators.metrics import alerts, with_class_weight

# Fixed values that must equal the reference behaviour.
FOREST_TREES = 100
MIN_TRAIN_ROWS = 5
SEED = 42
QUALITY_F1 = 0.60


def relu(c: Column | str) -> Column:
    """Non-negative output."""
    c = F.col(c) if isinstance(c, str) else c
    return F.greatest(c, F.lit(0.0))


# ---------------------------------------------------------------- M7

def train_event_forest(train: DataFrame, *, label: str = "is_anomaly", features=FEATURE_COLUMNS,
                       trees: int = FOREST_TREES, seed: int = SEED) -> PipelineModel:
    """Random forest on the event features. Refuses fewer than 5 rows."""
    if train.limit(MIN_TRAIN_ROWS).count() < MIN_TRAIN_ROWS:
        raise ValueError(f"need at least {MIN_TRAIN_ROWS} rows to train")
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")
    rf = RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=seed)
    return Pipeline(stages=[asm, rf]).fit(train)


# ---------------------------------------------------------------- M9 / M10

def _stat(ts: Column, j: int, how: str) -> Column:
    xs = F.transform(ts, lambda v: v[j])
    # a missing reading takes no part; without any, the statistic is missing
    n = F.nullif(F.size(F.filter(xs, lambda x: x.isNotNull())), F.lit(0))
    s = F.aggregate(xs, F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))
    if how == "mean":
        return s / n
    if how == "std":
        mean = s / n
        ss = F.aggregate(xs, F.lit(0.0), lambda a, x: a + (F.coalesce(x, mean) - mean) * (F.coalesce(x, mean) - mean))
        return F.sqrt(ss / n)
    if how == "min":
        return F.array_min(xs)
    if how == "max":
        return F.array_max(xs)
    return F.element_at(xs, -1)  # last


SUMMARIES = ("mean", "std", "min", "max", "last")


def summarize_sequences(df: DataFrame, n_sensors: int = 4, n_static: int = 5) -> DataFrame:
    """Flatten ``ts`` / ``num`` into model columns with array functions (no UDF)."""
    cols = [_stat(F.col("ts"), j, h).alias(f"s{j}_{h}") for j in range(n_sensors) for h in SUMMARIES]
    cols += [F.element_at("num", i + 1).alias(f"n{i}") for i in range(n_static)]
    # missing readings (e.g. a machine without metadata) count as 0 for the linear model
    return df.select("*", *cols).na.fill(0.0, subset=summary_columns(n_sensors, n_static))


def summary_columns(n_sensors: int = 4, n_static: int = 5) -> list[str]:
    return [f"s{j}_{h}" for j in range(n_sensors) for h in SUMMARIES] + [f"n{i}" for i in range(n_static)]


@dataclass
class FailureModels:
    classifier: PipelineModel
    regressor: PipelineModel

    def save(self, path: str) -> None:
        """Both pipelines under one folder (overwrite)."""
        self.classifier.write().overwrite().save(f"{path}/classifier")
        self.regressor.write().overwrite().save(f"{path}/regressor")

    @staticmethod
    def load(path: str) -> "FailureModels":
        return FailureModels(PipelineModel.load(f"{path}/classifier"), PipelineModel.load(f"{path}/regressor"))


def train_failure_models(samples: DataFrame, *, label: str = "label", ttf: str = "ttf",
                         iterations: int = 20, seed: int = SEED) -> FailureModels:
    """M9: weighted logistic regression (failure) + GBT regression (hours to failure)."""
    feats = summary_columns()
    data = with_class_weight(summarize_sequences(samples), label, "weight")
    asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")
    clf = Pipeline(stages=[asm, LogisticRegression(labelCol=label, weightCol="weight", maxIter=iterations)])
    reg = Pipeline(stages=[asm, GBTRegressor(labelCol=ttf, maxIter=iterations, seed=seed)])
    return FailureModels(clf.fit(data), reg.fit(data))


def score(models: FailureModels, samples: DataFrame, threshold: float | None = None) -> DataFrame:
    """Failure probability, hours to failure (>= 0) and the alert text per sample."""
    data = summarize_sequences(samples)
    p = models.classifier.transform(data).select(
        *samples.columns, vector_to_array("probability")[1].alias("score"), *summary_columns())
    r = models.regressor.transform(p).withColumn("ttf_pred", relu("prediction"))
    return alerts(r.select(*samples.columns, "score", "ttf_pred"), threshold)


def save_if_better(models, f1: float, path: str, min_f1: float = QUALITY_F1) -> bool:
    """Save only when ``f1 >= min_f1``; returns whether it was saved."""
    if f1 is not None and f1 >= min_f1:
        models.save(path) if hasattr(models, "save") else models.write().overwrite().save(path)
        return True
    return False
