import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from faultline.operators.models import FailureModels, save_if_better, score, train_event_forest, \
    train_failure_models

SF001 = "/root/testdata/sf0.001"


def test_forest_refuses_tiny_input(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1.0, 1.0, 0, 1)] * 3,
                               "temperature double, pressure double, sensor_value double, calculated_index double, "
                               "detection_count int, is_anomaly int")
    with pytest.raises(ValueError):
        train_event_forest(df)


def test_failure_models_learn_and_save(spark, tmpdir_path):
    rows = []
    for i in range(400):
        y = int(i % 5 == 0)
        base = 5.0 if y else 1.0
        ts = [[base + (i % 3) * 0.1, 1.0, 2.0, base] for _ in range(4)]
        rows.append((i, ts, [base, 1.0, 2.0, base, 3.0], y, 10.0 if y else 168.0))
    df = spark.createDataFrame(rows, "seq long, ts array<array<double>>, num array<double>, label int, ttf double")
    models = train_failure_models(df, iterations=5)
    out = score(models, df).collect()
    acc = sum((r.score >= 0.5) == (r.label == 1) for r in out) / len(out)
    assert acc > 0.95 and all(r.ttf_pred >= 0 for r in out)
    path = os.path.join(tmpdir_path, "m")
    assert not save_if_better(models, 0.5, path)
    assert save_if_better(models, 0.7, path)
    again = score(FailureModels.load(path), df).select("score").collect()
    assert [r.score for r in again] == [r.score for r in out]


def test_entry_and_contract(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["column", "value", "n"] and len(rows) > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 40


@pytest.mark.parametrize("name", ["j4_combine", "w1_rolling_mean", "m5_knn_component", "a7_pr_curve",
                                  "s14_upsert_latest"])
def test_partitioning_does_not_change_results(spark, name):
    q = E.queries()[name]
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    a = sorted(map(tuple, q(spark, SF001).collect()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    b = sorted(map(tuple, q(spark, SF001).collect()), key=repr)
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert a == b
