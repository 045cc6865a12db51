import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faultline.operators import features as FE
from faultline.operators.segmented import keyed_row_windows
from faultline.operators.sequences import failure_labels, sequences


def _frame(spark):
    rows = []
    rng = np.random.default_rng(7)
    seq = 0
    for m in range(4):
        n = [1, 5, 40, 23][m]  # one machine with a single row
        for i in range(n):
            seq += 1
            t = dt.datetime(2024, 1, 1) + dt.timedelta(days=int(i * [1, 3, 1, 2][m]) // 2)  # equal timestamps
            v = None if (m == 2 and i % 7 == 3) else float(rng.normal(10, 3))
            rows.append((t, m, seq, v, float(rng.normal(0, 1))))
    return spark.createDataFrame(rows, "datetime timestamp_ntz, machine_id long, seq long, volt double, age double")


def _pandas_reference(pdf, cols):
    out = []
    for _, g in pdf.sort_values(["datetime", "seq"]).groupby("machine_id"):
        g = g.copy()
        for c in cols:
            g[f"{c}_roll_mean_3"] = g[c].rolling(3, min_periods=1).mean()
            g[f"{c}_roll_std_3"] = g[c].rolling(3, min_periods=1).std().fillna(0)
            g[f"{c}_lag_1"] = g[c].shift(1).fillna(g[c])
        out.append(g)
    return pd.concat(out).sort_values("seq").reset_index(drop=True)


def test_rolling_lag_match_pandas_and_plain_window(spark):
    df = _frame(spark)
    cols = ["volt", "age"]
    want = _pandas_reference(df.toPandas(), cols)
    for segment_rows in (1, 3, 30):
        got = (FE.rolling_and_lag(df.repartition(3), cols, segment_rows=segment_rows)
               .orderBy("seq").toPandas())
        for c in FE.roll_columns(cols):
            np.testing.assert_allclose(got[c].astype(float), want[c].astype(float), rtol=1e-9, atol=1e-12,
                                       err_msg=f"{c} segment={segment_rows}")
    plain = FE.rolling_and_lag(df, cols, skew_safe=False).orderBy("seq").toPandas()
    np.testing.assert_allclose(plain["volt_roll_std_3"].astype(float), want["volt_roll_std_3"].astype(float))


def test_single_row_machine(spark):
    out = FE.rolling_and_lag(_frame(spark), ["volt"]).filter(F.col("machine_id") == 0).first()
    assert out.volt_roll_std_3 == 0.0 and out.volt_lag_1 == out.volt and out.volt_roll_mean_3 == out.volt


def test_halo_spans_several_sparse_buckets(spark):
    rows = [(dt.datetime(2024, 1, 1) + dt.timedelta(days=10 * i), 1, i, float(i)) for i in range(12)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, machine_id long, seq long, v double")

    def compute(frame, w):
        return frame.select("*", F.collect_list("v").over(w.rowsBetween(-5, 0)).alias("hist"))
    got = keyed_row_windows(df, key="machine_id", order_cols=["datetime", "seq"], halo=5, compute=compute,
                            segment_rows=5).orderBy("seq").collect()
    assert [r.hist for r in got][-1] == [6.0, 7.0, 8.0, 9.0, 10.0, 11.0]
    assert [len(r.hist) for r in got] == [1, 2, 3, 4, 5, 6, 6, 6, 6, 6, 6, 6]


def test_one_hot_null_and_drop_first(spark):
    df = spark.createDataFrame([("model2",), (None,), ("model1",)], "model string")
    out = FE.one_hot(df, ["model"]).collect()
    assert [(r.model_model1, r.model_model2) for r in out] == [(0, 1), (0, 0), (1, 0)]
    assert FE.one_hot(df, ["model"], drop_first=True).columns == ["model_model2"]


def test_scaler_population_std_and_zero_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "a double, b double")
    scaled, params = FE.standard_scale(df, ["a", "b"])
    p = FE.scaler_params(params)
    assert p["a"] == (2.0, 1.0) and p["b"] == (5.0, 0.0)
    assert [r.a for r in scaled.collect()] == [-1.0, 1.0, None]
    assert [r.b for r in scaled.collect()] == [0.0, 0.0, 0.0]
    back = FE.inverse_scaler(scaled, p).collect()
    assert [r.a for r in back] == [1.0, 3.0, None]


def test_failure_labels(spark):
    d0 = dt.datetime(2024, 1, 1)
    rows = [(d0 + dt.timedelta(days=i), 1, i, 1 if i in (4, 20) else 0) for i in range(25)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, machine_id long, seq long, failed int")
    out = {r.seq: (r.ttf, r.label) for r in failure_labels(df, segment_rows=3).collect()}
    assert out[4] == (0.0, 1) and out[3] == (24.0, 1) and out[1] == (72.0, 1) and out[0] == (168.0, 0)
    assert out[21] == (168.0, 0) and out[17] == (72.0, 1)


def test_sequences_match_plain(spark):
    df = _frame(spark).fillna({"volt": 0.0}).withColumn("rotate", F.col("volt")).withColumn(
        "pressure", F.col("age")).withColumn("vibration", F.lit(1.0))
    a = sequences(df, length=4).select("seq", "ts").orderBy("seq").collect()
    b = sequences(df, length=4, skew_safe=False).select("seq", "ts").orderBy("seq").collect()
    assert a == b and len(a) == (5 - 3) + (40 - 3) + (23 - 3)


def test_hot_machine_is_split_across_tasks(spark):
    """One machine with a third of all rows: its window work lands in many tasks."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keep the planned partitions visible
    try:
        hot = [(0, dt.datetime(2024, 1, 1) + dt.timedelta(hours=6 * i), i, float(i % 17)) for i in range(1200)]
        cold = [(m, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), 10_000 + m * 100 + d, 1.0)
                for m in range(1, 25) for d in range(100)]
        df = spark.createDataFrame(hot + cold, "machine_id long, datetime timestamp_ntz, seq long, volt double")
        def parts(skew_safe):
            rows = (FE.rolling_and_lag(df, ["volt"], skew_safe=skew_safe, segment_rows=128)
                    .withColumn("pid", F.spark_partition_id()).collect())  # whole result, then count here
            return ({r.pid for r in rows if r.machine_id == 0},
                    sorted((r.seq, r.volt_roll_mean_3, r.volt_lag_1) for r in rows))
        hot_safe, a = parts(True)
        hot_plain, b = parts(False)
        assert len(hot_plain) == 1 and len(hot_safe) >= 4
        assert a == b
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_segments_add_few_rows_and_split_a_dense_week(spark):
    """Daily rows at length 64 are copied a sixteenth at most; a week of very many rows lies in many segments."""
    from faultline.operators.segmented import HALO_SHARE, ranked_segments
    seen = []

    def compute(frame, w):
        seen.append(frame)
        return frame.select("*", F.count("v").over(w.rowsBetween(-63, 0)).alias("n"))
    daily = spark.range(40_000).select((F.col("id") % 20).alias("machine_id"), "id", F.lit(1.0).alias("v"),
                                       F.expr("date_add(date'2000-01-01', cast(id div 20 as int))").alias("day"))
    out = keyed_row_windows(daily, key="machine_id", order_cols=["day", "id"], halo=63, compute=compute)
    assert seen[0].count() <= 40_000 * (1 + 1 / HALO_SHARE) + 63
    assert out.count() == 40_000 and out.where("n < 64").count() == 20 * 63
    week = spark.range(1_000_000).select(F.lit(1).alias("machine_id"), F.expr("timestamp_ntz'2024-01-01' + make_interval(0,0,0,0,0,0,id * 0.6)")
                                         .alias("t"), "id")
    sizes = [r["count"] for r in ranked_segments(week, "machine_id", ["t", "id"], 4096).groupBy("_seg").count().collect()]
    assert len(sizes) == 245 and max(sizes) == 4096


def test_sequence_stride_counts_from_the_first_window_of_each_machine(spark):
    rows = [(m, dt.datetime(2024, 1, 1) + dt.timedelta(days=i), m * 100 + i, float(i)) for m in (1, 2) for i in range(11)]
    df = spark.createDataFrame(rows, "machine_id long, datetime timestamp_ntz, seq long, volt double")
    for safe in (True, False):
        got = sequences(df, length=4, stride=3, skew_safe=safe).orderBy("seq").collect()
        assert [r.seq % 100 for r in got] == [3, 6, 9] * 2
        assert [x[0] for x in got[1].ts] == [3.0, 4.0, 5.0, 6.0]
