import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.functions.names import normalize_table_name, resolve_column, standardize_column_name
from faultline.functions.numeric import lenient_number
from faultline.operators import clean
from faultline.operators.combine import combine, first_per_key


def test_column_names():
    assert standardize_column_name(" Vibration Level (mm/s) ") == "vibration_level_mm_per_s"
    assert standardize_column_name("Load Percentage") == "load_percentage"
    assert standardize_column_name("machineID") == "machine_id"
    assert standardize_column_name(" Machine ID ") == "machine_id"
    assert standardize_column_name("Load (%)") == "load"
    assert normalize_table_name("PdM_telemetry_ingested") == "telemetry"
    assert normalize_table_name("microsoft_azure_pmd_raw_v1_machines") == "machines"
    assert resolve_column(["machineID", "x"], "machine_id") == "machineID"


def test_standardize_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a_b` int")
    with pytest.raises(ValueError):
        clean.sanitize_physical(df)


def test_clip_null_negative_glitch(spark):
    df = spark.createDataFrame(
        [(None, -1.0, 16.0, 151.0), (-0.01, 2.0, 15.0, 150.0), (0.0, None, 14.0, 10.0),
         (100.0, 3.0, None, None), (100.01, 4.0, -2.0, -3.0)],
        "`Load Percentage` double, `Operating Hours` double, `Vibration Level (mm/s)` double, "
        "`Temperature C` double")
    out = clean.sanitize_physical(df).collect()
    assert [r.load_percentage for r in out] == [None, 0.0, 0.0, 100.0, 100.0]
    assert [r.operating_hours for r in out] == [None, 2.0, None, 3.0, 4.0]
    assert [r.vibration_level_mm_per_s for r in out] == [None, 15.0, 14.0, None, None]
    assert [r.temperature_c for r in out] == [None, 150.0, 10.0, None, None]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (-0.125,), (0.135,), (1.0,)], "volt double")
    assert [r.volt for r in clean.round_precision(df).collect()] == [0.12, -0.12, 0.14, 1.0]


def test_failure_component_and_flag(spark):
    df = spark.createDataFrame([("comp1", None, "error1"), (None, "comp2", None), (None, None, "error2"),
                                (None, None, None)], "failure string, comp string, errorID string")
    m = clean.add_failed_flag(clean.merge_failure_component(df))
    assert m.columns == ["errorID", "comp_failure", "failed"]
    assert [(r.comp_failure, r.failed) for r in m.collect()] == [("comp1", 1), ("comp2", 1), (None, 0), (None, 0)]
    assert clean.unresolved_errors(m).count() == 1
    only = clean.merge_failure_component(spark.createDataFrame([("c",)], "failure string"))
    assert only.columns == ["comp_failure"]
    none = spark.createDataFrame([(1,)], "x int")
    assert clean.add_failed_flag(clean.merge_failure_component(none)).columns == ["x"]
    assert clean.unresolved_errors(none).count() == 0


def test_first_per_key_uses_order_not_arrival(spark):
    rows = [(dt.datetime(2024, 1, 1), 1, "late", 9), (dt.datetime(2024, 1, 1), 1, "early", 3),
            (dt.datetime(2024, 1, 2), 1, "only", 5)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, machine_id long, failure string, seq long")
    for parts in (1, 3):
        out = first_per_key(df.repartition(parts), ["datetime", "machine_id"]).orderBy("datetime").collect()
        assert [r.failure for r in out] == ["early", "only"]
        assert "seq" not in out[0].asDict()


def test_combine_matches_pandas(spark):
    d1, d2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    tel = pd.DataFrame({"datetime": [d1, d2, d1], "machineID": [1, 1, 2], "volt": [1.0, 2.0, 3.0],
                        "seq": [1, 2, 3]})
    mac = pd.DataFrame({"machineID": [1], "model": ["model1"], "age": [5]})
    fai = pd.DataFrame({"datetime": [d1, d1], "machineID": [1, 1], "failure": ["comp2", "comp1"], "seq": [7, 4]})
    tables = {"PdM_telemetry": spark.createDataFrame(tel), "machines": spark.createDataFrame(mac),
              "failures": spark.createDataFrame(fai)}
    out = combine(tables, key="machineID").orderBy("seq").toPandas()
    assert list(out.columns) == ["machineID", "datetime", "volt", "seq", "model", "age", "failure"] or \
        list(out.columns) == ["datetime", "machineID", "volt", "seq", "model", "age", "failure"]
    assert out["failure"].tolist()[0] == "comp1"
    assert out["model"].isna().tolist() == [False, False, True]
    fan = combine(tables, key="machineID", dedup_events=False)
    assert fan.count() == 4
    assert combine({"telemetry": tables["PdM_telemetry"]}) is None


def test_counts(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", None), (None, float("nan"))], "c string, x double")
    vc = {(r.column, r.value): r.n for r in clean.value_counts(df, ["c"]).collect()}
    assert vc == {("c", "a"): 2, ("c", None): 1}
    mc = {r.column: r.n_missing for r in clean.missing_counts(df).collect()}
    assert mc == {"c": 1, "x": 2, "__total__": 3}
    assert clean.shape(df).first().asDict() == {"n_rows": 3, "n_cols": 2}
    assert clean.drop_exact_duplicates(df.union(df)).count() == 3
    assert clean.drop_if_present(df, "C", "missing").columns == ["x"]


def test_parse_datetime(spark):
    df = spark.createDataFrame([("2024-01-01 06:00:00",), ("garbage",)], "datetime string")
    out = clean.parse_datetime(df).collect()
    assert out[0].datetime == dt.datetime(2024, 1, 1, 6) and out[1].datetime is None
    assert dict(clean.parse_datetime(df).dtypes)["datetime"] == "timestamp_ntz"


def test_lenient_number(spark):
    df = spark.createDataFrame([("12abc",), ("",), (None,), ("x",), (" -3.5e2 ",)], "s string")
    assert [r[0] for r in df.select(lenient_number(F.col("s"))).collect()] == [12.0, 0.0, 0.0, 0.0, -350.0]
