"""Randomised checks: the skew-safe operators equal their plain forms for any layout."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from faultline.functions.nulls import sanitize_nested, zero_fill
from faultline.operators.features import rolling_and_lag
from faultline.operators.sequences import failure_labels

rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 60), st.one_of(st.none(), st.floats(-5, 5)), st.booleans()),
    min_size=1, max_size=60)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_strategy, days=st.integers(1, 20))
def test_windows_equal_plain_window(spark, rows, days):
    data = [(m, dt.datetime(2024, 1, 1) + dt.timedelta(days=d), i, v, int(f)) for i, (m, d, v, f) in enumerate(rows)]
    df = spark.createDataFrame(data, "machine_id long, datetime timestamp_ntz, seq long, volt double, failed int")
    a = rolling_and_lag(df, ["volt"], segment_rows=days).orderBy("seq").collect()
    b = rolling_and_lag(df, ["volt"], skew_safe=False).orderBy("seq").collect()
    for x, y in zip(a, b):
        for c in ("volt_roll_mean_3", "volt_roll_std_3", "volt_lag_1"):
            if x[c] is None or y[c] is None:
                assert x[c] is None and y[c] is None
            else:
                assert math.isclose(x[c], y[c], rel_tol=1e-9, abs_tol=1e-12)
    la = {r.seq: (r.ttf, r.label) for r in failure_labels(df, segment_rows=days).collect()}
    # plain reference: next failure at or after the row within the machine
    for s_, (m, d, _, _) in enumerate(rows):
        nxt = [d2 for (m2, d2, _, f2) in rows if m2 == m and f2 and d2 >= d]
        hours = (min(nxt) - d) * 24.0 if nxt else None
        want = (hours, 1) if hours is not None and hours <= 72 else (168.0, 0)
        assert la[s_] == want


def test_nested_sanitize_and_zero_fill(spark):
    df = spark.createDataFrame(
        [(1, {"a": float("nan"), "b": [1.0, float("inf"), None]}, {"k": float("-inf")}, None, None)],
        "id int, s struct<a: double, b: array<double>>, m map<string, double>, x double, t string")
    r = sanitize_nested(df).first()
    assert r.s.a == 0.0 and r.s.b == [1.0, 0.0, None] and r.m == {"k": 0.0} and r.x is None
    z = zero_fill(df.select("id", "x", "t")).first()
    assert z.x == 0.0 and z.t == "0"
