"""Named queries: zero fill, nested sanitise, trend columns, assessment, ReLU, ordering
(P13-P16, P18, O1-O3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.functions.nulls import sanitize_nested, zero_fill
from faultline.operators.assess import assessment, chronological, chronological_rank, head, sensor_trend, top1
from faultline.operators.models import relu
from faultline.plans import oracle_ctes as C
from faultline.plans.inputs import combined
from faultline.plans.registry import register
from faultline.plans.util import round_floats


@register("p13_zero_fill", views=["envelopes"], sql="""
SELECT event_id, seq, event_time,
       CASE WHEN temperature IS NULL OR isnan(temperature) OR isinf(temperature) THEN 0.0 ELSE temperature END
         AS temperature,
       CASE WHEN pressure IS NULL OR isnan(pressure) OR isinf(pressure) THEN 0.0 ELSE pressure END AS pressure,
       CASE WHEN sensor_value IS NULL OR isnan(sensor_value) OR isinf(sensor_value) THEN 0.0 ELSE sensor_value END
         AS sensor_value,
       coalesce(image_path, '0') AS image_path
FROM envelopes
""")
def p13_zero_fill(spark, sf):
    return zero_fill(role_view(spark, sf, "envelopes"))


@register("p14_sanitize_nested", sql="""
SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN isnan(x) OR isinf(x) THEN CAST(0.0 AS FLOAT) ELSE x END)
         AS embedding, label
FROM embeddings
""")
def p14_sanitize_nested(spark, sf):
    role_view(spark, sf, "scores")  # registers the base tables for this folder
    return sanitize_nested(spark.table("embeddings"))


@register("p15_sensor_trend", views=["envelopes"], sql="SELECT event_time, sensor_value FROM envelopes")
def p15_sensor_trend(spark, sf):
    return sensor_trend(role_view(spark, sf, "envelopes"), "event_time")


@register("p16_assessment", views=["scores"], sql="""
SELECT id, CASE WHEN label = 1 THEN 'High Risk' ELSE 'Low Risk' END AS risk_label,
       CAST(CAST(round(score * 240) AS BIGINT) AS VARCHAR) AS rul_display, CAST(100 AS DOUBLE) AS health_index
FROM scores
""")
def p16_assessment(spark, sf):
    s = role_view(spark, sf, "scores").select(
        "id", (F.col("label") == 1).alias("maintenance_required"),
        F.round(F.col("score") * 240).cast("long").alias("predicted_RUL"))
    return assessment(s).select("id", "risk_label", "rul_display", "health_index")


@register("p18_relu", views=["scores"], sql="SELECT id, round(greatest(score - 0.5, 0.0), 6) AS margin FROM scores")
def p18_relu(spark, sf):
    s = role_view(spark, sf, "scores")
    return round_floats(s.select("id", relu(F.col("score") - 0.5).alias("margin")))


@register("o1_chronological", views=C.COMBINED_VIEWS, ctes=C.COMBINED,
          sql="SELECT datetime, machine_id, seq FROM combined ORDER BY datetime, machine_id")
def o1_chronological(spark, sf):
    return chronological(combined(spark, sf).select("datetime", "machine_id", "seq"))


@register("o1_chronological_rank", views=C.COMBINED_VIEWS, ctes=C.COMBINED, sql="""
SELECT datetime, machine_id, seq, row_number() OVER (ORDER BY datetime, machine_id, seq) AS "rank" FROM combined
""")
def o1_chronological_rank(spark, sf):
    df = combined(spark, sf).select("datetime", "machine_id", "seq")
    return chronological_rank(df, tie_cols=("machine_id", "seq"))


@register("o2_head", views=C.COMBINED_VIEWS, ctes=C.COMBINED, sql="""
SELECT datetime, machine_id, seq, volt FROM combined ORDER BY datetime, machine_id, seq LIMIT 5
""")
def o2_head(spark, sf):
    return head(combined(spark, sf).select("datetime", "machine_id", "seq", "volt"), 5,
                ("datetime", "machine_id", "seq"))


@register("o3_top_score", views=["scores"], sql="""
SELECT id, label, round(score, 6) AS score FROM scores ORDER BY score DESC, id ASC LIMIT 1
""")
def o3_top_score(spark, sf):
    return round_floats(top1(role_view(spark, sf, "scores"), "score", "id"))
