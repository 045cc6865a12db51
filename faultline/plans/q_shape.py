"""Named queries: column names, dates, dropped columns, parsed envelopes, image plans and counts
(P1, P2, P10, T1, M14, A13)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.functions.names import standardize_columns
from faultline.operators import events as EV
from faultline.operators.clean import drop_if_present, parse_datetime
from faultline.plans.registry import register
from faultline.sources.images import letterbox_plan, outcome_counts

#: Headers of the maintenance file as its source writes them.
RAW_HEADERS = {"operating_hours": "Operating Hours", "temperature_c": " Temperature (C)",
               "vibration_level_mm_per_s": "Vibration Level (mm/s)", "load_percentage": "Load  Percentage (%) ",
               "l_orderkey": "machineID"}


@register("p1_column_names", views=["maintenance"], sql="""
SELECT l_orderkey AS machine_id, l_partkey, l_suppkey, l_linenumber, operating_hours, temperature_c,
       vibration_level_mm_per_s, load_percentage FROM maintenance
""")
def p1_column_names(spark, sf):
    raw = role_view(spark, sf, "maintenance").withColumnsRenamed(RAW_HEADERS)
    return standardize_columns(raw)


_TEXT_DATE = "CASE WHEN event_id % 29 = 4 THEN 'not a date' WHEN event_id % 29 = 7 THEN NULL ELSE {day} END"


@register("p2_parse_datetime", sql="""
SELECT event_id, CASE WHEN event_id % 29 IN (4, 7) THEN NULL ELSE date_trunc('second', ts) END AS datetime FROM events
""")
def p2_parse_datetime(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    text = F.expr(_TEXT_DATE.format(day="date_format(ts, 'yyyy-MM-dd HH:mm:ss')"))
    return parse_datetime(ev.select("event_id", text.alias("datetime")))


@register("p10_drop_if_present", views=["telemetry"], sql="SELECT datetime, volt, rotate, vibration FROM telemetry")
def p10_drop_if_present(spark, sf):
    return drop_if_present(role_view(spark, sf, "telemetry"), "machineID", "Pressure", "SEQ", "absent")


#: Every 23rd text is cut off, every 41st has no id.
_JSON_TEXT = """
SELECT seq, CASE WHEN seq % 23 = 5 THEN substring(j, 1, 20) ELSE j END AS value FROM (
  SELECT seq, to_json(named_struct('eventId', CASE WHEN seq % 41 = 3 THEN NULL ELSE event_id END, 'imagePath', image_path,
    'numericData', named_struct('temperature', temperature, 'pressure', pressure, 'sensorValue', sensor_value),
    'timestamp', date_format(event_time, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))) AS j FROM envelopes)
"""


def _texts(spark, sf):
    role_view(spark, sf, "envelopes").createOrReplaceTempView("envelopes")
    return spark.sql(_JSON_TEXT)


@register("t1_parse_envelopes", views=["envelopes"], sql="""
SELECT seq, event_id, strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp, coalesce(temperature, 0.0) AS temperature,
       coalesce(pressure, 0.0) AS pressure, coalesce(sensor_value, 0.0) AS sensor_value, image_path,
       temperature IS NULL OR pressure IS NULL OR sensor_value IS NULL AS had_null_reading
FROM envelopes WHERE seq % 23 <> 5 AND seq % 41 <> 3
""")
def t1_parse_envelopes(spark, sf):
    return EV.parse_envelopes(_texts(spark, sf), "value")[0]


@register("t1_quarantine", views=["envelopes"], sql="SELECT seq FROM envelopes WHERE seq % 23 = 5 OR seq % 41 = 3")
def t1_quarantine(spark, sf):
    return EV.parse_envelopes(_texts(spark, sf), "value")[1].select("seq")


#: Image sizes by part: wide, tall and square ones.
_SIZES = """
SELECT concat('/img/p', CAST(p_partkey AS {S}), '.jpg') AS path, CAST(40 + p_partkey % 700 AS int) AS width,
       CAST(CASE WHEN p_partkey % 9 = 0 THEN 40 + p_partkey % 700 ELSE 30 + p_size * 17 END AS int) AS height FROM part
"""


@register("m14_letterbox_plan", sql=f"""
WITH s AS ({_SIZES.format(S="VARCHAR")}),
n AS (SELECT *, CASE WHEN width >= height THEN 256 ELSE CAST(round_even(width * 1e0 / height * 256, 0) AS INTEGER) END AS new_width,
             CASE WHEN height >= width THEN 256 ELSE CAST(round_even(height * 1e0 / width * 256, 0) AS INTEGER) END AS new_height FROM s)
SELECT path, width, height, new_width, new_height,
       CASE WHEN new_width <> 256 THEN CAST(round_even((256 - new_width) * 0.5e0, 0) AS INTEGER) ELSE 0 END AS pad_left,
       CASE WHEN new_width = 256 AND new_height <> 256 THEN CAST(round_even((256 - new_height) * 0.5e0, 0) AS INTEGER) ELSE 0 END AS pad_top,
       replace(split_part(path, '/', 3), '.jpg', '.png') AS target_name FROM n
""")
def m14_letterbox_plan(spark, sf):
    spark.read.parquet(f"{sf}/part.parquet").createOrReplaceTempView("part")
    return letterbox_plan(spark.sql(_SIZES.format(S="string")))


@register("a13_image_counts", sql="""
SELECT count(*) AS total, count(*) FILTER (event_type IN ('view', 'click')) AS kept,
       count(*) FILTER (event_type = 'error') AS removed_corrupt, count(*) FILTER (event_type = 'signup') AS removed_blank,
       count(*) FILTER (event_type = 'purchase') AS undecodable FROM events
""")
def a13_image_counts(spark, sf):
    ev = spark.read.parquet(f"{sf}/events.parquet")
    outcome = (F.when(F.col("event_type").isin("view", "click"), "kept").when(F.col("event_type") == "error", "corrupt")
               .when(F.col("event_type") == "signup", "blank").otherwise("undecodable"))
    return outcome_counts(ev.select(outcome.alias("outcome")))
