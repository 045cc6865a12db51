"""Named queries: envelopes, health index, detections, keyed upsert, event features,
anomaly label, hash split, balanced sample, random forest (S13-S15, P11, P12, J6, A12, M6-M8)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.operators import events as EV
from faultline.plans.registry import register
from faultline.plans.util import round_floats

ENV_VIEWS = ["envelopes", "detections"]
_PROC = [
    ("det", "SELECT image_path, list(class_name ORDER BY class_name) AS detected_objects, "
            "CAST(count(*) AS INTEGER) AS detection_count FROM detections GROUP BY image_path"),
    ("proc", """SELECT e.event_id, e.seq, strftime(e.event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS timestamp,
       coalesce(e.temperature, 0.0) AS temperature, coalesce(e.pressure, 0.0) AS pressure,
       coalesce(e.sensor_value, 0.0) AS sensor_value,
       coalesce(e.temperature, 0.0) * 0.5 + coalesce(e.pressure, 0.0) * 0.3 + coalesce(e.sensor_value, 0.0) * 0.2
         AS calculated_index,
       e.image_path,
       CASE WHEN e.image_path IS NULL THEN []::VARCHAR[] ELSE coalesce(d.detected_objects, []::VARCHAR[]) END
         AS detected_objects,
       CASE WHEN e.image_path IS NULL THEN 0 ELSE coalesce(d.detection_count, 0) END AS detection_count
FROM envelopes e LEFT JOIN det d ON e.image_path = d.image_path"""),
    ("latest", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY seq DESC) "
               "AS rn FROM proc) WHERE rn = 1"),
]


def processed(spark, sf, latest=True, objects=True):
    """envelopes -> readings (missing -> 0) -> [latest per id] -> health index + detections.

    The last write per id is taken before anything is joined, and the lists of objects only where they are asked for.
    """
    env = role_view(spark, sf, "envelopes")
    ev = env.select("event_id", "seq", F.date_format("event_time", EV.ISO_MILLIS).alias("timestamp"),
                    F.coalesce("temperature", F.lit(0.0)).alias("temperature"),
                    F.coalesce("pressure", F.lit(0.0)).alias("pressure"),
                    F.coalesce("sensor_value", F.lit(0.0)).alias("sensor_value"), "image_path")
    if latest:
        ev = EV.latest_per_key(ev, "event_id", "seq")
    found = role_view(spark, sf, "detections")
    return EV.process_events(ev, per_image=EV.detections_per_image(found) if objects else EV.detection_counts(found))


@register("s13_envelope_json", views=["envelopes"], sql="""
SELECT event_id, seq, CAST(json_object(
  'eventId', event_id, 'imagePath', image_path,
  'numericData', json_object('temperature', coalesce(temperature, 0.0), 'pressure', coalesce(pressure, 0.0),
                             'sensorValue', coalesce(sensor_value, 0.0)),
  'timestamp', strftime(event_time, '%Y-%m-%dT%H:%M:%S.%g') || 'Z') AS VARCHAR) AS envelope
FROM envelopes
""")
def s13_envelope_json(spark, sf):
    env = role_view(spark, sf, "envelopes")
    return env.select("event_id", "seq", EV.build_envelopes(env).alias("envelope"))


@register("p11_health_index", views=ENV_VIEWS, ctes=_PROC,
          sql="SELECT event_id, seq, round(calculated_index, 6) AS calculated_index FROM proc")
def p11_health_index(spark, sf):
    return round_floats(processed(spark, sf, latest=False, objects=False).select("event_id", "seq", "calculated_index"))


@register("a12_detections_per_image", views=["detections"], ctes=_PROC[:1], sql="SELECT * FROM det")
def a12_detections_per_image(spark, sf):
    return EV.detections_per_image(role_view(spark, sf, "detections"))


@register("j6_event_detections", views=ENV_VIEWS, ctes=_PROC,
          sql="SELECT event_id, seq, image_path, detected_objects, detection_count FROM proc")
def j6_event_detections(spark, sf):
    return processed(spark, sf, latest=False).select("event_id", "seq", "image_path", "detected_objects",
                                                     "detection_count")


@register("s14_upsert_latest", views=ENV_VIEWS, ctes=_PROC, sql="""
SELECT event_id, seq, timestamp, temperature, pressure, sensor_value, round(calculated_index, 6) AS calculated_index,
       image_path, detected_objects, detection_count FROM latest
""")
def s14_upsert_latest(spark, sf):
    return round_floats(processed(spark, sf))


@register("s15_event_features", views=ENV_VIEWS, ctes=_PROC, sql="""
SELECT temperature, pressure, sensor_value, round(calculated_index, 6) AS calculated_index, detection_count
FROM latest
""")
def s15_event_features(spark, sf):
    return round_floats(EV.event_features(processed(spark, sf, objects=False)))


@register("p12_anomaly_label", views=ENV_VIEWS, ctes=_PROC, sql="""
SELECT event_id, CAST(coalesce(temperature > 40 OR detection_count > 0, false) AS INTEGER) AS is_anomaly FROM latest
""")
def p12_anomaly_label(spark, sf):
    return processed(spark, sf, objects=False).select("event_id", EV.anomaly_label().alias("is_anomaly"))


_H = "CAST(('0x' || substr(md5(event_id || '|42'), 1, 7)) AS BIGINT)"


@register("m6_hash_split", views=ENV_VIEWS, ctes=_PROC,
          sql=f"SELECT event_id, CASE WHEN {_H} % 10 < 8 THEN 'train' ELSE 'test' END AS part FROM latest")
def m6_hash_split(spark, sf):
    train, test = EV.hash_split(processed(spark, sf, objects=False), "event_id")
    return (train.select("event_id", F.lit("train").alias("part"))
            .unionByName(test.select("event_id", F.lit("test").alias("part"))))


@register("m8_balanced_sample", views=ENV_VIEWS, ctes=_PROC + [
    ("lab", "SELECT event_id, CAST(coalesce(temperature > 40 OR detection_count > 0, false) AS INTEGER) AS label "
            "FROM latest"),
    ("cls", "SELECT label, count(*) AS cn, count(*) OVER () AS k, sum(count(*)) OVER () AS tot FROM lab GROUP BY label"),
    ("ex", f"SELECT l.event_id, l.label, tot / (k * cn) AS e, {_H} / 268435456.0 AS u FROM lab l JOIN cls USING (label)"),
    ("cp", "SELECT event_id, label, CAST(floor(e) + CASE WHEN u < e - floor(e) THEN 1 ELSE 0 END AS INTEGER) AS c FROM ex"),
], sql="SELECT event_id, label, c.i AS copy FROM cp, LATERAL (SELECT unnest(range(1, cp.c + 1)) AS i) c")
def m8_balanced_sample(spark, sf):
    lab = processed(spark, sf, objects=False).select("event_id", EV.anomaly_label().alias("label"))
    return EV.balanced_sample(lab, label="label", key="event_id").select(
        "event_id", "label", F.col("_copy").alias("copy"))
