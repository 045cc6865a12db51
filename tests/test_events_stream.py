import json
import os

from pyspark.sql import functions as F

from faultline.operators import events as EV
from faultline.streaming.pipeline import file_envelopes, start_event_stream
from faultline.streaming.upsert import read_table


def test_envelope_build_and_parse(spark):
    raw = spark.createDataFrame([("e1", "12abc", None, "", "img_1"), ("e2", "x", "3.5", "7", None)],
                                "event_id string, temperature string, pressure string, sensor_value string, "
                                "image_path string").withColumn("event_time", F.lit("2024-01-02 03:04:05.678")
                                                                 .cast("timestamp_ntz"))
    env = [json.loads(r[0]) for r in raw.select(EV.build_envelopes(raw)).collect()]
    assert env[0] == {"eventId": "e1", "imagePath": "img_1",
                      "numericData": {"temperature": 12.0, "pressure": 0.0, "sensorValue": 0.0},
                      "timestamp": "2024-01-02T03:04:05.678Z"}
    assert env[1]["numericData"]["temperature"] is None and env[1]["imagePath"] is None
    lines = [json.dumps(e) for e in env] + ["{broken", '{"imagePath": "x"}',
                                            '{"eventId": "e3", "numericData": {"temperature": 1.5}}']
    ev, bad = EV.parse_envelopes(spark.createDataFrame([(x,) for x in lines], "value string"))
    got = {r.event_id: r for r in ev.collect()}
    assert bad.count() == 2
    assert got["e2"].temperature == 0.0 and got["e2"].had_null_reading
    assert got["e3"].pressure == 0.0 and got["e3"].had_null_reading and got["e1"].temperature == 12.0


def test_detections_and_index(spark):
    det = spark.createDataFrame([("a", "cat"), ("a", "bus"), ("a", "cat"), ("b", "dog")],
                                "image_path string, class_name string")
    ev = spark.createDataFrame([("1", 10.0, 20.0, 30.0, "a"), ("2", 1.0, 1.0, 1.0, None), ("3", 0.0, 0.0, 0.0, "z")],
                               "event_id string, temperature double, pressure double, sensor_value double, "
                               "image_path string").withColumn("timestamp", F.lit("t"))
    out = {r.event_id: r for r in EV.process_events(ev, det).collect()}
    assert out["1"].detected_objects == ["bus", "cat", "cat"] and out["1"].detection_count == 3
    assert out["1"].calculated_index == 10 * 0.5 + 20 * 0.3 + 30 * 0.2
    assert out["2"].detected_objects == [] and out["3"].detection_count == 0
    lab = EV.process_events(ev, det).select("event_id", EV.anomaly_label().alias("y")).collect()
    assert {r.event_id: r.y for r in lab} == {"1": 1, "2": 0, "3": 0}


def test_split_and_sample_repeatable(spark):
    df = spark.range(2000).select(F.concat(F.lit("evt_"), F.col("id").cast("string")).alias("event_id"),
                                  (F.col("id") % 10 == 0).cast("int").alias("label"))
    a = sorted(r[0] for r in EV.hash_split(df.repartition(1), "event_id")[0].collect())
    b = sorted(r[0] for r in EV.hash_split(df.repartition(7), "event_id")[0].collect())
    assert a == b and 1500 < len(a) < 1700
    s = EV.balanced_sample(df, key="event_id")
    counts = {r.label: r["count"] for r in s.groupBy("label").count().collect()}
    assert abs(counts[0] - 1000) < 150 and abs(counts[1] - 1000) < 150


def test_latest_per_key(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")],
                               "event_id string, seq int, v string")
    assert {r.event_id: r.v for r in EV.latest_per_key(df).collect()} == {"a": "z", "b": "q"}


def _write_batch(folder, name, envs):
    with open(os.path.join(folder, name), "w") as f:
        for e in envs:
            f.write((json.dumps(e) if isinstance(e, dict) else e) + "\n")


def _env(i, temp, img=None):
    return {"eventId": f"evt_{i}", "imagePath": img, "numericData": {"temperature": temp, "pressure": 1.0,
                                                                      "sensorValue": 2.0},
            "timestamp": "2024-01-01T00:00:00.000Z"}


def test_stream_upsert_replay(spark, tmpdir_path):
    src, table = os.path.join(tmpdir_path, "in"), os.path.join(tmpdir_path, "table")
    ckpt = os.path.join(tmpdir_path, "ckpt")
    os.makedirs(src)
    det = spark.createDataFrame([("img_1", "cat")], "image_path string, class_name string")
    _write_batch(src, "b0.json", [_env(1, 10.0, "img_1"), _env(2, 20.0), _env(1, 11.0, "img_1"), "not json"])
    q = start_event_stream(spark, file_envelopes(spark, src, 1), det, table, checkpoint=ckpt)
    q.awaitTermination()
    _write_batch(src, "b1.json", [_env(2, 25.0), _env(3, None)])
    q = start_event_stream(spark, file_envelopes(spark, src, 1), det, table, checkpoint=ckpt)
    q.awaitTermination()
    snap = {r.event_id: r for r in read_table(spark, table).collect()}
    assert set(snap) == {"evt_1", "evt_2", "evt_3"}
    assert snap["evt_1"].temperature == 11.0 and snap["evt_1"].detected_objects == ["cat"]
    assert snap["evt_2"].temperature == 25.0
    assert snap["evt_3"].temperature == 0.0 and snap["evt_3"].had_null_reading
    # replay everything from the start into a fresh checkpoint: same table
    q = start_event_stream(spark, file_envelopes(spark, src, 1), det, os.path.join(tmpdir_path, "t2"),
                           checkpoint=os.path.join(tmpdir_path, "ck2"))
    q.awaitTermination()
    again = {r.event_id: (r.temperature, r.detection_count) for r in
             read_table(spark, os.path.join(tmpdir_path, "t2")).collect()}
    assert again == {k: (v.temperature, v.detection_count) for k, v in snap.items()}
    assert spark.read.json(os.path.join(table, "_quarantine")).count() == 1


def test_balanced_sample_heavy_rows(spark, monkeypatch):
    monkeypatch.setattr(EV, "COPY_CHUNK", 7)
    df = spark.range(60).select(F.concat(F.lit("evt_"), F.col("id").cast("string")).alias("event_id"),
                                (F.col("id") == 0).cast("int").alias("label"))
    s = EV.balanced_sample(df, key="event_id")
    rare = s.filter("label = 1").collect()
    assert len(rare) == 30 and sorted(r._copy for r in rare) == list(range(1, 31))
    assert s.filter("label = 0").count() in range(20, 40)


def test_upsert_batch_is_idempotent(spark, tmpdir_path):
    from faultline.streaming.upsert import upsert_batch
    table = os.path.join(tmpdir_path, "t")
    assert read_table(spark, table) is None
    b0 = spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "event_id string, _seq int, v double")
    b1 = spark.createDataFrame([("a", 2, 5.0), ("c", 2, 7.0), ("a", 3, 6.0)], "event_id string, _seq int, v double")
    upsert_batch(b0, 0, table, order_col="_seq")
    upsert_batch(b1, 1, table, order_col="_seq")
    first = sorted((r.event_id, r.v) for r in read_table(spark, table).collect())
    upsert_batch(b1, 1, table, order_col="_seq")  # re-delivery of the same batch
    again = sorted((r.event_id, r.v) for r in read_table(spark, table).collect())
    assert first == again == [("a", 6.0), ("b", 2.0), ("c", 7.0)]
