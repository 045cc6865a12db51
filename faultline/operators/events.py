"""Sensor-event operators (S13, S15, P11, P12, J6, A12, S14 batch form, M6, M8).

An event carries an id, a timestamp, three readings and an optional image
path. Envelopes are the JSON documents exchanged on the stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.numeric import NUMERIC_PREFIX

# Fixed values that must equal the reference behaviour.
INDEX_WEIGHTS = {"temperature": 0.5, "pressure": 0.3, "sensor_value": 0.2}
ANOMALY_TEMPERATURE = 40.0
ISO_MILLIS = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
ENVELOPE_ID_PREFIX = "evt_"
SPLIT_SEED = 42
TRAIN_FRACTION_TENTHS = 8  # 80/20
FEATURE_COLUMNS = ("temperature", "pressure", "sensor_value", "calculated_index", "detection_count")
COPY_CHUNK = 100_000  # copies of one row expanded by one task in the balanced sample
MAX_CLASSES = 10_000

ENVELOPE_SCHEMA = T.StructType([
    T.StructField("eventId", T.StringType()),
    T.StructField("imagePath", T.StringType()),
    T.StructField("numericData", T.StructType([
        T.StructField("temperature", T.DoubleType()),
        T.StructField("pressure", T.DoubleType()),
        T.StructField("sensorValue", T.DoubleType()),
    ])),
    T.StructField("timestamp", T.StringType()),
])

PROCESSED_SCHEMA = ("event_id string, timestamp string, temperature double, pressure double, "
                    "sensor_value double, calculated_index double, image_path string, "
                    "detected_objects array<string>, detection_count int")


def lenient_reading(c: Column) -> Column:
    """Form value -> number as the envelope producer reads it.

    missing / empty -> 0; numeric prefix ("12abc" -> 12); no number -> NULL
    (the producer's NaN, which JSON encodes as null).
    """
    s = F.regexp_replace(c.cast("string"), r"^\s+|\s+$", "")  # blanks, tabs and line feeds
    num = F.regexp_extract(s, NUMERIC_PREFIX, 0)
    return (F.when(c.isNull() | (s == ""), F.lit(0.0))
            .otherwise(F.when(num == "", F.lit(None)).otherwise(num.try_cast("double"))))


def build_envelopes(df: DataFrame, *, id_col: str = "event_id", ts_col: str = "event_time",
                    temperature: str = "temperature", pressure: str = "pressure",
                    sensor_value: str = "sensor_value", image_path: str = "image_path") -> Column:
    """The JSON envelope of each row (nulls kept as JSON null, key order fixed)."""
    env = F.struct(
        F.col(id_col).cast("string").alias("eventId"),
        F.col(image_path).alias("imagePath"),
        F.struct(lenient_reading(F.col(temperature)).alias("temperature"),
                 lenient_reading(F.col(pressure)).alias("pressure"),
                 lenient_reading(F.col(sensor_value)).alias("sensorValue")).alias("numericData"),
        F.date_format(F.col(ts_col), ISO_MILLIS).alias("timestamp"),
    )
    return F.to_json(env, {"ignoreNullFields": "false"})


def parse_envelopes(df: DataFrame, value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """JSON text -> event columns; returns (events, quarantine).

    Missing or null readings become 0.0 and set ``had_null_reading``. Text that
    is not a JSON object with an ``eventId`` goes to the quarantine output.
    """
    p = df.withColumn("_env", F.from_json(F.col(value_col).cast("string"), ENVELOPE_SCHEMA))
    ok = F.col("_env").isNotNull() & F.col("_env.eventId").isNotNull()
    n = F.col("_env.numericData")
    readings = [n["temperature"], n["pressure"], n["sensorValue"]]
    had_null = F.lit(False)
    for r in readings:
        had_null = had_null | r.isNull()
    keep = [c for c in df.columns if c != value_col]
    events = p.filter(ok).select(
        *keep,
        F.col("_env.eventId").alias("event_id"),
        F.col("_env.timestamp").alias("timestamp"),
        F.coalesce(readings[0], F.lit(0.0)).alias("temperature"),
        F.coalesce(readings[1], F.lit(0.0)).alias("pressure"),
        F.coalesce(readings[2], F.lit(0.0)).alias("sensor_value"),
        F.col("_env.imagePath").alias("image_path"),
        had_null.alias("had_null_reading"))
    bad = p.filter(~ok | F.col("_env").isNull()).select(*df.columns)
    return events, bad


def health_index(temperature="temperature", pressure="pressure", sensor_value="sensor_value") -> Column:
    """0.5 temperature + 0.3 pressure + 0.2 sensor value, missing readings as 0."""
    w = INDEX_WEIGHTS
    return (F.coalesce(F.col(temperature), F.lit(0.0)) * w["temperature"]
            + F.coalesce(F.col(pressure), F.lit(0.0)) * w["pressure"]
            + F.coalesce(F.col(sensor_value), F.lit(0.0)) * w["sensor_value"])


def detections_per_image(detections: DataFrame, image_col: str = "image_path",
                         class_col: str = "class_name") -> DataFrame:
    """The detected classes of each image (sorted, repeats kept) and their count.

    Counted per (image, class) first -- a partial aggregate, so an image with
    very many detections is reduced map-side to one row per class -- and the
    list is expanded from the class counts. The list length is the number of
    detections of one image, which the detector bounds (a few hundred boxes).
    """
    per_class = detections.groupBy(image_col, class_col).agg(F.count(F.lit(1)).alias("_n"))
    grouped = per_class.groupBy(image_col).agg(
        F.sort_array(F.collect_list(F.struct(F.col(class_col).alias("c"), F.col("_n").alias("n")))).alias("_cn"),
        F.sum("_n").cast("int").alias("detection_count"))
    expand = F.flatten(F.transform("_cn", lambda x: F.array_repeat(x["c"], x["n"].cast("int"))))
    return grouped.select(image_col, expand.alias("detected_objects"), "detection_count")


def detection_counts(detections: DataFrame, image_col: str = "image_path") -> DataFrame:
    """A12 without the lists: how many detections each image has."""
    return detections.groupBy(image_col).agg(F.count(F.lit(1)).cast("int").alias("detection_count"))


def attach_detections(events: DataFrame, detections: DataFrame | None = None, image_col: str = "image_path",
                      per_image: DataFrame | None = None) -> DataFrame:
    """Events LEFT JOIN per-image detections; no image or no detection -> [] and 0.

    ``per_image`` (the output of :func:`detections_per_image`) can be passed
    instead of raw detections, e.g. computed once for a whole stream; that of
    :func:`detection_counts` attaches the count alone, so no list is shuffled.
    """
    per = per_image if per_image is not None else detections_per_image(detections, image_col)
    out = events.join(per, image_col, "left")
    empty = F.array().cast("array<string>")
    lists = [F.when(F.col(image_col).isNull(), empty)
             .otherwise(F.coalesce(F.col("detected_objects"), empty)).alias("detected_objects")] \
        if "detected_objects" in per.columns else []
    return out.select(*events.columns, *lists,
                      F.when(F.col(image_col).isNull(), F.lit(0))
                      .otherwise(F.coalesce(F.col("detection_count"), F.lit(0))).alias("detection_count"))


def process_events(events: DataFrame, detections: DataFrame | None = None,
                   per_image: DataFrame | None = None) -> DataFrame:
    """T2 (stateless part): health index + detections, in the processed-events layout."""
    e = events.withColumn("calculated_index", health_index())
    e = attach_detections(e, detections, per_image=per_image)
    extra = [c for c in e.columns if c not in PROCESSED_COLUMNS]
    return e.select(*[c for c in PROCESSED_COLUMNS if c in e.columns], *extra)


PROCESSED_COLUMNS = ["event_id", "timestamp", "temperature", "pressure", "sensor_value", "calculated_index",
                     "image_path", "detected_objects", "detection_count"]


def latest_per_key(df: DataFrame, key: str = "event_id", order_col: str = "seq") -> DataFrame:
    """S14 (batch form): last write wins per key, by ``order_col`` (partial aggregate)."""
    rest = [c for c in df.columns if c != key]
    picked = F.max_by(F.struct(*[F.col(c) for c in rest]), F.col(order_col)).alias("_last")
    return df.groupBy(key).agg(picked).select(key, "_last.*").select(*df.columns)


def event_features(df: DataFrame) -> DataFrame:
    """The five model features of the processed-events table."""
    return df.select(*FEATURE_COLUMNS)


def anomaly_label(temperature="temperature", detection_count="detection_count") -> Column:
    """Temperature > 40 or any detection -> 1 (NULL compares false -> 0)."""
    cond = (F.col(temperature) > ANOMALY_TEMPERATURE) | (F.col(detection_count) > 0)
    return F.coalesce(cond, F.lit(False)).cast("int")


def split_hash(key: Column | str, seed: int = SPLIT_SEED) -> Column:
    """First 7 hex digits of md5("<key>|<seed>") as a number in [0, 16^7)."""
    k = F.col(key) if isinstance(key, str) else key
    digest = F.md5(F.concat(k.cast("string"), F.lit(f"|{seed}")))
    return F.conv(F.substring(digest, 1, 7), 16, 10).cast("long")


def hash_split(df: DataFrame, key: str, seed: int = SPLIT_SEED,
               train_tenths: int = TRAIN_FRACTION_TENTHS) -> tuple[DataFrame, DataFrame]:
    """M6: repeatable 80/20 split by key hash (independent of partitioning, unlike randomSplit)."""
    in_train = (split_hash(key, seed) % 10) < train_tenths
    return df.filter(in_train), df.filter(~in_train)


def balanced_sample(df: DataFrame, *, label: str = "label", key: str, n: int | None = None,
                    seed: int = SPLIT_SEED) -> DataFrame:
    """M8: draw ``n`` rows (default: all) with probability proportional to 1 / class size.

    Each row is repeated floor(e) times plus once more when its hash fraction u
    is below frac(e), where e = n / (classes * class size) is its expected count.
    Classes are balanced and ``n`` is met in expectation; repeatable for any
    partitioning. The class sizes (one number per class) are fitted on the
    driver and applied as literals.
    """
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cn")).limit(MAX_CLASSES + 1).collect()
    if len(counts) > MAX_CLASSES:
        raise ValueError(f"more than {MAX_CLASSES} classes in {label}")
    total = sum(r["_cn"] for r in counts) if n is None else int(n)
    # expected copies of one row of each class (fitted values, one per class)
    expect = {r[label]: total / (len(counts) * r["_cn"]) for r in counts}
    e = F.element_at(F.create_map(*[x for c, v in expect.items() if c is not None
                                    for x in (F.lit(c), F.lit(float(v)))]), F.col(label))
    if None in expect:
        e = F.when(F.col(label).isNull(), F.lit(float(expect[None]))).otherwise(e)
    u = split_hash(key, seed) / F.lit(float(16 ** 7))
    copies = (F.floor(e) + F.when(u < e - F.floor(e), 1).otherwise(0)).cast("long")
    j = df.withColumn("_copies", copies)
    light = (j.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_copies"), F.lit(1)))))
             .filter(F.col("_copies") >= F.col("_copy")))
    cols = [c for c in light.columns if c != "_copies"]
    if max(expect.values(), default=0) < COPY_CHUNK:
        return light.select(*cols).withColumn("_copy", F.col("_copy").cast("int"))
    # a row of a very rare class can owe millions of copies: such rows are cut into
    # chunks of COPY_CHUNK copies that are spread over tasks before they are expanded
    light = light.filter(F.col("_copies") <= COPY_CHUNK)
    heavy = (j.filter(F.col("_copies") > COPY_CHUNK)
             .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPY_CHUNK))))
             .repartition(F.col(key), F.col("_chunk")))
    heavy = heavy.withColumn("_copy", F.explode(F.sequence(
        F.col("_chunk") * COPY_CHUNK + 1, F.least(F.col("_copies"), (F.col("_chunk") + 1) * COPY_CHUNK))))
    return light.select(*cols).unionByName(heavy.select(*cols)).withColumn("_copy", F.col("_copy").cast("int"))
