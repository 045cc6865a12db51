"""The event stream: envelopes -> parse (T1) -> enrich (T2) -> keyed upsert (T3),
replayable from the earliest offset (T4)."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.events import PROCESSED_COLUMNS, detections_per_image, parse_envelopes, process_events
from faultline.session import checkpoint_root, materialize
from faultline.streaming.upsert import upsert_batch

TOPIC = "raw-dataset-events"  # fixed value: topic name of the envelope stream


def kafka_envelopes(spark: SparkSession, bootstrap: str, topic: str = TOPIC) -> DataFrame:
    """Envelopes from Kafka, earliest offsets first; ``_seq`` orders writes per partition.

    Needs the Kafka connector on the classpath (not bundled here).
    """
    raw = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", bootstrap)
           .option("subscribe", topic).option("startingOffsets", "earliest").load())
    return raw.select(F.col("value").cast("string").alias("value"),
                      F.struct("timestamp", "partition", "offset").alias("_seq"))


def file_envelopes(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Envelopes from JSON-lines files (one envelope per line), the same downstream transform.

    Files are ordered by the time they were written, then by name.
    """
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    at = F.struct(F.col("_metadata.file_modification_time").alias("time"), F.col("_metadata.file_path").alias("file"),
                  F.col("_metadata.file_block_start").alias("block"))
    return r.load(path).select("value", at.alias("_place"))


def start_event_stream(spark: SparkSession, source: DataFrame, detections: DataFrame, table_path: str, *,
                       checkpoint: str | None = None, available_now: bool = True):
    """Run T1-T3 with ``foreachBatch``; returns the StreamingQuery.

    Unparsable envelopes are appended to ``<table_path>/_quarantine`` (per
    batch, overwritten on replay). The write order is the
    source order (Kafka offsets, or file then line for files), in every stream over the source. A stream is
    known by its checkpoint folder: one that goes on from it overwrites a batch delivered again.
    """
    checkpoint = checkpoint or os.path.join(checkpoint_root(spark), "event_stream")
    name = hashlib.md5(checkpoint.encode()).hexdigest()[:12]
    # the static side is aggregated once per stream start, not once per micro-batch
    per_image = materialize(detections_per_image(detections), "detections-per-image")

    def handle(batch: DataFrame, batch_id: int) -> None:
        if "_seq" not in batch.columns:  # lines of a split stay together and in order
            batch = batch.withColumn("_seq", F.struct("_place", F.monotonically_increasing_id().alias("line")))
        events, bad = parse_envelopes(batch, "value")
        (bad.select("value").write.mode("overwrite")
         .json(os.path.join(table_path, "_quarantine", f"stream={name}", f"b={batch_id}")))
        proc = process_events(events, per_image=per_image).select(*PROCESSED_COLUMNS, "had_null_reading", "_seq")
        upsert_batch(proc, batch_id, table_path, key="event_id", order_col="_seq", stream=name)

    w = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="5 seconds")
    return w.start()
