"""Ingest stage: manifest -> load tabular files and archive members -> named tables; and the way back from disk."""

from __future__ import annotations

import logging
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.names import normalize_table_name
from faultline.operators.clean import parse_datetime
from faultline.operators.combine import combine
from faultline.sources.archives import archive_images, load_archive_tables
from faultline.sources.images import image_quality, letterbox_plan, outcome_counts, read_images
from faultline.sources.manifest import file_manifest
from faultline.sources.readers import LOADERS, load_table

log = logging.getLogger(__name__)
TIME_SERIES_TABLES = ("telemetry", "failures", "errors", "maint")
EVENT_TABLES = ("failures", "errors", "maint")  # reduced to their first row per key, so the files' order counts
COMBINED_WORD = "combined"  # fixed value: tables that are results themselves


def _load(spark: SparkSession, path: str, stem: str) -> DataFrame | None:
    order = "seq" if normalize_table_name(stem) in EVENT_TABLES else None
    df = load_table(spark, path)
    if df is None or order is None or order in df.columns:
        return df
    return load_table(spark, path, order_col=order)


def ingest_folder(spark: SparkSession, folder: str) -> tuple[dict[str, DataFrame], DataFrame]:
    """All tables of a raw folder keyed by file/member stem, plus the manifest.

    All archives are opened together. Of a file and a member with one stem, the file that comes
    later by path wins; the manifest reports stems that occur twice.
    """
    manifest = file_manifest(spark, folder).cache()
    todo = manifest.filter(F.col("action").isin("tabular", "zip")).select("path", "stem", "action") \
        .orderBy("path").collect()  # one row per file (names only)
    tables: dict[str, DataFrame] = {}
    zips = [r["path"] for r in todo if r["action"] == "zip"]
    if zips:
        tables.update(load_archive_tables(spark, zips)[0])
    for r in todo:
        if r["action"] == "tabular":
            df = _load(spark, r["path"], r["stem"])
            if df is not None:
                tables[r["stem"]] = df
    return tables, manifest


def prepare_tables(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Normalise names; parse ``datetime`` of the time-series tables."""
    out = {}
    for k, v in tables.items():
        n = normalize_table_name(k)
        out[n] = parse_datetime(v) if n in TIME_SERIES_TABLES else v
    return out


def load_ingested(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Tables of an ingested folder by normalised name, results (stems with ``combined``) left out.

    A table is a file, or a folder of part files as Spark writes it; its name is the stem.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path")
    own = os.path.basename(folder.rstrip("/"))
    part = F.element_at(F.split("path", "/"), -1).startswith("part-")
    at = F.when(part, F.regexp_replace("path", "/[^/]*$", "")).otherwise(F.col("path"))
    ext = F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))
    found = files.select(at.alias("path"), ext.alias("ext")).distinct().orderBy("path").collect()  # names only
    tables = {}
    for r in found:
        name = os.path.basename(r["path"])
        stem = name[:-len(r["ext"])] if r["ext"] and name.lower().endswith(r["ext"]) else name
        if COMBINED_WORD in stem.lower() or r["ext"] not in LOADERS or stem == own:
            continue
        order = "seq" if normalize_table_name(stem) in EVENT_TABLES else None
        df = LOADERS[r["ext"]](spark, r["path"])
        if order and order not in df.columns and r["ext"] == ".csv":
            df = LOADERS[r["ext"]](spark, r["path"], order_col=order)
        tables[stem] = df
    return prepare_tables(tables)


def combine_ingested(spark: SparkSession, folder: str) -> DataFrame | None:
    """J4 from an ingested folder; None (with a warning) without telemetry or machines."""
    return combine(load_ingested(spark, folder))


def image_stage(spark: SparkSession, folder: str, manifest: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """S8, M13, M14, A13 for a raw folder: outcome per image, resize plan of those kept, counts.

    Image files of the folder and image members of its archives count alike.
    """
    kinds = {r["action"]: r["n"] for r in manifest.groupBy("action").agg(F.count(F.lit(1)).alias("n")).collect()}
    images = read_images(spark, folder if kinds.get("image") else None)
    if kinds.get("zip"):
        zips = [r["path"] for r in manifest.where("action = 'zip'").select("path").collect()]
        images = images.unionByName(archive_images(spark, zips))
    quality = image_quality(images).cache()
    plan = letterbox_plan(quality.where("outcome = 'kept'").select("path", "width", "height"))
    return quality, plan, outcome_counts(quality)
