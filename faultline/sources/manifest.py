"""File manifest (S1) and table names.

Both the listing and the content test (is it a zip archive?) are Spark reads, so any file system that
Spark reads from works. The listing is the ``binaryFile`` source without its content column, which opens no file. For the
test, executors read the first line of every file and stop: each file is a
partition of its own and the task takes one row from it.
"""

from __future__ import annotations

import os
import re
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.functions.names import TABLE_NAME_DROP_FRAGMENTS, normalize_table_name
from faultline.sources.readers import LOADERS

# Fixed values that must equal the reference behaviour.
METADATA_WORDS = ("readme", "license", "notes", "description")
IMAGE_EXTENSIONS = (".png", ".jpg", ".jpeg", ".bmp", ".tiff", ".webp")
COMPONENT_TABLES = ("telemetry", "machines", "failures", "errors", "maint")
ZIP_MAGIC = (b"PK\x03\x04", b"PK\x05\x06", b"PK\x07\x08")
HEAD_LINE = 1 << 16  # bytes of a first line that are read at most


def _depth(path: str) -> int:
    """Folders above a file, scheme and authority aside."""
    return len([p for p in re.sub(r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "", path).split("/") if p])


def list_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Top-level files of ``folder``: path, length (no descent). Missing folder raises.

    Empty files, and names that start with ``_`` or ``.``, are skipped by Spark's readers and so not listed.
    """
    root = folder if re.match(r"^[A-Za-z][\w+.-]*:", folder) else os.path.abspath(folder)
    try:
        # without the recursive listing, a sub-folder named like a partition (k=1) would hide the files beside it
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path", "length")
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(f"folder '{folder}' does not exist") from e
        raise
    parts = F.regexp_replace("path", r"^[A-Za-z][\w+.-]*:(//[^/]*)?", "")
    depth = F.size(F.filter(F.split(parts, "/"), lambda p: p != ""))
    return files.where(depth == _depth(root) + 1)


@contextmanager
def _settings(spark: SparkSession, **values: str):
    """Session settings for the reads inside the block."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def _first_row(batches):
    for b in batches:
        if b.num_rows:
            yield b.slice(0, 1)
            return


def zip_paths(spark: SparkSession, files: DataFrame) -> set[str]:
    """Paths whose first bytes are those of a zip archive (read in the executors, one row a file)."""
    paths = [r["path"] for r in files.select("path").collect()]  # names only
    if not paths:
        return set()
    largest = str(2 ** 62)  # one partition a file, whole
    with _settings(spark, spark__sql__files__maxPartitionBytes=largest, spark__sql__files__openCostInBytes=largest,
                   spark__sql__execution__arrow__maxRecordsPerBatch="1"):
        lines = spark.read.option("mapreduce.input.linerecordreader.line.maxlength", HEAD_LINE).text(paths)
        head = F.substring(F.col("value").cast("binary"), 1, 4)
        heads = lines.select(F.col("_metadata.file_path").alias("path"), head.alias("head"))
        found = heads.mapInArrow(_first_row, "path string, head binary").where(
            F.col("head").isin(*[bytearray(m) for m in ZIP_MAGIC])).select("path").collect()
    same = {_plain(p): p for p in paths}
    return {same[_plain(r["path"])] for r in found}


def _plain(path: str) -> str:
    """A path without the differences in how Spark writes it (``file:/a`` and ``file:///a``, escapes)."""
    from urllib.parse import unquote
    return re.sub(r"^([A-Za-z][\w+.-]*):/+", r"\1:/", unquote(path))


def action_expr(stem_lower, ext, is_zip):
    meta = F.lit(False)
    for w in METADATA_WORDS:
        meta = meta | stem_lower.contains(w)
    return (F.when(meta, "skip_metadata").when(is_zip, "zip")
            .when(ext.isin(*IMAGE_EXTENSIONS), "image")
            .when(ext.isin(*LOADERS), "tabular").otherwise("unsupported"))


def file_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per top-level file: path, name, stem, ext, length, action, table.

    action: ``skip_metadata`` (stem contains readme/license/notes/description),
    ``zip`` (by content), ``image``, ``tabular`` or ``unsupported``; ``table`` is
    the normalised stem (S10); ``duplicate_stem`` flags stems seen twice.
    """
    files = list_folder(spark, folder)
    zips = zip_paths(spark, files)
    name = F.element_at(F.split("path", "/"), -1)
    ext = F.lower(F.regexp_extract(name, r"(\.[^.]*)$", 1))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    m = files.select("path", name.alias("name"), stem.alias("stem"), ext.alias("ext"), "length")
    is_zip = F.col("path").isin(*zips) if zips else F.lit(False)
    m = m.withColumn("action", action_expr(F.lower(F.col("stem")), F.col("ext"), is_zip))
    m = m.withColumn("table", normalize_table_name_expr(F.col("stem")))
    from pyspark.sql import Window
    return m.withColumn("duplicate_stem", F.count(F.lit(1)).over(Window.partitionBy("stem")) > 1)


def normalize_table_name_expr(stem):
    """S10 on a column: lower, drop the fixed fragments, trim."""
    s = F.lower(stem)
    for frag in TABLE_NAME_DROP_FRAGMENTS:
        s = F.replace(s, F.lit(frag), F.lit(""))
    return F.trim(s)


def is_component_table(name: str) -> bool:
    """Exact match on the normalised name (not a substring test)."""
    return normalize_table_name(name) in COMPONENT_TABLES
