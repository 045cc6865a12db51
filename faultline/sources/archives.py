"""Zip archives (S7): members are listed, classified and written out by the executors.

``binaryFile`` brings each archive's bytes to one task, which walks every member (all folder levels), applies
the manifest rules and emits one row per member. The rows are written once. Text members (CSV, TSV, TXT, JSON and whatever a
user has registered) are then written as files of their own under the shared folder, by one Spark write, and the
same readers load them by path as load any other file; columnar members (Parquet, Feather) are decoded from their bytes in
the executors. Members of one shape - same header, keys or schema - are inspected together, so the number
of jobs follows the number of different shapes, not of members. A member that can't be read is
reported, the others go on.
"""

from __future__ import annotations

import io
import json
import logging
import os
import uuid
import zipfile
import zlib

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import checkpoint_root, materialize
from faultline.sources import readers
from faultline.sources.images import read_images
from faultline.sources.manifest import IMAGE_EXTENSIONS, METADATA_WORDS
from faultline.sources.readers import LOADERS, SNIFF_DELIMITERS, SNIFF_LINES, missing_to_null, spark_schema

log = logging.getLogger(__name__)

_COLUMNS = ["archive", "member", "name", "stem", "ext", "action", "shape", "content", "error"]
MEMBER_SCHEMA = ("archive string, member string, name string, stem string, ext string, action string, "
                 "shape binary, content binary, error string")
DELIMITED = {".csv": readers.read_csv, ".tsv": readers.read_tsv, ".txt": readers.read_txt}
COLUMNAR = {".parquet": readers.read_parquet, ".feather": readers.read_feather}


def _member_action(name: str, known: frozenset) -> str:
    stem, ext = os.path.splitext(name)
    if any(w in stem.lower() for w in METADATA_WORDS):
        return "skip_metadata"
    if ext.lower() in IMAGE_EXTENSIONS:
        return "image"
    return "tabular" if ext.lower() in known else "unsupported"


def _delimiter(lines: list[str]) -> str:
    """The rule of ``readers.sniff_delimiter`` on the first lines of a member."""
    for d in SNIFF_DELIMITERS:
        counts = {x.count(d) for x in lines}
        if len(counts) == 1 and counts != {0}:
            return d
    return ","


def _shape(ext: str, data: bytes) -> bytes:
    """What members must share to be inspected together; raises if the member can't be of its format."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    if ext == ".parquet":
        return pq.read_schema(io.BytesIO(data)).remove_metadata().serialize().to_pybytes()
    if ext == ".feather":
        return pa.ipc.open_file(pa.BufferReader(data)).schema.remove_metadata().serialize().to_pybytes()
    if ext == ".json":
        got = json.loads(data)
        rows = got if isinstance(got, list) else [got]
        return json.dumps(sorted({k for r in rows if isinstance(r, dict) for k in r})).encode()
    lines = [x for x in data[:1 << 16].decode("utf-8-sig", "replace").splitlines() if x.strip()][:SNIFF_LINES]
    if not lines:
        raise ValueError("no columns")
    sep = "\t" if ext == ".tsv" else _delimiter(lines) if ext == ".txt" else ","
    return json.dumps([sep, lines[0]]).encode()


def _member_row(z: zipfile.ZipFile, info: zipfile.ZipInfo, path: str, own: frozenset, known: frozenset) -> tuple:
    """One member; a member that can't be read (bad checksum, encrypted, broken data) is an error row of its own."""
    name = os.path.basename(info.filename)
    stem, ext = os.path.splitext(name)
    ext = ext.lower()
    action, data, error, shape = _member_action(name, known), None, None, None
    if action in ("tabular", "image"):
        try:
            data = z.read(info)
            shape = _shape(ext, data) if action == "tabular" and ext in own else None
        except (zipfile.BadZipFile, zlib.error, RuntimeError, NotImplementedError, EOFError, ValueError, OSError) as e:
            action, error, data = "error", f"{type(e).__name__}: {e}"[:200], None
    return path, info.filename, name, stem, ext, action, shape, data, error


def _explode_archives(own: frozenset, known: frozenset):
    def run(it):
        for pdf in it:
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        for info in z.infolist():  # a row at a time: one member's bytes are held, not all
                            if not info.is_dir():
                                yield pd.DataFrame([_member_row(z, info, path, own, known)], columns=_COLUMNS)
                except zipfile.BadZipFile as e:
                    yield pd.DataFrame([(path, *[None] * 4, "error", None, None, str(e))], columns=_COLUMNS)
    return run


def _own_formats() -> frozenset:
    """Formats whose reader is the library's own (a user may have replaced some)."""
    own = DELIMITED | COLUMNAR | {".json": readers.read_json}
    return frozenset(e for e, loader in own.items() if LOADERS.get(e) is loader)


def archive_members(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per file inside the zip archive(s) at ``path``."""
    raw = spark.read.format("binaryFile").load(path).select("path", "content")
    return raw.mapInPandas(_explode_archives(_own_formats(), frozenset(LOADERS)), MEMBER_SCHEMA)


def _decode(ext: str):
    import pyarrow as pa

    def run(batches):
        import pyarrow.parquet as pq
        for b in batches:
            for content in b.column(0).to_pylist():
                if ext == ".parquet":
                    yield from pq.ParquetFile(pa.BufferReader(content)).iter_batches()
                else:
                    reader = pa.ipc.open_file(pa.BufferReader(content))
                    for i in range(reader.num_record_batches):
                        yield reader.get_batch(i)
    return run


class _Members:
    """Members of the archives as loadable tables."""

    def __init__(self, spark: SparkSession, members: DataFrame):
        self.spark, self.members = spark, members
        self.folder = os.path.join(checkpoint_root(spark), "members", uuid.uuid4().hex[:12])

    def write_texts(self, columnar: frozenset) -> None:
        """Every member that is read by path, as one file in a folder of its own (followed by a line feed)."""
        texts = self.members.where((F.col("action") == "tabular") & ~F.col("ext").isin(*columnar))
        texts.select(F.col("content").cast("string").alias("value"), "id").write.partitionBy("id").text(self.folder)

    def path(self, r) -> str:
        return os.path.join(self.folder, f"id={r['id']}")

    def load(self, rows: list, ext: str, shape: bytes | None) -> tuple[dict[int, DataFrame], dict[int, str]]:
        """Members of one extension and shape -> table or error by member id."""
        own = shape is not None
        if own and ext in COLUMNAR:
            import pyarrow as pa
            schema = spark_schema(pa.ipc.read_schema(pa.py_buffer(shape)))
            return {r["id"]: missing_to_null(self.members.where(F.col("id") == r["id"]).select("content")
                                             .mapInArrow(_decode(ext), schema)) for r in rows}, {}
        if own and ext in DELIMITED:
            sep = json.loads(shape)[0]
            scans = readers.scan_types(self.spark, [self.path(r) for r in rows], sep, by_file=True)
            of = {int(f.rsplit("/id=", 1)[1].split("/")[0]): s for f, s in scans.items()}
            empty = readers.Scan([], {})
            if scans:
                empty = next(iter(scans.values()))
                empty = readers.Scan(empty.names, {n: "string" for n in empty.names})
            return {r["id"]: readers._typed(self.spark, self.path(r), of.get(r["id"], empty), sep, None) for r in rows}, {}
        if own:  # JSON: one schema of all members with these keys
            schema = self.spark.read.option("multiLine", True).json([self.path(r) for r in rows]).schema
            return {r["id"]: readers.read_json(self.spark, self.path(r), schema) for r in rows}, {}
        done, errors = {}, {}
        for r in rows:  # a registered loader gets a path of its own
            try:
                done[r["id"]] = LOADERS[ext](self.spark, self.path(r))
            except Exception as e:  # noqa: BLE001  (whatever a user's loader raises concerns this member only)
                errors[r["id"]] = f"{type(e).__name__}: {e}"[:200]
        return done, errors


def load_archive_tables(spark: SparkSession, path: str | list[str]) -> tuple[dict[str, DataFrame], DataFrame]:
    """Tabular members as DataFrames keyed by member stem, plus the member report.

    A member that fails to parse is logged and marked in ``error``. Of members with one stem, the last one (by archive
    and path) is the table; ``duplicate_stem`` reports them. Image members are in
    the report (without bytes); ``archive_images`` gives them to the image stage.
    """
    numbered = archive_members(spark, path).withColumn("id", F.monotonically_increasing_id())
    members = materialize(numbered, "members")
    tab = members.where("action = 'tabular'").select("id", "archive", "member", "stem", "ext", "shape").orderBy(
        "archive", "member", "id").collect()  # names and shapes, no contents
    kit = _Members(spark, members)
    columnar = frozenset(COLUMNAR) & _own_formats()
    if any(r["ext"] not in columnar for r in tab):
        kit.write_texts(columnar)
    groups: dict[tuple, list] = {}
    for r in tab:
        groups.setdefault((r["ext"], bytes(r["shape"]) if r["shape"] is not None else None), []).append(r)
    loaded, errors = {}, {}
    for (ext, shape), rows in groups.items():
        done, failed = kit.load(rows, ext, shape)
        loaded.update(done)
        errors.update(failed)
    tables = {r["stem"]: loaded[r["id"]] for r in tab if r["id"] in loaded}
    for r in tab:
        if r["id"] in errors:
            log.warning("skipped tabular member '%s': %s", r["member"], errors[r["id"]])
    same = Window.partitionBy("stem")
    report = members.drop("content", "shape").withColumn(
        "duplicate_stem", (F.col("action") == "tabular") & (F.count_if(F.col("action") == "tabular").over(same) > 1))
    if errors:
        told = F.create_map(*[x for k, v in errors.items() for x in (F.lit(k), F.lit(v))])
        report = report.withColumn("error", F.coalesce(F.col("error"), told[F.col("id")]))
    return tables, report.drop("id")


def archive_images(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Image members, decoded like image files; ``path`` is ``archive!member``.

    Their bytes are written as files under the shared folder (a byte after an image's end is ignored by decoders).
    """
    m = materialize(archive_members(spark, path).where("action = 'image'").select("archive", "member", "content")
                    .withColumn("id", F.monotonically_increasing_id()), "member-images")
    folder = os.path.join(checkpoint_root(spark), "members", uuid.uuid4().hex[:12])
    names = m.select("id", F.concat_ws("!", "archive", "member").alias("path"))
    if not names.take(1):
        return read_images(spark, None)
    m.select(F.col("content").cast("string").alias("value"), "id").write.partitionBy("id").text(folder)
    found = read_images(spark, folder, by_name=False)
    of = F.regexp_extract("path", r"/id=([0-9]+)/[^/]*$", 1).cast("long")
    return found.withColumn("id", of).drop("path").join(names, "id").select("path", "height", "width", "channels", "data")
