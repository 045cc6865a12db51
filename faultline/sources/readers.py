"""Table readers by extension (S2-S6) and the user-extendable registry.

A delimited file without a given schema is typed by one distributed pass over its values
(``scan_types``): a column is a number only if every value follows a strict number pattern, so codes such as
``1d`` stay text. Lines with too many fields are kept out of the table and can be listed
(``malformed_lines``); missing fields at a line's end are NULL.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.functions.numeric import nan_to_null
from faultline.sources.json_arrays import array_as_lines

SNIFF_DELIMITERS = (",", "\t", ";", "|")  # fixed: candidates of the text-file sniffer
SNIFF_LINES = 20
# Texts that a tabular text file uses for a missing value.
MISSING_TEXTS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                 "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
_WHOLE = r"^[+-]?[0-9]{1,18}$"
_NUMBER = r"^[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]{1,3})?|[iI]nf(inity)?)$"
_TRUTH = ("True", "TRUE", "true", "False", "FALSE", "false")
_CORRUPT = "_corrupt_record"
SPLIT_BYTES = 64 << 20  # a JSON array above this size is cut into elements first


def missing_to_null(df: DataFrame, texts: tuple[str, ...] = ()) -> DataFrame:
    """NaN in float columns, and ``texts`` in string columns, become NULL once, at the scan."""
    def clean(f):
        c = F.col(f"`{f.name}`")
        kind = f.dataType.simpleString()
        if kind in ("double", "float"):
            return nan_to_null(c).alias(f.name)
        if kind == "string" and texts:
            return F.when(F.trim(c).isin(*texts), F.lit(None)).otherwise(c).alias(f.name)
        return c
    return df.select(*[clean(f) for f in df.schema])


# ---------------------------------------------------------------- delimited text

@dataclass
class Scan:
    """What the pass over a file's values found."""
    names: list[str]
    types: dict[str, str]
    malformed: int = 0  # lines with other than the header's number of fields
    quoted_breaks: bool = False  # quoted values that run over a line's end


def _present(c: Column) -> Column:
    return F.when(~F.trim(c).isin(*MISSING_TEXTS), F.trim(c))


def _raw(spark: SparkSession, path, names: list[str], sep: str, multiline: bool, corrupt: bool) -> DataFrame:
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, *([_CORRUPT] if corrupt else [])]])
    return (spark.read.schema(schema).option("header", True).option("sep", sep).option("escape", '"')
            .option("multiLine", multiline).option("enforceSchema", True).option("columnPruning", not corrupt)
            .option("columnNameOfCorruptRecord", _CORRUPT).csv(path))


def _names(spark: SparkSession, path, sep: str, multiline: bool = False) -> list[str]:
    """Columns of the header (one line is read)."""
    return (spark.read.option("header", True).option("sep", sep).option("escape", '"')
            .option("multiLine", multiline).csv(path).columns)


def _kind(seen: int, whole: int, number: int, truth: int, rows_present: int) -> str:
    if not seen:
        return "string"
    if whole == seen:
        return "bigint"
    if number == seen:
        return "double"
    return "boolean" if truth == seen == rows_present else "string"


def scan_types(spark: SparkSession, path, sep: str = ",", by_file: bool = False):
    """Types of a delimited file, or of each of several with one header (``by_file``: {file path: Scan}).

    One pass, two where a quoted value holds a line break. A column is a whole number, number or truth value if all its
    present values are; a truth value also needs all rows present.
    """
    names = _names(spark, path, sep)
    multiline = False
    while True:
        raw = _raw(spark, path, names, sep, multiline, corrupt=True)
        flags = [F.count(F.lit(1)).alias("n"), F.count(F.col(_CORRUPT)).alias("bad")]
        broken = F.lit(False)
        for i, n in enumerate(names):
            c, v = F.col(f"`{n}`"), _present(F.col(f"`{n}`"))
            flags += [F.count(v).alias(f"s{i}"), F.count_if(v.rlike(_WHOLE)).alias(f"w{i}"),
                      F.count_if(v.rlike(_NUMBER)).alias(f"d{i}"), F.count_if(v.isin(*_TRUTH)).alias(f"t{i}")]
            broken = broken | F.coalesce(c.contains('"'), F.lit(False))
        flags.append(F.max(broken).alias("q"))
        key = [F.col("_metadata.file_path").alias("file")] if by_file else []
        got = raw.select("*", *key).groupBy(*(["file"] if by_file else [])).agg(*flags).collect()
        if not multiline and any(r["q"] for r in got) and _open_quotes(spark, path):
            multiline, names = True, _names(spark, path, sep, True)
            continue
        scans = {(r["file"] if by_file else None): Scan(
            names, {n: _kind(r[f"s{i}"], r[f"w{i}"], r[f"d{i}"], r[f"t{i}"], r["n"]) for i, n in enumerate(names)},
            r["bad"], multiline) for r in got}
        return scans if by_file else scans.get(None, Scan(names, {n: "string" for n in names}))


def _open_quotes(spark: SparkSession, path) -> bool:
    """Whether a line holds an odd number of quotes, so that a quoted value goes on in the next one."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return bool(spark.read.text(path).where(quotes % 2 == 1).take(1))


def _too_many(raw: DataFrame, scan: Scan, sep: str) -> Column:
    """Whether a line has more fields than the header (fewer are NULLs, as in any reader of such files)."""
    wider = ", ".join(f"`_c{i}` string" for i in range(len(scan.names) + 1))
    again = F.from_csv(F.col(_CORRUPT), wider, {"sep": sep, "escape": '"'})
    return F.col(_CORRUPT).isNotNull() & again[f"_c{len(scan.names)}"].isNotNull()


def _typed(spark: SparkSession, path, scan: Scan, sep: str, order_col: str | None) -> DataFrame:
    raw = _raw(spark, path, scan.names, sep, scan.quoted_breaks, corrupt=scan.malformed > 0)
    raw = _with_order(raw, order_col)
    if scan.malformed:
        raw = raw.where(~_too_many(raw, scan, sep))
    cols = []
    for n in scan.names:
        v, kind = _present(F.col(f"`{n}`")), scan.types[n]
        text = F.when(~F.trim(F.col(f"`{n}`")).isin(*MISSING_TEXTS), F.col(f"`{n}`"))
        cols.append((text if kind == "string" else v.cast(kind)).alias(n))
    return raw.select(*cols, *([order_col] if order_col else []))


def _with_order(raw: DataFrame, order_col: str | None) -> DataFrame:
    """The place of a row in its files, as they are named: path, offset of the split, row in the split.

    Spark packs files into partitions by size; this order doesn't depend on it.
    """
    if not order_col:
        return raw
    return raw.withColumn(order_col, F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row")))


def read_csv(spark: SparkSession, path: str, schema=None, sep: str = ",", order_col: str | None = None) -> DataFrame:
    """Header row; an explicit schema, else types from a pass over the values.

    ``order_col`` names a column with the order of the rows in the file(s).
    """
    if schema is not None:
        raw = spark.read.option("header", True).option("sep", sep).option("escape", '"').schema(schema).csv(path)
        raw = _with_order(raw, order_col)
        return missing_to_null(raw, MISSING_TEXTS)
    return _typed(spark, path, scan_types(spark, path, sep), sep, order_col)


def malformed_lines(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """Lines with another number of fields than the header: ``line``, and ``left_out`` (too many fields)."""
    scan = scan_types(spark, path, sep)
    raw = _raw(spark, path, scan.names, sep, scan.quoted_breaks, corrupt=True)
    # Spark refuses to read the corrupt column alone, so the condition looks at a value as well; which
    # lines are malformed shows only when all columns are parsed, so nothing is pruned then
    bad = F.col(_CORRUPT).isNotNull() & (F.coalesce(F.length(F.col(f"`{scan.names[0]}`")), F.lit(-1)) >= -1)
    return raw.where(bad).select(F.col(_CORRUPT).alias("line"), _too_many(raw, scan, sep).alias("left_out"))


def sniff_delimiter(spark: SparkSession, path: str, n: int = SNIFF_LINES) -> str:
    """The candidate that occurs the same non-zero number of times on each of
    the first ``n`` non-empty lines (first candidate in the fixed order wins)."""
    lines = spark.read.text(path).filter(F.trim("value") != "").limit(n)
    counts = lines.select(*[
        (F.length("value") - F.length(F.replace(F.col("value"), F.lit(d), F.lit("")))).alias(f"c{i}")
        for i, d in enumerate(SNIFF_DELIMITERS)])
    stats = counts.agg(*[F.min(f"c{i}").alias(f"lo{i}") for i in range(len(SNIFF_DELIMITERS))],
                       *[F.max(f"c{i}").alias(f"hi{i}") for i in range(len(SNIFF_DELIMITERS))]).first()
    for i, d in enumerate(SNIFF_DELIMITERS):
        if stats[f"lo{i}"] is not None and stats[f"lo{i}"] == stats[f"hi{i}"] and stats[f"lo{i}"] > 0:
            return d
    return ","


def read_tsv(spark: SparkSession, path: str, schema=None, order_col: str | None = None) -> DataFrame:
    return read_csv(spark, path, schema, sep="\t", order_col=order_col)


def read_txt(spark: SparkSession, path: str, schema=None, order_col: str | None = None) -> DataFrame:
    return read_csv(spark, path, schema, sep=sniff_delimiter(spark, path), order_col=order_col)


# ---------------------------------------------------------------- other formats

def _large_arrays(spark: SparkSession, path, bytes_: int) -> bool:
    """Whether a file at ``path`` is too large for one task and holds an array."""
    files = spark.read.format("binaryFile").load(path)
    large = [r["path"] for r in files.where(F.col("length") > bytes_).select("path").collect()]  # names only
    if not large:
        return False
    first = spark.read.text(large).select(F.ltrim("value").alias("v")).where("v <> ''").first()
    return first is not None and first["v"][:1] == "["


def read_json(spark: SparkSession, path: str, schema=None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """A JSON array of records or one document per file.

    Arrays in files of more than ``split_bytes`` are read by many tasks (``json_arrays``); the rows are the same (line breaks inside a
    value that has no one type, which Spark keeps as text, become blanks).
    """
    r = spark.read
    if _large_arrays(spark, path, split_bytes):
        path = array_as_lines(spark, path)
    else:
        r = r.option("multiLine", True)
    if schema is not None:
        r = r.schema(schema)
    return missing_to_null(r.json(path))


def read_parquet(spark: SparkSession, path: str, schema=None) -> DataFrame:
    return missing_to_null(spark.read.parquet(path))


def spark_schema(arrow_schema) -> T.StructType:
    from pyspark.sql.pandas.types import from_arrow_schema
    return from_arrow_schema(arrow_schema)


def _feather_schema(batches):
    import pyarrow as pa
    for b in batches:
        for content in b.column(0).to_pylist():
            yield pa.RecordBatch.from_pydict({"schema": [pa.ipc.open_file(pa.BufferReader(content)).schema.serialize().to_pybytes()]},
                                             schema=pa.schema([("schema", pa.binary())]))


def read_feather(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Feather (Arrow IPC) files, decoded in the executors with ``mapInArrow``.

    The schema is that of the smallest file, read by an executor, unless given.
    """
    import pyarrow as pa
    files = spark.read.format("binaryFile").load(path)
    if schema is None:
        first = files.select("path").orderBy("length", "path").first()["path"]  # names and sizes, no content
        one = spark.read.format("binaryFile").load(first).select("content")
        schema = spark_schema(pa.ipc.read_schema(pa.py_buffer(bytes(one.mapInArrow(_feather_schema, "schema binary").first()[0]))))

    def decode(batches):
        for b in batches:
            for content in b.column("content").to_pylist():
                reader = pa.ipc.open_file(pa.BufferReader(content))
                for i in range(reader.num_record_batches):
                    yield reader.get_batch(i)

    return missing_to_null(files.select("content").mapInArrow(decode, schema))


Loader = Callable[..., DataFrame]

LOADERS: dict[str, Loader] = {
    ".csv": read_csv,
    ".tsv": read_tsv,
    ".txt": read_txt,
    ".json": read_json,
    ".parquet": read_parquet,
    ".feather": read_feather,
}


def register_loader(ext: str, loader: Loader) -> None:
    """Add or replace the loader of an extension (``loader(spark, path, schema=None)``)."""
    LOADERS[ext.lower()] = loader


def load_table(spark: SparkSession, path: str, schema=None, order_col: str | None = None) -> DataFrame | None:
    """Load one file by extension; None for an unsupported extension.

    ``order_col`` asks for the rows' order in the file; delimited files have one.
    """
    loader = LOADERS.get(os.path.splitext(path)[1].lower())
    if loader is None:
        return None
    more = {} if schema is None else {"schema": schema}
    if order_col and loader in (read_csv, read_tsv, read_txt):
        more["order_col"] = order_col
    return loader(spark, path, **more)
