"""Helpers shared by the text operators: Arrow sizing, digests, stage tables."""

from __future__ import annotations

import ctypes

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir, materialize, ship_package

#: Rows handed to Python at once. Texts may be long, so this is far below
#: Spark's default of 10,000 rows.
ARROW_ROWS = 1000

#: Bytes handed to Python at once, unless one row alone is longer.
ARROW_BYTES = 4 << 20

#: Rows read from Parquet at once, below Spark's default of 4,096: the texts of a read are one array of the JVM's heap.
READ_ROWS = 256

LETTERS_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

h64 = xxhash.xxh3_64_intdigest

_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)


def prepare(spark: SparkSession) -> None:
    """Session settings of the text operators: shared folder, package, batch size."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000")) > ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    key = "spark.sql.parquet.columnarReaderBatchSize"
    if int(spark.conf.get(key, "4096")) > READ_ROWS:
        spark.conf.set(key, str(READ_ROWS))


_HELD: dict = {}


def let_go() -> None:
    """Drop the tables of an earlier operator and give freed memory back to the system."""
    _HELD.clear()
    give_back()


def give_back() -> None:
    """Freed memory goes back to the system: a reused worker would keep it while others need it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(run):
    """``run`` over batches for ``mapInArrow``: starts without earlier tables and leaves none behind.

    Idle workers take turns, so tables left in one would stay in memory while another builds its own.
    """
    def own(batches):
        let_go()
        yield from run(batches)
        let_go()
    return own


def held(kind: str, key, build):
    """What a worker builds once and keeps between batches: one thing at a time.

    Python workers are reused, so the tables of an earlier operator would otherwise stay in memory.
    """
    if _HELD.get("key") != (kind, key):
        let_go()
        _HELD.update(value=build(), key=(kind, key))
    return _HELD["value"]


def stage(df: DataFrame, name: str) -> DataFrame:
    """Written table in the shared folder: cuts the lineage, is computed once."""
    return materialize(df, name)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser of 64-bit values (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _MIX1
    x = x ^ (x >> np.uint64(27))
    x = x * _MIX2
    return x ^ (x >> np.uint64(31))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only, as the contracts ask for."""
    return F.translate(text, LETTERS_UPPER, LETTERS_UPPER.lower())


def words_of(text: bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the whole text, A-Z lower-cased.

    ``bytes.lower`` touches A-Z only and ``bytes.split`` splits at exactly
    those six white-space bytes, so neither depends on the locale.
    """
    return text.lower().split() if text else []


def distinct(a: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort is the fastest way for 64-bit integers)."""
    if len(a) < 2:
        return a
    a = np.sort(a)
    keep = np.empty(len(a), bool)
    keep[0] = True
    np.not_equal(a[1:], a[:-1], out=keep[1:])
    return a[keep]


# Rolling hash of a word: sum of value[byte] * base**position, modulo 2**64. The base is odd, so
# powers have inverses and a word's hash doesn't depend on where it stands.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_VALUE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_VALUE[0x41:0x5B] = _VALUE[0x61:0x7B]  # A-Z count as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the base and of its inverse; tables double until a text fits."""
    while len(_POWERS[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            t = _POWERS[k]
            _POWERS[k] = np.concatenate([t, t * np.uint64(pow(base, len(t), 1 << 64))])
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hashes of the words (see ``words_of``) of a whole text, in order."""
    return word_spans(text)[3]


_EMPTY = (np.empty(0, np.uint8), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))


def word_spans(text: bytes | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The text's bytes, and start, end and hash of each word."""
    if not text:
        return _EMPTY
    raw = np.frombuffer(text, np.uint8)
    blank = np.empty(len(raw) + 2, bool)
    blank[0] = blank[-1] = True
    np.take(_SPACE, raw, out=blank[1:-1])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return _EMPTY
    power, inverse = _powers(len(raw) + 1)
    total = np.empty(len(raw) + 1, np.uint64)
    total[0] = 0
    np.cumsum(_VALUE[raw] * power[:-1], out=total[1:])
    return raw, start, end, mix64((total[end] - total[start]) * inverse[start])


_HASHED_AT_ONCE = 1 << 15  # bytes; their 64-bit values stay in the processor's cache
_BLANK = bytes(_SPACE.tolist())


def words_of_all(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts' bytes one after another, start, end and hash of each word (as in ``word_spans``), and the words of each text."""
    texts = [t or b"" for t in texts]
    whole = b" ".join([b"", *texts, b""])
    raw, blank = np.frombuffer(whole, np.uint8), np.frombuffer(whole.translate(_BLANK), bool)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    start, end = edge[::2], edge[1::2]
    h = np.empty(len(start), np.uint64)
    cut = distinct(np.r_[np.searchsorted(start, np.arange(0, len(raw), _HASHED_AT_ONCE)), len(start)])
    for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
        first = start[a]
        own = raw[first:end[b - 1] + 1]
        power, inverse = _powers(len(own))
        total = np.add.reduceat(np.take(_VALUE, own) * power, edge[2 * a:2 * b] - first)[::2]
        h[a:b] = mix64(total * inverse[start[a:b] - first])
    ends = np.cumsum([len(t) + 1 for t in texts], dtype=np.int64)
    return raw, start, end, h, np.diff(np.searchsorted(start, ends), prepend=0)


def flat_text(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column one after another, and the n + 1 offsets; NULL counts as empty."""
    col = col.cast(pa.binary()).fill_null(b"").cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def is_space(raw: np.ndarray) -> np.ndarray:
    """Which bytes are white space (``[\\x20\\x09-\\x0D]``)."""
    return np.take(_SPACE, raw)


def byte_values(raw: np.ndarray) -> np.ndarray:
    """A 64-bit value per byte, the same for both cases of A-Z."""
    return _VALUE[raw]


def held_out(key: Column, mod: int, remainder: int) -> Column:
    """crc32 of the id's decimal text, modulo ``mod``, equals ``remainder``."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def batch_of(columns: dict[str, pa.Array], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name] for f in schema], schema=schema)


def partitions_of(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def same_or_new(df: DataFrame, wanted: list[tuple[str, str]], more: list[Column] = ()) -> DataFrame:
    """Only the wanted columns, typed (and ``more``); a column that is missing becomes NULL.

    Extra columns, also ones that clash with an operator's own names, never
    reach the operator.
    """
    have = {c.lower(): c for c in df.columns}
    return df.select(*[
        (F.col(f"`{have[n]}`") if n in have else F.lit(None)).cast(t).alias(n) for n, t in wanted
    ], *more)


DOCUMENT_COLUMNS = [("doc_id", "bigint"), ("text", "string"), ("lang", "string"),
                    ("source", "string"), ("n_chars", "bigint")]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
