"""Large JSON arrays read by many tasks.

Spark reads a multi-line JSON file in one task. Here the file is read in byte ranges, cut at ``}`` (a line separator
like any other to the text source), and what a range means is found by two scans:

1. per range, whether it ends inside a string and by how much it changes the depth, for both cases of how it
   may begin; one row a range goes to the driver, which chains them into the state at the start of every range;
2. with that state, every range emits the elements that begin and end in it, and the fragments at its edges;
   the fragments, at most two a range, are joined in order into the elements that cross ranges.

Elements become lines of a written table of JSON lines, which any number of tasks can read.
"""

from __future__ import annotations

import os
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.session import checkpoint_root, materialize

CUT = "}"
BATCH_BYTES = 8 << 20
_STATES = "file string, block long, inside0 boolean, depth0 long, inside1 boolean, depth1 long"
_PIECES = "file string, block long, kind int, text string"
HEAD, WHOLE, TAIL, ELEMENT = 0, 1, 2, 3


def outside_strings(raw: np.ndarray, inside: bool) -> tuple[np.ndarray, bool]:
    """Which bytes lie outside of strings, and whether the text ends inside one."""
    quotes = np.flatnonzero(raw == 0x22)
    if len(quotes) and (raw == 0x5C).any():  # a quote after an odd number of backslashes is none
        plain = np.maximum.accumulate(np.where(raw != 0x5C, np.arange(len(raw)), -1))
        before = np.maximum(quotes - 1, 0)
        quotes = quotes[(quotes == 0) | ((before - plain[before]) % 2 == 0)]
    flips = np.zeros(len(raw) + 1, np.int8)
    flips[quotes + 1] = 1
    state = (np.cumsum(flips, dtype=np.int32) + int(inside)) % 2
    return state[:-1] == 0, bool(state[-1])


def steps(raw: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Change of depth at every byte."""
    up, down = (raw == 0x7B) | (raw == 0x5B), (raw == 0x7D) | (raw == 0x5D)
    return (up.astype(np.int8) - down.astype(np.int8)) * outside


def _ranges(batches):
    """(file, block, text) of the pieces of a batch that belong to one range, cuts put back."""
    for b in batches:
        files, blocks, texts = b.column(0).to_pylist(), np.asarray(b.column(1)), b.column(2).to_pylist()
        s = 0
        for t in range(1, len(files) + 1):
            if t == len(files) or files[t] != files[s] or blocks[t] != blocks[s]:
                yield files[s], int(blocks[s]), (CUT.join(texts[s:t]) + CUT).encode()
                s = t


def _states(batches):
    at = None
    for file, block, text in _ranges(batches):
        if at is None or [file, block] != at[:2]:
            if at is not None:
                yield _state_row(at)
            at = [file, block, False, 0, True, 0]
        raw = np.frombuffer(text, np.uint8)
        for i in (2, 4):
            outside, at[i] = outside_strings(raw, at[i])
            at[i + 1] += int(steps(raw, outside).sum())
    if at is not None:
        yield _state_row(at)


def _state_row(at: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(dict(zip(("file", "block", "inside0", "depth0", "inside1", "depth1"), [[x] for x in at])))


def _elements(begin: dict):
    """Elements that lie in one range, and what is left at its edges."""
    def batch(rows):
        f, b, k, t = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(b, pa.int64()), pa.array(k, pa.int32()),
                                           pa.array(t, pa.string())], names=["file", "block", "kind", "text"])

    def run(batches):
        at, rest, open_, inside, depth = None, [], False, False, 0
        for file, block, text in _ranges(batches):
            if (file, block) != at:
                if at is not None and rest:
                    yield batch([(*at, TAIL if open_ else WHOLE, b"".join(rest).decode())])
                at, rest, open_ = (file, block), [], False  # open_: a boundary was met in this range
                inside, depth = begin[at]
            raw = np.frombuffer(text, np.uint8)
            outside, after = outside_strings(raw, inside)
            level = depth + np.cumsum(steps(raw, outside), dtype=np.int64)
            comma = outside & (raw == 0x2C) & (level == 1)
            first = outside & (raw == 0x5B) & (level == 1)  # the array's own brackets
            last = outside & (raw == 0x5D) & (level == 0)
            rows, done = [], 0
            for i in np.flatnonzero(comma | first | last).tolist():
                if first[i]:
                    open_, rest, done = True, [], i + 1
                    continue
                own = b"".join([*rest, text[done:i]]).decode()
                rows.append((*at, ELEMENT if open_ else HEAD, own))
                open_, rest, done = True, [], i + 1
                if last[i]:
                    done = len(text)
            inside, depth = after, int(level[-1]) if len(level) else depth
            if depth > 0 or inside:
                rest.append(text[done:])
            if rows:
                yield batch(rows)
        if at is not None and rest:
            yield batch([(*at, TAIL if open_ else WHOLE, b"".join(rest).decode())])
    return run


def array_elements(spark: SparkSession, path) -> DataFrame:
    """Every element of the top-level array of the file(s) at ``path``, as one line of JSON text (``value``)."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    pieces = spark.read.option("lineSep", CUT).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    begin, file, state = {}, None, (False, 0)
    for r in sorted(pieces.mapInArrow(_states, _STATES).collect()):  # one row a range
        if r["file"] != file:
            file, state = r["file"], (False, 0)
        begin[(file, r["block"])] = state
        state = (r["inside1"], state[1] + r["depth1"]) if state[0] else (r["inside0"], state[1] + r["depth0"])
    found = materialize(pieces.mapInArrow(_elements(begin), _PIECES), "json-elements")
    order = Window.partitionBy("file").orderBy("block", "kind").rowsBetween(Window.unboundedPreceding, 0)
    edges = found.where(F.col("kind") != ELEMENT).withColumn("chain", F.count_if(F.col("kind") == TAIL).over(order))
    joined = edges.groupBy("file", "chain").agg(F.sort_array(F.collect_list(F.struct("block", "kind", "text"))).alias("x"))
    across = joined.select(F.array_join(F.transform("x", lambda r: r["text"]), "").alias("value"))
    every = found.where(F.col("kind") == ELEMENT).select(F.col("text").alias("value")).unionByName(across)
    one_line = F.trim(F.translate("value", "\r\n", "  "))
    return every.select(one_line.alias("value")).where("value <> ''")


def array_as_lines(spark: SparkSession, path) -> str:
    """Write the elements as JSON lines under the shared folder; returns the folder."""
    out = os.path.join(checkpoint_root(spark), "json-lines", uuid.uuid4().hex[:12])
    array_elements(spark, path).write.text(out)
    return out
