"""Operator 12: how filters interact, audited over every order they could be applied in.

Each document gets a mask of the filters that it fails; documents with the same part, mask and labels are one
cell, so a part has at most 2^k cells whatever its size. All 2^k sets of active filters are walked in Gray-code
order: one filter is toggled at a time, every cell that fails it has its counter of active failures raised
or lowered, and the running survivors change by the cells whose counter leaves or reaches 0. The survivors of every
set are stored once (32 states for five filters); a step of an order is the difference of two states.

Identical texts are found by their sha256: a document fails the last filter if a smaller doc_id anywhere in the table
has the same text. Only digests are shuffled, counted map-side per digest, part and labels, and no row is
joined back to its group, so a text that a third of the rows share is no hot key.
"""

from __future__ import annotations

import hashlib
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import flat_text, prepare, same_or_new

NAMES = "ABCDE"
MIN_WORDS = 200  # A: fewer words fail
MIN_DISTINCT = 50  # B: a smaller percentage of distinct words fails
MAX_UPPER = 3  # C: a larger percentage of capital letters fails
SYMBOLS = b"#$%&*|"  # D: any of them fails
DUPLICATE = 1 << NAMES.index("E")
PIECE = 1 << 20  # bytes of a text whose words are split at once
MEASURES = ("n", "good", "toxic")

_ROW = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
        "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def word_counts(text: bytes) -> tuple[int, int]:
    """Words and distinct words of a whole text; only the distinct ones are held."""
    n, seen, at = 0, set(), 0
    while at < len(text):
        to = at + PIECE
        if to < len(text):  # go on to the end of the word
            rest = text[to:to + 4096].split(None, 1)
            while to < len(text) and text[to] not in b" \t\n\r\x0b\x0c":
                step = len(rest[0]) if rest else 1
                to += max(step, 1)
                rest = text[to:to + 4096].split(None, 1)
        words = text[at:to].split()
        n += len(words)
        seen.update(words)
        at = to
    return n, len(seen)


def own_mask(text: bytes) -> int:
    """Which of the filters A to D a text fails by itself."""
    raw = np.frombuffer(text, np.uint8)
    seen = np.bincount(raw, minlength=256)
    points = len(raw) - int(seen[0x80:0xC0].sum())
    n, different = word_counts(text)
    return ((n < MIN_WORDS) | (100 * different < MIN_DISTINCT * n) << 1
            | (100 * int(seen[0x41:0x5B].sum()) > MAX_UPPER * points) << 2 | bool(seen[list(SYMBOLS)].any()) << 3)


def _judge(batches):
    for b in batches:
        raw, off = flat_text(b.column(2))
        data, masks, digests = raw.tobytes(), [], []
        for lo, hi in zip(off[:-1].tolist(), off[1:].tolist()):
            text = data[lo:hi]
            masks.append(own_mask(text))
            digests.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(masks, pa.int32()),
                                          pa.array(digests, pa.binary())], names=["doc_id", "part", "mask", "digest"])


def failure_cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs(doc_id, text, lang)``, ``labels(doc_id, quality, toxic)`` -> ``part, mask, n, good, toxic``.

    NULL text is empty, NULL lang is the part ''. Every row counts, repeated rows too; rows with the same
    doc_id and text are no duplicates of each other, as neither id is smaller. A NULL doc_id is
    smaller than none and larger than none. A document is good (toxic) if any row of its id
    in ``labels`` has quality = 1 (toxic = 1). Extra columns are ignored.
    """
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("lang", "string"), ("text", "binary")])
    d = d.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), "text")
    rows = d.mapInArrow(_judge, "doc_id bigint, part string, mask int, digest binary")
    # Repeated rows first: afterwards the smallest id of a group comes once per cell.
    rows = rows.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n"))
    known = same_or_new(labels, [("doc_id", "bigint"), ("quality", "int"), ("toxic", "int")])
    known = known.groupBy("doc_id").agg(F.max((F.col("quality") == 1).cast("int")).alias("good"),
                                        F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = rows.join(known.where("doc_id is not null"), "doc_id", "left").fillna(0, ["good", "toxic"])
    # Equal texts share their own mask, so a group has few cells: its parts and labels.
    cells = rows.groupBy("digest", "mask", "part", "good", "toxic").agg(
        F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least"))
    groups = cells.groupBy("digest", "mask").agg(
        F.min("least.doc_id").alias("least_id"),
        F.collect_list(F.struct("part", "good", "toxic", "n", "no_id", "least")).alias("cells"))
    cell = groups.select("mask", "least_id", F.explode("cells").alias("c")).select("mask", "least_id", "c.*")
    first = F.col("no_id") + F.when(F.col("least.doc_id") == F.col("least_id"), F.col("least.n")).otherwise(0)
    split = cell.select("part", "good", "toxic", F.explode(F.array(
        F.struct(F.col("mask"), first.alias("n")),
        F.struct((F.col("mask") + DUPLICATE).alias("mask"), (F.col("n") - first).alias("n")))).alias("x"))
    return split.where("x.n > 0").groupBy("part", F.col("x.mask").alias("mask")).agg(
        F.sum("x.n").alias("n"), F.sum(F.col("x.n") * F.col("good")).alias("good"),
        F.sum(F.col("x.n") * F.col("toxic")).alias("toxic"))


def survivors(masks: np.ndarray, counts: np.ndarray, k: int) -> np.ndarray:
    """``counts[cell, measure]`` left by every set of active filters, by a Gray-code walk over the 2^k sets."""
    active = np.zeros(len(masks), np.int64)  # active filters that each cell fails
    running = counts.sum(axis=0)
    states = np.empty((1 << k, counts.shape[1]), np.int64)
    states[0] = running
    state = 0
    for i in range(1, 1 << k):
        toggled = (i & -i).bit_length() - 1
        state ^= 1 << toggled
        hit = masks >> toggled & 1 == 1
        if state >> toggled & 1:
            running = running - counts[hit & (active == 0)].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            running = running + counts[hit & (active == 0)].sum(axis=0)
        states[state] = running
    return states


def order_report(states: np.ndarray, names: str) -> list[tuple]:
    """Every step of every order of the filters, as differences of stored states."""
    k, everything = len(names), len(states) - 1
    left = states[:, 0]
    sole = [int(left[everything ^ (1 << f)] - left[everything]) for f in range(k)]
    shapley = [0] * k  # removals at any step, summed over the k! orders
    for f in range(k):
        for s in range(len(states)):
            if not s >> f & 1:
                before = s.bit_count()
                shapley[f] += factorial(before) * factorial(k - 1 - before) * int(left[s] - left[s | 1 << f])
    rows = []
    for order in permutations(range(k)):
        told, s = "".join(names[f] for f in order), 0
        for step, f in enumerate(order, 1):
            t = s | 1 << f
            lost = states[s] - states[t]
            fails = int(left[0] - left[1 << f])
            rows.append((told, step, int(left[t]), int(lost[0]), fails - int(lost[0]), sole[f],
                         int(lost[1]), int(lost[2]), shapley[f]))
            s = t
    return rows


def _audit(names: str):
    def run(cells: pd.DataFrame) -> pd.DataFrame:
        states = survivors(cells["mask"].to_numpy(np.int64), cells[list(MEASURES)].to_numpy(np.int64), len(names))
        rows = pd.DataFrame(order_report(states, names), columns=[
            "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"])
        rows.insert(0, "part", cells["part"].iloc[0])
        return rows
    return run


def audit(cells: DataFrame, names: str = NAMES) -> DataFrame:
    """``part, mask, n, good, toxic`` (one row per cell) -> one row per part, order of the filters and step.

    A group holds the cells of one part, at most 2^k rows. No cells, no rows.
    """
    return cells.groupBy("part").applyInPandas(_audit(names), _ROW)
