"""Exact k-nearest-neighbour join over k-d cells of all shared coordinates.

A pair is compared on the coordinates that both have. Donors with presence pattern ``q`` and targets
with pattern ``p`` share ``p & q``; so for every pair of patterns that occurs, donors of ``q`` are projected on ``p & q``
(one *group*; identical projections keep the k smallest ids, which is exact) and searched in these coordinates only. There
are as many patterns as the columns with gaps allow, whatever the number of rows.

1. **Cells.** Equal donors are one row with their k smallest ids. Every group is split by a k-d tree into blocks of about
   2^BLOCK_BITS cells. Split values are medians of a sample of 16 rows a block; a level of the tree is at most 10 binary splits,
   built per cell from a bounded sample (at most 16,384 rows), and deeper trees are more levels. Rows go down a tree in batches
   (numpy; a join where there are many trees). A block is cut into cells of at most ``CELL_ROWS`` rows in one task, and a cell
   is one row from then on: its box and its donors as arrays. Boxes are the exact minima and maxima of the rows, so the
   sample only decides the balance.
2. **Bounds.** A target goes to the block of its own place in the group that can serve all
   it lacks; the search inside that block bounds its k-th distance, per column to fill.
3. **Visits.** A block of targets needs the cells, of all its groups, whose box is within its largest bound: a join of block
   boxes with cell boxes, level by level from the root. Donors of these cells are sent to the block
   (in chunks of bounded size) and searched cell by cell under each target's own bound.

Blocks and cells grow in number with the data, not in size, and a bound shrinks as donors get denser, so the
donors compared per target stay about the same at any number of rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from faultline.operators.knn_local import MARGIN, TARGET_CHUNK, Group, Nearest
from faultline.session import broadcast_if_small, drop_stage, materialize

CELL_ROWS = 256  # donors of a cell (equal ones count once)
LEVEL_BITS = 10  # binary splits of one level of the tree
BLOCK_BITS = 6  # cells of a block: 2^6
BLOCK_TARGETS = 4096  # targets of a block; a busier one is dealt to several
CHUNK_DONORS = 1 << 17  # donors (equal ones once) sent to one task at once: 10 to 20 MB a copy, and Arrow and the search hold several
SLICE_DONORS = 1 << 22  # donors sent at once to all tasks, or as many as there are in the cells
UNEVEN = 8  # a block is split once more when it holds so many times 2^BLOCK_BITS cells
SAMPLE_PER_BLOCK = 16
TREES_BROADCAST = 1000  # trees of at most 1,023 nodes: 12 MB
TIMES = np.uint16  # number of equal donors of a row, at most k
_PATH_BITS = 42

_CAND = "_tid long, _task int, _did long, _dq double, _val double, _lab int"


def presence(cols: list[str]) -> Column:
    return sum((F.when(F.col(c).isNotNull(), F.lit(1 << j)).otherwise(F.lit(0)) for j, c in enumerate(cols)),
               F.lit(0)).cast("int")


def _bits(x: int, n: int) -> list[int]:
    return [j for j in range(n) if x >> j & 1]


# ---------------------------------------------------------------- groups of patterns

def _groups(p_all: list[int], q_count: dict[int, int], n_feat: int, impute_idx: list[int] | None):
    """Group number of every (donor pattern, shared coordinates), and what each target pattern uses.

    Returns ``{(q, c): gid}``, ``{p: [(gid, tasks served)]}`` and ``{p: [gid of the first search]}``.
    """
    gid, uses, first = {}, {}, {}
    for p in p_all:
        lacks = None if impute_idx is None else {i for i, j in enumerate(impute_idx) if not p >> j & 1}
        found = []
        for q in sorted(q_count):
            serves = [0] if lacks is None else [i for i in sorted(lacks) if q >> impute_idx[i] & 1]
            if serves and p & q:
                found.append((gid.setdefault((q, p & q), len(gid)), serves, q))
        uses[p] = [(g, s) for g, s, _ in found]
        # Groups for the first bound: most columns still without one, then most shared coordinates, then most donors.
        open_, first[p] = {i for _, s, _ in found for i in s}, []
        while open_:
            g, s, _ = max(found, key=lambda x: (len(open_ & set(x[1])), (x[2] & p).bit_count(), q_count[x[2]], -x[0]))
            first[p].append(g)
            open_ -= set(s)
    return gid, uses, first


def _lookup(key: Column, table: dict[int, list[int]]) -> Column:
    """Array of the numbers that belong to a key (a map literal over patterns)."""
    if not table:
        return F.array().cast("array<int>")
    entries = [x for k, v in sorted(table.items()) for x in (F.lit(k), F.array(*map(F.lit, v)).cast("array<int>"))]
    return F.element_at(F.create_map(*entries), key)


# ---------------------------------------------------------------- k-d cells

def _tree(x: np.ndarray, depth: int) -> tuple[list[int], list[float]]:
    """Heap-ordered split dimensions and values of a balanced tree; a node that can't be split sends all rows left."""
    nodes = (1 << depth) - 1
    dims, vals = np.zeros(nodes, int), np.full(nodes, np.inf)
    rows = {1: np.arange(len(x))}
    for node in range(1, nodes + 1):
        own = rows.pop(node, np.empty(0, int))
        left = own
        right = own[:0]
        if len(own) > 1:
            sub = x[own]
            spread = sub.max(axis=0) - sub.min(axis=0)
            spread[np.isnan(spread)] = -1.0
            j = int(spread.argmax())
            if spread[j] > 0:
                v = sub[:, j]
                cut = np.partition(v, (len(v) - 1) // 2)[(len(v) - 1) // 2]
                if cut == v.max():
                    cut = v[v < cut].max()
                dims[node - 1], vals[node - 1] = j, cut
                left, right = own[v <= cut], own[v > cut]
        if 2 * node <= nodes:
            rows[2 * node], rows[2 * node + 1] = left, right
    return dims.tolist(), vals.tolist()


def _build(n_feat: int):
    cols = [f"_g{j}" for j in range(n_feat)]

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        depth = int(pdf["_depth"].iloc[0])
        with np.errstate(invalid="ignore"):
            dims, vals = _tree(pdf[cols].to_numpy(float, na_value=np.nan), depth)
        return pd.DataFrame({"_cell": [pdf["_cell"].iloc[0]], "_depth": [depth], "_dims": [dims], "_vals": [vals]})
    return build


def _flat(trees: DataFrame) -> tuple[np.ndarray, ...] | None:
    """The trees as flat arrays (cell, depth, offset, dimensions, values), or None if there are many."""
    found = trees.limit(TREES_BROADCAST + 1).toArrow()
    if found.num_rows > TREES_BROADCAST:
        return None
    found = found.sort_by("_cell")
    dims, vals = found["_dims"].combine_chunks(), found["_vals"].combine_chunks()
    return (found["_cell"].to_numpy(), found["_depth"].to_numpy().astype(np.int64), np.asarray(dims.offsets)[:-1] - np.asarray(dims.offsets)[0],
            dims.flatten().to_numpy().astype(np.int16), vals.flatten().to_numpy())


def _route(flat: tuple[np.ndarray, ...], cols: list[str], out: str):
    """One level down for batches of rows: all rows of a batch take each binary split together."""
    cells, depths, offsets, dims, vals = flat

    def leaf(cell: np.ndarray, x: list[np.ndarray]) -> np.ndarray:
        at = np.minimum(np.searchsorted(cells, cell), len(cells) - 1)
        depth = np.where(cells[at] == cell, depths[at], 0)
        new = cell.copy()
        rows = np.flatnonzero(depth)
        at, node, x = at[rows], np.ones(len(rows), np.int64), np.stack([v[rows] for v in x])
        for level in range(int(depth.max(initial=0))):
            go = np.flatnonzero(depth[rows] > level)
            i = offsets[at[go]] + node[go] - 1
            node[go] = node[go] * 2 + ~(x[dims[i], go] <= vals[i])
        # the path keeps a leading 1; the node number of a leaf is 2^depth + leaf
        inside = cell[rows] & ((1 << _PATH_BITS) - 1)
        new[rows] += inside * ((1 << depth[rows]) - 1) + node - (1 << depth[rows])
        return new

    def run(batches):
        for b in batches:
            names = b.schema.names
            x = [b.column(names.index(c)).fill_null(0.0).to_numpy(zero_copy_only=False) for c in cols]
            new = pa.array(leaf(b.column(names.index("_cell")).to_numpy(), x))
            yield pa.RecordBatch.from_arrays([*[new if c == "_cell" else b.column(i) for i, c in enumerate(names)], new], names=[*names, out])
    return run


def _descend(rows: DataFrame, trees: DataFrame, cols: list[str], out: str) -> DataFrame:
    """One level down: the cell of each row after the splits of its tree (rows without a tree stay)."""
    flat = _flat(trees)
    if flat is not None:
        return rows.mapInArrow(_route(flat, cols, out), T.StructType([*rows.schema.fields, T.StructField(out, T.LongType())]))
    xs = F.array(*[F.coalesce(F.col(c), F.lit(0.0)) for c in cols])
    node = F.aggregate(F.sequence(F.lit(1), F.col("_depth")), F.lit(1), lambda at, _: (
        at * 2 + F.when(F.element_at(xs, F.element_at("_dims", at) + 1) > F.element_at("_vals", at), 1).otherwise(0)))
    joined = rows.join(trees, "_cell", "left").withColumn("_node", F.when(F.col("_depth").isNotNull(), node).cast("bigint"))
    inside = F.col("_cell").bitwiseAND(F.lit((1 << _PATH_BITS) - 1))
    wide = F.expr("cast(power(2, _depth) as bigint)")
    deeper = F.coalesce(F.col("_cell") + inside * (wide - 1) + F.col("_node") - wide, F.col("_cell"))
    return joined.withColumn("_cell", deeper).select(*rows.columns).withColumn(out, F.col("_cell"))


def _split(gcols: list[str], payload: list[str], above: list[str], cell_rows: int):
    """Cells of one block: halves of equal size along the widest coordinate, until none is above ``cell_rows``.

    A cell is one row: its box, and its donors as arrays of numbers (vectors, ids, how many ids each vector has, values); of
    vectors and values only the columns that are there (``_has``, ``_serves``).
    """
    def split(rows: pa.Table) -> pa.Table:
        depth = max(0, (-(-rows.num_rows // cell_rows) - 1).bit_length())
        x = np.stack([rows[c].to_numpy() for c in gcols]).astype(float)
        there = [j for j, c in enumerate(gcols) if rows[c].null_count < rows.num_rows]
        parts = [np.arange(rows.num_rows)]
        for _ in range(depth):
            halves = []
            for own in parts:
                half = (len(own) + 1) // 2
                if half < len(own):
                    sub = x[there][:, own] if len(there) < len(x) else x[:, own]
                    spread = sub.max(axis=1) - sub.min(axis=1)
                    spread[np.isnan(spread)] = -1.0
                    own = own[np.argpartition(sub[int(spread.argmax())], half)]
                halves += [own[:half], own[half:]]
            parts = halves
        numbers = np.flatnonzero([len(own) for own in parts])
        ends = np.cumsum([len(parts[i]) for i in numbers])
        cuts = list(zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()))
        order = np.concatenate(parts)
        x = x[:, order]
        lists = rows["_ids"].combine_chunks().take(pa.array(order))
        times = pc.list_value_length(lists).to_numpy().astype(TIMES)
        ids, upto = lists.flatten().to_numpy(), np.r_[0, np.cumsum(times, dtype=np.int64)]
        served = [i for i, c in enumerate(payload) if rows[c].null_count < rows.num_rows]
        values = np.stack([rows[payload[i]].to_numpy()[order] for i in served], axis=1).astype(float) if served else np.empty((len(order), 0))
        vectors = np.ascontiguousarray(x[there].T)
        block = rows["_cell"][0].as_py()
        inside = block & ((1 << _PATH_BITS) - 1)
        out = {"_gid": pa.array(np.full(len(cuts), rows["_gid"][0].as_py(), np.int32)), "_blk": pa.array(np.full(len(cuts), block)),
               **{c: pa.array(np.full(len(cuts), rows[c][0].as_py())) for c in above},
               "_cell": pa.array(block - inside + (inside << depth) + numbers),
               "_n": pa.array([e - s for s, e in cuts], pa.int64()),
               "_has": pa.array(np.full(len(cuts), sum(1 << j for j in there), np.int32)),
               "_serves": pa.array(np.full(len(cuts), sum(1 << i for i in served), np.int32))}
        first = [s for s, _ in cuts]
        for name, smallest in (("_lo", np.fmin), ("_hi", np.maximum)):
            for j in range(len(gcols)):
                out[f"{name}{j}"] = pa.array(smallest.reduceat(x[j], first)) if j in there else pa.nulls(len(cuts), pa.float64())
        out["_x"] = pa.array([vectors[s:e].tobytes() for s, e in cuts], pa.binary())
        out["_times"] = pa.array([times[s:e].tobytes() for s, e in cuts], pa.binary())
        out["_ids"] = pa.array([ids[upto[s]:upto[e]].tobytes() for s, e in cuts], pa.binary())
        out["_values"] = pa.array([values[s:e].tobytes() for s, e in cuts], pa.binary())
        return pa.table(out)
    schema = ", ".join(["_gid int", "_blk long", *[f"{c} long" for c in above], "_cell long", "_n long", "_has int", "_serves int",
                        *[f"{b}{j} double" for b in ("_lo", "_hi") for j in range(len(gcols))],
                        *[f"{c} binary" for c in ("_x", "_times", "_ids", "_values")]])
    return split, schema


def _cells(donors: DataFrame, gcols: list[str], payload: list[str], cell_rows: int) -> tuple[DataFrame, list[DataFrame]]:
    """Cells with their block (``_blk``) and the places above (``_c0``: the group, ``_c1`` ...), and the trees that lead to a block.

    The rows are written once and go down the trees again for every level; only the cells stay on disk.
    """
    root = F.col("_gid").cast("bigint") * F.lit(1 << _PATH_BITS) + 1
    block_rows = cell_rows << BLOCK_BITS
    rows = written = materialize(donors.withColumn("_cell", root).withColumn("_c0", root), "knn-cells")
    place = rows.select("_cell", "_c0", F.col("_ids")[0].alias("_did"), *gcols)  # what the trees need of the rows
    trees = []
    while True:
        parent = f"_c{max(0, len(trees) - 1)}"
        counts = materialize(place.groupBy("_cell", parent).agg(F.count(F.lit(1)).alias("_n")), "knn-counts")
        need = F.ceil(F.log2(F.col("_n") / F.lit(float(block_rows))))
        depth = F.when(need <= LEVEL_BITS, need).otherwise((need - 1) % LEVEL_BITS + 1).cast("int")
        limit = (2 if not trees else UNEVEN) * block_rows
        big = counts.where(F.col("_n") > limit)
        if trees:  # a cell that its tree couldn't split (equal rows in the sample) stays as it is
            whole = counts.groupBy(parent).agg(F.sum("_n").alias("_pn"))
            big = big.join(whole, parent).where("_n < _pn")
        big = big.select("_cell", "_n", depth.alias("_depth"))
        if not big.take(1) or len(trees) == _PATH_BITS // LEVEL_BITS - 1:
            drop_stage(counts)
            break
        share = F.lit(float(SAMPLE_PER_BLOCK)) * F.expr("power(2, _depth)") / F.col("_n")
        sample = (place.select("_cell", "_did", *gcols).join(broadcast_if_small(big), "_cell")
                  .where(F.pmod(F.xxhash64("_did", *gcols, "_cell"), F.lit(1 << 20)) < share * (1 << 20)).drop("_did"))
        level = materialize(sample.groupBy("_cell").applyInPandas(
            _build(len(gcols)), "_cell long, _depth int, _dims array<int>, _vals array<double>"), "knn-trees")
        drop_stage(counts)
        trees.append(level)
        place, rows = (_descend(x, level, gcols, f"_c{len(trees)}") for x in (place, rows))
    split, schema = _split(gcols, payload, [f"_c{i}" for i in range(len(trees) + 1)], cell_rows)
    cells = materialize(rows.groupBy("_cell").applyInArrow(split, schema), "knn-packed")
    drop_stage(written)
    return cells, trees


def _boxes(rows: DataFrame, by: list[str], cols: list[str], *more: Column) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *[F.min(c).alias(f"_lo{j}") for j, c in enumerate(cols)],
                                 *[F.max(c).alias(f"_hi{j}") for j, c in enumerate(cols)], *more)


# ---------------------------------------------------------------- searches inside tasks

def _numbers(packed: pd.Series, dtype=float) -> np.ndarray:
    return np.frombuffer(b"".join(packed), dtype)


def _columns(dp: pd.DataFrame, packed: str, there: str, n_cols: int) -> np.ndarray:
    """Packed vectors or values of these cells in all columns; NaN in those that aren't there."""
    n, bits = dp["_n"].to_numpy(), dp[there].to_numpy()
    out = np.full((n.sum(), n_cols), np.nan)
    for b in np.unique(bits):
        cols = _bits(int(b), n_cols)
        if cols:
            out[np.ix_(np.repeat(bits == b, n), cols)] = _numbers(dp[packed][bits == b]).reshape(-1, len(cols))
    return out


def _groups_of(dp: pd.DataFrame, n_feat: int, times: np.ndarray, serves: dict[int, list[int]]) -> list[Group]:
    """The groups of these cells; ``at`` numbers the vectors in the order in which they come."""
    n, gid, cell = dp["_n"].to_numpy(), dp["_gid"].to_numpy(), dp["_cell"].to_numpy()
    x = _columns(dp, "_x", "_has", n_feat)
    of, cell = np.repeat(gid, n), np.repeat(cell, n)
    out = []
    for g in np.unique(gid):
        at = np.flatnonzero(of == g)
        out.append(Group(x[at], cell[at], at, serves[int(g)], times[at]))
    return sorted(out, key=lambda g: len(g.at))


def _bound_solver(n_feat: int, k: int, n_tasks: int, uses: dict[int, dict[int, list[int]]]):
    fcols = [f"_f{j}" for j in range(n_feat)]

    def solve(tp: pd.DataFrame, dp: pd.DataFrame) -> pd.DataFrame:
        bound = np.full((len(tp), n_tasks), np.inf)
        if len(tp) and len(dp):
            p = int(tp["_p"].iloc[0])
            groups = _groups_of(dp, n_feat, _numbers(dp["_times"], TIMES), uses[p])
            tx = tp[fcols].to_numpy(float, na_value=np.nan)
            for s in range(0, len(tx), TARGET_CHUNK):
                near = Nearest(bound[s:s + TARGET_CHUNK], k)
                for g in groups:
                    near.search(tx[s:s + TARGET_CHUNK], g, n_feat)
                bound[s:s + TARGET_CHUNK] = near.bound
        out = tp[["_tid", "_p", "_blk", "_sub", *fcols]].copy()
        for i in range(n_tasks):
            out[f"_u{i}"] = bound[:, i]
        return out
    return solve


def _search_solver(n_feat: int, k: int, n_tasks: int, uses: dict[int, dict[int, list[int]]], labelled: bool):
    fcols = [f"_f{j}" for j in range(n_feat)]
    empty = pd.DataFrame({"_tid": np.empty(0, np.int64), "_task": np.empty(0, np.int32), "_did": np.empty(0, np.int64),
                          "_dq": np.empty(0), "_val": np.empty(0), "_lab": np.empty(0, np.int32)})

    def solve(tp: pd.DataFrame, dp: pd.DataFrame) -> pd.DataFrame:
        if not len(tp) or not len(dp):
            return empty
        times, ids = _numbers(dp["_times"], TIMES).astype(np.int64), _numbers(dp["_ids"], np.int64)
        groups = _groups_of(dp, n_feat, times, uses[int(tp["_p"].iloc[0])])
        values = _columns(dp, "_values", "_serves", n_tasks)
        vector = np.repeat(np.arange(len(times)), times)  # of every id
        tx, tid = tp[fcols].to_numpy(float, na_value=np.nan), tp["_tid"].to_numpy()
        bound = tp[[f"_u{i}" for i in range(n_tasks)]].to_numpy(float, na_value=np.inf)
        parts = []
        for s in range(0, len(tx), TARGET_CHUNK):
            near = Nearest(bound[s:s + TARGET_CHUNK] + MARGIN, k)
            for g in groups:
                near.search(tx[s:s + TARGET_CHUNK], g, n_feat)
            for i in range(n_tasks):
                r, d, v = near.take(i, ids, times)
                if len(r):
                    parts.append(pd.DataFrame({
                        "_tid": tid[s + r], "_task": np.full(len(r), i, np.int32), "_did": ids[d], "_dq": v,
                        "_val": np.full(len(r), np.nan) if labelled else values[vector[d], i],
                        "_lab": values[vector[d], 0].astype(np.int32) if labelled else np.full(len(r), -1, np.int32)}))
        return pd.concat(parts, ignore_index=True) if parts else empty
    return solve


# ---------------------------------------------------------------- the join

def _renamed(rows: DataFrame, key: list[str]):
    """Rows grouped by their key under other names: both sides of a cogroup come from one frame."""
    return rows.select(*[F.col(c).alias(f"_d{c}") if c in key else F.col(c) for c in rows.columns]).groupBy(
        *[f"_d{c}" for c in key])


def _k_first(rows: DataFrame, equal: list[str], by: Column, k: int) -> tuple[DataFrame, Window]:
    # sorted by a hash first: rows are told apart by one number, not column by column
    w = Window.partitionBy(F.xxhash64(*equal), *equal).orderBy(by)
    return rows.withColumn("_same", F.row_number().over(w)).where(F.col("_same") <= k), w


def _k_smallest_ids(rows: DataFrame, equal: list[str], k: int) -> DataFrame:
    """One row per different ``equal`` with its k smallest ids, ``_ids``, in order."""
    first, w = _k_first(rows, equal, F.col("_did"), k)
    ids = F.array_compact(F.array("_did", *[F.lead("_did", i).over(w) for i in range(1, k)]))
    return first.withColumn("_ids", ids).where("_same = 1").drop("_same", "_did")


def knn_join(targets: DataFrame, donors: DataFrame, *, n_feat: int, k: int, nan_aware: bool,
             impute_idx: list[int] | None = None, cell_rows: int = CELL_ROWS,
             answer: Callable[[DataFrame], DataFrame] = lambda found: found) -> DataFrame:
    """The ``k`` nearest donors of every target, ranked: ``_tid, _task, _did, _dq, _val, _lab, _rank``, as a written table.

    ``answer`` turns them into what the caller wants of each target; it sees all rows of a target together, but
    not all targets at once: donors are sent in slices of the targets, about as many at a time as there are in the cells.

    targets: ``_tid, _f0 ..`` (a written table); donors: ``_did, _f0 ..`` and ``_r{i}`` (values to impute: one task per entry of
    ``impute_idx``, for the targets that lack it) or ``_lab`` (a class: one task). Distances are rounded to 9
    digits, ties go to the smaller ``_did``. A pair without a shared coordinate has no
    distance; unless ``nan_aware``, neither has a row with a gap. Target ids are unique.
    """
    fcols, gcols = [f"_f{j}" for j in range(n_feat)], [f"_g{j}" for j in range(n_feat)]
    labelled = impute_idx is None
    n_tasks = 1 if labelled else len(impute_idx)
    payload = ["_lab"] if labelled else [f"_r{i}" for i in range(n_tasks)]
    full = (1 << n_feat) - 1
    t = targets.select("_tid", *fcols).withColumn("_p", presence(fcols))
    d = donors.withColumn("_q", presence(fcols)).select(
        "_did", "_q", *[F.col(f).alias(g) for f, g in zip(fcols, gcols)], *payload)
    t, d = (t.where("_p > 0"), d) if nan_aware else (t.where(f"_p = {full}"), d.where(f"_q = {full}"))
    # presence patterns: at most 2^(columns with gaps) rows each
    p_all = [r[0] for r in t.select("_p").distinct().collect()]
    q_count = {r[0]: r[1] for r in d.groupBy("_q").count().collect()}
    gid, uses, first = _groups(p_all, q_count, n_feat, impute_idx)
    if not gid:
        return answer(t.sparkSession.createDataFrame([], _CAND + ", _rank int"))
    used = {p: {g: s for g, s in v} for p, v in uses.items()}

    # equal donors are one row with their k smallest ids; one copy of it per group, with the shared coordinates only (and
    # the values of the others: targets of the group lack them); k of equal copies, by their first id, hold the k smallest ids
    of_q: dict[int, list[int]] = {}
    for (q, _), g in gid.items():
        of_q.setdefault(q, []).append(g)
    mask = _lookup(F.col("_gid"), {g: [c] for (_, c), g in gid.items()})[0]
    copies = _k_smallest_ids(d, [*gcols, *payload], k).withColumn("_gid", F.explode(_lookup(F.col("_q"), of_q))).withColumn("_mask", mask)
    shared_by = [F.col("_mask").bitwiseAND(F.lit(1 << j)) != 0 for j in range(n_feat)]
    copies = copies.select("_ids", "_gid", *[F.when(s, F.col(g)).alias(g) for s, g in zip(shared_by, gcols)], *(
        payload if labelled else [F.when(~shared_by[j], F.col(f"_r{i}")).alias(f"_r{i}") for i, j in enumerate(impute_idx)]))
    copies = _k_first(copies, ["_gid", *gcols], F.col("_ids")[0], k)[0].drop("_same")
    rows, trees = _cells(copies, gcols, payload, cell_rows)
    levels = [*[f"_c{i}" for i in range(len(trees) + 1)], "_cell"]

    # first search: inside the block of the target's own place
    at = t.withColumn("_gid", F.explode(_lookup(F.col("_p"), first)))
    at = at.withColumn("_cell", F.col("_gid").cast("bigint") * F.lit(1 << _PATH_BITS) + 1)
    for i, level in enumerate(trees, 1):
        at = _descend(at, level, fcols, f"_c{i}")
    at = at_table = materialize(at.select("_tid", "_p", F.col("_cell").alias("_blk"), *fcols), "knn-placed")
    busy = (at.groupBy("_p", "_blk").agg(F.ceil(F.count(F.lit(1)) / F.lit(BLOCK_TARGETS)).cast("int").alias("_subs")))
    busy = broadcast_if_small(materialize(busy, "knn-blocks"))
    at = (at.join(busy, ["_p", "_blk"]).withColumn("_sub", F.pmod(F.xxhash64("_tid"), F.col("_subs")).cast("int")).drop("_subs"))
    block = ["_blk", "_p", "_sub"]
    own = (rows.select("_blk", "_gid", "_cell", "_n", "_has", "_x", "_times").join(busy, "_blk")
           .withColumn("_sub", F.explode(F.expr("sequence(0, _subs - 1)"))).drop("_subs"))
    u_cols = [f"_u{i}" for i in range(n_tasks)]
    bounds = at.groupBy(*block).cogroup(_renamed(own, block)).applyInPandas(
        _bound_solver(n_feat, k, n_tasks, used),
        "_tid long, _p int, _blk long, _sub int, " + ", ".join(f"{c} double" for c in [*fcols, *u_cols]))
    if any(len(v) > 1 for v in first.values()):  # several first searches: the smallest bound counts
        bounds = bounds.groupBy("_tid").agg(
            F.min_by(F.struct(*block, *fcols), F.struct(*block)).alias("_x"),
            *[F.min(u).alias(u) for u in u_cols]).select("_tid", "_x.*", *u_cols)
    bounds = materialize(bounds, "knn-bounds")

    # which cells each block needs: boxes against boxes, from the roots down
    blocks = _boxes(bounds, block, fcols, *[F.max(u).alias(u) for u in u_cols])
    blocks = blocks.select(*block, *[F.col(f"_lo{j}").alias(f"_tlo{j}") for j in range(n_feat)],
                           *[F.col(f"_hi{j}").alias(f"_thi{j}") for j in range(n_feat)], *u_cols)
    pairs = blocks.withColumn("_gid", F.explode(_lookup(F.col("_p"), {p: [g for g, _ in v] for p, v in uses.items()})))
    serves = F.lit(0.0)
    if labelled:
        serves = F.col("_u0")
    else:
        q_of = _lookup(F.col("_gid"), {g: [q] for (q, _), g in gid.items()})[0]
        pairs = pairs.withColumn("_gq", q_of)
        for i, j in enumerate(impute_idx):
            bit = F.lit(1 << j)
            can = (F.col("_gq").bitwiseAND(bit) != 0) & (F.col("_p").bitwiseAND(bit) == 0)
            serves = F.greatest(serves, F.when(can, F.col(f"_u{i}")))
    pairs = pairs.withColumn("_reach", serves).drop("_gq", *u_cols).withColumn(
        "_node", F.col("_gid").cast("bigint") * F.lit(1 << _PATH_BITS) + 1)
    gap2, shared = F.lit(0.0), F.lit(0)
    for j in range(n_feat):
        gap = F.greatest(F.col(f"_lo{j}") - F.col(f"_thi{j}"), F.col(f"_tlo{j}") - F.col(f"_hi{j}"), F.lit(0.0))
        gap2 = gap2 + gap * gap
        shared = shared + F.col(f"_lo{j}").isNotNull().cast("int")
    near = F.sqrt(gap2 * F.lit(n_feat) / shared) <= F.col("_reach") + F.lit(2 * MARGIN)
    for up, down in zip(levels, levels[1:]):
        nodes = rows.groupBy(F.col(up).alias("_up"), F.col(down).alias("_down")).agg(
            F.sum("_n").alias("_n"), *[F.min(f"_lo{j}").alias(f"_lo{j}") for j in range(n_feat)],
            *[F.max(f"_hi{j}").alias(f"_hi{j}") for j in range(n_feat)])
        nodes = broadcast_if_small(nodes)
        cols = [c for c in pairs.columns if c not in ("_node", "_n")]
        pairs = (pairs.drop("_n").join(nodes, F.col("_node") == F.col("_up")).where(near)
                 .select(*cols, F.col("_down").alias("_node"), F.col("_n")))
    so_far = Window.partitionBy(*block).orderBy("_node").rowsBetween(Window.unboundedPreceding, 0)
    pairs = materialize(pairs.select(*block, F.col("_node").alias("_cell"), "_n",
                                     F.floor(F.sum("_n").over(so_far) / F.lit(CHUNK_DONORS)).cast("int").alias("_chunk")),
                        "knn-visits")
    visited = pairs.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    slices = max(1, -(-visited // max(SLICE_DONORS, rows.agg(F.sum("_n")).first()[0])))
    key = [*block, "_chunk"]
    w = Window.partitionBy("_tid", "_task").orderBy("_dq", "_did")
    out = None
    for i in range(slices):  # a target is in one block, so in one slice
        part = pairs.drop("_n").where(F.pmod(F.xxhash64(*block), F.lit(slices)) == i)
        sent = rows.select("_gid", "_cell", "_n", "_has", "_serves", "_x", "_times", "_ids", "_values").join(broadcast_if_small(part), "_cell")
        asked = bounds.join(part.select(*key).distinct(), block)
        cand = asked.groupBy(*key).cogroup(_renamed(sent, key)).applyInPandas(
            _search_solver(n_feat, k, n_tasks, used, labelled), _CAND)
        found = materialize(answer(cand.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= k)), "knn-found")
        out = found if out is None else out.unionByName(found)
    for done in (rows, at_table, bounds, pairs):
        drop_stage(done)
    return out
