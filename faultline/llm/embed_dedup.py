"""Operator 10: near-duplicate vectors by cosine, spherical k-means cells and blocked products.

Equal vectors collapse to one row with a multiplicity. Spherical k-means
centroids are fitted on a bounded sample; every vector has one home cell. A
pair is compared in the home cell of one of its two vectors: the other vector
visits every cell whose border it may have a partner behind. For a partner at
angle ``phi`` or less, the border between cells ``c`` (home) and ``d`` is out
of reach if ``v.(c - d) / |c - d| > sin(phi)`` - that is exact. With ``z`` set,
the reach is ``min(sin(phi), z tan(phi) / sqrt(dim))``: the displacement
of a partner is taken as a random direction, whose component towards the border
has the standard deviation ``tan(phi) / sqrt(dim)``. A link is lost only if
both vectors fail that bound. ``z=None`` asks for the exact reach.

Cells are cut into chunks of bounded size, so a hot cell is many tasks. A task
multiplies blocks in double precision and returns one count per vector and a
spanning forest of the links it found, never the pairs.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import mix64, prepare, same_or_new, stage
from faultline.llm.components import components

SIMILARITY = 0.9
SAMPLE = 32_768  # most vectors that the centroids are fitted on
MAX_CELLS = 4096  # the centroid table is at most this times the dimension
CELL = 2048  # vectors of a cell, on average
CHUNK = 2048  # home vectors of a task
LOT = 8192  # visitors of a task
REACH_Z = 3.0
ROUNDS = 12


def fit_cells(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """Spherical k-means: unit rows in, unit centroids out. Deterministic."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        home = np.argmax(x @ c.T, axis=1)
        s = np.zeros_like(c)
        np.add.at(s, home, x)
        n = np.linalg.norm(s, axis=1)
        ok = n > 0
        c[ok] = s[ok] / n[ok, None]
    return np.unique(c, axis=0)


def reach_of(similarity: float, dim: int, z: float | None) -> float:
    phi = math.acos(max(-1.0, min(1.0, similarity)))
    exact = math.sin(phi) if phi < math.pi / 2 else 2.0
    return exact if z is None else min(exact, z * math.tan(phi) / math.sqrt(dim))


def visits(x: np.ndarray, cells: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell per row and the mask of cells that the row must be compared in."""
    dot = x @ cells.T
    home = np.argmax(dot, axis=1)
    gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (cells @ cells.T)))
    lead = dot[np.arange(len(x)), home][:, None] - dot
    return home, lead <= reach * gap[home] + 1e-9


def _vectors(col) -> np.ndarray:
    """Unit rows from the packed values of a column."""
    x = np.frombuffer(b"".join(col), np.float64).reshape(len(col), -1)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _pack(frames):
    for pdf in frames:
        yield pd.DataFrame({"rep": pdf["rep"], "copies": pdf["copies"],
                            "x": [np.asarray(e, np.float64).tobytes() for e in pdf["embedding"]]})


def _load(cells, reach):
    """Home vectors and visitors of each cell, counted per batch."""
    def run(frames):
        for pdf in frames:
            if len(pdf):
                home, mask = visits(_vectors(pdf["x"]), cells.value, reach)
                k = len(cells.value)
                yield pd.DataFrame({"cell": np.arange(k), "homes": np.bincount(home, minlength=k), "guests": mask.sum(axis=0)})
    return run


def _spread(rep: np.ndarray, n: np.ndarray, salt: int) -> np.ndarray:
    return (mix64(rep.astype(np.uint64) ^ np.uint64(salt)) % n.astype(np.uint64)).astype(np.int64)


def _place(cells, reach, load, as_home: bool):
    """Rows (cell, chunk of the cell, lot of visitors): a home vector once per lot, a visitor once per chunk."""
    def run(frames):
        homes, guests = load.value
        chunks, lots = np.maximum(1, -(-homes // CHUNK)), np.maximum(1, -(-guests // LOT))
        for pdf in frames:
            if not len(pdf):
                continue
            rep = pdf["rep"].to_numpy()
            home, mask = visits(_vectors(pdf["x"]), cells.value, reach)
            own = _spread(rep, chunks[home], 1)
            if as_home:
                i = np.arange(len(rep))
                times, cell = lots[home], home
            else:
                i, cell = np.nonzero(mask & (homes > 0))
                # Within a cell, a chunk meets its own vectors and those of later chunks.
                times = np.where(home[i] == cell, own[i] + 1, chunks[cell])
            at = np.repeat(np.arange(len(i)), times)
            turn = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
            i, cell = i[at], cell[at]
            lot = turn if as_home else _spread(rep[i], lots[cell], 2)
            yield pd.DataFrame({"cell": cell, "at": own[i] if as_home else turn, "lot": lot, "rep": rep[i],
                                "copies": pdf["copies"].to_numpy()[i], "x": pdf["x"].to_numpy()[i],
                                "home": home[i], "chunk": own[i]})
    return run


_PLACED = "cell bigint, at bigint, lot bigint, rep bigint, copies bigint, x binary, home bigint, chunk bigint"


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable, for links a-b over 0..n-1."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while not np.array_equal(root, root[root]):
            root = root[root]
        if np.array_equal(before, root):
            break
    return root


def _compare(cells, reach, similarity):
    """One chunk of a cell against one lot of visitors; counts each pair of vectors once."""
    def run(key, homes: pd.DataFrame, guests: pd.DataFrame) -> pd.DataFrame:
        cols = ["rep", "n", "root"]
        if not len(homes) or not len(guests):
            return pd.DataFrame({c: pd.Series([], dtype="int64") for c in cols})
        h = _vectors(homes["x"])
        hid, hw = homes["rep"].to_numpy(), homes["copies"].to_numpy()
        cell, chunk = int(key[0]), int(key[1])
        ids = np.concatenate([hid, guests["rep"].to_numpy()])
        count = np.zeros(len(ids), np.int64)
        pairs_a, pairs_b = [], []
        for s in range(0, len(guests), 1024):
            g = guests.iloc[s:s + 1024]
            x = _vectors(g["x"])
            i, j = np.nonzero(x @ h.T >= similarity)
            gid, ghome, gchunk = g["rep"].to_numpy(), g["home"].to_numpy(), g["chunk"].to_numpy()
            ok = gid[i] != hid[j]
            same = ghome[i] == cell
            # Within the cell: chunk pairs meet once, and within one chunk each pair once.
            ok &= ~same | (gchunk[i] > chunk) | ((gchunk[i] == chunk) & (gid[i] > hid[j]))
            i, j, same = i[ok], j[ok], same[ok]
            if len(i) and not same.all():
                # Between cells: where both vectors visit each other's cell, the smaller cell counts.
                hx, other = h[j], ghome[i]
                c = cells.value
                gap = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (c[cell] @ c[other].T)))
                back = (hx @ c[cell]) - np.einsum("ij,ij->i", hx, c[other]) <= reach * gap + 1e-9
                ok = same | ~back | (cell < other)
                i, j = i[ok], j[ok]
            gw = g["copies"].to_numpy()
            np.add.at(count, j, gw[i])
            np.add.at(count, len(hid) + s + i, hw[j])
            pairs_a.append(j)
            pairs_b.append(len(hid) + s + i)
        # The same vector may be both at home and a guest here: link its two places.
        u, place = np.unique(ids, return_inverse=True)
        a, b = place[np.concatenate(pairs_a)], place[np.concatenate(pairs_b)]
        root = _roots(a, b, len(u))
        n = np.bincount(place, weights=count, minlength=len(u)).astype(np.int64)
        k = n > 0
        return pd.DataFrame({"rep": u[k], "n": n[k], "root": u[root[k]]})
    return run


def cosine_components(vectors: DataFrame, similarity: float = SIMILARITY, z: float | None = REACH_Z,
                      cells: int | None = None, sample: int = SAMPLE) -> DataFrame:
    """``vectors(vec_id, embedding)`` -> one row per input row: ``vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows linked directly, equal vectors included.
    NULL, empty and zero vectors and vectors with NULL, NaN or infinite components link with
    nothing and are kept; so are rows with NULL ``vec_id`` (``component_id`` NULL).
    Vectors of different dimensions never link. Extra columns are ignored.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = same_or_new(vectors, [("vec_id", "bigint"), ("embedding", "array<double>")])
    squared = F.aggregate("embedding", F.lit(0.0), lambda s, e: s + e * e)
    norm = F.sqrt(squared)
    usable = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
              & ~F.exists("embedding", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf"))))
    rows = stage(v.select("vec_id", F.when(usable, F.col("embedding")).alias("embedding")).select(
        "vec_id", F.when((norm > 0) & (norm < float("inf")), F.col("embedding")).alias("embedding")), "vectors")
    good = rows.where("embedding is not null")
    same = stage(good.groupBy("embedding").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
                 .select("rep", "copies", F.size("embedding").alias("dim"), "embedding"), "distinct")
    counts = {r["dim"]: r["count"] for r in same.groupBy("dim").count().collect()}
    found = None
    for dim, n in sorted(counts.items()):
        own = same.where(F.col("dim") == dim).select("rep", "copies", "embedding").mapInPandas(
            _pack, "rep bigint, copies bigint, x binary")
        k = cells or max(1, min(MAX_CELLS, n // CELL))
        share = min(1.0, sample / n)
        fit = (own.where(F.pmod(F.xxhash64("rep"), F.lit(1 << 20)) < int(share * (1 << 20)))
               if share < 1 else own).select("rep", "x").toPandas().sort_values("rep")
        table = fit_cells(_vectors(fit["x"]), k) if len(fit) else np.eye(1, dim)
        part = _links(own, spark.sparkContext.broadcast(table), reach_of(similarity, dim, z), similarity)
        found = part if found is None else found.union(part)
    if found is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"),
                           F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = stage(found, "found")
    comp = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("n").alias("n"))
    per = (same.join(links, "rep", "left").join(comp, F.col("rep") == F.col("node"), "left")
           .select("embedding", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
                   F.coalesce("component", "rep").alias("component_id")))
    out = good.join(per, "embedding").select("vec_id", "n_links", "component_id")
    out = out.union(rows.where("embedding is null").select("vec_id", F.lit(0).cast("bigint"), "vec_id"))
    return out.select("vec_id", "n_links", "component_id",
                      F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)).alias("kept"))


def _links(own: DataFrame, cells, reach: float, similarity: float) -> DataFrame:
    """(rep, n, root): per task and vector the links found and the root of their forest."""
    load = (own.mapInPandas(_load(cells, reach), "cell bigint, homes bigint, guests bigint")
            .groupBy("cell").agg(F.sum("homes").alias("homes"), F.sum("guests").alias("guests"))
            .toPandas().sort_values("cell"))  # one row per cell
    size = own.sparkSession.sparkContext.broadcast((load["homes"].to_numpy(), load["guests"].to_numpy()))
    homes = own.mapInPandas(_place(cells, reach, size, True), _PLACED)
    guests = own.mapInPandas(_place(cells, reach, size, False), _PLACED)
    return (homes.groupBy("cell", "at", "lot").cogroup(guests.groupBy("cell", "at", "lot"))
            .applyInPandas(_compare(cells, reach, similarity), "rep bigint, n bigint, root bigint"))
