"""Nearest donors of the targets of one block, over the cells shipped to it (numpy, inside a task).

Cells are small runs of donors with a tight box. A target first looks into the cell whose box is nearest,
then only into cells whose box is not farther than its k-th distance so far.
"""

from __future__ import annotations

import numpy as np

DIST_DIGITS = 9
MARGIN = 2 * 10.0 ** -DIST_DIGITS  # covers the rounding of distances
TARGET_CHUNK = 2048


def distances(t: np.ndarray, d: np.ndarray, factor: tuple[int, int]) -> np.ndarray:
    """Euclidean distances scaled by sqrt(all / shared coordinates), rounded; coordinates in index order."""
    acc = np.zeros((len(t), len(d)))
    buf = np.empty_like(acc)
    for j in range(t.shape[1]):
        np.subtract(t[:, j, None], d[None, :, j], out=buf)
        buf *= buf
        acc += buf
    return _scaled(acc, factor)


def _scaled(acc: np.ndarray, factor: tuple[int, int]) -> np.ndarray:
    if factor[0] != factor[1]:
        acc *= factor[0]
        acc /= factor[1]
    np.sqrt(acc, out=acc)
    return np.round(acc, DIST_DIGITS, out=acc)


def box_distances(t: np.ndarray, lo: np.ndarray, hi: np.ndarray, factor: tuple[int, int]) -> np.ndarray:
    acc = np.zeros((len(t), len(lo)))
    for j in range(t.shape[1]):
        gap = np.maximum(lo[None, :, j] - t[:, j, None], t[:, j, None] - hi[None, :, j])
        np.maximum(gap, 0.0, out=gap)
        gap *= gap
        acc += gap
    return _scaled(acc, factor)


class Group:
    """Donors that share a presence pattern, projected on the coordinates in common with the targets.

    A row may stand for several equal donors (``times``).
    """

    def __init__(self, x: np.ndarray, cell: np.ndarray, at: np.ndarray, serves: list[int], times: np.ndarray | None = None):
        self.dims = np.flatnonzero(~np.isnan(x[0]))
        order = np.argsort(cell, kind="stable")
        self.x, self.at, self.serves = np.ascontiguousarray(x[order][:, self.dims]), at[order], serves
        self.times = None if times is None or (times == 1).all() else times[order]
        cell = cell[order]
        self.start = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        self.end = np.r_[self.start[1:], len(cell)]
        self.lo = np.minimum.reduceat(self.x, self.start, axis=0)
        self.hi = np.maximum.reduceat(self.x, self.start, axis=0)


class Nearest:
    """Running k smallest distances of a chunk of targets per task, and the donors within them."""

    def __init__(self, bound: np.ndarray, k: int):
        self.k = k
        self.best = [np.full((len(bound), k), np.inf) for _ in range(bound.shape[1])]
        self.bound = bound.copy()  # [target, task]
        self.found: list[list[tuple]] = [[] for _ in range(bound.shape[1])]

    def look(self, rows: np.ndarray, t: np.ndarray, g: Group, c: int, factor) -> None:
        lo, hi = g.start[c], g.end[c]
        dq = distances(t[rows], g.x[lo:hi], factor)
        for task in g.serves:
            hit = dq <= self.bound[rows, task, None]
            some = np.flatnonzero(hit.any(axis=1))
            if not len(some):
                continue
            own, near = rows[some], dq[some]
            both = np.concatenate([self.best[task][own], self._each(np.where(hit[some], near, np.inf), g, lo, hi)], axis=1)
            if both.shape[1] > self.k:
                both = np.partition(both, self.k - 1, axis=1)[:, :self.k]
            self.best[task][own] = both
            self.bound[own, task] = np.minimum(self.bound[own, task], both.max(axis=1))
            # only what the new bound leaves is kept: about k a target and cell, not the whole first cell
            r, at = np.nonzero(near <= self.bound[own, task, None])
            self.found[task].append((own[r], g.at[lo + at], near[r, at]))

    def _each(self, near: np.ndarray, g: Group, lo: int, hi: int) -> np.ndarray:
        """Distances of the donors that the rows of a cell stand for; those of the k nearest rows, as others can't count."""
        if g.times is None:
            return near
        times = np.broadcast_to(g.times[lo:hi], near.shape)
        if near.shape[1] > self.k:
            first = np.argpartition(near, self.k - 1, axis=1)[:, :self.k]
            near, times = np.take_along_axis(near, first, axis=1), np.take_along_axis(times, first, axis=1)
        each = np.where(np.arange(self.k) < times[:, :, None], near[:, :, None], np.inf)
        return each.reshape(len(near), -1)

    def search(self, t: np.ndarray, g: Group, n_feat: int) -> None:
        """All cells of a group: the nearest box first, then those within the bound."""
        factor = (n_feat, len(g.dims))
        t = np.ascontiguousarray(t[:, g.dims])
        box = box_distances(t, g.lo, g.hi, factor)
        home = box.argmin(axis=1)
        reach = self.bound[:, g.serves].max(axis=1) + MARGIN
        order = np.argsort(home, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(home[order]) != 0])
        for rows in np.split(order, cuts[1:]):
            c = home[rows[0]]
            rows = rows[box[rows, c] <= reach[rows]]
            if len(rows):
                self.look(rows, t, g, c, factor)
        box[np.arange(len(t)), home] = np.inf
        reach = self.bound[:, g.serves].max(axis=1) + MARGIN
        for c in np.flatnonzero((box <= reach[:, None]).any(axis=0)):
            reach = self.bound[:, g.serves].max(axis=1) + MARGIN  # bounds shrink on the way
            rows = np.flatnonzero(box[:, c] <= reach)
            rows = rows[np.isfinite(box[rows, c])]
            if len(rows):
                self.look(rows, t, g, c, factor)

    def take(self, task: int, ids: np.ndarray, times: np.ndarray | None = None):
        """(target row, donor, distance) of the k nearest, ties to the smaller donor id; a donor is its place in ``ids``.

        ``times``: how many ids, one after the other, each donor row has (one, if not given).
        """
        if not self.found[task]:
            return (np.empty(0, np.int64),) * 2 + (np.empty(0),)
        r, d, v = (np.concatenate(x) for x in zip(*self.found[task]))
        near = v <= self.bound[r, task]
        r, d, v = r[near], d[near], v[near]
        if times is not None:
            n, first = times[d], (np.cumsum(times) - times)[d]
            r, v = np.repeat(r, n), np.repeat(v, n)
            d = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(len(r))
        order = np.lexsort((ids[d], v, r))
        r, d, v = r[order], d[order], v[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < self.k
        return r[keep], d[keep], v[keep]
