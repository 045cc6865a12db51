"""Operator 3: Brown class-based bigram scoring.

P(word | previous) = P(class | previous class) * P(word | class), both smoothed.

1. Word counts of the training texts, over the whole corpus: packed hash and
   count buffers, summed per hash partition and written once.
2. Word types: every word that occurs ``FLOOR`` times is a type of its own, so the list grows with the
   corpus; a rarer word belongs to the type of its ending. The texts are written once as type numbers.
3. Clustering: the ``WORD_TYPES`` most frequent words and the endings are exchanged one at a time, to
   the class that raises the class-bigram likelihood most, until no move helps. Every other type then
   moves by its own class-bigram counts, summed per type by a shuffle, round after round until the likelihood
   rises by less than ``LEAST_RISE`` of the total.
4. Scoring: class terms and the counts of frequent words are known where a text is
   read. The other words travel as packed buffers to the partition that holds their counts; the
   sums come back per text.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import byte_values, held_out, lean, mix64, partitions_of, prepare, same_or_new, stage, word_spans, words_of_all

WORD_TYPES = 3000  # words that are exchanged one at a time
FLOOR = 20  # occurrences from which a word is a type of its own
ENDINGS = 1000
CLASSES = 48
LEAST_RISE = 1e-5
TYPES_A_GROUP = 20_000  # class counts of so many types are summed in one group
TOKENS_AT_ONCE = 1 << 20
CELLS_AT_ONCE = 1 << 22  # class counts a task holds before they are shuffled
WORDS_HELD = 1 << 20  # distinct words that a task adds up before they are shuffled
ADD = 0.1  # added to counts, in the base and in the class emissions
BACKOFF = 20.0  # weight of the class unigram in the class transitions


def tokens(text: bytes | None) -> tuple[np.ndarray, np.ndarray]:
    """Hash and ending number of each word of a text."""
    raw, start, end, h = word_spans(text)
    return h, endings(raw, start, end)


def endings(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Ending numbers of words, by their last three bytes."""
    v = np.zeros(len(start), np.uint64)
    for k in (1, 2, 3):
        at = end - k
        ok = at >= start
        v[ok] = v[ok] * np.uint64(31) + byte_values(raw[at[ok]])
    return (mix64(v) % np.uint64(ENDINGS)).astype(np.int64)


def _count_batches(parts: int):
    """Per task and hash partition: distinct word hashes, their endings and counts.

    Counts of batches are added up before they leave the task, unless too many words are held.
    """
    def run(batches):
        held, size = [], 0
        for b in batches:
            raw, start, end, h, _ = words_of_all(b.column(0).to_pylist())
            if not len(h):
                continue
            u, first, n = _runs(h)
            held.append((u, endings(raw, start[first], end[first]).astype(np.uint16), n))
            size += len(u)
            if size > WORDS_HELD:
                held = [_added(held)]
                size = len(held[0][0])
                if size > WORDS_HELD // 2:
                    yield _word_batch(*held[0], parts)
                    held, size = [], 0
        if held:
            yield _word_batch(*_added(held), parts)
    return run


def _added(held: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(held) == 1:
        return held[0]
    h, e, n = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(h, kind="stable")
    h, e, n = h[order], e[order], n[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    return h[first], e[first], np.add.reduceat(n, first)


def _word_batch(h: np.ndarray, e: np.ndarray, n: np.ndarray, parts: int) -> pa.RecordBatch:
    return _dealt({"h": h, "e": e, "n": n.astype(np.uint32)}, h, parts)


def _runs(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values, an index of each and its count."""
    order = np.argsort(h)
    s = h[order]
    first = np.flatnonzero(np.r_[True, s[1:] != s[:-1]])
    return s[first], order[first], np.diff(np.r_[first, len(s)])


def _dealt(arrays: dict, h: np.ndarray, parts: int, extra: dict | None = None) -> pa.RecordBatch:
    part = ((h >> np.uint64(40)) % np.uint64(parts)).astype(np.uint16 if parts <= 1 << 16 else np.int32)
    order = np.argsort(part, kind="stable")  # in linear time for 16 bits
    part = part[order].astype(np.int32)
    cut = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(part)]
    cols = {"p": pa.array(part[cut[:-1]])}
    for k, v in (extra or {}).items():
        cols[k] = pa.array([v] * (len(cut) - 1), pa.int64())
    for k, v in arrays.items():
        v = v[order]
        cols[k] = pa.array([v[s:t].tobytes() for s, t in zip(cut[:-1], cut[1:])], pa.binary())
    return pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))


def _sum_counts(key, pdf: pd.DataFrame) -> pd.DataFrame:
    h = np.concatenate([np.frombuffer(x, np.uint64) for x in pdf["h"]])
    e = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["e"]])
    n = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["n"]]).astype(np.int64)
    order = np.argsort(h, kind="stable")
    h, e, n = h[order], e[order], n[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
    total = np.add.reduceat(n, first)
    return pd.DataFrame({"p": [key[0]], "words": [len(first)], "total": [int(total.sum())],
                         "h": [h[first].tobytes()], "e": [e[first].tobytes()], "n": [total.tobytes()]})


def _levels(batches):
    """How many words have a count on each level (64 levels an octave): a small table."""
    tally = np.zeros(64 * 64, np.int64)
    for b in batches:
        for blob in b.column(0).to_pylist():
            tally += np.bincount(_level(np.frombuffer(blob, np.int64)), minlength=len(tally))
    k = np.flatnonzero(tally)
    yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(tally[k])], names=["level", "words"])


def _level(n: np.ndarray) -> np.ndarray:
    return (np.log2(n) * 64).astype(np.int64)


def _above(level: int):
    def run(batches):
        for b in batches:
            for h, e, n in zip(*(c.to_pylist() for c in b.columns)):
                h, e, n = np.frombuffer(h, np.uint64), np.frombuffer(e, np.uint16), np.frombuffer(n, np.int64)
                k = _level(n) >= level
                yield pa.RecordBatch.from_arrays([pa.array(h[k].astype(np.int64)), pa.array(e[k].astype(np.int32)), pa.array(n[k])],
                                                 names=["h", "e", "n"])
    return run


class Types:
    """Type of each token: frequent word, else its ending; the last two types are start and end."""

    def __init__(self, frequent: np.ndarray):
        self.frequent = frequent  # sorted hashes
        self.count = len(frequent) + ENDINGS + 2
        self.start, self.end = self.count - 2, self.count - 1
        bits = len(frequent).bit_length() + 1  # by the first bits of a hash: where to look for it
        self.shift = np.uint64(64 - bits)
        self.slots = np.searchsorted(frequent, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def place(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        last = len(self.frequent) - 1
        if last < 0:
            return np.zeros(len(h), np.int64), np.zeros(len(h), bool)
        i = np.minimum(self.slots[h >> self.shift], last)
        at = self.frequent[i]
        known, on = at == h, np.flatnonzero(at < h)
        while len(on):  # the few further words of a slot
            on = on[i[on] < last]
            i[on] += 1
            at, want = self.frequent[i[on]], h[on]
            known[on] = at == want
            on = on[at < want]
        return i, known

    def of_words(self, raw: np.ndarray, start: np.ndarray, end: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``of``, the endings being looked up only where they count."""
        i, known = self.place(h)
        rare, t = np.flatnonzero(~known), i.copy()
        t[rare] = len(self.frequent) + endings(raw, start[rare], end[rare])
        return t, known, i

    def framed(self, t: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The types of texts of n words each, every text with its start and end; and the place of each start."""
        at = np.cumsum(n + 2) - (n + 2)
        out, word = np.empty(len(t) + 2 * len(n), np.int64), np.ones(len(t) + 2 * len(n), bool)
        out[at], out[at + n + 1] = self.start, self.end
        word[at] = word[at + n + 1] = False
        out[word] = t
        return out, at

    def of(self, h: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Types, with whether each word is frequent and its place among the frequent ones."""
        i, known = self.place(h)
        return np.where(known, i, len(self.frequent) + e), known, i


def _sequences(frequent):
    """Type numbers of each batch of texts, one text after another with its start and end."""
    def run(batches):
        types = Types(frequent.value)
        for b in batches:
            if b.num_rows:
                *words, n = words_of_all(b.column(0).to_pylist())
                s = types.framed(types.of_words(*words)[0], n)[0]
                yield pa.RecordBatch.from_arrays([pa.array([s.astype(np.uint32).tobytes()], pa.binary())], names=["s"])
    return run


def _pairs_of(batches, end: int):
    """First and second types of the bigrams, about ``TOKENS_AT_ONCE`` of them together."""
    held, size = [], 0
    for b in batches:
        for blob in b.column(0).to_pylist():
            s = np.frombuffer(blob, np.uint32)
            own = s[:-1] != end  # no bigram from one text to the next
            held.append((s[:-1][own], s[1:][own]))
            size += len(s)
            if size >= TOKENS_AT_ONCE:
                yield tuple(map(np.concatenate, zip(*held)))
                held, size = [], 0
    if held:
        yield tuple(map(np.concatenate, zip(*held)))


class _Tally:
    """Counts of keys below ``keys``: sorted runs of key and count in one 64-bit number, merged when they have doubled."""

    def __init__(self, keys: int):
        self.kind = np.uint32 if keys <= 1 << 32 else np.uint64
        self.bits = np.uint64(64 - max(1, (keys - 1).bit_length()))
        self.clear()

    def clear(self):
        self.runs, self.size, self.merged, self.seen = [], 0, 0, 0

    def room(self, n: int) -> bool:
        """Whether n more keys can be counted without a count that outgrows its bits."""
        return self.seen + n < 1 << int(self.bits)

    def add(self, keys: np.ndarray):
        """Counts keys of type ``kind``, which are sorted in place."""
        if not len(keys):
            return
        keys.sort()
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        n = np.diff(np.r_[first, len(keys)]).astype(np.uint64)
        self.runs.append(keys[first].astype(np.uint64) << self.bits | n)
        self.size, self.seen = self.size + len(first), self.seen + len(keys)
        if self.size > 2 * max(self.merged, TOKENS_AT_ONCE):
            self.merge()

    def merge(self):
        x = np.concatenate(self.runs)
        self.runs = []
        x.sort()
        key = x >> self.bits
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        x &= (np.uint64(1) << self.bits) - np.uint64(1)
        self.runs = [key[first] << self.bits | np.add.reduceat(x, first)]
        self.size = self.merged = len(first)

    def counts(self) -> tuple[np.ndarray, np.ndarray]:
        """Sorted keys and their counts."""
        if not self.runs:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        if len(self.runs) > 1:
            self.merge()
        x = self.runs[0]
        return (x >> self.bits).astype(np.int64), (x & ((np.uint64(1) << self.bits) - np.uint64(1))).astype(np.int64)


def _bigrams(shared):
    """Core type bigrams of a task's texts, one row per first type: packed second types and counts."""
    def batch(keys, nums, count):
        a, c = keys // count, (keys % count).astype(np.uint16)
        cut = np.r_[0, np.flatnonzero(np.diff(a)) + 1, len(a)]
        return pa.RecordBatch.from_arrays(
            [pa.array(a[cut[:-1]].astype(np.int32)),
             pa.array([c[s:t].tobytes() for s, t in zip(cut[:-1], cut[1:])], pa.binary()),
             pa.array([nums[s:t].tobytes() for s, t in zip(cut[:-1], cut[1:])], pa.binary())], names=["a", "c", "n"])

    def run(batches):
        end, count = len(shared.value) - 1, int(shared.value.max()) + 1
        tally = _Tally(count * count)
        core = shared.value.astype(tally.kind)
        for a, c in _pairs_of(batches, end):
            if not tally.room(len(a)):
                yield batch(*tally.counts(), count)
                tally.clear()
            tally.add(core[a] * tally.kind(count) + core[c])
        if tally.runs:
            yield batch(*tally.counts(), count)
    return run


def _sum_row(key, pdf: pd.DataFrame) -> pd.DataFrame:
    c = np.concatenate([np.frombuffer(x, np.uint16) for x in pdf["c"]])
    n = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["n"]])
    u, inv = np.unique(c, return_inverse=True)
    return pd.DataFrame({"a": [key[0]], "c": [u.tobytes()], "n": [np.bincount(inv, weights=n).astype(np.int64).tobytes()]})


def _xlogx(x: np.ndarray) -> np.ndarray:
    out = np.maximum(x, 1e-300)  # 0 log 0 is 0
    np.log(out, out=out)
    out *= x
    return out


class _ClassTable:
    """Bigrams between classes: their cells and x log x of each, kept up as types come and go.

    The table stands twice, by column and by row, so what a type meets is read in rows.
    """

    def __init__(self, table: np.ndarray):
        self.k = len(table)
        self.cells = np.stack([table.T, table]).astype(float)
        self.logs = _xlogx(self.cells)

    def add(self, c: int, own: np.ndarray, itself: float):
        """Class c's row gets own[0], its column own[1], its own cell both and the pairs of the type with itself; none falls below 0."""
        lines = self.cells[:, c] + own[::-1]
        lines[:, c] = lines[0, c] + own[0, c] + itself
        np.maximum(lines, 0.0, out=lines)
        logs = _xlogx(lines)
        self.cells[:, c], self.cells[:, :, c] = lines, lines[::-1]
        self.logs[:, c], self.logs[:, :, c] = logs, logs[::-1]

    def join_gain(self, own: np.ndarray, itself: float) -> np.ndarray:
        """The gain in likelihood of adding a type to each class."""
        k = self.k
        cells, logs = self.cells.reshape(2 * k, k), self.logs.reshape(2 * k, k)
        at = own.ravel().nonzero()[0]  # other cells stay as they are
        new = np.empty((len(at) + 7, k))
        np.take(cells, at, axis=0, out=new[7:], mode="clip")
        new[7:] += own.ravel()[at, None]
        sums = np.add.reduce(cells, axis=1).reshape(2, k)  # into each class, and out of it
        new[0:2] = sums
        np.add(cells.diagonal(), own, out=new[3:5])
        np.add(new[3], own[1] + itself, out=new[2])
        np.add(sums, (np.add.reduce(own, axis=1) + itself)[::-1, None], out=new[5:7])
        f = _xlogx(new)
        f[3:7] *= -1
        return np.add.reduce(f, axis=0) + logs.diagonal() - np.add.reduce(logs.take(at, axis=0), axis=0)


def exchange(pairs: dict[int, tuple[np.ndarray, np.ndarray]], types: int, fixed: tuple[int, int],
             classes: int = CLASSES) -> np.ndarray:
    """Class of each type. Start and end have classes of their own (the last two).

    Moves one type at a time, most frequent first, to the class with the largest
    ``sum N(c,d) log N(c,d) - 2 sum N(c) log N(c)``, until no move helps.
    """
    right = [(np.empty(0, np.int64), np.empty(0))] * types
    rows = [[] for _ in range(types)]
    count = np.zeros(types)
    for a, (c, n) in pairs.items():
        right[a] = (c.astype(np.int64), n.astype(float))
        count[a] += n.sum()
        for d, x in zip(c.tolist(), n.tolist()):
            rows[d].append((a, x))
    left = [(np.array([a for a, _ in r], np.int64), np.array([x for _, x in r], float)) for r in rows]
    count[fixed[1]] = left[fixed[1]][1].sum()  # the end has nothing to its right
    order = [int(w) for w in np.argsort(-count, kind="stable") if w not in fixed and count[w] > 0]
    k = classes + 2
    cls = np.arange(types) % classes
    for place, w in enumerate(order):
        cls[w] = place % classes
    cls[fixed[0]], cls[fixed[1]] = classes, classes + 1
    table = np.zeros((k, k))
    for a, (c, n) in enumerate(right):
        np.add.at(table, (cls[a], cls[c]), n)
    table = _ClassTable(table)
    moved = 1
    while moved:
        moved = 0
        for w in order:
            old = cls[w]
            (rc, rn), (lc, ln) = right[w], left[w]
            itself = rn[rc == w].sum()
            own = np.stack([np.bincount(cls[rc], weights=rn, minlength=k), np.bincount(cls[lc], weights=ln, minlength=k)])
            own[:, old] -= itself
            table.add(old, -own, -itself)
            gain = table.join_gain(own, itself)
            best = int(np.argmax(gain[:classes]))
            if gain[best] <= gain[old] + 1e-9:
                best = old
            moved += best != old
            cls[w] = best
            table.add(best, own, itself)
    return cls


class _Cells:
    """Cells (type, class) of the class counts: 2 k + 1 a type, dealt to ``parts`` ranges of types.

    A cell travels as 4 bytes within its range and a 2-byte count; what a count has above that is a row of its own.
    """

    def __init__(self, types: int, k: int, parts: int):
        self.types, self.width = types, 2 * k + 1
        first = -(-np.arange(parts + 1, dtype=np.int64) * types // parts)
        self.bounds = first * self.width

    def rows(self, keys: np.ndarray, n: np.ndarray):
        """Sorted cells and counts -> (range, cells, counts, bits the counts are shifted by)."""
        for shift in (0, 16, 32):
            part = n >> shift & 0xFFFF
            some = np.flatnonzero(part)
            if not len(some):
                continue
            at = keys[some]
            cut = np.searchsorted(at, self.bounds)
            for p in np.flatnonzero(np.diff(cut)):
                s, t = cut[p], cut[p + 1]
                yield int(p), (at[s:t] - self.bounds[p]).astype(np.uint32).tobytes(), part[some[s:t]].astype(np.uint16).tobytes(), shift

    def sums(self, p: int, blobs, counts, shifts) -> tuple[np.ndarray, np.ndarray]:
        n = np.zeros(int(self.bounds[p + 1] - self.bounds[p]), np.int64)  # at most TYPES_A_GROUP types and two more
        for c, x, s in zip(blobs, counts, shifts):
            n[np.frombuffer(c, np.uint32)] += np.frombuffer(x, np.uint16).astype(np.int64) << int(s)
        at = np.flatnonzero(n)
        return at + self.bounds[p], n[at]


def _class_counts(shared, cells: _Cells, k: int):
    """Per type, dealt by type: bigrams with each class to its right and left, and with itself; the class table in group -1.

    Counts are added up over a task (over CELLS_AT_ONCE of them where there are more cells) before they leave it.
    """
    def batch(rows):
        rows = list(zip(*rows))
        return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()),
                                           pa.array(rows[2], pa.binary()), pa.array(rows[3], pa.int32())], names=["p", "c", "n", "s"])

    def run(batches):
        cls = shared.value.astype(np.int64)
        width, table = cells.width, np.zeros(k * k, np.int64)
        total = cells.types * width
        tally = _Tally(total + 3 * width)
        kind = tally.kind
        for a, b in _pairs_of(batches, len(cls) - 1):
            left, right, same = cls[a], cls[b], a[a == b]
            table += np.bincount(left * k + right, minlength=k * k)
            a, b, same, left, right = (x.astype(kind, copy=False) for x in (a, b, same, left, right))
            keys = np.concatenate([a * kind(width) + right, b * kind(width) + left + kind(k), same * kind(width) + kind(2 * k)])
            if not tally.room(len(keys)):
                yield batch(cells.rows(*tally.counts()))
                tally.clear()
            tally.add(keys[keys < total])  # start and end stay
            if tally.size > CELLS_AT_ONCE:
                tally.merge()
                if tally.size > CELLS_AT_ONCE:
                    yield batch(cells.rows(*tally.counts()))
                    tally.clear()
        if tally.runs:
            yield batch(cells.rows(*tally.counts()))
        yield batch([(-1, None, table.tobytes(), 0)])
    return run


def _sum_classes(cells: _Cells):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:
            table = np.sum([np.frombuffer(x, np.int64) for x in pdf["n"]], axis=0)
            return pd.DataFrame({"p": [-1], "c": [None], "n": [table.tobytes()]})
        keys, n = cells.sums(int(key[0]), pdf["c"], pdf["n"], pdf["s"])
        return pd.DataFrame({"p": [key[0]], "c": [keys.tobytes()], "n": [n.tobytes()]})
    return run


def _move(shared, classes: int):
    """The best class of each type by its own counts, with the moves before it in its group; exchanged types stay."""
    def run(batches):
        cls, start, core = shared.value
        k = classes + 2
        width = 2 * k + 1
        for batch in batches:
            for c, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, n = np.frombuffer(c, np.int64), np.frombuffer(n, np.int64).astype(float)
                w, at = np.divmod(keys, width)
                cut = np.flatnonzero(np.r_[True, w[1:] != w[:-1], True]) if len(w) else np.zeros(1, np.int64)
                own_types = w[cut[:-1]]
                types, best, table = [], [], _ClassTable(start)
                for i in np.flatnonzero(~core[own_types]).tolist():
                    s, t = cut[i], cut[i + 1]
                    own, old = np.zeros(width), int(cls[own_types[i]])
                    own[at[s:t]] = n[s:t]
                    own, itself = own[:-1].reshape(2, k), own[-1]
                    own[:, old] -= itself
                    table.add(old, -own, -itself)  # counts by the round's start may be taken from a moved neighbour
                    gain = table.join_gain(own, itself)
                    to = int(np.argmax(gain[:classes]))
                    if gain[to] > gain[old] + 1e-9:
                        types.append(own_types[i])
                        best.append(to)
                    else:
                        to = old
                    table.add(to, own, itself)
                yield pa.RecordBatch.from_arrays([pa.array(types, pa.int64()), pa.array(best, pa.int32())], names=["w", "cls"])
    return run


def _likelihood(table: np.ndarray) -> float:
    return float(_xlogx(table).sum() - _xlogx(table.sum(axis=1)).sum() - _xlogx(table.sum(axis=0)).sum())


def assign(sequences: DataFrame, cls: np.ndarray, core: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes of all types and their bigram table: types out of ``core`` move by their own counts, the groups of a round side by side.

    The classes x classes table is broadcast; a round that doesn't raise the likelihood is not kept.
    """
    spark, k = sequences.sparkSession, classes + 2
    parts = max(partitions_of(sequences) * 2, len(cls) // TYPES_A_GROUP + 1)
    cells = _Cells(len(cls) - 2, k, parts)
    kept, before = None, -math.inf
    while True:
        shared = spark.sparkContext.broadcast(cls.astype(np.uint8 if k < 256 else np.uint16))
        sums = stage(sequences.mapInArrow(lean(_class_counts(shared, cells, k)), "p int, c binary, n binary, s int").groupBy("p")
                     .applyInPandas(_sum_classes(cells), "p int, c binary, n binary"), "classes")
        got = sums.where("p = -1").select("n").first()
        table = (np.frombuffer(got["n"], np.int64).reshape(k, k) if got else np.zeros((k, k))).astype(float)
        now = _likelihood(table)
        if kept is not None and now <= before:
            return kept
        kept = cls, table
        if now - before < LEAST_RISE * abs(now) or not len(core):
            return kept
        before = now
        moved = (sums.where("p >= 0").select("c", "n")
                 .mapInArrow(lean(_move(spark.sparkContext.broadcast((cls, table, core)), classes)), "w bigint, cls int").toPandas())
        if not len(moved):
            return kept
        cls = cls.copy()
        cls[moved["w"].to_numpy(int)] = moved["cls"].to_numpy(int)


def fit(docs: DataFrame, word_types: int = WORD_TYPES, classes: int = CLASSES, floor: int = FLOOR) -> dict:
    """Model from ``docs(text)``: all rows are counted. NULL texts are empty: just an end."""
    spark = docs.sparkSession
    prepare(spark)
    d = same_or_new(docs, [("text", "binary")])
    parts = partitions_of(d) * 2
    counts = stage(d.mapInArrow(_count_batches(parts), "p int, h binary, e binary, n binary").groupBy("p")
                   .applyInPandas(_sum_counts, "p int, words bigint, total bigint, h binary, e binary, n binary"), "counts")
    n_docs = d.count()
    sums = counts.agg(F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    levels = (counts.select("n").mapInArrow(_levels, "level bigint, words bigint").groupBy("level")
              .agg(F.sum("words").alias("words")).orderBy(F.desc("level")).collect())
    level, room = 64 * 64, word_types
    for r in levels:
        if r["words"] > room:
            break
        level, room = r["level"], room - r["words"]
    least = min(level, int(_level(np.array([float(floor)]))[0]))
    top = counts.select("h", "e", "n").mapInArrow(_above(least), "h bigint, e int, n bigint").toPandas()
    h = top["h"].to_numpy(np.int64).astype(np.uint64)
    order = np.argsort(h)
    frequent, n_frequent = h[order], top["n"].to_numpy(np.int64)[order]
    types = Types(frequent)
    shared = spark.sparkContext.broadcast(frequent)
    sequences = stage(d.mapInArrow(lean(_sequences(shared)), "s binary"), "sequences")
    # Core types: exchanged words, endings, start and end. Until it has a class of its own, a word counts by its ending.
    exchanged = _level(n_frequent) >= level
    n_core = int(exchanged.sum())
    core = np.empty(types.count, np.int64)
    core[:len(frequent)] = np.where(exchanged, np.cumsum(exchanged) - 1, n_core + top["e"].to_numpy(np.int64)[order])
    core[len(frequent):] = n_core + np.arange(ENDINGS + 2)
    rows = (sequences.mapInArrow(lean(_bigrams(spark.sparkContext.broadcast(core))), "a int, c binary, n binary").groupBy("a")
            .applyInPandas(_sum_row, "a int, c binary, n binary").toPandas())
    pairs = {a: (np.frombuffer(c, np.uint16), np.frombuffer(n, np.int64))
             for a, c, n in zip(rows["a"], rows["c"], rows["n"])}
    n_types = n_core + ENDINGS + 2
    cls = exchange(pairs, n_types, (n_types - 2, n_types - 1), classes)[core]
    k = classes + 2
    cls, table = assign(sequences, cls, np.r_[exchanged, np.zeros(ENDINGS + 2, bool)], classes)
    into = table.sum(axis=0)
    # Classes that can follow: all but the start. Unseen transitions fall back to the class unigram.
    unigram = into + 1.0
    unigram[classes] = 0.0
    unigram /= unigram.sum()
    move = (table + BACKOFF * unigram) / (table.sum(axis=1, keepdims=True) + BACKOFF)
    vocabulary = np.zeros(types.count)
    vocabulary[:len(frequent)] = 1
    vocabulary[types.end] = 1
    words = counts.select("h", "e").mapInArrow(_ending_words(shared), "e int, words bigint").groupBy("e").agg(
        F.sum("words").alias("words")).toPandas()
    vocabulary[len(frequent) + words["e"].to_numpy(int)] = words["words"]
    # Tokens of a class: its transitions in; of words: their counts, which are the same.
    per_class = np.bincount(cls, weights=vocabulary, minlength=k)
    emit = np.log10(into + ADD * (per_class + 1))
    with np.errstate(divide="ignore"):
        step = np.log10(move) - emit[None, :]
    total = int(sums[1]) + n_docs
    return {"frequent": frequent, "n_frequent": n_frequent, "classes": cls, "step": step, "counts": counts,
            "parts": parts, "train_tokens": total, "vocabulary": int(sums[0]) + (n_docs > 0), "ends": n_docs}


def _ending_words(frequent):
    """Number of distinct words, other than the frequent ones, per ending."""
    def run(batches):
        types, tally = Types(frequent.value), np.zeros(ENDINGS, np.int64)
        for b in batches:
            for h, e in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                known = types.place(np.frombuffer(h, np.uint64))[1]
                tally += np.bincount(np.frombuffer(e, np.uint16)[~known], minlength=ENDINGS)
        k = np.flatnonzero(tally)
        yield pa.RecordBatch.from_arrays([pa.array(k.astype(np.int32)), pa.array(tally[k])], names=["e", "words"])
    return run


_DOC = np.dtype([("id", "i8"), ("null", "?"), ("held", "?"), ("n", "i8"), ("known", "i8"), ("base", "f8"), ("cls", "f8")])
_ROUTE = "p int, b bigint, h binary, i binary, doc binary"


def _route(shared):
    """Per batch: one row with what is known of its texts, and the other words dealt by hash."""
    def run(batches):
        m = shared.value
        types, parts, step, k = Types(m["frequent"]), m["parts"], m["step"].ravel(), len(m["step"])
        log_frequent, log_end = np.log10(m["n_frequent"] + ADD), math.log10(m["ends"] + ADD)
        task, seq = TaskContext.get().partitionId(), 0
        for b in batches:
            if not b.num_rows:
                continue
            docs = np.zeros(b.num_rows, _DOC)
            docs["id"] = b.column(0).fill_null(0)
            docs["null"] = b.column(0).is_null()
            docs["held"] = b.column(1)
            *words, n = words_of_all(b.column(2).to_pylist())
            h, (t, known, _) = words[-1], types.of_words(*words)
            s, at = types.framed(t, n)
            c = m["classes"][s]
            steps = step[c[:-1] * k + c[1:]]
            steps[at[1:] - 1] = 0.0  # from the end of a text to the next one's start
            docs["cls"] = np.add.reduceat(steps, at)
            own = s < len(log_frequent)
            logs = np.zeros(len(s))
            logs[own] = log_frequent[s[own]]
            docs["base"] = np.add.reduceat(logs, at) + log_end
            docs["known"] = np.add.reduceat(own, at, dtype=np.int64) + (m["ends"] > 0)
            docs["n"] = n + 1
            key = task << 32 | seq
            seq += 1
            own = int(mix64(np.array([key], np.uint64))[0] % np.uint64(parts))
            yield pa.RecordBatch.from_pydict({"p": [own], "b": [key], "h": [None], "i": [None], "doc": [docs.tobytes()]},
                                             schema=_ROUTE_SCHEMA)
            rare = np.flatnonzero(~known)
            if len(rare):
                idx = np.repeat(np.arange(len(n), dtype=np.uint16), n)
                out = _dealt({"h": h[rare], "i": idx[rare]}, h[rare], parts, {"b": key})
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.nulls(out.num_rows, pa.binary())], names=[*out.schema.names, "doc"]).select(
                        ["p", "b", "h", "i", "doc"])
    return run


_ROUTE_SCHEMA = pa.schema([("p", pa.int32()), ("b", pa.int64()), ("h", pa.binary()), ("i", pa.binary()), ("doc", pa.binary())])


def _look_up(key, words: pd.DataFrame, counts: pd.DataFrame) -> pd.DataFrame:
    """Sums of log counts and of known words per text, for one hash partition."""
    out = []
    if len(counts):
        table, n = np.frombuffer(counts["h"].iloc[0], np.uint64), np.frombuffer(counts["n"].iloc[0], np.int64)
    else:
        table, n = np.zeros(1, np.uint64), np.zeros(1, np.int64)
    for b, h, i, doc in zip(words["b"], words["h"], words["i"], words["doc"]):
        if h is None:
            out.append((b, None, None, None, doc))
            continue
        h, i = np.frombuffer(h, np.uint64), np.frombuffer(i, np.uint16)
        at = np.minimum(np.searchsorted(table, h), len(table) - 1)
        c = np.where(table[at] == h, n[at], 0)
        u, inv = np.unique(i, return_inverse=True)
        out.append((b, u.tobytes(), np.bincount(inv, weights=np.log10(c + ADD)).tobytes(),
                    np.bincount(inv, weights=c > 0).astype(np.uint32).tobytes(), None))
    return pd.DataFrame(out, columns=["b", "i", "logs", "known", "doc"])


def _collect(shared):
    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        m = shared.value
        docs = np.frombuffer(next(x for x in pdf["doc"] if x is not None), _DOC).copy()
        for i, logs, known in zip(pdf["i"], pdf["logs"], pdf["known"]):
            if i is not None:
                i = np.frombuffer(i, np.uint16)
                docs["base"][i] += np.frombuffer(logs, np.float64)
                docs["known"][i] += np.frombuffer(known, np.uint32)
        room = math.log10(m["train_tokens"] + ADD * (m["vocabulary"] + 1))
        ids = pd.array(docs["id"], dtype="Int64")
        ids[docs["null"]] = pd.NA
        return pd.DataFrame({"doc_id": ids, "held_out": docs["held"], "n_tokens": docs["n"], "n_known": docs["known"],
                             "train_tokens": m["train_tokens"], "base_score": docs["base"] - docs["n"] * room,
                             "score": docs["base"] + docs["cls"]})
    return run


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs(doc_id, held_out, text)`` -> one row per input row.

    Columns: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``; scores are
    log10 probabilities of the whole text. NULL texts are empty: one end token. Repeated
    rows are scored alike; extra columns are ignored; NULL ids stay NULL.
    """
    spark = docs.sparkSession
    prepare(spark)
    d = same_or_new(docs, [("doc_id", "bigint"), ("held_out", "boolean"), ("text", "binary")])
    small = {k: v for k, v in model.items() if k != "counts"}
    shared = spark.sparkContext.broadcast(small)
    routed = d.mapInArrow(_route(shared), _ROUTE)
    found = (routed.groupBy("p").cogroup(model["counts"].select("p", "h", "n").groupBy("p"))
             .applyInPandas(_look_up, "b bigint, i binary, logs binary, known binary, doc binary"))
    return found.groupBy("b").applyInPandas(
        _collect(shared), "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
                          "base_score double, score double")


def perplexity(log10_prob, n_tokens):
    """Per-token perplexity of a log10 probability."""
    return F.pow(F.lit(10.0), -F.col(log10_prob) / F.col(n_tokens))


def score_corpus(docs: DataFrame) -> DataFrame:
    """Learn from the rows whose crc32 of the id modulo 10 is not 0, score all rows."""
    d = docs.select("doc_id", "text", held_out(F.col("doc_id"), 10, 0).alias("held_out"))
    return score(d, fit(d.where("not held_out")))
