"""Operator 7: byte-level BPE encoding and decoding.

A text is cut by the tokenizer's pattern; each piece that isn't a token
itself is merged pair by pair, lowest rank first and leftmost among equal ranks.
The next pair is the root of a segment tree over the piece's byte positions;
its leaves hold the rank of the pair that starts at a live position. A merge
touches three leaves (the pair, the right neighbour that dies, the pair before)
and the tree nodes above them, so a piece of n bytes takes O(n log n) steps. Short
pieces are merged side by side: their trees are the rows of one numpy matrix.

Merged pieces are kept in a bounded per-worker table, since words repeat.
"""

from __future__ import annotations

import base64
from itertools import chain, islice, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import held, lean, prepare, same_or_new

VOCABULARY = "byte_bpe_50k.tiktoken"
LOT_PIECES = 50_000  # pieces encoded at once
KEPT_PIECES = 100_000  # pieces in the per-worker table (about 16 MB); it is emptied when full, tested every lot
SHORT = 64  # bytes of a piece whose tree is a row of a matrix; longer ones have a list of their own
FOREST_BYTES = 1 << 17  # bytes of pieces, filled up to powers of two, whose trees are one matrix
SLICE_BYTES = 1 << 20  # bytes of texts encoded and handed back at once, unless one text alone is longer
_NONE = 1 << 60


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


class ByteBpe:
    """Encoder and decoder for one vocabulary of byte strings with ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.single = [ranks[bytes([b])] for b in range(256)]
        # A pair of tokens can merge if its bytes are a token too: key left << 32 | right, rank of the whole.
        whole = ((ranks[t[:i]] << 32 | ranks[t[i:]], r) for t, r in ranks.items()
                 for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks)
        key, rank = np.fromiter(chain.from_iterable(whole), np.int64).reshape(-1, 2).T.copy()
        self._forget()
        self.single_np = np.array(self.single, np.int64)
        self.bigrams_np = np.full(1 << 16, _NONE, np.int64)
        for t, r in ranks.items():
            if len(t) == 2:
                self.bigrams_np[t[0] << 8 | t[1]] = r
        # Open addressing, placed in rounds: a key sits at most self.probes slots after its own.
        bits = max(4, (2 * len(key)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.slot_key = np.full((1 << bits) + 256, -1, np.int64)
        self.slot_rank = np.full((1 << bits) + 256, _NONE, np.int64)
        home, self.probes = self._home(key), 0
        while len(key):
            at = home + self.probes
            free = np.flatnonzero(self.slot_key[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.slot_key[at[put]], self.slot_rank[at[put]] = key[put], rank[put]
            left = np.ones(len(key), bool)
            left[put] = False
            key, rank, home = key[left], rank[left], home[left]
            self.probes += 1

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of tokens, _NONE where the pair isn't in the vocabulary."""
        key = left << 32 | right
        at = self._home(key)
        found = self.slot_key[at]
        out = np.where(found == key, self.slot_rank[at], _NONE)
        todo = np.flatnonzero((found != key) & (found != -1))
        for i in range(1, self.probes):
            if not len(todo):
                break
            at_i = at[todo] + i
            found = self.slot_key[at_i]
            hit = found == key[todo]
            out[todo[hit]] = self.slot_rank[at_i[hit]]
            todo = todo[~hit & (found != -1)]
        return out

    def merge_many(self, pieces: list[bytes]) -> list[list[int]]:
        """``merge`` for many short pieces: their trees are rows of one matrix, one merge each a round."""
        flat, size = self._merge_flat(pieces)
        ends = np.cumsum(size).tolist()
        return [flat[a:b].tolist() for a, b in zip([0, *ends], ends)]

    def _merge_flat(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after another, and how many each has."""
        size, parts = np.zeros(len(pieces), np.int64), []
        by_shift: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            if 1 < len(p) <= SHORT:
                by_shift.setdefault((len(p) - 1).bit_length(), []).append(i)
            else:
                ids = np.array(self.merge(p), np.int32)
                size[i] = len(ids)
                parts.append(([i], ids))
        for shift, rows in by_shift.items():
            step = FOREST_BYTES >> shift
            for s in range(0, len(rows), step):
                part = rows[s:s + step]
                ids, size[part] = self._forest([pieces[i] for i in part], shift)
                parts.append((part, ids))
        begin, out = np.cumsum(size) - size, np.empty(size.sum(), np.int32)
        for part, ids in parts:
            out[_runs(begin[part], size[part])] = ids
        return out, size

    def _forest(self, pieces: list[bytes], shift: int) -> tuple[np.ndarray, np.ndarray]:
        n, width = len(pieces), 1 << shift
        size = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join([p.ljust(width, b"\0") for p in pieces]), np.uint8).reshape(n, width)
        at = np.arange(width)
        token = np.where(at < size[:, None], self.single_np[raw], -1)
        rank = self.bigrams_np[raw[:, :-1].astype(np.int64) << 8 | raw[:, 1:]]
        tree = np.full((n, 2 * width), _NONE, np.int64)
        ok = (at[1:] < size[:, None]) & (rank < _NONE)
        tree[:, width:-1] = np.where(ok, rank << shift | at[:-1], _NONE)
        level = width // 2
        while level:
            tree[:, level:2 * level] = np.minimum(tree[:, 2 * level:4 * level:2], tree[:, 2 * level + 1:4 * level:2])
            level //= 2
        # Flat views: position p of row r is r * width + p, tree node k is r * 2 width + k.
        after = np.broadcast_to(at + 1, (n, width)).ravel().copy()
        before = np.broadcast_to(at - 1, (n, width)).ravel().copy()
        flat, tok = tree.ravel(), token.ravel()
        row = np.flatnonzero(tree[:, 1] < _NONE)
        while len(row):
            p0, t0 = row * width, row * (2 * width)
            best = flat[t0 + 1]
            pos, merged = best & (width - 1), best >> shift
            at_pos = p0 + pos
            right = after[at_pos]
            end = after[p0 + right]
            after[at_pos] = end
            tok[at_pos] = merged
            tok[p0 + right] = -1
            flat[t0 + width + right] = _NONE
            here = np.full(len(row), _NONE, np.int64)
            k = np.flatnonzero(end < size[row])
            if len(k):
                at_end = p0[k] + end[k]
                before[at_end] = pos[k]
                r = self._ranks(merged[k], tok[at_end])
                here[k] = np.where(r < _NONE, r << shift | pos[k], _NONE)
            flat[t0 + width + pos] = here
            prev = before[at_pos]
            k = np.flatnonzero(prev >= 0)
            if len(k):
                q = prev[k]
                r = self._ranks(tok[p0[k] + q], merged[k])
                flat[t0[k] + width + q] = np.where(r < _NONE, r << shift | q, _NONE)
            # A missing left pair climbs from the merged position instead.
            paths = (width + right, width + pos, width + np.where(prev >= 0, prev, pos))
            for _ in range(shift):
                paths = tuple(node >> 1 for node in paths)
                for node in paths:
                    child = t0 + 2 * node
                    flat[t0 + node] = np.minimum(flat[child], flat[child + 1])
            row = row[flat[t0 + 1] < _NONE]
        live = token >= 0
        return token[live].astype(np.int32), live.sum(axis=1)

    def merge(self, piece: bytes) -> list[int]:
        """Token ids of one piece by pair merges alone.

        ``tree[1]`` is ``rank * width + position`` of the next pair: the lowest
        rank and, among equals, the leftmost position.
        """
        n = len(piece)
        token = [self.single[b] for b in piece]
        if n < 2:
            return token
        ranks, name, none = self.ranks.get, self.bytes_of, _NONE
        shift = (n - 1).bit_length()
        width = 1 << shift
        level = [none if (r := ranks(piece[i:i + 2])) is None else r << shift | i for i in range(n - 1)]
        level += [none] * (width - n + 1)
        levels = [level]
        while len(level) > 1:
            level = list(map(min, level[::2], level[1::2]))
            levels.append(level)
        tree = [none]
        for level in reversed(levels):
            tree += level
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        low = width - 1
        while (top := tree[1]) < none:
            pos = top & low
            rank = top >> shift
            right = after[pos]
            end = after[pos] = after[right]
            token[pos] = rank
            token[right] = -1
            tree[width + right] = tree[width + pos] = none
            if end < n:
                before[end] = pos
                r = ranks(name[rank] + name[token[end]])
                if r is not None:
                    tree[width + pos] = r << shift | pos
            a = b = (width + pos) >> 1
            c = (width + right) >> 1
            prev = before[pos]
            if prev >= 0:
                r = ranks(name[token[prev]] + name[rank])
                tree[width + prev] = none if r is None else r << shift | prev
                a = (width + prev) >> 1
            # The three paths to the root join on the way; a shared node is computed once a level.
            while b:
                x, y = tree[2 * b], tree[2 * b + 1]
                tree[b] = x if x < y else y
                if c != b:
                    x, y = tree[2 * c], tree[2 * c + 1]
                    tree[c] = x if x < y else y
                if a != b:
                    x, y = tree[2 * a], tree[2 * a + 1]
                    tree[a] = x if x < y else y
                a >>= 1
                b >>= 1
                c >>= 1
        return [t for t in token if t >= 0]

    def _forget(self) -> None:
        """Empty the table of pieces: piece -> its number; the ids of all one after another, first and count by number."""
        self.kept: dict[str, int] = {}
        self.kept_ids = np.empty(0, np.int32)
        self.kept_first, self.kept_size = np.empty(0, np.int64), np.empty(0, np.int64)

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces one after another, and how many each has; those met before are looked up."""
        if len(self.kept) > KEPT_PIECES:
            self._forget()
        kept = self.kept
        new = list(set(pieces).difference(kept))
        if new:
            raw = list(map(str.encode, new))
            rank = np.fromiter(map(self.ranks.get, raw, repeat(-1)), np.int64, len(raw))
            hard = np.flatnonzero(rank < 0)
            ids, count = self._merge_flat([raw[i] for i in hard.tolist()])
            size = np.ones(len(new), np.int64)
            size[hard] = count
            first = np.cumsum(size) - size
            own = np.empty(size.sum(), np.int32)
            own[first] = rank
            own[_runs(first[hard], count)] = ids
            kept.update(zip(new, range(len(kept), len(kept) + len(new))))
            self.kept_first = np.concatenate([self.kept_first, first + len(self.kept_ids)])
            self.kept_size = np.concatenate([self.kept_size, size])
            self.kept_ids = np.concatenate([self.kept_ids, own])
        at = np.fromiter(map(kept.__getitem__, pieces), np.int64, len(pieces))
        size = self.kept_size[at]
        return self.kept_ids[_runs(self.kept_first[at], size)], size

    def _lots(self, texts: list[str | None]):
        """Pieces of whole texts, about ``LOT_PIECES`` at a time, with (text, pieces of it) in order."""
        pieces, whose = [], []
        for i, t in enumerate(texts):
            found = self.pattern.finditer(t) if t and len(t) > LOT_PIECES else None
            if found is None:
                got = self.pattern.findall(t) if t else []
                pieces += got
                whose.append((i, len(got)))
            else:  # a long text in several lots
                while got := [m[0] for m in islice(found, LOT_PIECES)]:
                    yield [*pieces, *got], [*whose, (i, len(got))]
                    pieces, whose = [], []
            if len(pieces) >= LOT_PIECES:
                yield pieces, whose
                pieces, whose = [], []
        if pieces:
            yield pieces, whose

    def encode_flat(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of whole texts one after another, and the n + 1 offsets; NULL counts as empty.

        Pieces are handled in lots, across texts and within a long one, so memory beyond the texts
        and their ids doesn't grow with them.
        """
        count, parts = np.zeros(len(texts) + 1, np.int64), []
        for pieces, whose in self._lots(texts):
            ids, size = self._ids_of(pieces)
            upto = np.concatenate([[0], np.cumsum(size)])
            parts.append(ids)
            at = 0
            for i, n in whose:
                count[i + 1] += upto[at + n] - upto[at]
                at += n
        return np.concatenate(parts) if parts else np.empty(0, np.int32), np.cumsum(count)

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of whole texts, without special tokens; NULL counts as empty."""
        flat, off = self.encode_flat(texts)
        return [flat[a:b].tolist() for a, b in zip(off[:-1].tolist(), off[1:].tolist())]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def coder(path: str | None = None, pattern: str | None = None) -> ByteBpe:
    """Encoder of a vocabulary file, built once per worker."""
    import public_tokenizers
    return held("byte_bpe", (path, pattern), lambda: ByteBpe(
        read_ranks(path or vocabulary_path()), pattern or public_tokenizers.PATTERN))


def _runs(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first, first + 1, ... (size of them) for each pair, one after another."""
    return np.repeat(first - (np.cumsum(size) - size), size) + np.arange(size.sum())


def _slices(batches, at: int):
    """The same rows in order, in batches whose texts have about ``SLICE_BYTES`` at most: their ids and lists are many times their size."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(at)), 0).to_numpy(zero_copy_only=False)
        lot = np.cumsum(size, dtype=np.int64) // SLICE_BYTES
        cut = [0, *(np.flatnonzero(np.diff(lot)) + 1).tolist(), b.num_rows]
        for x, y in zip(cut, cut[1:]):
            yield b.slice(x, y - x)


def _encode(at: int, path, pattern, decoded: bool):
    def run(batches):
        bpe = coder(path, pattern)
        for b in _slices(batches, at):
            flat, off = bpe.encode_flat(b.column(at).to_pylist())
            new = [pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(flat))]
            if decoded:
                new.append(pa.array([bpe.decode(flat[x:y].tolist()) for x, y in zip(off[:-1].tolist(), off[1:].tolist())],
                                    pa.binary()))
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), *new],
                                             names=[*(n for i, n in enumerate(b.schema.names) if i != at),
                                                    *["ids", "decoded"][:len(new)]])
    return run


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, decoded: bool = False) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, ids array<int>`` (and ``decoded binary``: the ids read back).

    Each row is encoded on its own, whole; NULL and empty texts give an empty array. Repeated rows
    and NULL ids stay; extra columns are ignored. ``path`` names a vocabulary
    file that every executor can read; it defaults to the installed public one.
    """
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string")])
    return d.mapInArrow(lean(_encode(1, path, pattern, decoded)),
                        "doc_id bigint, ids array<int>" + ", decoded binary" * decoded)


def _decode(path, pattern):
    def run(batches):
        bpe = coder(path, pattern)
        for b in batches:
            out = [None if x is None else bpe.decode(x) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.binary())], names=["doc_id", "decoded"])
    return run


def decode(encoded: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``(doc_id, ids)`` -> ``(doc_id, decoded binary)``; NULL ids give NULL, an unknown id fails."""
    prepare(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(lean(_decode(path, pattern)), "doc_id bigint, decoded binary")


def digest(encoded: DataFrame) -> DataFrame:
    """Per document: number of ids, digests of the ids and of the decoded bytes."""
    return encoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
