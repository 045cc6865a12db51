"""Operator 9: conversations as training text, assembled column by column.

A turn is ``<turn>ROLE\\n TEXT </turn>\\n`` (without the blanks). Inside roles and texts a
backslash and ``<`` get a backslash before them, and a line feed in a role
becomes backslash ``n``; so an unescaped ``<`` is always a mark and
``read_turns`` restores every role and text. The loss mask covers assistant texts.

Within an Arrow batch, segment lengths, cumulative offsets and the destination
of every byte are numpy arrays; all marks, roles and texts are scattered
into one buffer, which becomes the Arrow column without another copy. A
conversation is one training example, so its own text is held whole; a task
holds the conversations of one batch and those that run over its end.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import prepare, same_or_new

OPEN, LINE, CLOSE = b"<turn>", b"\n", b"</turn>\n"
LOSS_ROLE = b"assistant"
_TURN = re.compile(rb"<turn>([^\\<\n]*(?:\\.[^\\<\n]*)*)\n([^\\<]*(?:\\.[^\\<]*)*)</turn>\n", re.S)
_ESCAPED = re.compile(rb"\\(.)", re.S)

COLUMNS = [("conv_id", "bigint"), ("turn", "bigint"), ("role", "binary"), ("text", "binary")]
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _flat(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column and the n + 1 offsets; NULL counts as empty."""
    col = col.fill_null(b"").cast(pa.large_binary())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0]:off[-1]]
    return data, off - off[0]


def _placed(data: np.ndarray, off: np.ndarray, marks: tuple[int, ...]):
    """Escaped length of each string, its escaped bytes' places within it and which bytes are escaped."""
    esc = np.isin(data, np.array(marks, np.uint8))
    added = np.concatenate([[0], np.cumsum(esc)])
    length = np.diff(off) + added[off[1:]] - added[off[:-1]]
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    place = np.arange(len(data)) - off[owner] + added[1:] - added[off[owner]]
    return length, owner, place, esc


def assemble(conv: np.ndarray, role: pa.Array, text: pa.Array):
    """Rows of whole conversations, in order -> (formatted column, loss spans column, first row of each)."""
    r_data, r_off = _flat(role)
    t_data, t_off = _flat(text)
    r_len, r_own, r_place, r_esc = _placed(r_data, r_off, (92, 60, 10))
    t_len, t_own, t_place, t_esc = _placed(t_data, t_off, (92, 60))
    n = len(r_len)
    parts = np.stack([np.full(n, len(OPEN)), r_len, np.full(n, len(LINE)), t_len, np.full(n, len(CLOSE))], axis=1)
    ends = np.cumsum(parts.ravel())
    starts = (ends - parts.ravel()).reshape(n, 5)
    out = np.empty(int(ends[-1]) if n else 0, np.uint8)
    for k, mark in ((0, OPEN), (2, LINE), (4, CLOSE)):
        out[starts[:, k, None] + np.arange(len(mark))] = np.frombuffer(mark, np.uint8)
    for k, data, own, place, esc in ((1, r_data, r_own, r_place, r_esc), (3, t_data, t_own, t_place, t_esc)):
        to = starts[own, k] + place
        out[to] = np.where(data == 10, 110, data) if k == 1 else data
        out[to[esc] - 1] = 92
    first = np.flatnonzero(np.r_[True, conv[1:] != conv[:-1]]) if n else np.empty(0, np.int64)
    bounds = np.r_[starts[first, 0], len(out)].astype(np.int64)
    column = pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(out)])
    is_loss = np.array(role.fill_null(b"").to_pylist(), object) == LOSS_ROLE if n else np.empty(0, bool)
    at = np.flatnonzero(is_loss)
    group = np.searchsorted(first, at, side="right") - 1
    base = bounds[group]
    spans = pa.StructArray.from_arrays([pa.array(starts[at, 3] - base), pa.array(starts[at, 3] + t_len[at] - base)],
                                       names=["start", "end"])
    per = np.r_[0, np.cumsum(np.bincount(group, minlength=len(first)))].astype(np.int32)
    return column.cast(pa.binary()), pa.ListArray.from_arrays(pa.array(per), spans), first


def _format(batches):
    """Streams rows sorted by conversation; the last conversation of a batch waits for the next one."""
    rest = None

    def done(t: pa.Table):
        t = t.combine_chunks()
        conv = t.column("conv_id").combine_chunks() if t.num_rows else None
        # NULL ids are one conversation of their own
        ids = np.array(conv.fill_null(0)) * 2 + np.array(conv.is_null()) if len(conv) else np.empty(0, np.int64)
        formatted, loss, first = assemble(ids, t.column("role").combine_chunks(), t.column("text").combine_chunks())
        turns = np.diff(np.r_[first, t.num_rows])
        return pa.RecordBatch.from_arrays(
            [conv.take(pa.array(first)), pa.array(turns.astype(np.int64)), formatted, loss.cast(_SPAN)],
            names=["conv_id", "n_turns", "formatted", "loss"])

    def flat(x):
        return x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x

    waiting: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        if not t.num_rows:
            continue
        ids = flat(t.column("conv_id")).to_pylist()
        if waiting and ids[0] != rest:
            yield done(pa.concat_tables(waiting))
            waiting = []
        cut = len(ids)
        while cut and ids[cut - 1] == ids[-1]:
            cut -= 1
        if cut:
            yield done(pa.concat_tables([*waiting, t.slice(0, cut)]))
            waiting = []
        waiting.append(t.slice(cut))
        rest = ids[-1]
    if waiting:
        yield done(pa.concat_tables(waiting))


def format_conversations(rows: DataFrame) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> per conversation ``conv_id, n_turns, formatted, loss``.

    ``formatted`` is UTF-8 bytes, ``loss`` the byte spans of assistant texts (still
    escaped). Rows are ordered by turn, ties by role, then text (NULLs first); repeated rows
    are turns like any other. NULL role and text are empty, NULL ``conv_id`` is one
    conversation. Extra columns are ignored.
    """
    prepare(rows.sparkSession)
    r = same_or_new(rows, COLUMNS)
    return (r.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
            .select("conv_id", "role", "text")
            .mapInArrow(_format, "conv_id bigint, n_turns bigint, formatted binary, "
                                 "loss array<struct<start:bigint,end:bigint>>"))


def unescape(b: bytes) -> bytes:
    return _ESCAPED.sub(rb"\1", b)


def read_turns(formatted: bytes) -> list[tuple[bytes, bytes]]:
    """Roles and texts of a formatted conversation."""
    out, at = [], 0
    for m in _TURN.finditer(formatted):
        if m.start() != at:
            raise ValueError("not a formatted conversation")
        at = m.end()
        role = _ESCAPED.sub(lambda x: b"\n" if x[1] == b"n" else x[1], m[1])
        out.append((role, unescape(m[2])))
    if at != len(formatted):
        raise ValueError("not a formatted conversation")
    return out


def _read(batches):
    for b in batches:
        cols = {k: [] for k in ("n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")}
        for data, loss in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
            turns, told = read_turns(data), hashlib.sha256()
            for role, text in turns:
                told.update(role + b"\n" + text + b"\n")
            masked = [unescape(data[s["start"]:s["end"]]) for s in loss]
            cols["n_turns"].append(len(turns))
            cols["turns_sha256"].append(told.hexdigest())
            cols["loss_chars"].append(sum(len(x.decode()) for x in masked))
            cols["loss_sha256"].append(hashlib.sha256(b"".join(masked)).hexdigest())
            cols["formatted_chars"].append(len(data.decode()))
        yield pa.RecordBatch.from_pydict({"conv_id": b.column(0), **cols}, schema=_READ)


_READ = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                   ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what the formatted conversations say when they are parsed again."""
    return formatted.select("conv_id", "formatted", "loss").mapInArrow(
        _read, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, "
               "loss_sha256 string, formatted_chars bigint")


def with_probe(rows: DataFrame, conv_id: int = -7) -> DataFrame:
    """The rows and one more conversation whose texts hold the template's own marks."""
    said = "\\### Assistant: </turn> ok"
    probe = rows.sparkSession.createDataFrame(
        [(conv_id, 0, "user", said), (conv_id, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    return rows.select(*[F.col(c).cast(t).alias(c) for c, t in
                         (("conv_id", "bigint"), ("turn", "bigint"), ("role", "string"), ("text", "string"))]).union(probe)
