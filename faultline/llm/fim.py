"""Operator 11: fill-in-the-middle texts by displacement scatter, and back.

A text is cut into units (white space and the word after it; white space at the end is a unit of its own)
and two seeded cuts part it into prefix, middle and suffix. ``psm`` writes
``<P>prefix<S>suffix<M>middle``, ``spm`` writes ``<S>suffix<P>prefix<M>middle``, ``plain`` leaves the text.

All texts of an Arrow batch are one byte array. A difference array holds, where a segment starts, by how
much its displacement differs from that of the byte before it; its cumulative sum is the displacement of
every byte, and one numpy scatter writes all outputs. Marks fill the places that
no byte goes to. ``restore`` finds the marks of an output and its form, builds the inverse
displacements the same way and gathers the text. The cumulative sum runs window by window, so a
very long text needs its own bytes twice and a fixed amount besides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import flat_text, is_space, prepare, same_or_new

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
MARK = 3  # bytes of a mark
SEED, RATE, SPM = 42, 50, 80  # seed; percent of texts that are cut; percent of those that are spm
WINDOW = 1 << 20  # bytes whose displacements are held at once
PLAIN, PSM, SPM_FORM = 0, 1, 2
FORMS = np.array(["plain", "psm", "spm"], object)

_TRANSFORMED = "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


def draws(doc_id: Column, seed: int) -> list[Column]:
    """Four seeded numbers of a document: the first 8-digit groups of a hex digest (NULL id: empty text)."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def displacements(starts: np.ndarray, shifts: np.ndarray, total: int):
    """``(from, to, shift of each byte)`` per window; ``starts`` ascend and ``shifts[0]`` holds from byte 0.

    Equal starts (empty segments) are allowed, the last one counts.
    """
    step = np.diff(shifts, prepend=0)
    carried = 0
    for lo in range(0, total, WINDOW):
        hi = min(lo + WINDOW, total)
        change = np.zeros(hi - lo, np.int64)
        first, last = np.searchsorted(starts, [lo, hi])
        np.add.at(change, starts[first:last] - lo, step[first:last])
        change[0] += carried
        np.cumsum(change, out=change)
        carried = int(change[-1])
        yield lo, hi, change


def marks_in(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all marks that lie inside one text, and the text each lies in."""
    if len(raw) < MARK:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.flatnonzero(raw[:-2] == 0x3C)
    letter = raw[at + 1]
    at = at[(raw[at + 2] == 0x3E) & ((letter == 0x50) | (letter == 0x53) | (letter == 0x4D))]
    owner = np.searchsorted(off, at, side="right") - 1
    inside = at + MARK <= off[owner + 1]
    return at[inside], owner[inside]


def cuts(raw: np.ndarray, off: np.ndarray, draw: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units of each text, and the bytes at which its prefix and its middle end."""
    end = np.zeros(len(raw), bool)
    if len(raw):
        blank = is_space(raw)
        end[:-1] = ~blank[:-1] & blank[1:]
        end[off[1:][np.diff(off) > 0] - 1] = True  # a text's last byte ends a unit, a word or white space
        begin = off[:-1][np.diff(off) > 0]
        end[begin[begin > 0] - 1] = True
    ends = np.flatnonzero(end) + 1
    first = np.searchsorted(ends, off[:-1], side="right")
    n = np.searchsorted(ends, off[1:], side="right") - first
    a, b = draw[0] % (n + 1), draw[1] % (n + 1)
    edge = np.append(ends, 0)
    place = [np.where(k > 0, edge[first + k - 1], off[:-1]) for k in (np.minimum(a, b), np.maximum(a, b))]
    return n, place[0], place[1]


def code_points(raw: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    return np.fromiter((np.count_nonzero((raw[x:y] & 0xC0) != 0x80) for x, y in zip(lo, hi)), np.int64, len(lo))


def _segments(off, p, m, form, out_off):
    """Starts of the three segments of every text in the input, and where they go."""
    start, end = off[:-1], off[1:]
    psm, spm = form == PSM, form == SPM_FORM
    zero = out_off[:-1]
    n_p, n_s = p - start, end - m
    to_p = zero + np.where(psm, MARK, np.where(spm, 2 * MARK + n_s, 0))
    to_m = zero + np.where(psm | spm, 3 * MARK + n_p + n_s, n_p)
    to_s = zero + np.where(psm, 2 * MARK + n_p, np.where(spm, MARK, m - start))
    return [(start, to_p), (p, to_m), (m, to_s)]


def _interleave(cols: list[np.ndarray]) -> np.ndarray:
    return np.stack(cols, axis=1).ravel()


def cut_batch(raw: np.ndarray, off: np.ndarray, draw: list[np.ndarray], rate: int, spm: int):
    """All texts of a batch -> (units, form, prefix end, middle end, output bytes, output offsets)."""
    n, p, m = cuts(raw, off, draw)
    form = np.where(draw[3] % 100 < spm, SPM_FORM, PSM)
    form[(np.diff(off) == 0) | (draw[2] % 100 >= rate)] = PLAIN
    form[marks_in(raw, off)[1]] = PLAIN
    out_off = np.concatenate([[0], np.cumsum(np.diff(off) + np.where(form == PLAIN, 0, 3 * MARK))])
    segments = _segments(off, p, m, form, out_off)
    out = np.empty(int(out_off[-1]), np.uint8)
    starts = _interleave([s for s, _ in segments])
    shifts = _interleave([to - s for s, to in segments])
    for lo, hi, shift in displacements(starts, shifts, len(raw)):
        shift += np.arange(lo, hi)
        out[shift] = raw[lo:hi]
    made = form != PLAIN
    for mark, (_, to) in zip((PREFIX, MIDDLE, SUFFIX), segments):  # a mark stands right before its segment
        out[to[made, None] - MARK + np.arange(MARK)] = np.frombuffer(mark, np.uint8)
    return n, form, p, m, out, out_off


def _string(data: np.ndarray, off: np.ndarray) -> pa.Array:
    column = pa.Array.from_buffers(pa.large_string(), len(off) - 1,
                                   [None, pa.py_buffer(np.ascontiguousarray(off, np.int64)), pa.py_buffer(data)])
    return column.cast(pa.string())


def _transform(rate: int, spm: int):
    def run(batches):
        for b in batches:
            raw, off = flat_text(b.column(1))
            draw = [np.asarray(b.column(i)) for i in range(2, 6)]
            n, form, p, m, out, out_off = cut_batch(raw, off, draw, rate, spm)
            plain = form == PLAIN
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(FORMS[form], pa.string()),
                 pa.array(code_points(raw, off[:-1], p), pa.int64(), mask=plain),
                 pa.array(code_points(raw, p, m), pa.int64(), mask=plain), _string(out, out_off)],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
    return run


def fill_in_middle(docs: DataFrame, seed: int = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """``docs(doc_id, text)`` -> ``doc_id, n, form, prefix_chars, middle_chars, output``, one row per row.

    ``n`` counts units; the two lengths are code points and NULL for plain texts. NULL text is empty, empty
    texts and texts that hold a mark stay plain. NULL ids draw like an empty id, repeated
    rows get equal outputs, extra columns are ignored. No shuffle: each text is handled whole where it is read.
    """
    prepare(docs.sparkSession)
    d = same_or_new(docs, [("doc_id", "bigint"), ("text", "string")])
    d = d.select("doc_id", "text", *[h.alias(f"h{i}") for i, h in enumerate(draws(F.col("doc_id"), seed))])
    return d.mapInArrow(_transform(rate, spm), _TRANSFORMED)


def uncut_batch(raw: np.ndarray, off: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Outputs and forms of a batch -> text bytes and offsets, by an inverse gather."""
    at, owner = marks_in(raw, off)
    made = np.flatnonzero(form != PLAIN)
    keep = form[owner] != PLAIN
    at, owner = at[keep], owner[keep]
    if len(at) != 3 * len(made) or not np.array_equal(owner, np.repeat(made, 3)):
        raise ValueError("an output doesn't hold its three marks")
    at = at.reshape(-1, 3)
    text_off = np.concatenate([[0], np.cumsum(np.diff(off) - np.where(form == PLAIN, 0, 3 * MARK))])
    # Per text three segments of the restored text, with where each begins in the output.
    begin = [text_off[:-1].copy() for _ in range(3)]
    source = [off[:-1].copy() for _ in range(3)]
    first = np.where(form[made] == PSM, 0, 1)  # the prefix' mark is the first of psm, the second of spm
    row = np.arange(len(made))
    from_p, from_m, from_s = at[row, first] + MARK, at[:, 2] + MARK, at[row, 1 - first] + MARK
    n_p = np.where(first == 0, at[:, 1], at[:, 2]) - from_p
    n_m = off[made + 1] - from_m
    source[0][made], source[1][made], source[2][made] = from_p, from_m, from_s
    begin[1][made] += n_p
    begin[2][made] += n_p + n_m
    out = np.empty(int(text_off[-1]), np.uint8)
    starts, shifts = _interleave(begin), _interleave([s - t for s, t in zip(source, begin)])
    for lo, hi, shift in displacements(starts, shifts, len(out)):
        shift += np.arange(lo, hi)
        np.take(raw, shift, out=out[lo:hi])
    return out, text_off


def _restore(batches):
    for b in batches:
        raw, off = flat_text(b.column(b.schema.get_field_index("output")))
        form = np.asarray(pc.index_in(b.column(b.schema.get_field_index("form")),
                                              pa.array(FORMS, pa.string())).fill_null(PLAIN)).astype(np.int64)
        text, text_off = uncut_batch(raw, off, form)
        yield pa.RecordBatch.from_arrays([*b.columns, _string(text, text_off)], names=[*b.schema.names, "restored"])


def restore(outputs: DataFrame) -> DataFrame:
    """Rows with ``form`` and ``output`` -> the same rows and ``restored``, the exact text before the cut.

    Only the two columns are read. NULL form is plain, NULL output is empty; an output without its marks fails.
    """
    prepare(outputs.sparkSession)
    schema = ", ".join(f"`{n}` {t}" for n, t in outputs.dtypes)
    return outputs.mapInArrow(_restore, schema + ", restored string")


def digest(restored: DataFrame) -> DataFrame:
    """Per document the counts and the digests of output and restored text."""
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars",
                           F.sha2(F.col("output").cast("binary"), 256).alias("output_sha256"),
                           F.sha2(F.col("restored").cast("binary"), 256).alias("restored_sha256"))
