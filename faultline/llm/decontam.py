"""Operator 4: benchmark contamination with one Aho-Corasick automaton.

Test texts are normalised to words and cut into windows of 13 consecutive
words (an item of fewer words is one window). All distinct windows go into one
automaton, built once per Python worker from a broadcast of the normalised
windows; each document is normalised and scanned once, whole. A match gives the
hit words, and their offsets in the original text.

The automaton's input is bounded: above ``MAX_AUTOMATON_CHARS`` of windows the
benchmark is dealt into several automata of that size, and the documents are
scanned once per automaton (every window is used, whatever the size).
"""

from __future__ import annotations

import hashlib

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.llm.common import held, prepare, same_or_new

WINDOW = 13
MAX_AUTOMATON_CHARS = 16_000_000

#: Bytes of words as they are, A-Z lower-cased, all others a blank: words are ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
_FOLD = bytes(
    b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 0x20
    for b in range(256)
)


def normalised(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def windows_of(text: bytes | None, size: int = WINDOW) -> list[bytes]:
    """Distinct windows, each as its words with a blank on either side."""
    w = normalised(text)
    if not w:
        return []
    return list(dict.fromkeys(b" " + b" ".join(w[i:i + size]) + b" " for i in range(max(1, len(w) - size + 1))))


def automata(items: list[tuple[int | None, bytes]], size: int = WINDOW, limit: int = MAX_AUTOMATON_CHARS):
    """Windows with the items they belong to, in lots of at most ``limit`` characters."""
    owners: dict[bytes, list] = {}
    for item, text in items:
        for w in windows_of(text, size):
            owners.setdefault(w, []).append(item)
    lots, chars = [[]], 0
    for w, own in owners.items():
        if chars + len(w) > limit and lots[-1]:
            lots.append([])
            chars = 0
        chars += len(w)
        lots[-1].append((w, sorted({o for o in own if o is not None})))
    return lots


def _build(lots) -> list:
    out = []
    for lot in lots:
        a = ahocorasick.Automaton()
        for w, own in lot:
            # latin-1 gives one character per byte, so positions are byte positions
            a.add_word(w.decode("latin-1"), (w.count(b" ") - 1, len(w), tuple(own)))
        a.make_automaton()
        out.append(a)
    return out


def scan(a, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
    """Hit word ranges (start, end) and the items found, for one document's words."""
    if not len(a) or not words:
        return [], set()
    line = " " + b" ".join(words).decode("latin-1") + " "
    ends, items, starts = [], set(), None
    for end, (n, length, own) in a.iter(line):
        if starts is None:
            starts = np.cumsum([1] + [len(w) + 1 for w in words])
        first = int(np.searchsorted(starts, end - length + 2))
        ends.append((first, first + n))
        items.update(own)
    return ends, items


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(ranges):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def original_spans(text: bytes, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character offsets in the original text of merged word ranges."""
    folded = np.frombuffer(b" " + text.translate(_FOLD) + b" ", np.uint8) != 0x20
    begin = np.flatnonzero(~folded[:-1] & folded[1:])
    end = np.flatnonzero(folded[:-1] & ~folded[1:])
    chars = np.cumsum(np.r_[0, (np.frombuffer(text, np.uint8) & 0xC0) != 0x80])
    return [(int(chars[begin[s]]), int(chars[end[e - 1]])) for s, e in ranges]


_SCHEMA = pa.schema([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.int64())),
                     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
_SQL = "n_words bigint, n_hit bigint, items array<bigint>, spans array<struct<start:bigint,end:bigint>>"


def _scan_batches(shared, key: str, at: int):
    def run(batches):
        built = held("automata", key, lambda: _build(shared.value))
        for b in batches:
            rows = {f.name: [] for f in _SCHEMA}
            for text in b.column(at).to_pylist():
                words = normalised(text)
                ranges, items = [], set()
                for a in built:
                    r, i = scan(a, words)
                    ranges += r
                    items |= i
                hit = merged(ranges)
                rows["n_words"].append(len(words))
                rows["n_hit"].append(sum(e - s for s, e in hit))
                rows["items"].append(sorted(items, key=str))
                rows["spans"].append([{"start": s, "end": e} for s, e in original_spans(text, hit)] if hit else [])
            new = pa.RecordBatch.from_pydict(rows, schema=_SCHEMA)
            yield pa.RecordBatch.from_arrays([*(c for i, c in enumerate(b.columns) if i != at), *new.columns],
                                             names=[*(n for i, n in enumerate(b.schema.names) if i != at), *_SCHEMA.names])
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """``docs(doc_id, text)`` -> per row ``doc_id, n_words, n_hit, items, spans, contaminated``.

    ``items`` are the distinct item ids found, sorted as strings; ``spans`` the hit
    passages as character offsets of the original text. NULL, empty and
    wordless texts have no words and are clean. Benchmark rows without text are ignored; rows
    without an id still mark words. Repeated rows change nothing.
    ``contaminated``: n_hit > 0 and 20 n_hit >= n_words.
    """
    return _marked(same_or_new(docs, [("doc_id", "bigint"), ("text", "binary")]), benchmark, size).select(
        "doc_id", "n_words", "n_hit", "items", "spans", "contaminated")


def _marked(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    spark = docs.sparkSession
    prepare(spark)
    # The benchmark is the query side: it is held by every worker, in lots of bounded size.
    items = [(r["item_id"], bytes(r["text"])) for r in same_or_new(
        benchmark, [("item_id", "bigint"), ("text", "binary")]).where("text is not null").distinct().collect()]
    lots = automata(sorted(items, key=lambda r: (r[0] is None, r[0] or 0, r[1])), size)
    shared = spark.sparkContext.broadcast(lots)
    key = hashlib.sha256(repr(lots).encode()).hexdigest()
    at = docs.columns.index("text")
    schema = ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in docs.schema if f.name != "text"), _SQL])
    return docs.mapInArrow(_scan_batches(shared, key, at), schema).withColumn(
        "contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def items_digest(items: str = "items"):
    """sha256 of the comma-joined ids, sorted as strings."""
    return F.sha2(F.array_join(F.array_sort(F.transform(items, lambda x: x.cast("string"))), ",").cast("binary"), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns unchanged.

    The columns are handed through Arrow beside a binary copy of the text, under names of
    their own, so extra columns may have any name.
    """
    names = docs.columns
    tagged = docs.toDF(*[f"c{i}" for i in range(len(names))])
    text = tagged.columns[[n.lower() for n in names].index("text")]
    tagged = tagged.withColumn("text", F.col(text).cast("binary"))
    kept = _marked(tagged, benchmark, size).where("not contaminated")
    return kept.select(*[F.col(f"c{i}").alias(n) for i, n in enumerate(names)])
