"""Fill-in-middle, filter audit and source mixing against plain Python on small tables."""

import hashlib
import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from faultline.llm import filter_audit, fim, mixing

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SPACE = "[\x20\x09-\x0D]+"
DOCS = "doc_id bigint, text string, lang string, source string, size int, output string, part string, mask string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return [w for w in re.split(SPACE, text or "") if w]


def table(spark, rows):
    """Rows (id, text, lang, source) with columns whose names clash with the operators' own."""
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], DOCS)


TEXTS = [None, "", " ", "\n\t ", "a", " a", "a ", "one two  three\n", "héllo wörld ẞ 日本語 text x", "<P> is a mark", "a<S", ">b <", "P> <M",
         "x <M> y", "<P", "\x0bone\x1f two\x0c", "<<<<", "a\0b c", "😀 😀😀 end"]


def fim_plain(doc_id, text):
    t = text or ""
    h = sha(f"42:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in range(0, 32, 8))
    u = UNIT.findall(t)
    n = len(u)
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return (doc_id, n, "plain", None, None, sha(t), sha(t))
    if h4 % 100 < 80:
        return (doc_id, n, "spm", len(p), len(m), sha(f"<S>{s}<P>{p}<M>{m}"), sha(t))
    return (doc_id, n, "psm", len(p), len(m), sha(f"<P>{p}<S>{s}<M>{m}"), sha(t))


def key(rows):
    return sorted(map(repr, rows))


def test_fill_in_middle_equals_plain_python(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.choice(TEXTS) if i % 3 else " ".join(rnd.choice(["ab", "é", "<S", "P>", "日本", "\n"]) for _ in range(i)),
             "en", "s") for i in range(400)]
    rows += [(None, "no id at all here", "en", "s"), (None, None, None, None), (7, rows[7][1], "en", "s"),
             (9001, "long " * 700_000 + "tail", "en", "s"), (9002, "é" * 1_500_000, "en", "s"), (-5, "minus five words of text", "de", "s")]
    got = fim.digest(fim.restore(fim.fill_in_middle(table(spark, rows)))).collect()
    assert key(map(tuple, got)) == key(fim_plain(r[0], r[1]) for r in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_fill_in_middle_windows_and_empty_table(spark, monkeypatch):
    monkeypatch.setattr(fim, "WINDOW", 3)
    import numpy as np
    texts = [t.encode() if t else b"" for t in TEXTS] * 3
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    raw = np.frombuffer(b"".join(texts), np.uint8)
    draw = [np.random.default_rng(i).integers(0, 1 << 32, len(texts)) for i in range(4)]
    _, form, _, _, out, out_off = fim.cut_batch(raw, off, draw, 100, 50)
    back, back_off = fim.uncut_batch(out, out_off, form)
    assert back.tobytes() == raw.tobytes() and back_off.tolist() == off.tolist()
    assert fim.restore(fim.fill_in_middle(table(spark, []))).count() == 0
    with pytest.raises(ValueError):
        fim.uncut_batch(raw, off, np.full(len(texts), fim.PSM))


def fails(rows, i):
    doc_id, text = rows[i][0], rows[i][1] or ""
    w = words(text)
    return {name for name, bad in (
        ("A", len(w) < 200), ("B", 100 * len(set(w)) < 50 * len(w)),
        ("C", 100 * len(re.findall("[A-Z]", text)) > 3 * len(text)), ("D", bool(re.search(r"[#$%&*|]", text))),
        ("E", doc_id is not None and any(r[0] is not None and r[0] < doc_id and (r[1] or "") == text for r in rows))) if bad}


def audit_plain(rows, labels):
    good = {d for d, q, _ in labels if q == 1}
    toxic = {d for d, _, t in labels if t == 1}
    bad = [fails(rows, i) for i in range(len(rows))]
    out, removed_by = [], {}
    for part in {r[2] or "" for r in rows}:
        own = [i for i, r in enumerate(rows) if (r[2] or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [i for i in left if f in bad[i]]
                kept = [i for i in left if f not in bad[i]]
                removed_by[part, f] = removed_by.get((part, f), 0) + len(gone)
                out.append((part, "".join(order), step, len(kept), len(gone),
                            sum(f in bad[i] for i in own) - len(gone), sum(bad[i] == {f} for i in own),
                            sum(rows[i][0] in good for i in gone), sum(rows[i][0] in toxic for i in gone)))
                left = kept
    return [(*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out]


def test_filter_audit_equals_running_every_order(spark):
    rnd = random.Random(8)
    long = [" ".join(rnd.choice("abcdefghij") + str(rnd.randint(0, k)) for _ in range(rnd.choice((199, 200, 230)))) for k in (2, 30, 400)]
    pool = [*long, long[0] + " #", long[2].upper(), long[2] + " Ünïcode ÀÉ", "short", None, "", "AB ab", *TEXTS[7:9]]
    rows = [(i, rnd.choice(pool), rnd.choice(["en", "de", None, ""]), "s") for i in range(160)]
    rows += [(None, long[2], "en", "s")] * 2 + [(3, rows[3][1], "de", "s"), (3, rows[3][1], rows[3][2], "s"), (3, long[1], "en", "s"), (-1, long[2], "xx", None)]
    labels = [(i, i % 3, i % 2) for i in range(0, 170, 2)] + [(4, 1, None), (None, 1, 1), (6, None, 1)]
    known = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    got = filter_audit.audit(filter_audit.failure_cells(table(spark, rows), known)).collect()
    assert key(map(tuple, got)) == key(audit_plain(rows, labels))
    empty = spark.createDataFrame([], known.schema)
    assert filter_audit.audit(filter_audit.failure_cells(table(spark, []), empty)).count() == 0
    assert filter_audit.audit(filter_audit.failure_cells(table(spark, rows), empty)).agg(F.sum("good_lost")).first()[0] == 0


def test_words_across_pieces(monkeypatch):
    monkeypatch.setattr(filter_audit, "PIECE", 7)
    rnd = random.Random(2)
    for _ in range(200):
        text = "".join(rnd.choice("ab \n\té") for _ in range(rnd.randint(0, 80))).encode()
        assert filter_audit.word_counts(text) == (len(text.split()), len(set(text.split())))
    long = b"x" * 20_000 + b" y " + b"x" * 20_000
    assert filter_audit.word_counts(long) == (3, 2)


def targets_plain(sizes, epochs=3):
    """Rounds of resharing, as stated, in fractions."""
    from fractions import Fraction
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(epochs * sizes[s] for s in capped)
        target = {s: Fraction(left * weight[s], sum(weight[x] for x in free)) for s in free}
        over = {s for s in free if target[s] > epochs * sizes[s]}
        if not over:
            return target | {s: Fraction(epochs * sizes[s]) for s in capped}
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_mixture_meets_its_targets(spark, seed):
    rnd = random.Random(seed)
    names = ["a", "b", "Z", "é", "￿", "😀", "", None, "src10", "src2"][:rnd.randint(1, 10)]
    rows = []
    for i in range(600):
        s = names[0] if rnd.random() < 0.4 else rnd.choice(names)
        rows.append((i, rnd.choice(TEXTS) if rnd.random() < 0.2 else "w " * rnd.randint(0, 60), "en", s))
    rows += [(None, "no id", "en", names[0])] * 3 + [(5, "same row again", "en", names[0])] * 40
    docs = table(spark, rows)
    got = mixing.mixture(docs).collect()
    assert sorted((repr(r.doc_id), r.size) for r in got) == sorted((repr(r[0]), len(words(r[1]))) for r in rows)
    sizes, largest, taken = {}, {}, {}
    for i, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
        largest[s] = max(largest.get(s, 0), len(words(t)))
    want = targets_plain(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]))
        assert r.taken == r.copies * r.size <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    again = mixing.mixture(docs.repartition(7)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mixture_edges(spark):
    assert mixing.mixture(table(spark, [])).count() == 0
    none = mixing.mixture(table(spark, [(1, None, "en", "a"), (2, " ", "en", None)])).collect()
    assert [(r.size, r.target, r.taken) for r in none] == [(0, 0.0, 0)] * 2
    rows = [(i, "two words", "en", "a" if i else "b") for i in range(50)]
    mix = mixing.mixture(table(spark, rows), keep=("doc_id", "text", "size"))
    copies = {r.doc_id: r.copies for r in mix.collect()}
    out = mixing.repeated(mix)
    assert out.columns == ["doc_id", "text", "size", "epoch"]
    assert {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()} == {k: v for k, v in copies.items() if v}
    share = mixing.mixture(table(spark, rows), share=10.0).collect()  # more than all sources can give
    assert all(r.copies == 3 for r in share)


def test_water_fill_survives_many_sources(spark):
    s = spark.range(3000).selectExpr("cast(id as string) source", "id * id % 997 size", "element_at(array(5,2,1), cast(id % 3 as int) + 1) weight")
    got = mixing.water_fill(s).collect()
    total = sum(r.size for r in got)
    assert sum(r.target for r in got) == pytest.approx(total)
    free = {round(r.target / r.weight, 6) for r in got if r.target < 3 * r.size}
    assert len(free) == 1 and all(r.target <= 3 * r.size for r in got)
    level = free.pop()
    assert all(3 * r.size <= level * r.weight + 1e-6 for r in got if r.target == 3 * r.size)
