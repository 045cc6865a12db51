"""N-gram join, components, vector near-duplicates against brute force."""

import random

import numpy as np
import pytest

from faultline.llm.components import components
from faultline.llm.embed_dedup import cosine_components
from faultline.llm.ngram_join import jaccard_components

SCHEMA = "doc_id bigint, text string, node string, component_id int"


def closure(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w)} if 0 < len(w) < 5 else {tuple(w[i:i + 5]) for i in range(len(w) - 4)}


def test_components_of_chains_and_cliques(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 130)] + [(7, 7), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def corpus():
    rnd = random.Random(3)
    word = lambda: rnd.choice("abcdefgh") + rnd.choice("xyz") + str(rnd.randint(0, 400))
    common = " ".join(word() for _ in range(60))
    docs = []
    for _ in range(40):
        base = [word() for _ in range(rnd.randint(3, 120))]
        for _ in range(rnd.choice((1, 1, 2, 6))):
            w = list(base)
            for _ in range(rnd.choice((0, 0, 1, 2, 4))):
                w[rnd.randrange(len(w))] = word()
            docs.append(" ".join(w))
    big = [word() for _ in range(100)]
    for _ in range(60):  # a large group of near copies, at and around the threshold
        w = list(big)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = word()
        docs.append(" ".join(w))
    for _ in range(30):  # texts made mostly of one passage
        docs.append(common + " " + " ".join(word() for _ in range(rnd.randint(5, 40))))
    docs += ["", None, "  \n\t", "one", "ONE", "one two three four", "one two three four five", "\x0bone\x1f two",
             "long " * 30000, "long " * 29000 + "end"]
    rnd.shuffle(docs)
    return [(3 * i + 1, t, "x", 0) for i, t in enumerate(docs)]


def test_ngram_join_is_exact(spark):
    rows = corpus()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()}
    sets = {i: shingles(t) for i, t, *_ in rows}
    ids = sorted(sets)
    links = []
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            o = len(sets[a] & sets[b])
            if o and 100 * o >= 75 * (len(sets[a]) + len(sets[b]) - o):
                links.append((a, b))
    want = closure(ids, links)
    assert len(links) > 200
    assert got == {i: (len(sets[i]), want[i]) for i in ids}


def test_ngram_join_edge_rows(spark):
    rows = [(None, "a b c d e f", "x", 1), (5, "a b c d e f", "x", 1), (5, "a b c d e f", "x", 1), (2, "A B C D E F", None, None),
            (9, None, None, None)]
    got = sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, SCHEMA)).collect()), key=str)
    assert got == sorted([(None, 2, None), (5, 2, 2), (5, 2, 2), (2, 2, 2), (9, 0, 9)], key=str)
    assert jaccard_components(spark.createDataFrame([], SCHEMA)).count() == 0


def vectors(n=600, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dim))
    for i in range(0, n, 4):
        x[i + 1] = x[i] + rng.normal(size=dim) * rng.uniform(0.05, 0.7)
    x[7] = x[3]
    x[8:60] = x[7] + rng.normal(size=(52, dim)) * 0.1
    return x


@pytest.mark.parametrize("z,cells", [(None, 9), (None, 1), (5.0, 12)])
def test_vectors_against_all_pairs(spark, z, cells):
    x = vectors()
    rows = [(int(2 * i + 5), v.tolist(), 1, "home") for i, v in enumerate(x)]
    bad = [(1, None), (2, []), (3, [0.0] * 16), (4, [1.0] * 15 + [None]), (6, [float("nan")] + [1.0] * 15),
           (8, [float("inf")] + [1.0] * 15), (None, x[7].tolist()), (5001, [1.0, 0.0]), (5003, [2.0, 0.0])]
    df = spark.createDataFrame(rows + [(i, v, 0, None) for i, v in bad], "vec_id bigint, embedding array<double>, copies int, home string")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in cosine_components(df, z=z, cells=cells).collect()}
    u = x / np.linalg.norm(x, axis=1)[:, None]
    link = u @ u.T >= 0.9
    np.fill_diagonal(link, False)
    ids = [2 * i + 5 for i in range(len(x))]
    comp = closure(ids, [(ids[a], ids[b]) for a, b in np.argwhere(link)])
    want = {i: (int(link[k].sum()), comp[i], comp[i] == i) for k, i in enumerate(ids)}
    assert {i: got[i] for i in ids} == want
    assert [got[i] for i in (1, 2, 3, 4, 6, 8)] == [(0, i, True) for i in (1, 2, 3, 4, 6, 8)]
    assert got[None] == (0, None, True) and got[5001] == (1, 5001, True) and got[5003] == (1, 5001, False)


def test_no_vectors(spark):
    assert cosine_components(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0
