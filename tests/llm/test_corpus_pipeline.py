"""The corpus pipeline's stages against plain versions of their decisions."""

import corpus_pipeline
from faultline.llm import decontam
from faultline.llm.common import read_table, stage
from test_pairs import closure, shingles


def test_stages(spark, sf):
    docs = read_table(spark, sf, "documents")
    at, seen = docs, {}
    for name, apply in corpus_pipeline.STAGES:
        out = stage(apply(spark, at, sf), "t")
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        seen[name] = ({r.doc_id: r for r in at.collect()}, {r.doc_id: r for r in out.collect()})
        at = out
    before, after = seen["n-gram Jaccard join"]
    sets = {i: shingles(r.text) for i, r in before.items()}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    assert links and set(after) == {i for i, c in closure(sorted(sets), links).items() if i == c}
    before, after = seen["benchmark decontamination"]
    items = [(r.item_id, (r.text or "").encode()) for r in read_table(spark, sf, "benchmark").collect()]
    windows = {tuple(w.split()) for _, t in items for w in decontam.windows_of(t)}
    for i, r in before.items():
        w = decontam.normalised(r.text.encode())
        hit = {k + x for k in range(len(w)) for n in {len(x) for x in windows} if tuple(w[k:k + n]) in windows for x in range(n)}
        assert (i in after) == (not (hit and 20 * len(hit) >= len(w)))
    before, after = seen["secret scan"]
    assert set(before) == set(after)
    assert all(after[i].text == r.text for i, r in before.items() if "token" not in r.text.lower())
    before, after = seen["byte-level BPE"]
    import hashlib
    assert all(after[i].decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest() for i, r in before.items())


def test_empty_and_odd_rows(spark, sf):
    schema = read_table(spark, sf, "documents").schema
    for rows in ([], [(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "the and of that", "en", None, 15)]):
        at = spark.createDataFrame(rows, schema)
        for _, apply in corpus_pipeline.STAGES:
            at = stage(apply(spark, at, sf), "t")
        assert at.count() == (1 if rows else 0)


def test_equal_rows_are_one_group_whatever_their_ids(spark, sf):
    schema = read_table(spark, sf, "documents").schema
    same, other = "one two three four five six seven", "a text of its own with more than five words"
    long = " ".join(f"w{i % 5000}" for i in range(300_000))
    rows = [(5, same, "en", "s", 1), (5, same, "en", "s", 1), (None, same, "en", "s", 1), (None, same, None, None, None), (4, same, "en", "t", 1),
            (6, other, "en", "s", 1), (None, None, "en", "s", None), (None, "", "en", "s", 0), (9, long, "en", "s", 1), (None, long + " end", "en", "s", 1)]
    got = corpus_pipeline.near_duplicates(spark, stage(spark.createDataFrame(rows, schema), "t"), sf)
    assert got.columns == schema.names
    kept = sorted(((r.doc_id, (r.text or "")[:9], r.source) for r in got.collect()), key=repr)
    assert kept == sorted([(4, same[:9], "t"), (6, other[:9], "s"), (None, "", "s"), (None, "", "s"), (9, long[:9], "s")], key=repr)
    for _, apply in corpus_pipeline.STAGES[2:]:
        assert apply(spark, stage(spark.createDataFrame(rows, schema), "t"), sf).count() == len(rows)
