"""KNN operators against a plain numpy brute force of the documented rules."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.operators import clean
from faultline.operators.knn import knn_classify_component, knn_impute

SF01 = "/root/testdata/sf0.01"


def _nan_dist(a, b):
    ok = ~np.isnan(a) & ~np.isnan(b)
    if not ok.any():
        return np.nan
    return np.sqrt(len(a) / ok.sum() * ((a[ok] - b[ok]) ** 2).sum())


def brute_impute(pdf, cols, ids, k=5, scale=True):
    x = pdf[cols].to_numpy(float)
    z = x.copy()
    if scale:
        m, s = np.nanmean(x, axis=0), np.nanstd(x, axis=0)
        s[s == 0] = 1
        z = (x - m) / s
    out = x.copy()
    for i in np.nonzero(np.isnan(x).any(axis=1))[0]:
        for j in np.nonzero(np.isnan(x[i]))[0]:
            donors = [d for d in range(len(x)) if not np.isnan(x[d, j])]
            if not donors:
                continue
            ds = [(np.round(_nan_dist(z[i], z[d]), 9), ids[d], d) for d in donors]
            ds = sorted([t for t in ds if not np.isnan(t[0])])[:k]
            out[i, j] = np.mean([x[d, j] for _, _, d in ds]) if ds else np.nanmean(x[:, j])
    return out


def test_impute_matches_brute_force_on_maintenance_fixture(spark):
    m = role_view(spark, SF01, "maintenance").filter(F.col("l_partkey") < 40)  # small fixture
    m = m.withColumn("row_id", F.xxhash64("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"))
    df = clean.sanitize_physical(m)
    cols = ["temperature_c", "vibration_level_mm_per_s", "load_percentage", "operating_hours"]
    pdf = df.toPandas()
    want = brute_impute(pdf, cols, pdf["row_id"].to_numpy())
    got = knn_impute(df, id_col="row_id", block_rows=200).toPandas().set_index("row_id").loc[pdf["row_id"]]
    np.testing.assert_allclose(got[cols].to_numpy(float), want, rtol=1e-9, atol=1e-9)
    assert not np.isnan(got[cols].to_numpy(float)).any()


def test_impute_fallback_and_untouched(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, 5.0), (3, 3.0, 7.0), (4, None, None)],
                               "seq long, temperature_c double, load_percentage double")
    out = {r.seq: (r.temperature_c, r.load_percentage) for r in knn_impute(df, k=5).collect()}
    assert out[3] == (3.0, 7.0)
    # a donor sharing no present coordinate has no distance and is not used;
    # a row with no usable donor at all gets the column mean
    assert out[2][0] == 3.0 and out[1][1] == 7.0 and out[4] == (2.0, 6.0)


def test_component_vote_ties_and_brute_force(spark):
    rows = [(1, 0.0, "comp2", None), (2, 0.1, "comp1", None), (3, 5.0, "comp3", None), (4, 0.05, None, "e1"),
            (5, 5.1, None, None), (6, 4.9, None, "e2")]
    df = spark.createDataFrame(rows, "seq long, volt double, comp_failure string, errorid string")
    out = {r.seq: (r.comp_failure, r.failed) for r in knn_classify_component(df, k=2).collect()}
    assert out[4] == ("comp1", 1)  # comp2 and comp1 each one vote -> smaller name
    assert out[6] == ("comp3", 1) or out[6] == ("comp1", 1)
    assert out[5] == (None, 0) and out[1] == ("comp2", 1)
    k3 = {r.seq: r.comp_failure for r in knn_classify_component(df, k=3).collect()}
    # brute force: scaled 1-d distances, 3 nearest, majority then smallest name
    x = np.array([0.0, 0.1, 5.0, 0.05, 5.1, 4.9])
    z = (x - x.mean()) / x.std()
    labels = {0: "comp2", 1: "comp1", 2: "comp3"}
    for t in (3, 5):
        near = sorted(range(3), key=lambda d: (round(abs(z[t] - z[d]), 9), d + 1))[:3]
        votes = pd.Series([labels[d] for d in near]).value_counts()
        best = sorted(votes[votes == votes.max()].index)[0]
        assert k3[t + 1] == best


ONE_CELL = 1 << 20  # all donors of a pattern in one cell: plain search


def test_cells_equal_plain_search_on_random_data_with_gaps(spark):
    rng = np.random.default_rng(11)
    n = 900
    x = rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2]
    x[rng.random((n, 3)) < 0.15] = np.nan
    x[:40, 0] = 2.0  # a hot value
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "seq long, temperature_c double, load_percentage double, operating_hours double")
    a = knn_impute(df, block_rows=8).orderBy("seq").toPandas()
    b = knn_impute(df, block_rows=ONE_CELL).orderBy("seq").toPandas()
    np.testing.assert_allclose(a.drop(columns="seq").to_numpy(float), b.drop(columns="seq").to_numpy(float))
    want = brute_impute(df.toPandas(), ["temperature_c", "load_percentage", "operating_hours"],
                        np.arange(n))
    np.testing.assert_allclose(a.drop(columns="seq").to_numpy(float), want, rtol=1e-9, atol=1e-9)


def test_vote_over_cells_equals_plain_search(spark):
    rng = np.random.default_rng(5)
    n = 700
    rows = []
    for i in range(n):
        v = rng.normal(size=3)
        lab = None if i % 3 == 0 else f"comp{int(abs(v[0]) * 2) % 4 + 1}"
        err = "e1" if lab is None and i % 2 == 0 else None
        rows.append((i, float(v[0]), float(v[1] * 3), float(v[2]), lab, err))
    df = spark.createDataFrame(rows, "seq long, volt double, rotate double, pressure double, "
                                     "comp_failure string, errorid string")
    a = knn_classify_component(df, block_rows=8).orderBy("seq").collect()
    b = knn_classify_component(df, block_rows=ONE_CELL).orderBy("seq").collect()
    assert a == b
    assert sum(r.comp_failure is None for r in a) == sum(1 for r in rows if r[4] is None and r[5] is None)


def test_repeated_and_missing_ids_keep_every_row(spark):
    df = spark.createDataFrame([(7, None, 5.0), (7, 2.0, 5.0), (7, None, 5.0)], "seq long, temperature_c double, load_percentage double")
    got = knn_impute(df, k=1).collect()
    assert len(got) == 3 and [r.temperature_c for r in got] == [2.0] * 3
    no_id = df.withColumn("seq", F.lit(None).cast("long"))
    assert sorted(r.temperature_c for r in knn_impute(no_id, k=1).collect()) == [2.0] * 3
    keyed = spark.createDataFrame([(1, "b", None, 1.0), (1, "a", 4.0, 1.0), (0, "z", 8.0, 1.0)],
                                  "k1 int, k2 string, temperature_c double, load_percentage double")
    assert knn_impute(keyed, k=1, id_col=["k1", "k2"]).where("k2 = 'b'").first().temperature_c == 8.0  # the first key wins the tie
    votes = spark.createDataFrame([(1, 0.0, "c1", None), (1, 0.0, None, "e"), (1, 0.0, None, "e"), (1, 5.0, "c2", None)],
                                  "seq long, volt double, comp_failure string, errorid string")
    assert sorted(r.comp_failure for r in knn_classify_component(votes, k=1).collect()) == ["c1", "c1", "c1", "c2"]


def test_columns_never_present_together_over_several_levels(spark, monkeypatch):
    """No donor has both lacking columns, so bounds come from two groups; trees are several levels deep."""
    from faultline.operators import knn_cells
    monkeypatch.setattr(knn_cells, "LEVEL_BITS", 2)
    monkeypatch.setattr(knn_cells, "UNEVEN", 2)
    rng = np.random.default_rng(3)
    n = 500
    age, hours = rng.integers(0, 60, n).astype(float), rng.normal(size=n) * 40
    kind = rng.integers(0, 3, n)  # temperature only, load only, neither
    rows = [(i, float(age[i]), float(hours[i]), float(rng.normal()) if kind[i] == 0 else None,
             float(rng.normal()) if kind[i] == 1 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "seq long, age double, operating_hours double, temperature_c double, load_percentage double")
    cols = ["temperature_c", "load_percentage", "operating_hours", "age"]
    pdf = df.toPandas()
    want = brute_impute(pdf, cols, pdf["seq"].to_numpy())
    got = knn_impute(df, columns=cols, categorical=(), block_rows=4).toPandas().set_index("seq").loc[pdf["seq"]]
    np.testing.assert_allclose(got[cols].to_numpy(float), want, rtol=1e-9, atol=1e-9)


def test_donors_are_sent_in_slices_and_used_tables_go(spark, monkeypatch):
    """Small slices and chunks give the brute-force values; no table of copies or visits stays behind, nor shuffle files."""
    import os
    from faultline.operators import knn_cells
    from faultline.session import checkpoint_root
    monkeypatch.setattr(knn_cells, "SLICE_DONORS", 1)
    monkeypatch.setattr(knn_cells, "CHUNK_DONORS", 64)
    monkeypatch.setattr(knn_cells, "BLOCK_BITS", 1)
    written = []
    write = knn_cells.materialize
    monkeypatch.setattr(knn_cells, "materialize", lambda df, name: written.append(name) or write(df, name))
    rng = np.random.default_rng(17)
    n = 400
    x = np.round(rng.normal(size=(n, 3)) * [1.0, 5.0, 0.2], 1)
    x[rng.random((n, 3)) < 0.2] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, "seq long, temperature_c double, load_percentage double, operating_hours double")
    stages = os.path.join(checkpoint_root(spark), "stages")
    before = set(os.listdir(stages)) if os.path.isdir(stages) else set()
    got = knn_impute(df, block_rows=8).orderBy("seq").toPandas()
    cols = ["temperature_c", "load_percentage", "operating_hours"]
    np.testing.assert_allclose(got[cols].to_numpy(float), brute_impute(df.toPandas(), cols, np.arange(n)), rtol=1e-9, atol=1e-9)
    assert written.count("knn-found") > 1
    left = {p.rsplit("-", 1)[0] for p in set(os.listdir(stages)) - before}
    assert "knn-found" in left and not left & {"knn-cells", "knn-placed", "knn-bounds", "knn-visits"}


def test_written_tables_leave_no_shuffle_files(spark):
    from faultline.session import materialize
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {b for b in (str(x) for x in disk.getAllFiles().mkString("\n").split("\n")) if "shuffle_" in b}
    before = shuffles()
    table = materialize(spark.range(1000).selectExpr("id % 7 as k").groupBy("k").count(), "t")
    assert not shuffles() - before and table.count() == 7


def test_search_keeps_only_what_the_new_bound_leaves():
    from faultline.operators.knn_local import Group, Nearest
    x = np.arange(512.0)[:, None]
    near = Nearest(np.full((100, 1), np.inf), 5)
    near.search(np.linspace(0, 511, 100)[:, None], Group(x, np.arange(512) // 256, np.arange(512), [0]), 1)
    kept = sum(len(r) for r, _, _ in near.found[0])
    assert kept <= 100 * 12  # 100 x 256 and more when whole first cells were kept
    r, d, v = near.take(0, np.arange(512))
    want = np.sort(np.abs(np.linspace(0, 511, 100)[:, None] - x.T), axis=1)[:, :5]
    np.testing.assert_allclose(v.reshape(100, 5), want, atol=1e-8)


def test_equal_donors_are_one_row_and_cells_are_one_row_each(spark, monkeypatch):
    """Ten copies of each vector: written once with the k smallest ids; cells hold all donors, trees by batch and by row agree."""
    from faultline.operators import knn_cells
    monkeypatch.setattr(knn_cells, "LEVEL_BITS", 2)
    monkeypatch.setattr(knn_cells, "UNEVEN", 2)
    monkeypatch.setattr(knn_cells, "BLOCK_BITS", 1)
    written = []
    write = knn_cells.materialize

    def watched(df, name):
        out = write(df, name)
        written.append((name, out.count()))
        return out
    monkeypatch.setattr(knn_cells, "materialize", watched)
    rng = np.random.default_rng(23)
    x = np.round(rng.normal(size=(60, 3)) * [1.0, 5.0, 0.2], 2)
    x[:15, 0], x[10:20, 1] = np.nan, np.nan
    x = np.tile(x, (10, 1))
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r]) for i, r in enumerate(x[rng.permutation(len(x))])]
    df = spark.createDataFrame(rows, "seq long, temperature_c double, load_percentage double, operating_hours double")
    cols = ["temperature_c", "load_percentage", "operating_hours"]
    pdf = df.toPandas()
    want = brute_impute(pdf, cols, pdf["seq"].to_numpy())
    got = knn_impute(df, block_rows=4).orderBy("seq").toPandas()
    np.testing.assert_allclose(got[cols].to_numpy(float), want, rtol=1e-9, atol=1e-9)
    copies = max(n for name, n in written if name == "knn-cells")
    assert copies <= 60 * 6  # at most six (pattern, shared coordinates); five times as many when every id was a row
    assert 0 < dict(written)["knn-packed"] < copies
    monkeypatch.setattr(knn_cells, "TREES_BROADCAST", 0)  # as if there were too many trees to send to all tasks
    assert knn_impute(df, block_rows=4).orderBy("seq").toPandas()[cols].equals(got[cols])


def test_block_is_cut_into_even_cells_that_hold_all_donors():
    import pyarrow as pa
    from faultline.operators.knn_cells import _PATH_BITS, TIMES, _split
    from faultline.operators.knn_local import Group, Nearest
    rng = np.random.default_rng(29)
    n, block = 1000, (7 << _PATH_BITS) + 3
    x = np.round(rng.normal(size=(n, 2)), 1)
    ids = [sorted(rng.choice(10_000, int(m), replace=False).tolist()) for m in rng.integers(1, 6, n)]
    rows = pa.table({"_gid": pa.array([7] * n, pa.int32()), "_cell": [block] * n, "_c0": [(7 << _PATH_BITS) + 1] * n, "_ids": ids,
                     "_g0": x[:, 0], "_g1": pa.nulls(n, pa.float64()), "_g2": x[:, 1], "_r0": rng.normal(size=n)})
    split, _ = _split(["_g0", "_g1", "_g2"], ["_r0"], ["_c0"], 100)
    cells = split(rows).to_pandas()
    assert len(cells) == 16 and set(cells["_n"]) <= {62, 63} and cells["_cell"].is_unique and (cells["_blk"] == block).all()
    assert cells["_lo1"].isna().all() and cells["_lo0"].min() == x[:, 0].min() and cells["_hi2"].max() == x[:, 1].max()
    assert (cells["_has"] == 5).all() and (cells["_serves"] == 1).all()
    inside = np.insert(np.frombuffer(b"".join(cells["_x"])).reshape(-1, 2), 1, np.nan, axis=1)
    times = np.frombuffer(b"".join(cells["_times"]), TIMES).astype(np.int64)
    held = np.frombuffer(b"".join(cells["_ids"]), np.int64)
    assert sorted(held) == sorted(i for own in ids for i in own)
    near = Nearest(np.full((50, 1), np.inf), 5)
    t = np.c_[rng.normal(size=50), np.zeros(50), rng.normal(size=50)]
    near.search(t, Group(inside, np.repeat(cells["_cell"].to_numpy(), cells["_n"]), np.arange(n), [0], times), 3)
    r, d, v = near.take(0, held, times)
    each, owner = np.concatenate(ids), np.repeat(np.arange(n), [len(own) for own in ids])
    for i in range(50):
        dq = np.round(np.sqrt(((t[i, [0, 2]] - x[owner]) ** 2).sum(axis=1) * 3 / 2), 9)
        best = np.lexsort((each, dq))[:5]
        np.testing.assert_allclose(v[r == i], dq[best])
        assert held[d[r == i]].tolist() == each[best].tolist()
