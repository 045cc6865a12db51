"""Regressions found in review: missing values, replay, bucket count, image names, loaders, package."""

import zipfile

import pytest
from pyspark.sql import functions as F

from faultline.functions.numeric import clip_keep_null, negative_to_null
from faultline.operators.clean import drop_exact_duplicates
from faultline.operators.events import lenient_reading
from faultline.operators.models import _stat
from faultline.sources import manifest, readers
from faultline.sources.images import read_images
from faultline.streaming.upsert import read_table, upsert_batch


def test_nan_is_missing(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("load_percentage,volt,name\nNaN,1.5,a\n120,NA,N/A\n-1,nan,b\n")
    rows = readers.load_table(spark, str(p)).collect()
    assert [(r.load_percentage, r.volt, r.name) for r in rows] == [(None, 1.5, "a"), (120.0, None, None), (-1.0, None, "b")]
    x = spark.createDataFrame([(float("nan"),), (-1.0,), (5.0,), (None,)], "x double")
    got = x.select(clip_keep_null("x", 0.0, 3.0).alias("a"), negative_to_null("x").alias("b")).collect()
    assert [tuple(r) for r in got] == [(None, None), (0.0, None), (3.0, 5.0), (None, None)]


def rows(spark, data):
    return spark.createDataFrame(data, "event_id string, value int, _seq long")


def test_replay_by_another_stream_into_the_same_table(spark, tmp_path):
    path = str(tmp_path / "t")
    for i in range(3):
        upsert_batch(rows(spark, [(f"k{j}", 10 * i + j, 100 * i + j) for j in range(i, i + 4)]), i, path)
    before = sorted(map(tuple, read_table(spark, path).select("event_id", "value").collect()))
    everything = [(f"k{j}", 10 * i + j, 100 * i + j) for i in range(3) for j in range(i, i + 4)]
    upsert_batch(rows(spark, [*everything, ("new", 7, 1)]), 0, path, stream="again")  # a new stream starts at batch 0
    after = sorted(map(tuple, read_table(spark, path).select("event_id", "value").collect()))
    assert after == sorted([*before, ("new", 7)])


def test_upper_case_images_are_read(spark, tmp_path):
    (tmp_path / "a.PNG").write_bytes(b"not an image")
    (tmp_path / "b.Jpg").write_bytes(b"not an image")
    assert read_images(spark, str(tmp_path)).count() == 2


def test_registered_loader_reaches_the_manifest(spark, tmp_path):
    (tmp_path / "x.mine").write_text("1")
    (tmp_path / "y.xls").write_text("1")
    readers.register_loader(".mine", lambda spark, path, schema=None: spark.read.text(path))
    try:
        got = {r["name"]: r["action"] for r in manifest.file_manifest(spark, str(tmp_path)).collect()}
    finally:
        del readers.LOADERS[".mine"]
    assert got == {"x.mine": "tabular", "y.xls": "unsupported"}


def test_package_is_shipped_whatever_the_shared_folder(monkeypatch):
    from faultline import session
    sent = []

    class Context:
        applicationId, master = "app-x", "spark://x:7077"

        def addPyFile(self, path):
            sent.append(path)

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: None)
    session.ship_package(Session())
    assert "faultline/session.py" in zipfile.ZipFile(sent[0]).namelist()
    Context.getConf = lambda self: {}
    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_small_rules(spark):
    x = spark.createDataFrame([("\t12abc\n",), (" \n",)], "s string")
    assert [r[0] for r in x.select(lenient_reading(F.col("s"))).collect()] == [12.0, 0.0]
    d = spark.createDataFrame([(1, 5, "a"), (2, 5, "a"), (3, 6, "a")], "seq int, v int, w string")
    assert sorted(map(tuple, drop_exact_duplicates(d, "seq").collect())) == [(1, 5, "a"), (3, 6, "a")]
    t = spark.createDataFrame([([[1.0], [None], [3.0]],), ([[None]],)], "ts array<array<double>>")
    assert [tuple(r) for r in t.select(_stat(F.col("ts"), 0, "mean"), _stat(F.col("ts"), 0, "std")).collect()] == [(2.0, 1.0 * (2 / 2) ** 0.5), (None, None)]
