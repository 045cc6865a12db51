import io
import os
import struct
import zipfile
import zlib

import pyarrow as pa
import pyarrow.feather as feather

from faultline.sources.archives import load_archive_tables
from faultline.sources.images import image_quality, letterbox_plan, outcome_counts, read_images
from faultline.sources.manifest import file_manifest, is_component_table
from faultline.sources.readers import load_table, register_loader, sniff_delimiter
from faultline.sources.sinks import load_scaler_params, save_params, write_ingested
from faultline.operators.features import fit_scaler


def png_bytes(w, h, pixel):
    """Minimal RGB PNG (stdlib zlib/struct)."""
    raw = b"".join(b"\x00" + b"".join(bytes(pixel(x, y)) for x in range(w)) for y in range(h))

    def chunk(tag, data):
        c = struct.pack(">I", len(data)) + tag + data
        return c + struct.pack(">I", zlib.crc32(tag + data) & 0xFFFFFFFF)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw)) + chunk(b"IEND", b""))


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb" if isinstance(data, bytes) else "w") as f:
        f.write(data)


def test_manifest_rules(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/PdM_telemetry.csv", "datetime,machineID,volt\n2024-01-01 00:00:00,1,1.5\n")
    _write(f"{d}/README.md", "hello")
    _write(f"{d}/license.txt", "x")
    _write(f"{d}/notes_data.csv", "a\n1\n")
    _write(f"{d}/photo.PNG", png_bytes(2, 2, lambda x, y: (x * 50, y * 50, 0)))
    _write(f"{d}/blob.bin", "zzz")
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("a.csv", "x\n1\n")
    _write(f"{d}/archive.dat", buf.getvalue())  # a zip by content, not by extension
    _write(f"{d}/sub/inner.csv", "a\n1\n")  # not descended
    m = {r.name: r for r in file_manifest(spark, d).collect()}
    assert set(m) == {"PdM_telemetry.csv", "README.md", "license.txt", "notes_data.csv", "photo.PNG", "blob.bin",
                      "archive.dat"}
    assert m["README.md"].action == "skip_metadata" and m["notes_data.csv"].action == "skip_metadata"
    assert m["archive.dat"].action == "zip" and m["photo.PNG"].action == "image"
    assert m["blob.bin"].action == "unsupported" and m["PdM_telemetry.csv"].action == "tabular"
    assert m["PdM_telemetry.csv"].table == "telemetry"
    assert is_component_table("PdM_maint") and not is_component_table("machine_maintenance_dataset")


def test_readers(spark, tmpdir_path):
    d = tmpdir_path
    _write(f"{d}/t.txt", "a;b;c\n1;2;3\n4;5;6\n")
    _write(f"{d}/t.tsv", "a\tb\n1\t2\n")
    _write(f"{d}/t.json", '[{"a": 1, "b": "x"}, {"a": 2, "b": "y"}]')
    assert sniff_delimiter(spark, f"{d}/t.txt") == ";"
    assert load_table(spark, f"{d}/t.txt").columns == ["a", "b", "c"]
    assert load_table(spark, f"{d}/t.tsv").count() == 1
    assert load_table(spark, f"{d}/t.json").count() == 2
    feather.write_feather(pa.table({"a": [1, 2, 3], "b": ["x", "y", "z"]}), f"{d}/t.feather")
    assert sorted(r.a for r in load_table(spark, f"{d}/t.feather").collect()) == [1, 2, 3]
    assert load_table(spark, f"{d}/t.xyz") is None
    register_loader(".xyz", lambda spark, path, schema=None: spark.read.text(path))
    _write(f"{d}/t.xyz", "line\n")
    assert load_table(spark, f"{d}/t.xyz").count() == 1


def test_zip_members(spark, tmpdir_path):
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("data/sensors.csv", "id,v\n1,2.5\n2,3.5\n")
        z.writestr("README.txt", "docs")
        z.writestr("bad.json", "{not json")
        z.writestr("deep/er/img.png", png_bytes(2, 2, lambda x, y: (1, 2, 3)))
    _write(f"{tmpdir_path}/pack.zip", buf.getvalue())
    tables, report = load_archive_tables(spark, f"{tmpdir_path}/pack.zip")
    assert set(tables) == {"sensors"} and tables["sensors"].count() == 2
    rep = {r.member: r for r in report.collect()}
    assert rep["README.txt"].action == "skip_metadata" and rep["deep/er/img.png"].action == "image"
    assert rep["bad.json"].error is not None


def test_images(spark, tmpdir_path):
    d = f"{tmpdir_path}/img"
    _write(f"{d}/grad.png", png_bytes(6, 4, lambda x, y: (x * 40, y * 60, 10)))
    _write(f"{d}/flat.png", png_bytes(6, 4, lambda x, y: (7, 7, 7)))
    _write(f"{d}/broken.png", png_bytes(6, 4, lambda x, y: (1, 1, 1))[:40])
    q = image_quality(read_images(spark, d))
    out = {os.path.basename(r.path): r.outcome for r in q.collect()}
    assert out == {"grad.png": "kept", "flat.png": "blank", "broken.png": "corrupt"}
    c = outcome_counts(q).first()
    assert (c.total, c.kept, c.removed_corrupt, c.removed_blank) == (3, 1, 1, 1)
    plan = {r.path: r for r in letterbox_plan(spark.createDataFrame(
        [("/a/x.jpg", 600, 400), ("/a/y.jpg", 100, 300), ("/a/z.jpg", 50, 50)], "path string, width int, height int"))
        .collect()}
    x, y, z = plan["/a/x.jpg"], plan["/a/y.jpg"], plan["/a/z.jpg"]
    assert (x.new_width, x.new_height, x.pad_left, x.pad_top, x.target_name) == (256, 171, 0, 42, "x.png")
    assert (y.new_width, y.new_height, y.pad_left, y.pad_top) == (85, 256, 86, 0)
    assert (z.new_width, z.new_height, z.pad_left, z.pad_top) == (256, 256, 0, 0)


def test_sinks_and_params(spark, tmpdir_path):
    t = {"telemetry": spark.range(2), "machine_maintenance_dataset": spark.range(3)}
    assert write_ingested(t, tmpdir_path) == ["machine_maintenance_dataset"]
    params = fit_scaler(spark.createDataFrame([(1.0,), (3.0,)], "a double"), ["a"])
    save_params(params, f"{tmpdir_path}/scaler")
    assert load_scaler_params(spark, f"{tmpdir_path}/scaler") == {"a": (2.0, 1.0)}


def test_categories_come_back_in_order(spark, tmp_path):
    from faultline.operators.features import apply_one_hot, categories_frame, fit_categories
    from faultline.sources.sinks import load_categories
    df = spark.createDataFrame([("m2", "e"), ("m10", None), ("m1", "a"), ("m2", "e")], "model string, errorid string")
    cats = fit_categories(df, ["model", "errorid"])
    save_params(categories_frame(spark, cats), str(tmp_path / "cats"))
    back = load_categories(spark, str(tmp_path / "cats"))
    assert back == cats and back["model"] == ["m1", "m10", "m2"]
    assert apply_one_hot(df, back).columns == apply_one_hot(df, cats).columns


def test_stages_are_dropped(spark):
    from pyspark.errors import AnalysisException

    from faultline.session import drop_stages, materialize
    kept = materialize(spark.range(3), "t")
    assert kept.count() == 3 and drop_stages(spark) >= 1 and drop_stages(spark) == 0
    try:
        spark.read.parquet(kept.inputFiles()[0])
        raise AssertionError("the stage is still there")
    except AnalysisException:
        pass


def test_bad_member_leaves_the_others(spark, tmp_path):
    from faultline.sources.archives import archive_members
    path = tmp_path / "bad.zip"
    with zipfile.ZipFile(path, "w") as z:
        for n in ("a.csv", "b.csv", "c.csv"):
            z.writestr(n, f"k\n{n}-value\n")
    raw = path.read_bytes()
    path.write_bytes(raw.replace(b"b.csv-value", b"b.csv-VALUE"))  # checksum of one member no longer fits
    got = {r["member"]: r for r in archive_members(spark, str(path)).collect()}
    assert {m: r["action"] for m, r in got.items()} == {"a.csv": "tabular", "b.csv": "error", "c.csv": "tabular"}
    assert got["b.csv"]["error"] and bytes(got["c.csv"]["content"]) == b"k\nc.csv-value\n"
