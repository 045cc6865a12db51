"""Scan types, archives in every format, listing on any file system, images and the way back from an ingested folder."""

import io
import zipfile

import pyarrow as pa
import pyarrow.feather as feather
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from faultline.plans.ingest import combine_ingested, image_stage, ingest_folder, load_ingested
from faultline.sources import readers
from faultline.sources.archives import archive_images, load_archive_tables
from faultline.sources.images import image_quality
from faultline.sources.manifest import file_manifest
from test_sources import png_bytes


def test_strict_types(spark, tmp_path):
    p = tmp_path / "t.csv"
    p.write_text("code,n,x,flag,mixed,day,none,big\n1d,1,1.5,True,1,2024-01-01 00:00:00,,12345678901234567890\n"
                 "2f,-2,1e3,False,a,2024-01-02 00:00:00,NA,1\n3d,NA,inf,true,2,2024-01-03 00:00:00,null,2\n")
    df = readers.load_table(spark, str(p))
    assert dict(df.dtypes) == {"code": "string", "n": "bigint", "x": "double", "flag": "boolean", "mixed": "string",
                               "day": "string", "none": "string", "big": "double"}
    assert [r.code for r in df.collect()] == ["1d", "2f", "3d"] and [r.n for r in df.collect()] == [1, -2, None]
    assert readers.load_table(spark, str(p), schema="code string, n string, x string, flag string, mixed string, day string, none string, big string") \
        .first().code == "1d"


def test_ragged_lines_and_quoted_breaks(spark, tmp_path):
    p = tmp_path / "r.csv"
    p.write_text("a,b\n1,2\n3\n4,5,6\n7,8\n")
    got = sorted(readers.load_table(spark, str(p)).collect())
    assert [tuple(r) for r in got] == [(1, 2), (3, None), (7, 8)]  # too many fields: left out; too few: NULL
    assert sorted(map(tuple, readers.malformed_lines(spark, str(p)).collect())) == [("3", False), ("4,5,6", True)]
    q = tmp_path / "q.csv"
    q.write_text('id,note\n1,"x\ny"\n2,"say ""hi"", ok"\n')
    assert sorted(map(tuple, readers.load_table(spark, str(q)).collect())) == [(1, "x\ny"), (2, 'say "hi", ok')]
    empty = tmp_path / "e.csv"
    empty.write_text("a,b\n")
    assert readers.load_table(spark, str(empty)).columns == ["a", "b"] and readers.load_table(spark, str(empty)).count() == 0


def test_order_of_rows_over_several_files(spark, tmp_path):
    for name, size, first in (("a", 3, 0), ("b", 400, 1000), ("c", 50, 5000)):
        (tmp_path / f"{name}.csv").write_text("v\n" + "".join(f"{first + i}\n" for i in range(size)))
    df = readers.read_csv(spark, str(tmp_path), order_col="seq")
    got = [r.v for r in df.orderBy("seq").collect()]
    assert got == sorted(got) and len(got) == 453


def _feather(table):
    out = io.BytesIO()
    feather.write_feather(table, out)
    return out.getvalue()


def _parquet(table):
    out = io.BytesIO()
    pq.write_table(table, out)
    return out.getvalue()


def _zip(path, members):
    with zipfile.ZipFile(path, "w") as z:
        for name, data in members.items():
            z.writestr(name, data)


def test_archive_members_in_every_format(spark, tmp_path):
    t = pa.table({"k": [1, 2], "v": [float("nan"), 2.5]})
    members = {"a/quoted.csv": 'id,note\n1,"x\ny"\n2,z\n', "nan.csv": "x,y\nNaN,1d\n2,2f\n", "pretty.json": '[\n  {"a": 1},\n  {"a": 2}\n]\n',
               "p.parquet": _parquet(t), "f.feather": _feather(t), "semi.txt": "a;b\n1;2\n", "tab.tsv": "a\tb\n1\t2\n",
               "own.mine": "line\n", "empty.csv": "", "bad.json": "{not json", "bad.parquet": b"PAR1", "one/same.csv": "s\n1\n", "two/same.csv": "s\n2\n",
               **{f"many/m{i}.csv": f"c,d\n{i},x{i}\n" for i in range(12)}}
    _zip(tmp_path / "all.zip", members)
    readers.register_loader(".mine", lambda spark, path, schema=None: spark.read.text(path))
    try:
        tables, report = load_archive_tables(spark, str(tmp_path / "all.zip"))
        assert sorted(map(tuple, tables["quoted"].collect())) == [(1, "x\ny"), (2, "z")]
        assert sorted(map(tuple, tables["nan"].collect()), key=repr) == [(2, "2f"), (None, "1d")]
        assert sorted(r.a for r in tables["pretty"].collect()) == [1, 2]
        for name in ("p", "f"):
            assert sorted(map(tuple, tables[name].collect())) == [(1, None), (2, 2.5)]
        assert tuple(tables["semi"].first()) == tuple(tables["tab"].first()) == (1, 2)
        assert tables["own"].first().value == "line"
        assert tables["same"].first().s == 2
        assert [tuple(tables[f"m{i}"].first()) for i in range(12)] == [(i, f"x{i}") for i in range(12)]
        assert not {"empty", "bad"} & set(tables)
        rep = {r.member: r for r in report.collect()}
        assert {m for m, r in rep.items() if r.error} == {"empty.csv", "bad.json", "bad.parquet"}
        assert {m for m, r in rep.items() if r.duplicate_stem} == {"one/same.csv", "two/same.csv"}
    finally:
        del readers.LOADERS[".mine"]


def test_jobs_do_not_grow_with_the_number_of_members(spark, tmp_path):
    def jobs(n):
        _zip(tmp_path / f"z{n}.zip", {f"m{i}.csv": f"a,b\n{i},x\n" for i in range(n)})
        tracker, group = spark.sparkContext.statusTracker(), f"members-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            assert len(load_archive_tables(spark, str(tmp_path / f"z{n}.zip"))[0]) == n
            return len(tracker.getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs(3) == jobs(24)


@pytest.fixture()
def stub(spark, tmp_path):
    """A file system that only Spark's readers know: a mount over a local folder."""
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.stub.link./raw", f"file://{tmp_path}")
    return "viewfs://stub/raw"


def test_listing_and_feather_on_any_file_system(spark, tmp_path, stub):
    (tmp_path / "t.csv").write_text("a\n1\n")
    (tmp_path / "with space.csv").write_text("a\n1\n")
    (tmp_path / "empty.bin").write_bytes(b"")
    (tmp_path / "k=1").mkdir()
    (tmp_path / "k=1" / "inner.csv").write_text("a\n1\n")
    (tmp_path / "f.feather").write_bytes(_feather(pa.table({"a": [3, 4]})))
    _zip(tmp_path / "z.data", {"inside.csv": "b\n5\n"})
    m = {r.name: r for r in file_manifest(spark, stub).collect()}
    assert {n: r.action for n, r in m.items()} == {"t.csv": "tabular", "with space.csv": "tabular",
                                                   "f.feather": "tabular", "z.data": "zip"}
    assert m["t.csv"].length == 4
    assert sorted(r.a for r in readers.load_table(spark, f"{stub}/f.feather").collect()) == [3, 4]
    tables, _ = ingest_folder(spark, stub)
    assert tables["inside"].first().b == 5 and tables["f"].count() == 2
    with pytest.raises(FileNotFoundError):
        file_manifest(spark, f"{stub}/nothing")


def test_images_of_files_and_archives_count_alike(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    good, flat = png_bytes(6, 4, lambda x, y: (x * 40, y * 60, 10)), png_bytes(6, 4, lambda x, y: (7, 7, 7))
    (raw / "good.png").write_bytes(good)
    (raw / "modern.webp").write_bytes(b"RIFF....WEBPVP8 ")
    _zip(raw / "pack.zip", {"x/good.png": good, "flat.png": flat, "cut.png": good[:40], "t.csv": "a\n1\n"})
    _, manifest = ingest_folder(spark, str(raw))
    quality, plan, counts = image_stage(spark, str(raw), manifest)
    assert tuple(counts.first()) == (5, 2, 1, 1, 1)
    assert sorted(r.path.rsplit("/", 1)[-1] for r in quality.where("outcome = 'kept'").collect()) == ["good.png", "good.png"]
    assert plan.count() == 2 and set(r.new_width for r in plan.collect()) == {256}
    only_text = tmp_path / "text.zip"
    _zip(only_text, {"t.csv": "a\n1\n"})
    assert image_quality(archive_images(spark, str(only_text))).count() == 0


def test_combine_from_an_ingested_folder(spark, tmp_path):
    (tmp_path / "PdM_telemetry_ingested.csv").write_text("datetime,machineID,volt\n2024-01-01 00:00:00,1,1.5\n2024-01-02 00:00:00,1,2.5\n")
    (tmp_path / "PdM_machines.csv").write_text("machineID,model,age\n1,model3,18\n")
    (tmp_path / "PdM_failures.csv").write_text("datetime,machineID,failure\n2024-01-02 00:00:00,1,comp2\n2024-01-02 00:00:00,1,comp1\n")
    (tmp_path / "PdM_combined.csv").write_text("datetime,machineID\n")
    spark.createDataFrame([(1, 5.0)], "machineID long, x double").write.parquet(str(tmp_path / "machine_maintenance_dataset_ingested"))
    tables = load_ingested(spark, str(tmp_path))
    assert set(tables) == {"telemetry", "machines", "failures", "machine_maintenance_dataset"}
    got = combine_ingested(spark, str(tmp_path)).orderBy("datetime").collect()
    assert [(r.volt, r.model, r.failure) for r in got] == [(1.5, "model3", None), (2.5, "model3", "comp2")]
    assert got[0].asDict().get("seq") is None
    assert tables["failures"].select(F.max("datetime")).first()[0].year == 2024


def test_json_arrays_in_many_ranges_equal_one_task(spark, tmp_path):
    import json
    import random

    from faultline.sources.json_arrays import array_elements
    rnd = random.Random(9)
    nasty = ['}', '{', '],[', '\\"}', "\\", '"', "a,b", "é]}", "\n", ""]
    rows = [{"id": i, "s": "".join(rnd.choice(nasty) for _ in range(rnd.randint(0, 6))), "in": {"k": [{"n": rnd.randint(0, 9), "z": "}"}]},
             **({"big": "x}" * 3000} if i % 50 == 7 else {})} for i in range(300)]
    texts = {"flat": json.dumps(rows), "pretty": json.dumps(rows, indent=2, ensure_ascii=False) + "\n", "empty": "[ ]", "none": " \n[]\n",
             "plain": "[1, \"a}b\", null, [2, 3], {}]"}
    want = {"flat": rows, "pretty": rows, "empty": [], "none": [], "plain": json.loads(texts["plain"])}
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in ("700", "5000", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            for name, text in texts.items():
                (tmp_path / f"{name}.json").write_text(text)
                got = [json.loads(r.value) for r in array_elements(spark, str(tmp_path / f"{name}.json")).collect()]
                assert sorted(map(json.dumps, got)) == sorted(map(json.dumps, want[name])), (name, size)
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        cut = readers.read_json(spark, str(tmp_path / "pretty.json"), split_bytes=1000)
        one = readers.read_json(spark, str(tmp_path / "pretty.json"))
        assert cut.schema == one.schema and sorted(map(repr, cut.collect())) == sorted(map(repr, one.collect()))
        both = array_elements(spark, [str(tmp_path / "flat.json"), str(tmp_path / "plain.json")])
        assert both.count() == 305
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    (tmp_path / "doc.json").write_text('{"a": 1, "b": [1, 2]}')
    assert readers.read_json(spark, str(tmp_path / "doc.json"), split_bytes=1).first().a == 1
