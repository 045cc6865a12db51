import os

from faultline.fixtures import role_tables, role_view
from faultline.plans.pipelines import run_batch_pipeline

SF001 = "/root/testdata/sf0.001"


def test_batch_pipeline_from_raw_csv(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    names = {"telemetry": "PdM_telemetry", "machines": "PdM_machines", "failures": "PdM_failures",
             "errors": "PdM_errors", "maint": "PdM_maint"}
    for role, df in role_tables(spark, SF001).items():
        pdf = df.toPandas().rename(columns={"machine_id": "machineID", "errorid": "errorID"})
        pdf.to_csv(os.path.join(raw, names[role] + ".csv"), index=False)
    m = role_view(spark, SF001, "maintenance").toPandas().drop(columns=["l_orderkey", "l_partkey", "l_suppkey",
                                                                        "l_linenumber"]).head(300)
    m.columns = ["Operating Hours", "Temperature C", "Vibration Level (mm/s)", "Load Percentage"]
    m.to_csv(os.path.join(raw, "machine_maintenance_dataset.csv"), index=False)
    with open(os.path.join(raw, "README.md"), "w") as f:
        f.write("docs")
    out = run_batch_pipeline(spark, raw, os.path.join(tmpdir_path, "out"), block_rows=128)
    cleaned = spark.read.parquet(out["cleaned"])
    assert cleaned.count() == 265
    assert {"comp_failure", "failed", "machine_id"} <= set(cleaned.columns)
    assert cleaned.filter("comp_failure IS NULL AND errorid IS NOT NULL").count() == 0
    assert cleaned.filter("age IS NULL").count() == 0
    model = spark.read.parquet(out["model_dataset"])
    assert model.count() == 265 and "volt_roll_std_3" in model.columns and "machine_id" not in model.columns
    maint = spark.read.parquet(out["cleaned_machine_maintenance_dataset"])
    assert maint.count() <= 300 and maint.filter("load_percentage > 100 OR temperature_c > 150").count() == 0
    assert maint.filter("temperature_c IS NULL OR operating_hours IS NULL").count() == 0
    assert os.path.exists(os.path.join(tmpdir_path, "out", "ingested", "machine_maintenance_dataset_ingested"))


def test_event_and_failure_model_pipelines(spark, tmpdir_path):
    from faultline.plans.inputs import labelled
    from faultline.plans.pipelines import train_and_evaluate, train_event_model
    from faultline.plans.q_events import processed
    model, report = train_event_model(spark, processed(spark, "/root/testdata/sf0.01"))
    rep = {r.label: r for r in report.collect()}
    assert rep["accuracy"].f1 > 0.8 and rep["accuracy"].support > 1000
    row, saved = train_and_evaluate(spark, labelled(spark, SF001), os.path.join(tmpdir_path, "m"), length=4,
                                    min_f1=0.0)
    assert 0.0 <= row["pr_auc"] <= 1.0 and saved
    assert os.path.exists(os.path.join(tmpdir_path, "m", "classifier"))


def test_csv_sink(spark, tmpdir_path):
    from faultline.sources.sinks import write_table
    write_table(spark.range(3), os.path.join(tmpdir_path, "c"), fmt="csv")
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_path, "c")).count() == 3


def test_batch_pipeline_csv_output(spark, tmpdir_path):
    raw = os.path.join(tmpdir_path, "raw")
    os.makedirs(raw)
    for role, df in role_tables(spark, SF001).items():
        df.toPandas().to_csv(os.path.join(raw, role + ".csv"), index=False)
    out = run_batch_pipeline(spark, raw, os.path.join(tmpdir_path, "out"), fmt="csv", block_rows=128)
    cleaned = spark.read.option("header", True).csv(out["cleaned"])
    assert cleaned.count() == 265 and "comp_failure" in cleaned.columns
    assert spark.read.option("header", True).csv(out["model_dataset"]).count() == 265
