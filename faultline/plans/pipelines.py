"""End-to-end batch compositions (the reference's stage order, as one lazy plan
per stage with the two eager points it needs: fitted parameters and KNN)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from faultline.operators import clean
from faultline.operators.knn import CELL_ROWS, knn_classify_component, knn_impute
from faultline.session import drop_stages, stages_written


def clean_table(df: DataFrame, *, drop_duplicates: bool = True, impute: bool = True,
                engineer_target: bool = False, id_col: str = "seq", block_rows: int = CELL_ROWS) -> DataFrame:
    """load-dedup -> sanitize (P1, P3-P5) -> numeric KNN (M4) -> [target KNN (P6, M5, P7)] -> round."""
    if drop_duplicates:
        df = clean.drop_exact_duplicates(df, ignore=id_col)
    df = clean.sanitize_physical(df)
    if impute:
        df = knn_impute(df, id_col=id_col, block_rows=block_rows)
    if engineer_target:
        df = clean.merge_failure_component(df)
        df = knn_classify_component(df, id_col=id_col, block_rows=block_rows)
    return clean.round_precision(df)


def _read_stage(spark, path: str, fmt: str):
    """Read a written stage back (typed: parquet keeps types; CSV infers them and re-parses datetime)."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    from faultline.operators.clean import parse_datetime
    return parse_datetime(spark.read.option("header", True).option("inferSchema", True).format(fmt).load(path))


def run_batch_pipeline(spark, raw_folder: str, out_dir: str, *, fmt: str = "parquet", block_rows: int = CELL_ROWS):
    """Ingest -> combine -> clean (with target engineering) -> engineer -> write.

    Returns the written paths. Each stage's output is written to ``out_dir``,
    which also cuts the lineage between stages.
    """
    from faultline.operators.combine import combine
    from faultline.operators.features import engineer_features
    from faultline.plans.ingest import image_stage, ingest_folder, prepare_tables
    from faultline.sources.sinks import save_params, write_ingested, write_table

    since = stages_written(spark)
    tables, manifest = ingest_folder(spark, raw_folder)
    write_ingested(tables, f"{out_dir}/ingested", fmt)
    prepared = prepare_tables(tables)
    paths = {}
    quality, plan, counts = image_stage(spark, raw_folder, manifest)
    for name, df in (("image_quality", quality), ("image_plan", plan), ("image_counts", counts)):
        write_table(df, f"{out_dir}/{name}", "parquet")
        paths[name] = f"{out_dir}/{name}"
    combined = combine(prepared)
    if combined is not None:
        write_table(combined, f"{out_dir}/combined", fmt)
        combined = _read_stage(spark, f"{out_dir}/combined", fmt)
        cleaned = clean_table(combined, engineer_target=True, block_rows=block_rows)
        write_table(cleaned, f"{out_dir}/cleaned", fmt)
        model_table, params = engineer_features(_read_stage(spark, f"{out_dir}/cleaned", fmt))
        write_table(model_table, f"{out_dir}/model_dataset", fmt)
        save_params(params, f"{out_dir}/numerical_feature_scaler")
        paths.update(combined=f"{out_dir}/combined", cleaned=f"{out_dir}/cleaned",
                     model_dataset=f"{out_dir}/model_dataset")
    sensors = [k for k in prepared if "maintenance" in k]  # the second (non-PdM) sensor tables
    for name in sensors:
        kept = f"cleaned_{name}"
        maint = clean_table(prepared[name], engineer_target=False, id_col="__none__", block_rows=block_rows)
        write_table(maint, f"{out_dir}/{kept}", fmt)
        paths[kept] = f"{out_dir}/{kept}"
    drop_stages(spark, since)  # all results are written
    return paths


def train_event_model(spark, events_table: DataFrame):
    """E2 batch part: features (S15) -> rule label (P12) -> split (M6) -> forest (M7) -> report."""
    from pyspark.sql import functions as F

    from faultline.operators.events import anomaly_label, hash_split
    from faultline.operators.metrics import classification_report
    from faultline.operators.models import train_event_forest

    data = events_table.withColumn("is_anomaly", anomaly_label())
    train, test = hash_split(data, "event_id")
    model = train_event_forest(train)
    pred = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    return model, classification_report(pred, "is_anomaly", "prediction")


def train_and_evaluate(spark, labelled_table: DataFrame, model_path: str, *, length: int = 64,
                       min_f1: float = 0.60, key: str = "machine_id"):
    """Labels (W5) -> sequences (W4) -> split (M6) -> balanced sample (M8) -> models (M9)
    -> scores (M10) -> evaluation (M11) -> gate and save (M12, S17). Returns (report row, saved)."""
    from faultline.operators.events import balanced_sample, hash_split
    from faultline.operators.metrics import evaluation_report
    from faultline.operators.models import save_if_better, score, train_failure_models
    from faultline.operators.sequences import failure_labels, sequences

    samples = sequences(failure_labels(labelled_table, key=key), key=key, length=length).checkpoint()
    train, test = hash_split(samples, key)  # windows of a machine overlap: all on one side
    models = train_failure_models(balanced_sample(train, label="label", key="seq"))
    scored = score(models, test)
    report = evaluation_report(scored, "label", "score").first()
    saved = save_if_better(models, report["f1"], model_path, min_f1)
    return report, saved
