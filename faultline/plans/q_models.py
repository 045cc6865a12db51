"""Named queries: failure labels, sequences, models and scoring, cleaned table
(W4, W5, M7, M9, M10, E1 clean stage)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import events as EV
from faultline.operators import metrics as M
from faultline.operators.models import score, train_event_forest, train_failure_models
from faultline.operators.sequences import failure_labels, sequences
from faultline.plans import oracle_ctes as C
from faultline.plans.inputs import combined, labelled
from faultline.plans.pipelines import clean_table
from faultline.plans.q_events import processed
from faultline.plans.q_knn import M5_CTES
from faultline.plans.registry import register
from faultline.plans.util import round_floats

SEQ_LEN = 4  # machines have 9-27 daily rows in the role views; 64 is the library default


@register("w5_failure_labels", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql="""
SELECT datetime, machine_id, seq, failed,
       round(CASE WHEN h IS NOT NULL AND h <= 72 THEN h ELSE 168.0 END, 6) AS ttf,
       CAST(h IS NOT NULL AND h <= 72 AS INTEGER) AS label
FROM (SELECT *, date_diff('second', datetime, min(CASE WHEN failed = 1 THEN datetime END) OVER (
        PARTITION BY machine_id ORDER BY datetime DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) / 3600.0 AS h
      FROM labelled)
""")
def w5_failure_labels(spark, sf):
    out = failure_labels(labelled(spark, sf))
    return round_floats(out.select("datetime", "machine_id", "seq", "failed", "ttf", "label"))


@register("w4_sequences", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT machine_id, datetime, seq, ts, num FROM (
  SELECT *, list([volt, rotate, pressure, vibration]) OVER (PARTITION BY machine_id ORDER BY datetime, seq
              ROWS BETWEEN {SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS ts,
         [volt, rotate, pressure, vibration, CAST(age AS DOUBLE)] AS num
  FROM labelled) WHERE len(ts) = {SEQ_LEN}
""")
def w4_sequences(spark, sf):
    return sequences(labelled(spark, sf), length=SEQ_LEN).select("machine_id", "datetime", "seq", "ts", "num")


@register("w4_sequences_strided", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT machine_id, datetime, seq, ts FROM (
  SELECT *, list([volt, rotate, pressure, vibration]) OVER (PARTITION BY machine_id ORDER BY datetime, seq
              ROWS BETWEEN {SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS ts,
         row_number() OVER (PARTITION BY machine_id ORDER BY datetime, seq) AS n
  FROM labelled) WHERE len(ts) = {SEQ_LEN} AND (n - {SEQ_LEN}) % 3 = 0
""")
def w4_sequences_strided(spark, sf):
    return sequences(labelled(spark, sf), length=SEQ_LEN, stride=3).select("machine_id", "datetime", "seq", "ts")


@register("e1_clean_telemetry", views=C.COMBINED_VIEWS, ctes=M5_CTES, sql="""
SELECT l.datetime, l.machine_id, round_even(l.volt, 2) AS volt, round_even(l.rotate, 2) AS rotate,
       round_even(l.pressure, 2) AS pressure, round_even(l.vibration, 2) AS vibration, l.seq, l.model,
       round(l.age, 6) AS age, l.errorid, coalesce(l.comp_failure, p.pred) AS comp_failure,
       CAST(coalesce(l.comp_failure, p.pred) IS NOT NULL AS INTEGER) AS failed
FROM lab5 l LEFT JOIN pred5 p ON l.seq = p.tid
""")
def e1_clean_telemetry(spark, sf):
    out = clean_table(combined(spark, sf), engineer_target=True)
    return round_floats(out.withColumn("age", F.col("age").cast("double")))


def _sequence_samples(spark, sf):
    lab = failure_labels(labelled(spark, sf))
    return sequences(lab, length=SEQ_LEN)


@register("m10_failure_scoring")
def m10_failure_scoring(spark, sf):
    """M9 + M10: train on the hash-split train part of the sequence samples, score the
    test part. ML output: rows-only check (pytest bounds the quality)."""
    s = _sequence_samples(spark, sf).checkpoint()
    train, test = EV.hash_split(s, "machine_id")  # windows of a machine overlap: all on one side
    models = train_failure_models(train, iterations=10)
    return score(models, test).select("machine_id", "datetime", "seq", "label", "ttf", "score", "ttf_pred",
                                      "alert", "prob_pct")


@register("m7_event_forest_report")
def m7_event_forest_report(spark, sf):
    """M7 + A11: forest on the event features, report on the test split (rows-only check)."""
    data = processed(spark, sf).withColumn("is_anomaly", EV.anomaly_label()).checkpoint()
    train, test = EV.hash_split(data, "event_id")
    model = train_event_forest(train)
    pred = model.transform(test).withColumn("prediction", F.col("prediction").cast("int"))
    return M.classification_report(pred, "is_anomaly", "prediction")
