"""Evaluation metrics over (label, score) tables.

Everything is derived from one aggregate: positives and negatives per distinct
score. Cumulative counts in descending score order are running totals over a
range-partitioned order, so no step puts all scores in
one partition. Each curve point then carries what the trapezoid area, F1 and
the precision/recall at a threshold need, and those are plain aggregates.

Curve semantics: one point per distinct score used as threshold (score >= t):
precision = tp / (tp + fp), recall = tp / positives (all 1 when there are no
positives), plus the end point (precision 1, recall 0) that has no threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.ordered import running_totals
from faultline.session import broadcast_if_small

F1_EPS = 1e-10  # fixed value: added to p + r in the F1 denominator
DEFAULT_THRESHOLD = 0.5  # fixed value: threshold when the best point has none
ALERT_TEXT = "ALERT: FAILURE IMMINENT"  # fixed values of the alert projection
NORMAL_TEXT = "NORMAL"


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """A5: per class n, weight = 1/n, and pos_weight = negatives / max(positives, 1)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy()  # over the per-class table: one row per class
    pos = F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).over(everything)
    neg = F.sum(F.when(F.col(label) != 1, F.col("n")).otherwise(0)).over(everything)
    return counts.select(label, "n", (1.0 / F.col("n")).alias("weight"),
                         (neg / F.greatest(pos, F.lit(1))).alias("pos_weight"))


def with_class_weight(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Join the inverse-frequency weight of each row's class (the class table is tiny)."""
    w = class_weights(df, label).select(label, F.col("weight").alias(out))
    return df.join(broadcast_if_small(w), label, "left")  # one row per class


def score_counts(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Positives and negatives per distinct score (partial aggregate, small shuffle)."""
    return (df.groupBy(F.col(score).alias("threshold"))
            .agg(F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
                 F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg")))


def _descending_prefix(counts: DataFrame) -> DataFrame:
    """Add tps/fps = counts summed over all thresholds >= this one, and P = all positives."""
    run = running_totals(counts, [F.col("threshold").desc()], ["pos", "neg"])
    return run.select("threshold", "pos", "neg", F.col("all_pos").alias("P"),
                      (F.col("before_pos") + F.col("pos")).alias("tps"), (F.col("before_neg") + F.col("neg")).alias("fps"))


def _points(df: DataFrame, label: str, score: str) -> DataFrame:
    """Curve points with precision, recall, F1 and the previous point's precision."""
    c = _descending_prefix(score_counts(df, label, score))
    prec = F.when(F.col("tps") + F.col("fps") == 0, 0.0).otherwise(F.col("tps") / (F.col("tps") + F.col("fps")))
    rec = F.when(F.col("P") == 0, 1.0).otherwise(F.col("tps") / F.col("P"))
    ptp, pfp = F.col("tps") - F.col("pos"), F.col("fps") - F.col("neg")
    prev_prec = F.when(ptp + pfp == 0, 1.0).otherwise(ptp / (ptp + pfp))
    return c.select("threshold", "pos", "neg", "tps", "fps", "P",
                    prec.alias("precision"), rec.alias("recall"), prev_prec.alias("_pprev"))


def pr_curve(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """(threshold, precision, recall); the end point has threshold NULL."""
    pts = _points(df, label, score).select("threshold", "precision", "recall")
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)], pts.schema)
    return pts.unionByName(end)


def evaluation_report(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """M11 (A8-A10 in one row): pr_auc (trapezoid), threshold, f1, precision, recall.

    The area pairs each point with the next point in curve order, whose
    precision follows from this point's counts minus its own; the last pair
    reaches the end point (1, 0). The best F1 takes the lowest threshold on
    ties. Precision and recall at that threshold are 0 when undefined.
    """
    pts = _points(df, label, score)
    f1 = 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall") + F.lit(F1_EPS))
    pts = pts.withColumn("f1", f1)
    dr = F.when(F.col("P") == 0, F.lit(0.0)).otherwise(F.col("pos") / F.col("P"))  # recall step
    area_pos = F.sum(dr * (F.col("precision") + F.col("_pprev")) / 2)
    top = F.max_by("precision", "threshold")  # point with the highest threshold
    best = F.max_by(F.struct("threshold", "f1", "tps", "fps", "P"),
                    F.struct(F.col("f1"), (-F.col("threshold")).alias("t")))
    agg = pts.agg(area_pos.alias("_a"), top.alias("_top"), best.alias("_b"), F.first("P").alias("_P"))
    pr_auc = F.when(F.col("_P") == 0, (F.col("_top") + 1.0) / 2).otherwise(F.col("_a"))
    b = F.col("_b")
    return agg.select(
        pr_auc.alias("pr_auc"),
        F.coalesce(b["threshold"], F.lit(DEFAULT_THRESHOLD)).alias("threshold"),
        F.coalesce(b["f1"], F.lit(0.0)).alias("f1"),
        F.when(b["tps"] + b["fps"] == 0, 0.0).otherwise(b["tps"] / (b["tps"] + b["fps"])).alias("precision"),
        F.when(b["P"] == 0, 0.0).otherwise(b["tps"] / b["P"]).alias("recall"))


def precision_recall_at(df: DataFrame, threshold: float, label: str = "label", score: str = "score") -> DataFrame:
    """A10: precision and recall of ``score >= threshold`` (0 when the denominator is 0)."""
    pred = F.col(score) >= F.lit(threshold)
    pos = F.col(label) == 1
    a = df.agg(F.sum((pred & pos).cast("long")).alias("tp"), F.sum((pred & ~pos).cast("long")).alias("fp"),
               F.sum(pos.cast("long")).alias("p"))
    return a.select(
        F.when(F.col("tp") + F.col("fp") == 0, 0.0).otherwise(F.col("tp") / (F.col("tp") + F.col("fp")))
        .alias("precision"),
        F.when(F.col("p") == 0, 0.0).otherwise(F.col("tp") / F.col("p")).alias("recall"))


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per class precision, recall, f1, support; then accuracy, macro avg, weighted avg.

    Classes are the union of true and predicted labels. Undefined ratios are 0.
    The accuracy row carries the accuracy in ``f1`` and the total in ``support``.
    """
    conf = df.groupBy(F.col(label).cast("string").alias("t"), F.col(pred).cast("string").alias("p")).count()
    long = conf.select(F.explode(F.array(
        F.struct(F.col("t").alias("cls"), F.col("count").alias("sup"), F.lit(0).alias("prd"),
                 F.when(F.col("t") == F.col("p"), F.col("count")).otherwise(0).alias("tp")),
        F.struct(F.col("p").alias("cls"), F.lit(0).alias("sup"), F.col("count").alias("prd"), F.lit(0).alias("tp")),
    )).alias("x")).select("x.*")
    per = long.groupBy("cls").agg(F.sum("sup").alias("support"), F.sum("prd").alias("npred"), F.sum("tp").alias("tp"))
    p = F.when(F.col("npred") == 0, 0.0).otherwise(F.col("tp") / F.col("npred"))
    r = F.when(F.col("support") == 0, 0.0).otherwise(F.col("tp") / F.col("support"))
    per = per.select(F.col("cls").alias("label"), p.alias("precision"), r.alias("recall"), "support", "tp")
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") == 0, 0.0)
                         .otherwise(2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))))
    summ = per.agg(F.sum("support").alias("n"), F.sum("tp").alias("ntp"), F.count(F.lit(1)).alias("k"),
                   F.avg("precision").alias("mp"), F.avg("recall").alias("mr"), F.avg("f1").alias("mf"),
                   (F.sum(F.col("precision") * F.col("support")) / F.sum("support")).alias("wp"),
                   (F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("wr"),
                   (F.sum(F.col("f1") * F.col("support")) / F.sum("support")).alias("wf"))
    rows = summ.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("label"), F.lit(None).cast("double").alias("precision"),
                 F.lit(None).cast("double").alias("recall"), (F.col("ntp") / F.col("n")).alias("f1"),
                 F.col("n").alias("support")),
        F.struct(F.lit("macro avg").alias("label"), F.col("mp").alias("precision"), F.col("mr").alias("recall"),
                 F.col("mf").alias("f1"), F.col("n").alias("support")),
        F.struct(F.lit("weighted avg").alias("label"), F.col("wp").alias("precision"),
                 F.col("wr").alias("recall"), F.col("wf").alias("f1"), F.col("n").alias("support")),
    )).alias("x")).select("x.*")
    return per.select("label", "precision", "recall", "f1", "support").unionByName(rows)


def alerts(df: DataFrame, threshold: float | None, prob: str = "score") -> DataFrame:
    """Prob >= threshold -> alert text, else NORMAL; probability in percent (2 places).

    ``threshold=None`` falls back to 0.5.
    """
    thr = DEFAULT_THRESHOLD if threshold is None else threshold
    return df.withColumn("alert", F.when(F.col(prob) >= F.lit(thr), F.lit(ALERT_TEXT)).otherwise(F.lit(NORMAL_TEXT))) \
             .withColumn("prob_pct", F.round(F.col(prob) * 100, 2))
