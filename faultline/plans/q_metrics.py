"""Named queries: class weights, PR curve, AUC, best threshold, reports, alerts."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.operators import metrics as M
from faultline.plans.registry import register
from faultline.plans.util import round_floats

_CUM = [
    ("sc", "SELECT score AS threshold, sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) AS pos, "
           "sum(CASE WHEN label = 1 THEN 0 ELSE 1 END) AS neg FROM scores GROUP BY score"),
    ("cum", "SELECT threshold, pos, neg, "
            "sum(pos) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS tps, "
            "sum(neg) OVER (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING) AS fps, "
            "sum(pos) OVER () AS P FROM sc"),
    ("pts", "SELECT threshold, pos, neg, tps, fps, P, "
            "CASE WHEN tps + fps = 0 THEN 0.0 ELSE tps / (tps + fps) END AS precision, "
            "CASE WHEN P = 0 THEN 1.0 ELSE tps / P END AS recall, "
            "CASE WHEN tps - pos + fps - neg = 0 THEN 1.0 ELSE (tps - pos) / (tps - pos + fps - neg) END AS pprev "
            "FROM cum"),
    ("f1s", "SELECT *, 2 * precision * recall / (precision + recall + 1e-10) AS f1 FROM pts"),
    ("best", "SELECT threshold, f1, tps, fps, P FROM (SELECT *, row_number() OVER "
             "(ORDER BY f1 DESC, threshold ASC) AS r FROM f1s) WHERE r = 1"),
    ("auc", "SELECT CASE WHEN max(P) = 0 THEN (arg_max(precision, threshold) + 1) / 2 "
            "ELSE sum(pos / P * (precision + pprev) / 2) END AS pr_auc FROM pts"),
    ("report", "SELECT auc.pr_auc, coalesce(best.threshold, 0.5) AS threshold, coalesce(best.f1, 0.0) AS f1, "
               "CASE WHEN tps + fps = 0 THEN 0.0 ELSE tps / (tps + fps) END AS precision, "
               "CASE WHEN P = 0 THEN 0.0 ELSE tps / P END AS recall FROM auc LEFT JOIN best ON TRUE"),
]


def _scores(spark, sf):
    return role_view(spark, sf, "scores")


@register("a5_class_weights", views=["scores"], sql="""
SELECT label, n, round(1.0 / n, 6) AS weight,
       round(sum(CASE WHEN label <> 1 THEN n ELSE 0 END) OVER ()
             / greatest(sum(CASE WHEN label = 1 THEN n ELSE 0 END) OVER (), 1), 6) AS pos_weight
FROM (SELECT label, count(*) AS n FROM scores GROUP BY label)
""")
def a5_class_weights(spark, sf):
    return round_floats(M.class_weights(_scores(spark, sf)))


@register("a7_pr_curve", views=["scores"], ctes=_CUM, sql="""
SELECT round(threshold, 6) AS threshold, round(precision, 6) AS precision, round(recall, 6) AS recall FROM pts
UNION ALL SELECT NULL, 1.0, 0.0
""")
def a7_pr_curve(spark, sf):
    return round_floats(M.pr_curve(_scores(spark, sf)))


@register("a8_pr_auc", views=["scores"], ctes=_CUM, sql="SELECT round(pr_auc, 6) AS pr_auc FROM report")
def a8_pr_auc(spark, sf):
    return round_floats(M.evaluation_report(_scores(spark, sf)).select("pr_auc"))


@register("a9_best_f1_threshold", views=["scores"], ctes=_CUM,
          sql="SELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM report")
def a9_best_f1_threshold(spark, sf):
    return round_floats(M.evaluation_report(_scores(spark, sf)).select("threshold", "f1"))


def _best_threshold(spark, sf):
    return M.evaluation_report(_scores(spark, sf)).select("threshold").first()["threshold"]


@register("a10_precision_recall_at", views=["scores"], ctes=_CUM, sql="""
SELECT round(CASE WHEN sum(CASE WHEN s.score >= r.threshold THEN 1 ELSE 0 END) = 0 THEN 0.0
             ELSE sum(CASE WHEN s.score >= r.threshold AND s.label = 1 THEN 1 ELSE 0 END)
                  / sum(CASE WHEN s.score >= r.threshold THEN 1 ELSE 0 END) END, 6) AS precision,
       round(CASE WHEN sum(CASE WHEN s.label = 1 THEN 1 ELSE 0 END) = 0 THEN 0.0
             ELSE sum(CASE WHEN s.score >= r.threshold AND s.label = 1 THEN 1 ELSE 0 END)
                  / sum(CASE WHEN s.label = 1 THEN 1 ELSE 0 END) END, 6) AS recall
FROM scores s JOIN report r ON TRUE
""")
def a10_precision_recall_at(spark, sf):
    return round_floats(M.precision_recall_at(_scores(spark, sf), _best_threshold(spark, sf)))


@register("m11_evaluation_report", views=["scores"], ctes=_CUM, sql="""
SELECT round(pr_auc, 6) AS pr_auc, round(threshold, 6) AS threshold, round(f1, 6) AS f1,
       round(precision, 6) AS precision, round(recall, 6) AS recall FROM report
""")
def m11_evaluation_report(spark, sf):
    return round_floats(M.evaluation_report(_scores(spark, sf)))


@register("a11_class_report", views=["scores"], ctes=[
    ("pr", "SELECT CAST(label AS VARCHAR) AS t, CAST(CAST(score >= 0.5 AS INTEGER) AS VARCHAR) AS p FROM scores"),
    ("cls", "SELECT t AS label FROM pr UNION SELECT p FROM pr"),
    ("per", "SELECT cls.label, (SELECT count(*) FROM pr WHERE t = cls.label) AS support, "
            "(SELECT count(*) FROM pr WHERE p = cls.label) AS npred, "
            "(SELECT count(*) FROM pr WHERE t = cls.label AND p = cls.label) AS tp FROM cls"),
    ("per2", "SELECT label, CASE WHEN npred = 0 THEN 0.0 ELSE tp / npred END AS precision, "
             "CASE WHEN support = 0 THEN 0.0 ELSE tp / support END AS recall, support, tp FROM per"),
    ("per3", "SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 "
             "ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM per2"),
], sql="""
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM per3
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(tp) / sum(support), 6), sum(support) FROM per3
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support) FROM per3
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6),
       round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), sum(support)
FROM per3
""")
def a11_class_report(spark, sf):
    s = _scores(spark, sf).withColumn("prediction", (F.col("score") >= 0.5).cast("int"))
    return round_floats(M.classification_report(s, "label", "prediction"))


@register("p17_alerts", views=["scores"], ctes=_CUM, sql="""
SELECT s.id, s.label, round(s.score, 6) AS score,
       CASE WHEN s.score >= r.threshold THEN 'ALERT: FAILURE IMMINENT' ELSE 'NORMAL' END AS alert,
       round(s.score * 100, 2) AS prob_pct
FROM scores s JOIN report r ON TRUE
""")
def p17_alerts(spark, sf):
    return round_floats(M.alerts(_scores(spark, sf), _best_threshold(spark, sf)))
