import numpy as np
import pytest

from faultline.operators import metrics as M
from faultline.operators.metrics import _descending_prefix, score_counts


def ref_curve(y, s):
    """Hand-written precision-recall curve (all distinct scores kept)."""
    y, s = np.asarray(y), np.asarray(s, float)
    th = np.unique(s)
    P = y.sum()
    prec, rec = [], []
    for t in th:
        pred = s >= t
        tp, fp = (pred & (y == 1)).sum(), (pred & (y == 0)).sum()
        prec.append(tp / (tp + fp) if tp + fp else 0.0)
        rec.append(tp / P if P else 1.0)
    prec, rec = np.array(prec + [1.0]), np.array(rec + [0.0])
    auc = -np.trapezoid(prec, rec)
    f1 = 2 * prec * rec / (prec + rec + 1e-10)
    b = int(np.argmax(f1))
    thr = th[b] if b < len(th) else 0.5
    pred = s >= thr
    tp, fp = (pred & (y == 1)).sum(), (pred & (y == 0)).sum()
    return th, prec, rec, auc, thr, f1[b], (tp / (tp + fp) if tp + fp else 0.0), (tp / P if P else 0.0)


CASES = {
    "mixed": ([1, 0, 1, 1, 0, 0, 1, 0], [0.9, 0.8, 0.8, 0.4, 0.3, 0.3, 0.2, 0.1]),
    "all_equal": ([1, 0, 1, 0], [0.5, 0.5, 0.5, 0.5]),
    "no_positives": ([0, 0, 0], [0.2, 0.4, 0.9]),
    "perfect": ([0, 0, 1, 1], [0.1, 0.2, 0.8, 0.9]),
}


@pytest.mark.parametrize("name", list(CASES))
def test_curve_and_report(spark, name):
    y, s = CASES[name]
    df = spark.createDataFrame(list(zip(range(len(y)), y, s)), "id long, label int, score double")
    th, prec, rec, auc, thr, f1, p, r = ref_curve(y, s)
    curve = M.pr_curve(df).collect()
    got = sorted([(c.threshold if c.threshold is not None else 9e9, c.precision, c.recall) for c in curve])
    want = sorted(list(zip(list(th) + [9e9], prec, rec)))
    np.testing.assert_allclose(np.array(got), np.array(want), atol=1e-12)
    rep = M.evaluation_report(df).first()
    assert rep.pr_auc == pytest.approx(auc, abs=1e-12)
    assert rep.threshold == pytest.approx(thr) and rep.f1 == pytest.approx(f1)
    assert rep.precision == pytest.approx(p) and rep.recall == pytest.approx(r)
    at = M.precision_recall_at(df, rep.threshold).first()
    assert at.precision == pytest.approx(p) and at.recall == pytest.approx(r)


def test_prefix_sums_over_range_partitions(spark):
    rng = np.random.default_rng(3)
    s = rng.integers(0, 500, 3000) / 500
    y = (rng.random(3000) < s).astype(int)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = {r.threshold: (r.tps, r.fps) for r in _descending_prefix(score_counts(df)).collect()}
    for t in (0.0, 0.25, 0.5, 0.998):
        if t in got:
            assert got[t] == (int(((s >= t) & (y == 1)).sum()), int(((s >= t) & (y == 0)).sum()))
    assert len(got) == len(np.unique(s))


def test_class_weights_and_report(spark):
    df = spark.createDataFrame([(1, 1), (0, 0), (0, 1), (0, 0)], "label int, prediction int")
    w = {r.label: (r.n, r.weight, r.pos_weight) for r in M.class_weights(df).collect()}
    assert w[1] == (1, 1.0, 3.0) and w[0][1] == pytest.approx(1 / 3)
    rep = {r.label: r for r in M.classification_report(df).collect()}
    assert rep["1"].precision == 0.5 and rep["1"].recall == 1.0 and rep["0"].recall == pytest.approx(2 / 3)
    assert rep["accuracy"].f1 == 0.75 and rep["accuracy"].support == 4
    assert rep["macro avg"].precision == pytest.approx(0.75)
    al = M.alerts(spark.createDataFrame([(0.7,), (0.2,)], "score double"), None).collect()
    assert [a.alert for a in al] == ["ALERT: FAILURE IMMINENT", "NORMAL"] and al[0].prob_pct == 70.0
