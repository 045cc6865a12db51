"""Named queries: one-hot, scaler, rolling/lag windows, engineered table."""

from __future__ import annotations

from faultline.operators import features as FE
from faultline.plans import oracle_ctes as C
from faultline.plans.inputs import labelled
from faultline.plans.registry import register
from faultline.plans.util import round_floats

NUMS = list(FE.NUMERIC_FEATURES)
# categories present in the role views (fitted from data on the Spark side)
CATS = {"model": [f"model{i}" for i in range(1, 5)],
        "errorid": [f"error{i}" for i in range(1, 6)],
        "comp_failure": [f"comp{i}" for i in range(1, 5)]}
BASE = ["datetime", "machine_id", "volt", "rotate", "pressure", "vibration", "seq", "age", "failed"]


def _dummies_sql(drop_first=False):
    out = []
    for c, vals in CATS.items():
        for v in (vals[1:] if drop_first else vals):
            out.append(f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS {c}_{v}")
    return ", ".join(out)


WIN = ("WINDOW w AS (PARTITION BY machine_id ORDER BY datetime, seq), "
       "w3 AS (PARTITION BY machine_id ORDER BY datetime, seq ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)")


def _roll_sql(c):
    return (f"avg({c}) OVER w3 AS {c}_roll_mean_3, "
            f"coalesce(stddev_samp({c}) OVER w3, 0) AS {c}_roll_std_3")


def _lag_sql(c):
    return f"coalesce(lag({c}) OVER w, {c}) AS {c}_lag_1"


@register("m1_one_hot", views=C.COMBINED_VIEWS, ctes=C.LABELLED,
          sql=f"SELECT {', '.join(BASE)}, {_dummies_sql()} FROM labelled")
def m1_one_hot(spark, sf):
    return FE.one_hot(labelled(spark, sf), FE.ONE_HOT_COLUMNS)


@register("m2_one_hot_drop_first", views=C.COMBINED_VIEWS, ctes=C.LABELLED,
          sql=f"SELECT {', '.join(BASE)}, {_dummies_sql(True)} FROM labelled")
def m2_one_hot_drop_first(spark, sf):
    return FE.one_hot(labelled(spark, sf), FE.ONE_HOT_COLUMNS, drop_first=True)


@register("w1_rolling_mean", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT datetime, machine_id, seq, {', '.join(f'round(avg({c}) OVER w3, 6) AS {c}_roll_mean_3' for c in NUMS)}
FROM labelled {WIN}""")
def w1_rolling_mean(spark, sf):
    out = FE.rolling_and_lag(labelled(spark, sf), NUMS)
    return round_floats(out.select("datetime", "machine_id", "seq", *[f"{c}_roll_mean_3" for c in NUMS]))


@register("w2_rolling_std", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT datetime, machine_id, seq,
       {', '.join(f'round(coalesce(stddev_samp({c}) OVER w3, 0), 6) AS {c}_roll_std_3' for c in NUMS)}
FROM labelled {WIN}""")
def w2_rolling_std(spark, sf):
    out = FE.rolling_and_lag(labelled(spark, sf), NUMS)
    return round_floats(out.select("datetime", "machine_id", "seq", *[f"{c}_roll_std_3" for c in NUMS]))


@register("w3_lag", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT datetime, machine_id, seq, {', '.join(_lag_sql(c) for c in NUMS)}
FROM labelled {WIN}""")
def w3_lag(spark, sf):
    out = FE.rolling_and_lag(labelled(spark, sf), NUMS)
    return out.select("datetime", "machine_id", "seq", *[f"{c}_lag_1" for c in NUMS])


@register("a6_scaler_fit", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", round(avg({c}), 6) AS mean, round(stddev_pop({c}), 6) AS std FROM labelled"
    for c in NUMS))
def a6_scaler_fit(spark, sf):
    return round_floats(FE.fit_scaler(labelled(spark, sf), NUMS))


@register("m3_standard_scale", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql=f"""
SELECT datetime, machine_id, seq, {', '.join(
    f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
    f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}" for c in NUMS)}
FROM labelled""")
def m3_standard_scale(spark, sf):
    df = labelled(spark, sf).select("datetime", "machine_id", "seq", *NUMS)
    scaled, _ = FE.standard_scale(df, NUMS)
    return round_floats(scaled)


_ENG = NUMS + FE.roll_columns(NUMS)
_FEAT_SQL = f"""
SELECT datetime, machine_id, volt, rotate, pressure, vibration, seq, age, failed, {_dummies_sql()},
       {', '.join(_roll_sql(c) for c in NUMS)}, {', '.join(_lag_sql(c) for c in NUMS)}
FROM labelled {WIN}"""


def _scaled_sql(c):
    return (f"round(({c} - avg({c}) OVER ()) / CASE WHEN stddev_pop({c}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({c}) OVER () END, 6) AS {c}")


@register("e1_engineered_table", views=C.COMBINED_VIEWS, ctes=C.LABELLED + [("feat", _FEAT_SQL)], sql=f"""
SELECT datetime, seq, failed, {', '.join(f'{c}_{v}' for c, vs in CATS.items() for v in vs)},
       {', '.join(_scaled_sql(c) for c in _ENG)}
FROM feat""")
def e1_engineered_table(spark, sf):
    out, _ = FE.engineer_features(labelled(spark, sf))
    return round_floats(out)
