"""Named queries: KNN imputation (M4) and component classification (M5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.fixtures import role_view
from faultline.operators import clean
from faultline.operators.knn import knn_classify_component, knn_impute
from faultline.plans import oracle_ctes as C
from faultline.plans.inputs import combined
from faultline.plans.registry import register
from faultline.plans.util import round_floats

DUMMIES = ["model2", "model3", "model4"]  # drop-first dummies of model in the role views


def _z(expr, name):
    return (f"({expr} - avg({expr}) OVER ()) / CASE WHEN stddev_pop({expr}) OVER () = 0 THEN 1 "
            f"ELSE stddev_pop({expr}) OVER () END AS {name}")


# M4 on the telemetry path: only `age` (+ model dummies) of the sensor list is present.
M4_CTES = C.COMBINED + [
    ("enc4", "SELECT seq, age, " + ", ".join(
        f"CASE WHEN model = '{m}' THEN 1.0 ELSE 0.0 END AS d_{m}" for m in DUMMIES) + " FROM combined"),
    ("z4", "SELECT seq, age, " + _z("age", "z_age") + ", " + ", ".join(_z(f"d_{m}", f"z_{m}") for m in DUMMIES)
     + " FROM enc4"),
    ("pairs4", "SELECT t.seq AS tid, d.seq AS did, d.age AS val, round(sqrt(4.0 / 3.0 * ("
     + " + ".join(f"(t.z_{m} - d.z_{m}) * (t.z_{m} - d.z_{m})" for m in DUMMIES)
     + ")), 9) AS dq FROM z4 t JOIN z4 d ON t.age IS NULL AND d.age IS NOT NULL"),
    ("top4", "SELECT tid, avg(val) AS age_hat FROM (SELECT *, row_number() OVER "
     "(PARTITION BY tid ORDER BY dq, did) AS rk FROM pairs4) WHERE rk <= 5 GROUP BY tid"),
    ("imputed", "SELECT c.datetime, c.machine_id, c.volt, c.rotate, c.pressure, c.vibration, c.seq, c.model, "
     "CASE WHEN c.age IS NULL THEN t.age_hat ELSE c.age END AS age, c.failure, c.errorid, c.comp "
     "FROM combined c LEFT JOIN top4 t ON c.seq = t.tid"),
]


@register("m4_knn_impute_telemetry", views=C.COMBINED_VIEWS, ctes=M4_CTES,
          sql="SELECT seq, machine_id, round(age, 6) AS age FROM imputed")
def m4_knn_impute_telemetry(spark, sf):
    df = clean.sanitize_physical(combined(spark, sf))
    return round_floats(knn_impute(df, id_col="seq").select(
        "seq", "machine_id", F.col("age").cast("double").alias("age")))


NUM5 = ["volt", "rotate", "pressure", "vibration", "age"]
M5_CTES = M4_CTES + [
    ("lab5", "SELECT *, coalesce(failure, comp) AS comp_failure FROM imputed"),
    ("z5", "SELECT seq, comp_failure, errorid, " + ", ".join(_z(c, f"z_{c}") for c in NUM5) + ", "
     + ", ".join(_z(f"CASE WHEN model = '{m}' THEN 1.0 ELSE 0.0 END", f"z_{m}") for m in DUMMIES)
     + " FROM lab5"),
    ("pairs5", "SELECT t.seq AS tid, d.seq AS did, d.comp_failure AS lab, round(sqrt("
     + " + ".join(f"(t.z_{c} - d.z_{c}) * (t.z_{c} - d.z_{c})" for c in NUM5 + DUMMIES)
     + "), 9) AS dq FROM z5 t JOIN z5 d ON t.comp_failure IS NULL AND t.errorid IS NOT NULL "
     "AND d.comp_failure IS NOT NULL"),
    ("votes5", "SELECT tid, lab, count(*) AS v FROM (SELECT *, row_number() OVER "
     "(PARTITION BY tid ORDER BY dq, did) AS rk FROM pairs5) WHERE rk <= 5 GROUP BY tid, lab"),
    ("pred5", "SELECT tid, lab AS pred FROM (SELECT *, row_number() OVER "
     "(PARTITION BY tid ORDER BY v DESC, lab) AS r FROM votes5) WHERE r = 1"),
]


@register("m5_knn_component", views=C.COMBINED_VIEWS, ctes=M5_CTES, sql="""
SELECT seq, machine_id, coalesce(comp_failure, pred) AS comp_failure,
       CAST(coalesce(comp_failure, pred) IS NOT NULL AS INTEGER) AS failed
FROM lab5 LEFT JOIN pred5 ON seq = tid
""")
def m5_knn_component(spark, sf):
    df = clean.sanitize_physical(combined(spark, sf))
    df = knn_impute(df, id_col="seq")
    df = clean.merge_failure_component(df)
    out = knn_classify_component(df, id_col="seq")
    return out.select("seq", "machine_id", "comp_failure", "failed")


# M4 on the maintenance table: all pairs on the coordinates both have, the five best by (distance, place of the key).
# Distance and place are one number, so that the smallest five are an aggregate and no pair is written.
SENSORS4 = ["temperature_c", "vibration_level_mm_per_s", "load_percentage", "operating_hours"]
KEY4 = "l_orderkey, l_partkey, l_suppkey, l_linenumber"
_SHARED = " + ".join(f"CASE WHEN t.z{j} IS NULL OR d.z{j} IS NULL THEN 0 ELSE 1 END" for j in range(4))
_GAPS = " + ".join(f"coalesce((t.z{j} - d.z{j}) * (t.z{j} - d.z{j}), 0e0)" for j in range(4))
M4_MAINTENANCE = C.SANITIZED_MAINTENANCE + [
    ("zm", f"SELECT row_number() OVER (ORDER BY {KEY4}) AS did, *, " + ", ".join(
        _z(c, f"z{j}") for j, c in enumerate(SENSORS4)) + " FROM sanitized"),
    ("tm", "SELECT z0, z1, z2, z3, min(did) AS tid FROM zm WHERE z0 IS NULL OR z1 IS NULL OR z2 IS NULL OR z3 IS NULL "
           "GROUP BY z0, z1, z2, z3"),
    ("pm", f"SELECT t.tid, t.z0 AS t0, t.z1 AS t1, t.z2 AS t2, t.z3 AS t3, d.z0, d.z1, d.z2, d.z3, "
           f"CAST(round(sqrt(4e0 * ({_GAPS}) / nullif({_SHARED}, 0)) * 1e9) AS BIGINT) * 1048576 + d.did AS k "
           "FROM tm t JOIN zm d ON TRUE"),
    ("nm", "SELECT tid, " + ", ".join(f"min(k, 5) FILTER (t{j} IS NULL AND z{j} IS NOT NULL) AS n{j}" for j in range(4))
           + " FROM pm WHERE k IS NOT NULL GROUP BY tid"),
    *[(f"em{j}", f"SELECT tid, avg({c}) AS e FROM (SELECT tid, unnest(n{j}) % 1048576 AS did FROM nm) JOIN zm USING (did) "
                 "GROUP BY tid") for j, c in enumerate(SENSORS4)],
]


@register("m4_knn_impute_maintenance", views=["maintenance"], ctes=M4_MAINTENANCE,
          sql=f"SELECT {KEY4}, " + ", ".join(
              f"round(CASE WHEN zm.{c} IS NOT NULL THEN zm.{c} ELSE coalesce(em{j}.e, avg(zm.{c}) OVER ()) END, 6) AS {c}"
              for j, c in enumerate(SENSORS4))
          + " FROM zm LEFT JOIN tm ON " + " AND ".join(f"zm.z{j} IS NOT DISTINCT FROM tm.z{j}" for j in range(4))
          + "".join(f" LEFT JOIN em{j} ON em{j}.tid = tm.tid" for j in range(4)))
def m4_knn_impute_maintenance(spark, sf):
    """Whole maintenance table, ties by its four key columns."""
    df = clean.sanitize_physical(role_view(spark, sf, "maintenance"))
    return round_floats(knn_impute(df, id_col=KEY4.split(", ")))
