"""Named queries: combine, cleaning rules, counts."""

from __future__ import annotations


from faultline.fixtures import role_tables, role_view
from faultline.operators import clean
from faultline.operators.combine import first_per_key
from faultline.plans import oracle_ctes as C
from faultline.plans.inputs import combined, labelled, sanitized_maintenance
from faultline.plans.registry import register



@register("j1_machine_lookup", views=["telemetry", "machines"], sql="""
SELECT t.*, mc.model, mc.age FROM telemetry t LEFT JOIN machines mc ON t.machine_id = mc.machine_id
""")
def j1_machine_lookup(spark, sf):
    t = role_tables(spark, sf, ("telemetry", "machines"))
    return t["telemetry"].join(t["machines"], "machine_id", "left")


@register("a1b_first_failure_per_key", views=["failures"], sql="""
SELECT datetime, machine_id, arg_min(failure, seq) AS failure FROM failures GROUP BY datetime, machine_id
""")
def a1b_first_failure_per_key(spark, sf):
    return first_per_key(role_view(spark, sf, "failures"), ["datetime", "machine_id"], order_col="seq")


@register("j4_combine", views=C.COMBINED_VIEWS, ctes=C.COMBINED, sql="SELECT * FROM combined")
def j4_combine(spark, sf):
    return combined(spark, sf)


@register("j3_combine_fanout", views=C.COMBINED_VIEWS, sql="""
SELECT t.*, mc.model, mc.age, f.failure, e.errorid, m.comp
FROM telemetry t
LEFT JOIN machines mc ON t.machine_id = mc.machine_id
LEFT JOIN failures f ON t.datetime = f.datetime AND t.machine_id = f.machine_id
LEFT JOIN errors e ON t.datetime = e.datetime AND t.machine_id = e.machine_id
LEFT JOIN maint m ON t.datetime = m.datetime AND t.machine_id = m.machine_id
""")
def j3_combine_fanout(spark, sf):
    return combined(spark, sf, dedup_events=False)


@register("p7_failure_label", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql="SELECT * FROM labelled")
def p7_failure_label(spark, sf):
    return labelled(spark, sf)


@register("a2_value_counts", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql="""
SELECT 'comp_failure' AS "column", CAST(comp_failure AS VARCHAR) AS value, count(*) AS n
FROM labelled GROUP BY comp_failure
UNION ALL
SELECT 'errorid', CAST(errorid AS VARCHAR), count(*) FROM labelled GROUP BY errorid
UNION ALL
SELECT 'failed', CAST(failed AS VARCHAR), count(*) FROM labelled GROUP BY failed
""")
def a2_value_counts(spark, sf):
    return clean.value_counts(labelled(spark, sf), ["comp_failure", "errorid", "failed"])


@register("p8_unresolved_errors", views=C.COMBINED_VIEWS, ctes=C.LABELLED, sql="""
SELECT * FROM labelled WHERE comp_failure IS NULL AND errorid IS NOT NULL
""")
def p8_unresolved_errors(spark, sf):
    return clean.unresolved_errors(labelled(spark, sf))


@register("a4_shape", views=C.COMBINED_VIEWS, ctes=C.COMBINED, sql="""
SELECT count(*) AS n_rows, 12 AS n_cols FROM combined
""")
def a4_shape(spark, sf):
    return clean.shape(combined(spark, sf))


@register("p5_sanitize_maintenance", views=["maintenance"], ctes=C.SANITIZED_MAINTENANCE,
          sql="SELECT * FROM sanitized")
def p5_sanitize_maintenance(spark, sf):
    return sanitized_maintenance(spark, sf)


@register("p9_round_half_even", views=["maintenance"], ctes=C.SANITIZED_MAINTENANCE, sql="""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, operating_hours,
       round_even(temperature_c, 2) AS temperature_c,
       round_even(vibration_level_mm_per_s, 2) AS vibration_level_mm_per_s,
       round_even(load_percentage, 2) AS load_percentage
FROM sanitized
""")
def p9_round_half_even(spark, sf):
    return clean.round_precision(sanitized_maintenance(spark, sf))


@register("a1a_drop_duplicates", views=["maintenance"], ctes=C.SANITIZED_MAINTENANCE, sql="""
SELECT DISTINCT temperature_c, vibration_level_mm_per_s, load_percentage FROM sanitized
""")
def a1a_drop_duplicates(spark, sf):
    return clean.drop_exact_duplicates(
        sanitized_maintenance(spark, sf).select("temperature_c", "vibration_level_mm_per_s", "load_percentage"))


@register("a3_missing_counts", views=["maintenance"], ctes=C.SANITIZED_MAINTENANCE, sql="""
SELECT "column", n_missing FROM (
  SELECT 'operating_hours' AS "column", count(*) - count(operating_hours) AS n_missing FROM sanitized
  UNION ALL SELECT 'temperature_c', count(*) - count(temperature_c) FROM sanitized
  UNION ALL SELECT 'vibration_level_mm_per_s', count(*) - count(vibration_level_mm_per_s) FROM sanitized
  UNION ALL SELECT 'load_percentage', count(*) - count(load_percentage) FROM sanitized
  UNION ALL SELECT '__total__', 4 * count(*) - count(operating_hours) - count(temperature_c)
                               - count(vibration_level_mm_per_s) - count(load_percentage) FROM sanitized
)
""")
def a3_missing_counts(spark, sf):
    return clean.missing_counts(sanitized_maintenance(spark, sf),
                                ["operating_hours", "temperature_c", "vibration_level_mm_per_s", "load_percentage"])
