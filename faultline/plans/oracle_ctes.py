"""DuckDB building blocks shared by the oracle statements (not used by Spark)."""

EVENTS_FIRST = [
    ("f1", "SELECT datetime, machine_id, arg_min(failure, seq) AS failure FROM failures GROUP BY datetime, machine_id"),
    ("e1", "SELECT datetime, machine_id, arg_min(errorid, seq) AS errorid FROM errors GROUP BY datetime, machine_id"),
    ("m1", "SELECT datetime, machine_id, arg_min(comp, seq) AS comp FROM maint GROUP BY datetime, machine_id"),
]

COMBINED = EVENTS_FIRST + [("combined", """
SELECT t.datetime, t.machine_id, t.volt, t.rotate, t.pressure, t.vibration, t.seq,
       mc.model, mc.age, f1.failure, e1.errorid, m1.comp
FROM telemetry t
LEFT JOIN machines mc ON t.machine_id = mc.machine_id
LEFT JOIN f1 ON t.datetime = f1.datetime AND t.machine_id = f1.machine_id
LEFT JOIN e1 ON t.datetime = e1.datetime AND t.machine_id = e1.machine_id
LEFT JOIN m1 ON t.datetime = m1.datetime AND t.machine_id = m1.machine_id
""")]

# combined -> comp_failure (P6) -> failed
LABELLED = COMBINED + [("labelled", """
SELECT datetime, machine_id, volt, rotate, pressure, vibration, seq, model, age, errorid,
       coalesce(failure, comp) AS comp_failure,
       CAST(coalesce(failure, comp) IS NOT NULL AS INTEGER) AS failed
FROM combined
""")]

COMBINED_VIEWS = ["telemetry", "machines", "failures", "errors", "maint"]

SANITIZED_MAINTENANCE = [("sanitized", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN operating_hours < 0 THEN NULL ELSE operating_hours END AS operating_hours,
       CASE WHEN temperature_c < 0 THEN NULL WHEN temperature_c > 150 THEN NULL ELSE temperature_c END AS temperature_c,
       CASE WHEN vibration_level_mm_per_s < 0 THEN NULL WHEN vibration_level_mm_per_s > 15 THEN NULL
            ELSE vibration_level_mm_per_s END AS vibration_level_mm_per_s,
       CASE WHEN load_percentage < 0 THEN 0e0 WHEN load_percentage > 100 THEN 100e0 ELSE load_percentage END
            AS load_percentage
FROM maintenance
""")]
