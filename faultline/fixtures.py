"""Domain role views over the driver tables.

The driver tables are generic (events, customer, lineitem, part); the views
below give them the shape of the machine-health domain. The SQL text is the
same for Spark and DuckDB except for three engine tokens, so the DuckDB
oracle queries can embed exactly the input the Spark queries read.

Tokens: ``{TS}`` timestamp-without-zone type, ``{S}`` string type,
``{J}`` JSON field extraction of ``props.k``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_TOKENS = {
    "spark": {"TS": "timestamp_ntz", "S": "string", "J": "get_json_object(props, '$.k')"},
    "duckdb": {"TS": "timestamp", "S": "varchar", "J": "json_extract_string(props, '$.k')"},
}

_EVENT_TABLE = """
SELECT CAST(date_trunc('day', ts) AS {{TS}}) AS datetime, user_id AS machine_id,
       concat('{prefix}', CAST(1 + event_id % {mod} AS {{S}})) AS {column}, event_id AS seq
FROM events WHERE event_type = '{etype}'
"""

ROLE_VIEWS: dict[str, str] = {
    "telemetry": """
SELECT CAST(date_trunc('day', ts) AS {TS}) AS datetime, user_id AS machine_id,
       max(value) AS volt, min(value) AS rotate, CAST(count(*) AS double) AS pressure,
       round(max(value) - min(value), 2) AS vibration, min(event_id) AS seq
FROM events WHERE event_type IN ('view', 'click')
GROUP BY CAST(date_trunc('day', ts) AS {TS}), user_id
""",
    "machines": """
SELECT c_custkey + CASE WHEN c_custkey % 17 = 3 THEN 100000000 ELSE 0 END AS machine_id, concat('model', CAST(1 + c_nationkey % 4 AS {S})) AS model,
       c_nationkey AS age
FROM customer
""",
    "failures": _EVENT_TABLE.format(prefix="comp", mod=4, column="failure",
                                    etype="purchase"),
    "errors": _EVENT_TABLE.format(prefix="error", mod=5, column="errorid",
                                  etype="error"),
    "maint": _EVENT_TABLE.format(prefix="comp", mod=4, column="comp",
                                 etype="signup"),
    "maintenance": """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_partkey % 11 = 0 THEN NULL ELSE l_extendedprice / 100 - 20 END AS operating_hours,
       CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_quantity * 4 - 20 END AS temperature_c,
       l_tax * 250 - 1 AS vibration_level_mm_per_s,
       CASE WHEN l_linenumber = 3 THEN NULL ELSE l_quantity * 2.5e0 - 10 END AS load_percentage
FROM lineitem
""",
    "envelopes": """
SELECT concat('evt_', CAST(event_id - CASE WHEN event_id % 10 = 1 THEN 1 ELSE 0 END AS {S})) AS event_id,
       event_id AS seq, ts AS event_time,
       CASE WHEN event_id % 19 = 0 THEN NULL ELSE value END AS temperature,
       CAST({J} AS double) AS pressure, CAST(user_id AS double) AS sensor_value,
       CASE WHEN event_id % 5 = 0 THEN NULL
            ELSE concat('img_', CAST(event_id - event_id % 3 AS {S})) END AS image_path
FROM events
""",
    # detected objects: every part, four to an image; three events share an image and
    # many images have no detection, so lists stay short at any scale factor
    "detections": """
SELECT concat('img_', CAST((p_partkey - p_partkey % 4) * 3 AS {S})) AS image_path, p_type AS class_name
FROM part
""",
    "scores": """
SELECT event_id AS id, CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS label,
       (least(floor(value), 199) + CASE WHEN event_type = 'error' THEN 40 ELSE 0 END) / 240e0 AS score
FROM events
""",
}


def view_sql(name: str, engine: str = "spark") -> str:
    return ROLE_VIEWS[name].format(**_TOKENS[engine]).strip()


def with_views(names: list[str], body: str, engine: str = "duckdb") -> str:
    """Prefix ``body`` with the role views it reads as CTEs."""
    ctes = ",\n".join(f"{n} AS (\n{view_sql(n, engine)}\n)" for n in names)
    return f"WITH {ctes}\n{body.strip()}"


def register_base_tables(spark: SparkSession, sf_dir: str, names=BASE_TABLES) -> None:
    for t in names:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)


_REGISTERED: dict[int, str] = {}


def role_view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Role view ``name`` as a DataFrame over the parquet tables in ``sf_dir``.

    Base tables are (re-)registered when ``sf_dir`` changes for this session.
    """
    key = id(spark)
    if _REGISTERED.get(key) != sf_dir:
        register_base_tables(spark, sf_dir)
        _REGISTERED[key] = sf_dir
    return spark.sql(view_sql(name, "spark"))


def role_tables(spark: SparkSession, sf_dir: str, names=("telemetry", "machines", "failures", "errors", "maint")):
    return {n: role_view(spark, sf_dir, n) for n in names}
