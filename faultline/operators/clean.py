"""Cleaning rules for sensor tables.

All rules are schema-tolerant: they act on the named columns that are present
and leave the others alone. Every rule is a single projection or filter, so a
chain of them stays inside one whole-stage-codegen span and adds no exchange.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from faultline.functions.names import resolve_column, standardize_columns
from faultline.functions.numeric import above_to_null, clip_keep_null, half_even, negative_to_null

# Fixed values that must equal the reference behaviour.
PERCENT_COLUMNS = ("load_percentage",)  # clipped to [0, 100]
NON_NEGATIVE_COLUMNS = (
    "operating_hours", "temperature_c", "vibration_level_mm_per_s", "maintenance_due_in_hours",
    "volt", "rotate", "pressure", "vibration", "age",
)
GLITCH_CEILINGS = {"vibration_level_mm_per_s": 15.0, "temperature_c": 150.0}  # strictly above -> NULL
ROUNDED_COLUMNS = (
    "temperature_c", "vibration_level_mm_per_s", "load_percentage", "maintenance_due_in_hours",
    "volt", "rotate", "pressure", "vibration",
)
ROUND_DIGITS = 2


def drop_exact_duplicates(df: DataFrame, ignore: str | None = None) -> DataFrame:
    """Drop rows equal in every column (hash aggregate with map-side pre-aggregation).

    ``ignore`` names a row number: rows that differ in it only are equal, the smallest stays.
    """
    if ignore is None or ignore not in df.columns:
        return df.dropDuplicates()
    others = [c for c in df.columns if c != ignore]
    return df.groupBy(*others).agg(F.min(ignore).alias(ignore)).select(*df.columns)


def parse_datetime(df: DataFrame, col: str = "datetime", fmt: str | None = None,
                   strict: bool = False) -> DataFrame:
    """String -> timestamp_ntz when the column exists and is not a timestamp yet.

    Unparsable text becomes NULL (``strict=True`` raises instead, like pandas).
    """
    if col not in df.columns:
        return df
    dtype = dict(df.dtypes)[col]
    if dtype.startswith("timestamp"):
        return df.withColumn(col, F.col(col).cast("timestamp_ntz"))
    if strict:
        parsed = F.to_timestamp_ntz(F.col(col), F.lit(fmt)) if fmt else F.col(col).cast("timestamp_ntz")
    else:
        parsed = (F.try_to_timestamp(F.col(col), F.lit(fmt)) if fmt
                  else F.col(col).try_cast("timestamp_ntz"))
    return df.withColumn(col, parsed.cast("timestamp_ntz"))


def sanitize_physical(df: DataFrame, *, standardize_names: bool = True) -> DataFrame:
    """P1 + P3 + P4 + P5 in one projection.

    load_percentage clipped to [0, 100] (NULL stays NULL); negative physical
    readings -> NULL; vibration_level_mm_per_s > 15 and temperature_c > 150 -> NULL.
    """
    if standardize_names:
        df = standardize_columns(df)
    exprs = []
    for c in df.columns:
        e, touched = F.col(c), False
        if c in PERCENT_COLUMNS:
            e, touched = clip_keep_null(e, 0.0, 100.0), True
        if c in NON_NEGATIVE_COLUMNS:
            e, touched = negative_to_null(e), True
        if c in GLITCH_CEILINGS:
            e, touched = above_to_null(e, GLITCH_CEILINGS[c]), True
        exprs.append(e.alias(c) if touched else F.col(c))
    return df.select(*exprs)


def merge_failure_component(df: DataFrame) -> DataFrame:
    """``comp_failure`` = first non-null of failure, comp; both are dropped.

    Only ``failure`` present -> it is renamed. Neither -> unchanged.
    """
    fail = resolve_column(df, "failure")
    comp = resolve_column(df, "comp")
    if fail and comp:
        keep = [c for c in df.columns if c not in (fail, comp)]
        return df.select(*keep, F.coalesce(F.col(fail), F.col(comp)).alias("comp_failure"))
    if fail:
        keep = [c for c in df.columns if c != fail]
        return df.select(*keep, F.col(fail).alias("comp_failure"))
    return df


def add_failed_flag(df: DataFrame) -> DataFrame:
    """failed = comp_failure IS NOT NULL (int). No comp_failure column -> unchanged."""
    if "comp_failure" not in df.columns:
        return df
    return df.withColumn("failed", F.col("comp_failure").isNotNull().cast("int"))


def error_column(df: DataFrame) -> str | None:
    return resolve_column(df, "errorid")


def unresolved_error_mask(df: DataFrame):
    """P8 mask: comp_failure unknown but an error was logged."""
    err = error_column(df)
    if err is None or "comp_failure" not in df.columns:
        return F.lit(False)
    return F.col("comp_failure").isNull() & F.col(err).isNotNull()


def unresolved_errors(df: DataFrame) -> DataFrame:
    """Rows whose failure component is unknown although an error was logged."""
    return df.filter(unresolved_error_mask(df))


def round_precision(df: DataFrame, columns=ROUNDED_COLUMNS, digits: int = ROUND_DIGITS) -> DataFrame:
    """Half-even rounding of the named float columns that are present."""
    cols = set(columns)
    return df.select(*[half_even(c, digits).alias(c) if c in cols else F.col(c) for c in df.columns])


def drop_if_present(df: DataFrame, *names: str) -> DataFrame:
    """P10: drop columns, resolving names case- and underscore-insensitively."""
    found = [resolve_column(df, n) for n in names]
    return df.drop(*[f for f in found if f])


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """A2: counts per value, NULL included, for several columns in one pass.

    The columns are unpivoted into (column, value) and grouped once, so one
    shuffle serves all columns. Output: column, value (string), n.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        raise ValueError(f"none of {columns} present")
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in present
    ])).alias("kv")).select("kv.*")
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def missing_counts(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A3: number of NULL (or NaN) values per column, one global aggregate.

    Output: one row per column (column, n_missing) plus a row ``__total__``.
    """
    cols = columns or df.columns
    dtypes = dict(df.dtypes)

    def miss(c):
        e = F.col(c).isNull()
        if dtypes[c] in ("double", "float"):
            e = e | F.isnan(F.col(c))
        return F.sum(e.cast("long"))

    agg = df.agg(*[miss(c).alias(f"m{i}") for i, c in enumerate(cols)])
    rows = [F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("n_missing")) for i, c in enumerate(cols)]
    total = reduce(lambda a, b: a + b, [F.col(f"m{i}") for i in range(len(cols))])
    rows.append(F.struct(F.lit("__total__").alias("column"), total.alias("n_missing")))
    return agg.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def shape(df: DataFrame) -> DataFrame:
    """A4: one row (n_rows, n_cols)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn("n_cols", F.lit(len(df.columns)))
