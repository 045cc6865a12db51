"""Writers (S11) and fitted-parameter artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from faultline.sources.manifest import is_component_table


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite ``path`` with ``df`` (parquet by default; csv with a header row)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.format(fmt).save(path)


def write_ingested(tables: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> list[str]:
    """Write every ingested table as ``<name>_ingested`` except the PdM component
    tables (exact name match, D5). Returns the written names."""
    written = []
    for name, df in tables.items():
        if is_component_table(name):
            continue
        write_table(df, f"{out_dir}/{name}_ingested", fmt)
        written.append(name)
    return written


def save_params(params: DataFrame, path: str) -> None:
    """A fitted params table (scaler: column, mean, std; categories: column, category, position, place)."""
    params.coalesce(1).write.mode("overwrite").parquet(path)


def load_scaler_params(spark: SparkSession, path: str) -> dict[str, tuple[float, float]]:
    return {r["column"]: (r["mean"], r["std"]) for r in spark.read.parquet(path).collect()}


def load_categories(spark: SparkSession, path: str) -> dict[str, list[str]]:
    out: dict[str, list[str]] = {}
    saved = spark.read.parquet(path)
    order = [c for c in ("place", "column", "position") if c in saved.columns]  # dummies keep the order of their columns
    for r in saved.orderBy(*order).collect():
        out.setdefault(r["column"], []).append(r["category"])
    return out
