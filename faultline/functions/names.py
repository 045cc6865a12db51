"""Column and table name rules."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# Fixed values that must equal the reference behaviour.
# Table-name fragments removed when normalising a file stem, in this order:
TABLE_NAME_DROP_FRAGMENTS = ("_ingested", "pdm_", "microsoft_azure_pmd_raw_v1_")
# Characters removed from column names:
COLUMN_NAME_DROP_CHARS = r"[()%]"


def standardize_column_name(name: str) -> str:
    """``Vibration Level (mm/s)`` -> ``vibration_level_mm_per_s``.

    Order: strip, machineID -> machine_id (any case), lower case, drop ( ) %,
    "/" -> "_per_", strip, whitespace runs -> "_".
    """
    s = name.strip()
    s = re.sub("machineid", "machine_id", s, flags=re.IGNORECASE)
    s = s.lower()
    s = re.sub(COLUMN_NAME_DROP_CHARS, "", s)
    s = s.replace("/", "_per_")
    s = s.strip()
    return re.sub(r"\s+", "_", s)


def standardize_columns(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`standardize_column_name` (a metadata-only projection)."""
    new = [standardize_column_name(c) for c in df.columns]
    dup = sorted({n for n in new if new.count(n) > 1})
    if dup:
        raise ValueError(f"column names collide after standardisation: {dup}")
    return df.toDF(*new)


def normalize_table_name(stem: str) -> str:
    s = stem.lower()
    for frag in TABLE_NAME_DROP_FRAGMENTS:
        s = s.replace(frag, "")
    return s.strip()


def _loose(name: str) -> str:
    return name.replace("_", "").lower()


def resolve_column(df_or_cols, name: str) -> str | None:
    """Find ``name`` among the columns, ignoring case and underscores.

    ``machineID``, ``machine_id`` and ``MachineId`` all resolve to the same
    column; returns the actual column name or None.
    """
    cols = df_or_cols.columns if isinstance(df_or_cols, DataFrame) else list(df_or_cols)
    if name in cols:
        return name
    want = _loose(name)
    for c in cols:
        if _loose(c) == want:
            return c
    return None
