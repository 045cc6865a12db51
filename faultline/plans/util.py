"""Output helpers of the named queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

R6 = 6  # digits of float outputs compared with the oracle (summation order differs by engine)


def round_floats(df: DataFrame, digits: int = R6) -> DataFrame:
    types = dict(df.dtypes)
    return df.select(*[F.round(c, digits).alias(c) if types[c] in ("double", "float") else F.col(c)
                       for c in df.columns])


def sql_round(expr: str, digits: int = R6) -> str:
    return f"round({expr}, {digits})"
