"""Missing-value rules for outgoing records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def _bad_float(c: Column) -> Column:
    return F.isnan(c) | (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))


def zero_fill(df: DataFrame) -> DataFrame:
    """+-Inf, NaN and NULL -> 0 in numeric columns, NULL -> "0" in string columns.

    Other types are left as they are.
    """
    out = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(F.when(c.isNull() | _bad_float(c), F.lit(0.0)).otherwise(c).cast(f.dataType).alias(f.name))
        elif isinstance(f.dataType, _NUMERIC):
            out.append(F.coalesce(c, F.lit(0).cast(f.dataType)).alias(f.name))
        elif isinstance(f.dataType, T.StringType):
            out.append(F.coalesce(c, F.lit("0")).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


def _sanitize(c: Column, dt: T.DataType) -> Column:
    if isinstance(dt, (T.FloatType, T.DoubleType)):
        return F.when(_bad_float(c), F.lit(0.0).cast(dt)).otherwise(c)
    if isinstance(dt, T.StructType):
        return F.when(c.isNull(), F.lit(None)).otherwise(
            F.struct(*[_sanitize(c[f.name], f.dataType).alias(f.name) for f in dt.fields]))
    if isinstance(dt, T.ArrayType):
        return F.transform(c, lambda x: _sanitize(x, dt.elementType))
    if isinstance(dt, T.MapType):
        return F.transform_values(c, lambda k, v: _sanitize(v, dt.valueType))
    return c


def sanitize_nested(df: DataFrame) -> DataFrame:
    """NaN/Inf -> 0.0 at any depth (structs, arrays, maps); NULL and other values unchanged."""
    return df.select(*[_sanitize(F.col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
