"""Column expressions over numbers."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from undercut.schemas import CORNERS


def quantise2(value: Column) -> Column:
    """Two decimals, halves toward plus infinity; NaN becomes 0.

    The fraction is compared instead of adding 0.5, which would lift the largest
    double below one half. From 2**52 on a double has no fraction left.
    """
    scaled = value * 100.0
    whole = F.floor(scaled)
    up = (scaled - whole.cast("double") >= 0.5) & (F.abs(scaled) < float(1 << 52))
    return (whole + F.when(up, 1).otherwise(0)).cast("double") / 100.0


def corner_sum(reading: str) -> Column:
    """Sum of a four-corner reading such as ``tire_wear``."""
    return reduce(add, [F.col(f"{reading}_{corner}").cast("double") for corner in CORNERS])


def clip01(value: Column) -> Column:
    """Clip to [0, 1]; null and NaN give null (``least`` would skip the null)."""
    clipped = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return F.when(value.isNotNull() & ~F.isnan(value), clipped)


def finite(value: Column) -> Column:
    """The value, or null for NaN and the infinities."""
    return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)


def has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return has_float(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return has_float(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(has_float(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.DoubleType, T.FloatType))


def finite_deep(value: Column, dtype: T.DataType) -> Column:
    """``finite`` through structs, arrays and map values."""
    if not has_float(dtype):
        return value
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: finite_deep(x, dtype.elementType))
    if isinstance(dtype, T.MapType):
        return F.transform_values(value, lambda _, x: finite_deep(x, dtype.valueType))
    if isinstance(dtype, T.StructType):
        inner = [finite_deep(value.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*inner))
    return finite(value)
