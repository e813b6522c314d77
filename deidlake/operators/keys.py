"""Null-safe keys as plain columns.

``a <=> b`` equals ``coalesce(a, d) = coalesce(b, d) AND isnull(a) =
isnull(b)`` for a type default ``d``.  Materialising these two columns
lets an aggregate and a join on the same key share ONE hash partitioning
(Spark's own rewrite of ``<=>`` uses expressions the aggregate does not
produce, which costs an extra shuffle of the whole input)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _default(dtype: T.DataType) -> Column | None:
    if isinstance(dtype, (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
                          T.DecimalType)):
        return F.lit(0).cast(dtype)
    if isinstance(dtype, T.StringType):
        return F.lit("")
    if isinstance(dtype, T.BooleanType):
        return F.lit(False)
    if isinstance(dtype, T.DateType):
        return F.lit("1970-01-01").cast(dtype)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.lit("1970-01-01 00:00:00").cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.lit(bytearray())
    return None


def key_columns(df: DataFrame, keys, prefix: str = "_k") -> list[Column]:
    """Two columns per key (value-or-default, is-null); a key of a type
    without a default keeps its value and relies on ``<=>``-free equality
    of ``to_json``."""
    out = []
    for i, k in enumerate(keys):
        c = df[k]
        d = _default(df.schema[k].dataType)
        value = F.coalesce(c, d) if d is not None else F.coalesce(F.to_json(F.array(c)), F.lit(""))
        out.append(value.alias(f"{prefix}{i}v"))
        out.append(c.isNull().alias(f"{prefix}{i}n"))
    return out


def key_names(keys, prefix: str = "_k") -> list[str]:
    return [f"{prefix}{i}{s}" for i in range(len(keys)) for s in ("v", "n")]


def _has_map(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_map(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_map(f.dataType) for f in dtype.fields)
    return isinstance(dtype, (T.MapType, T.VariantType))


def check_orderable(df: DataFrame, keys) -> None:
    """One row per key is picked by the order of its other columns: a column
    without an order is refused by name (turn it into JSON text first)."""
    bad = [f.name for f in df.schema.fields if f.name not in keys and _has_map(f.dataType)]
    if bad:
        raise TypeError(f"columns {bad} hold maps, which have no order; convert them, e.g. by to_json")
