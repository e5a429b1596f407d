"""Canonical text of a row and its hash."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def canonical_text(c: Column, dtype: T.DataType, scale: int | None = None) -> Column:
    """Text that is equal exactly when two values of ``dtype`` are.

    Floating point values are taken as they are (zero has one sign); with a ``scale`` they are rounded to it.
    Instants go through microseconds, so the session zone does not matter.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        exact = (c + F.lit(0.0).cast(dtype)).cast("string")
        if scale is None:
            return exact
        return F.coalesce(c.try_cast(T.DecimalType(38, scale)).cast("string"), exact)
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(dtype, (T.MapType, T.StructType, T.ArrayType)):
        return F.to_json(_inner(c, dtype), {"ignoreNullFields": "false"})
    return c.cast("string")


def _inner(c: Column, dtype: T.DataType) -> Column:
    """A nested value with its inner values as canonical text, so that JSON cannot round them; maps as sorted entries."""
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _inner(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        parts = [_inner(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(c.isNotNull(), F.struct(*parts)) if parts else c
    if isinstance(dtype, T.MapType):
        return F.transform(
            F.array_sort(F.map_entries(c)),
            lambda e: F.struct(
                _inner(e["key"], dtype.keyType).alias("key"), _inner(e["value"], dtype.valueType).alias("value")
            ),
        )
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.TimestampType, T.TimestampNTZType, T.BinaryType)):
        return canonical_text(c, dtype)
    return c


def hashable(c: Column, dtype: T.DataType, scale: int | None = None) -> tuple[Column, Column | None]:
    """A value that Spark's own hash functions tell apart exactly where ``canonical_text`` does.

    Where a compact value cannot hold everything (a rounded double beyond 18 digits, not a number), the second Column
    gives the text of what it misses.
    """
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        if scale is None:
            return c + F.lit(0.0).cast(dtype), None
        compact = c.try_cast(T.DecimalType(18, scale))
        return compact, F.when(compact.isNull(), canonical_text(c, dtype, scale))
    if isinstance(dtype, (T.MapType, T.StructType, T.ArrayType)):
        return canonical_text(c, dtype, scale), None
    return c, None


def field(text: Column, failed: Column | None = None) -> Column:
    """One value inside the hashed text: its length and itself, ``~`` for null.

    Lengths keep neighbouring values apart and null apart from empty. ``failed`` is raw text whose cast to the
    target type gave nothing; its own mark keeps it from equalling a null.
    """
    plain = F.concat(F.length(text).cast("string"), F.lit(":"), text)
    if failed is None:
        return F.coalesce(plain, F.lit("~"))
    marked = F.concat(F.lit("!"), F.length(failed).cast("string"), F.lit(":"), failed)
    return F.coalesce(plain, marked, F.lit("~"))


def row_hash(schema: T.StructType, scales: Mapping[str, int] | None = None) -> Column:
    """SHA-256 in hex over the columns of ``schema``, in its order."""
    scales = scales or {}
    fields = [field(canonical_text(F.col(f"`{f.name}`"), f.dataType, scales.get(f.name))) for f in schema.fields]
    return F.sha2(F.concat(*fields), 256)
