"""Whole-row functions: order key, comparable form, change test, hash, plain-text form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.names import column, quote

# The first functions return SQL text: wide tables need hundreds of them, and text reaches the JVM in one call.


def order_key(update: str | None, insert: str) -> str:
    """Update time, else insert time."""
    return f"coalesce({update}, {insert})" if update else insert


def comparable(c: str, dtype: T.DataType) -> str:
    """A form of ``c`` that Spark can compare: VARIANT and values holding one go through JSON text
    (object keys come out sorted), maps become sorted entry lists."""
    if isinstance(dtype, T.VariantType):
        return f"to_json({c})"
    if isinstance(dtype, T.MapType) and orderable(dtype.valueType):
        return f"array_sort(map_entries({c}))"
    return c if orderable(dtype) else f"to_json(named_struct('v', {c}))"


def any_null(names) -> str:
    return "(" + " OR ".join(f"{quote(n)} IS NULL" for n in names) + ")"


def differs(left, right) -> str:
    """Null-safe "any column differs" over two equally long lists of comparable expressions.

    Exact, unlike a hash comparison: Spark's ``xxhash64`` skips nulls, so ('a', null) and (null, 'a') meet.
    """
    return f"NOT (struct({', '.join(left)}) <=> struct({', '.join(right)}))"


def _holds(dtype: T.DataType, kind) -> bool:
    if isinstance(dtype, kind):
        return True
    if isinstance(dtype, T.StructType):
        return any(_holds(f.dataType, kind) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _holds(dtype.elementType, kind)
    if isinstance(dtype, T.MapType):
        return _holds(dtype.keyType, kind) or _holds(dtype.valueType, kind)
    return False


def orderable(dtype: T.DataType) -> bool:
    return not _holds(dtype, T.VariantType) and not _holds(dtype, T.MapType)


def row_hash(df: DataFrame, names=None) -> Column:
    """SHA-256 over a row in which nulls and separators cannot collide (``concat_ws`` drops nulls)."""
    return F.sha2(F.to_json(F.struct(*[column(n) for n in (names or df.columns)]), {"ignoreNullFields": "false"}), 256)


def plain(df: DataFrame, names=None) -> DataFrame:
    """Scalars stay, nested values become JSON text."""
    out = []
    for f in df.schema.fields:
        c = column(f.name)
        if names is not None and f.name not in names:
            out.append(c)
        elif isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType, T.VariantType)):
            out.append(F.to_json(c).alias(f.name))
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BinaryType, T.DecimalType)):
            out.append(c.cast("string").alias(f.name))
        else:
            out.append(c)
    return df.select(*out)
