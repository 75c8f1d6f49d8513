"""Typed text of values: one form per value, so that rows compare and hash by what they hold.

A value becomes ``<bytes>:<text>`` and a null ``-``, so neither lengths nor nulls
let two rows run into one another.  Timestamps count microseconds, both zeros
are one, every NaN is one, arrays and structs nest, and a map is the array of
its entries in key order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, DoubleType, FloatType, MapType, StructType,
                               TimestampNTZType, TimestampType)


def _framed(text: Column) -> Column:
    return F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)


def _joined(items: Column) -> Column:
    return F.array_join(items, "")


def value_text(c: Column, kind: DataType) -> Column:
    """Framed text of a value of type ``kind``; ``-`` for null."""
    if isinstance(kind, (DoubleType, FloatType)):
        text = F.when(c == 0, F.lit(0.0).cast(kind)).otherwise(c).cast("string")
    elif isinstance(kind, TimestampType):
        text = F.unix_micros(c).cast("string")
    elif isinstance(kind, TimestampNTZType):
        text = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    elif isinstance(kind, BinaryType):
        text = F.hex(c)
    elif isinstance(kind, ArrayType):
        text = _joined(F.transform(c, lambda x: value_text(x, kind.elementType)))
    elif isinstance(kind, MapType):
        text = _joined(F.array_sort(F.transform(F.map_entries(c), lambda e: F.concat(
            value_text(e["key"], kind.keyType), value_text(e["value"], kind.valueType)))))
    elif isinstance(kind, StructType):
        parts = [value_text(c.getField(f.name), f.dataType) for f in kind.fields]
        text = F.concat(*parts) if parts else F.lit("")
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("-")).otherwise(_framed(text))


def row_text(df: DataFrame, cols: Sequence[str] | None = None) -> Column:
    """The framed texts of a row's columns, in their order."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    return F.concat(F.lit(""), *[value_text(F.col(f"`{c}`"), kinds[c]) for c in (df.columns if cols is None else cols)])
