"""Arrow batches in tasks: slices of bounded size, columns and results."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

SLICE_BYTES = 8 << 20


def file_system(uri: str):
    """File system and path of a URI or a plain path, for files that tasks write and read themselves."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if ":" in uri.split("/")[0] else os.path.abspath(uri))


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each (one row at least)."""
    for batch in batches:
        col = batch.column(batch.schema.get_field_index(column))
        wide = pa.types.is_large_string(col.type)
        if len(col) == 0:
            continue
        ends = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, side="right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The column's values as UTF-8, null as empty."""
    return as_bytes(batch.column(batch.schema.get_field_index(column)))


def as_bytes(col: pa.Array) -> list[bytes]:
    return [x or b"" for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()).to_pylist()]


def longs(batch: pa.RecordBatch, column: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(column))


def map_slices(rows: DataFrame, run, added: StructType, limit: int = SLICE_BYTES) -> DataFrame:
    """``rows`` with the columns ``added``: run(slice, texts) returns arrays of their values.

    A dict in place of the list also replaces columns of ``rows`` by name.  Columns travel under
    plain names, so any column name does.
    """
    new = [f.name for f in added.fields]
    keep = [c for c in rows.columns if c not in new]
    plain = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep)])
    at = keep.index("text")
    schema = StructType([StructField(f"c{i}", f.dataType) for i, f in enumerate([*plain.schema.fields, *added.fields])])
    names = schema.names

    def over(batches):
        for part in text_slices(batches, f"c{at}", limit):
            out = run(part, part.column(at))
            cols = list(part.columns)
            if isinstance(out, dict):
                for c in [c for c in out if c in keep]:
                    cols[keep.index(c)] = out[c]
                out = [out[c] for c in new]
            yield pa.RecordBatch.from_arrays([*cols, *out], names=names)

    return plain.mapInArrow(over, schema).toDF(*keep, *new)
