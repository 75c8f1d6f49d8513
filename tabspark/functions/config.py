"""Config signatures, struct flattening and history arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def signature(config_struct: Column, length: int = 10) -> Column:
    """Short content hash of a config struct (``sha1`` of its JSON).

    Field order inside the struct is fixed by the schema, which plays the
    role of sorted JSON keys."""
    return F.substring(F.sha1(F.to_json(config_struct)), 1, length)


def flatten_struct(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested struct columns -> dotted top-level names."""
    def walk(prefix: str, dtype, path: str):
        if isinstance(dtype, StructType):
            out = []
            for f in dtype.fields:
                out += walk(f"{prefix}{sep}{f.name}" if prefix else f.name, f.dataType,
                            f"{path}.`{f.name}`" if path else f"`{f.name}`")
            return out
        return [F.col(path).alias(prefix)]
    cols = []
    for f in df.schema.fields:
        cols += walk(f.name, f.dataType, f"`{f.name}`")
    return df.select(*cols)


def history_long(df: DataFrame, run: str, arrays: Sequence[str], epoch: str = "epoch") -> DataFrame:
    """Per-run arrays (one per metric) -> one row per (run, epoch)."""
    zipped = F.arrays_zip(*[F.col(a) for a in arrays])
    return (df.select(run, F.posexplode(zipped).alias("_pos", "_z"))
            .select(run, (F.col("_pos") + 1).alias(epoch),
                    *[F.col(f"_z.{a}").alias(a) for a in arrays]))
