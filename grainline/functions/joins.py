"""Joins against fitted lookup tables (dictionaries, group means).

A lookup table is broadcast by hint only when its size is known: a measured
row count times the fixed width of its columns, under ``BROADCAST_BYTES``.
With text or nested columns, or without a row count, the join is left to AQE,
which switches to a broadcast at run time from the measured bytes of the
lookup side; otherwise both sides shuffle and AQE's skew-join handling splits
a hot key of the big side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20
COLUMN_BYTES = 16               # at most, for a value of fixed width with its share of the row's header


def _row_bytes(dtype: T.DataType) -> int | None:
    """Bytes of a value of fixed width; None where the width varies."""
    if isinstance(dtype, T.StructType):
        parts = [_row_bytes(f.dataType) for f in dtype.fields]
        return None if None in parts else COLUMN_BYTES + sum(parts)
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return COLUMN_BYTES if isinstance(dtype, fixed) else None


def join_lookup(df: DataFrame, lookup: DataFrame, on, how: str = "left",
                lookup_rows: int | None = None) -> DataFrame:
    width = _row_bytes(lookup.schema)
    if lookup_rows is not None and width is not None and lookup_rows * width <= BROADCAST_BYTES:
        lookup = F.broadcast(lookup)
    return df.join(lookup, on, how)
