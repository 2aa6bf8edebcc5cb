"""Measured size of a join side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest side that is sent to every executor, in bytes of rows.
BROADCAST_LIMIT_BYTES = 64 * 1024**2

# Largest total a repeated side may grow to, over the whole cluster.
REPLICATE_LIMIT_BYTES = 64 * 1024**3

_VARIABLE_WIDTH = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)


def measure_bytes(df: DataFrame) -> int:
    """Bytes the rows of ``df`` take in memory.

    One aggregate over the rows: each task sends two numbers, and one row comes back. It is measured,
    because estimates of a filtered or aggregated input can be far off either way.
    """
    per_row = 8 + 8 * len(df.schema)
    measured = df.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(_variable_bytes(df.schema)), F.lit(0)).alias("variable"),
    ).collect()[0]
    return measured["rows"] * per_row + measured["variable"]


def _variable_bytes(schema: T.StructType) -> Column:
    widths = [
        F.coalesce(F.octet_length(F.col(f"`{field.name}`").cast("string")), F.lit(0)) + 8
        for field in schema
        if isinstance(field.dataType, _VARIABLE_WIDTH)
    ]
    return reduce(Column.__add__, widths, F.lit(0)).cast("bigint")
