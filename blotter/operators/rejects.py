"""Rows whose text does not parse."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.clean import parse_double


def reject_rows(df: DataFrame, numeric_text: Sequence[str]) -> DataFrame:
    """Rows in which at least one of the text columns is no number (missing text included)."""
    return df.filter(_any_unreadable(numeric_text))


def drop_rejects(df: DataFrame, numeric_text: Sequence[str]) -> DataFrame:
    """The other rows, with those columns as doubles."""
    return df.filter(~_any_unreadable(numeric_text)).withColumns(
        {name: parse_double(F.col(name)) for name in numeric_text}
    )


def unreadable_rows(df: DataFrame, column: str = "unreadable") -> DataFrame:
    """Rows of a table made by ``csv_to_parquet`` in which at least one value did not parse."""
    return df.filter(F.col(column).isNotNull())


def unreadable_values(df: DataFrame, key: str, column: str = "unreadable") -> DataFrame:
    """``key``, ``field``, ``text``: one row per value that did not parse."""
    return df.select(key, F.explode(column).alias("field", "text"))


def _any_unreadable(names: Sequence[str]) -> Column:
    return reduce(Column.__or__, [parse_double(F.col(name)).isNull() for name in names])
