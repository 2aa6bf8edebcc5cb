"""Typed readers of the four tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.filters import in_year
from blotter.schemas import GEOCODE, INCIDENTS, INCOME, STATIONS
from blotter.sources.scan import YEAR_COLUMN, conform, scan


def read_incidents(
    spark: SparkSession,
    paths: str | Sequence[str],
    fmt: str = "csv",
    header: Sequence[str] | None = None,
    multi_line: bool = False,
    year: int | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """All incidents of one or more files or folders, as one typed table. With ``year``, only those
    reported in it; of a table written ``by_year``, the folders of other years are not opened.
    ``unreadable`` names a column more, for the text of values that did not parse (see ``conform``)."""
    parts = [paths] if isinstance(paths, str) else paths
    frames = []
    for path in parts:
        found = scan(spark, path, fmt, header, multi_line)
        if year is not None and fmt == "parquet" and YEAR_COLUMN in found.columns:
            found = found.filter(F.col(YEAR_COLUMN) == year)
        frames.append(conform(found, INCIDENTS, unreadable=unreadable))
    united = union_years(frames, missing_as_null=True)
    return united if year is None else united.filter(in_year(F.col("date_rptd"), year))


def union_years(frames: Iterable[DataFrame], missing_as_null: bool = False) -> DataFrame:
    """Rows of all frames, repeats kept. Columns are matched by name, so their order may differ. One
    that only some frames have is an error, or null in the others with ``missing_as_null``."""
    parts = list(frames)
    if not parts:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=missing_as_null), parts)


def read_geocode(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return conform(scan(spark, path, fmt), GEOCODE)


def read_income(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return conform(scan(spark, path, fmt), INCOME)


def read_stations(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    return conform(scan(spark, path, fmt), STATIONS)
