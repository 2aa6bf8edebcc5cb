"""CSV to Parquet."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import INCIDENTS, Field
from blotter.sources.scan import YEAR_COLUMN, conform, scan

UNREADABLE_COLUMN = "unreadable"


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    fields: Sequence[Field] = INCIDENTS,
    mode: str = "errorifexists",
    source_names: bool = False,
    by_year: str | None = None,
    header: Sequence[str] | None = None,
    multi_line: bool = False,
    unreadable: str | None = UNREADABLE_COLUMN,
) -> DataFrame:
    """Write the CSV at ``source`` as typed Parquet at ``target``, and return a scan of it.

    All columns are kept; those of ``fields`` get their types, so later filters on dates and codes
    reach the scan. ``source_names`` keeps the headers as they are, blanks included. ``by_year``
    names a timestamp column whose year becomes a folder level; rows are then rebalanced so that
    every year is written in files of even size, however unequal the years are.

    A value that does not parse is null, and its text is kept in the map column ``unreadable``, which
    is null for all other rows; ``unreadable_rows`` selects from it. None leaves that column out.
    """
    text = scan(spark, source, "csv", header, multi_line)
    df = conform(
        text, fields, keep_rest=True, source_names=source_names, unreadable=unreadable
    )
    if by_year is None:
        df.write.mode(mode).parquet(target)
    else:
        (
            df.withColumn(YEAR_COLUMN, F.year(F.col(f"`{by_year}`")))
            .hint("rebalance", YEAR_COLUMN)
            .write.mode(mode)
            .partitionBy(YEAR_COLUMN)
            .parquet(target)
        )
    return spark.read.parquet(target)
