"""CSV records that arrive as lines of text."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import INCIDENTS, Field
from blotter.sources.incidents import union_years
from blotter.sources.scan import CSV_DIALECT, conform, text_schema

# No line holds this, so a reader that splits at it gives whole lines.
_NO_SEPARATOR = "\x1e\x1f"


def read_csv_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    fields: Sequence[Field] = INCIDENTS,
    header: str | None = None,
    unreadable: str | None = None,
) -> DataFrame:
    """Typed records of text files whose every line is a CSV record.

    Each path has a header of its own, and paths are put together by column name. Blank lines and
    every line equal to the path's header are dropped. ``header`` is the first line of all files; left
    out, it is read (one line per path). In a folder, a file with another first line fails the job.
    ``unreadable`` names a column more, for the text of values that did not parse (see ``conform``). A line
    whose quotes don't close, part of a record of several lines, fails the job: ``read_quoted_records`` reads those.
    """
    parts = [paths] if isinstance(paths, str) else paths
    return union_years(
        [_records(spark, path, fields, header, unreadable) for path in parts], missing_as_null=True
    )


def _records(
    spark: SparkSession, path: str, fields: Sequence[Field], header: str | None, unreadable: str | None
) -> DataFrame:
    if header is None:
        first = spark.read.text(path).filter(F.trim("value") != "").first()
        if first is None:
            raise ValueError(f"no header line in {path}")
        header = first["value"]
    names = next(csv.reader([header]))
    # One column, named as the header line is: the reader then checks the first line of each file.
    lines = (
        spark.read.options(header=True, enforceSchema=False, sep=_NO_SEPARATOR, quote="")
        .schema(text_schema([header]))
        .csv(path)
        .toDF("value")
    )
    body = lines.filter((F.trim("value") != "") & (F.col("value") != header))
    schema = ", ".join(
        "`{}` STRING".format(field.name.replace("`", "``")) for field in text_schema(names)
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    unclosed = F.raise_error(F.concat(F.lit("a quote isn't closed in the line "), F.col("value"))).cast("string")
    line = F.when(quotes % 2 == 1, unclosed).otherwise(F.col("value"))
    record = F.from_csv(line, schema, CSV_DIALECT)
    return conform(body.select(record.alias("record")).select("record.*"), fields, unreadable=unreadable)
