"""Scans of one file or folder, and the step from source columns to typed build columns.

Paths are Hadoop file-system URIs (``hdfs://``, ``s3a://``, ``file:``, or relative ones).
"""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.schemas import Field, plain_name

FORMATS = ("csv", "parquet")

# The folder level of tables that ``csv_to_parquet`` writes by year.
YEAR_COLUMN = "report_year"

# A quote inside a quoted field is written twice in the source files, so the quote escapes itself.
CSV_DIALECT = {"quote": '"', "escape": '"'}


def scan(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    header: Sequence[str] | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """Source columns as they are: text for CSV, stored types for Parquet.

    No types are inferred, so a CSV is never read twice. Without ``header`` the first line of the
    file is read for the names; with it even that is skipped. Either way every file of a folder is
    checked, and one with other columns, or the same in another order, fails the job: read such files
    as paths of their own. Only where a header is blank or repeated, so that Spark makes up a name, can't files be
    checked. ``multi_line`` allows line breaks inside quotes, at the price of one task per file;
    ``read_quoted_records`` reads them in parallel.
    """
    if fmt not in FORMATS:
        raise ValueError(f"unknown format {fmt!r}: expected one of {', '.join(FORMATS)}")
    if fmt == "parquet":
        return spark.read.parquet(*([path] if isinstance(path, str) else path))
    reader = spark.read.options(header=True, multiLine=multi_line, **CSV_DIALECT)
    if header is None:
        header = None if multi_line else header_of(spark, path)
        if header is None or not _all_named(header):
            found = reader.csv(path)
            if header is not None or not _all_named(found.columns):
                return found
            header = found.columns
    return reader.schema(text_schema(header)).option("enforceSchema", False).csv(path)


def header_of(spark: SparkSession, path: str | list[str]) -> list[str] | None:
    """The names in the first line of ``path`` that isn't blank, as they are written there."""
    first = spark.read.text(path).filter(F.trim("value") != "").first()
    return None if first is None else next(csv.reader([first["value"].removeprefix("\ufeff")]))


def _all_named(header: Sequence[str]) -> bool:
    """No name is blank, and none stands there twice in any case."""
    return all(name.strip() for name in header) and len({name.lower() for name in header}) == len(header)


def text_schema(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


def conform(
    df: DataFrame,
    fields: Sequence[Field],
    keep_rest: bool = False,
    source_names: bool = False,
    unreadable: str | None = None,
) -> DataFrame:
    """The columns of ``fields``, found by header whatever their order, case or blanks, and typed.

    ``keep_rest`` keeps the other columns as they are, behind them. ``source_names`` keeps the
    headers of the source instead of the build names. ``unreadable`` names one more column, a map from
    column name to source text of the values that are not blank and did not parse; null if all did.
    """
    by_plain_name = _by_plain_name(df.columns)
    types = dict(df.dtypes)
    used, out, parsed = set(), [], []
    for field in fields:
        source = by_plain_name.get(plain_name(field.header)) or by_plain_name.get(field.name)
        if source is None:
            if field.required:
                raise ValueError(f"no column {field.header!r} among {df.columns}")
            continue
        used.add(source)
        name = source if source_names else field.name
        value = field.parse(_column(source), types[source])
        out.append(value.alias(name))
        if types[source] != field.type:
            parsed.append((name, _column(source).cast("string"), value))
    if keep_rest:
        taken = {field.name for field in fields}
        for source in df.columns:
            if source in used:
                continue
            name = source if source_names else plain_name(source)
            if name in taken:
                raise ValueError(f"column {source!r} would repeat the name {name!r}")
            out.append(_column(source).alias(name))
    if unreadable is not None:
        out.append(_texts_not_parsed(parsed).alias(unreadable))
    return df.select(*out)


def _texts_not_parsed(parsed: Sequence[tuple[str, Column, Column]]) -> Column:
    texts = [
        F.struct(F.lit(name), F.when(value.isNull() & (F.trim(text) != ""), text).alias("text"))
        for name, text, value in parsed
    ]
    if not texts:
        return F.lit(None).cast("map<string,string>")
    kept = F.filter(F.array(*texts), lambda entry: entry["text"].isNotNull())
    return F.when(F.size(kept) > 0, F.map_from_entries(kept))


def _by_plain_name(columns: Sequence[str]) -> dict[str, str]:
    found: dict[str, str] = {}
    for column in columns:
        name = plain_name(column)
        if name in found:
            raise ValueError(f"columns {found[name]!r} and {column!r} have the same plain name")
        found[name] = column
    return found


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
