"""CSV records with line breaks inside quotes, read in parallel."""

from __future__ import annotations

import csv
from collections.abc import Iterator, Sequence

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.schemas import INCIDENTS, Field
from blotter.sources.incidents import union_years
from blotter.sources.scan import CSV_DIALECT, conform, text_schema

#: What a piece of a record is: all of it, its first lines, lines between, or its last ones.
_WHOLE, _OPENS, _GOES_ON, _CLOSES = range(4)


def read_quoted_records(
    spark: SparkSession, paths: str | Sequence[str], fields: Sequence[Field] = INCIDENTS
) -> DataFrame:
    """Typed records of CSV files in which a quoted value may hold line breaks, in as many tasks as a file has
    splits. ``scan(..., multi_line=True)`` gives the same records in one task a file.

    Each path has a header of its own, and paths are put together by column name. The header is the first
    record of each file; in a folder, a file with another first record fails the job, and so does a
    file in which the last quote isn't closed. Blank records and records equal to the header are dropped.
    """
    parts = [paths] if isinstance(paths, str) else paths
    return union_years([_typed(spark, path, fields) for path in parts], missing_as_null=True)


def quoted_records(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``split`` and ``nth`` (where a record begins, the latter in its split) and ``record``, its text without
    the last line break.

    A quote inside a value is written twice, so an odd number of quotes before a place means that it is inside one. The
    quotes of each split are counted first; the parity of all splits before one, a prefix sum over a row
    a split, tells whether it begins inside quotes. With that every task puts its lines together by
    itself. Only what crosses the end of a split is shuffled: the last lines of one, the first ones of the next, and
    whole splits inside one value.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value"
    )
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = lines.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    along = Window.partitionBy("file").orderBy("split")
    before = F.sum("quotes").over(along.rowsBetween(Window.unboundedPreceding, -1))
    inside = F.coalesce(before, F.lit(0)) % 2 == 1
    splits = counted.select("file", "split", inside.alias("inside"))
    # One row for each split, of which the driver has planned as many tasks. A line of a split that isn't among
    # them, because the two scans were split differently, ends the job.
    told = lines.join(F.broadcast(splits), ["file", "split"], "left")
    lost = F.raise_error(F.concat(F.lit("no split like that at "), F.col("file"), F.lit(":"), F.col("split")))
    told = told.select("file", "split", "value", F.coalesce("inside", lost.cast("boolean")).alias("inside"))
    pieces = told.mapInArrow(_pieces, "file string, split long, nth long, kind int, record string")
    crossing = pieces.filter(F.col("kind") != _WHOLE)
    opened = F.sum((F.col("kind") == _OPENS).cast("long")).over(Window.partitionBy("file").orderBy("split", "nth"))
    # All pieces up to the one that opens the next record. Its first piece is where it begins.
    together = crossing.withColumn("opened", opened).groupBy("file", "opened").agg(
        F.array_sort(F.collect_list(F.struct("split", "nth", "kind", "record"))).alias("pieces")
    )
    unclosed = F.element_at("pieces", -1)["kind"] != _CLOSES
    joined = F.array_join(F.transform("pieces", lambda piece: piece["record"]), "\n")
    whole = together.select(
        "file",
        F.get("pieces", F.lit(0))["split"].alias("split"),
        F.get("pieces", F.lit(0))["nth"].alias("nth"),
        F.when(unclosed, F.raise_error(F.concat(F.lit("a quote isn't closed in "), F.col("file"))).cast("string"))
        .otherwise(joined)
        .alias("record"),
    )
    found = pieces.filter(F.col("kind") == _WHOLE).select("file", "split", "nth", "record").unionByName(whole)
    return found.withColumn("record", F.regexp_replace("record", "\r$", ""))


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines in their order to pieces of records. Between two batches only an unfinished piece is kept."""
    at, nth, inside, began, held = None, 0, False, False, []

    def piece(last: bool) -> tuple:
        kind = (_WHOLE if last else _OPENS) if began else (_CLOSES if last else _GOES_ON)
        return (*at, nth, kind, "\n".join(held))

    for batch in batches:
        found = []
        odd = pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1).to_pylist()
        columns = (batch.column(name).to_pylist() for name in ("file", "split", "inside", "value"))
        for file, split, starts_inside, value, flips in zip(*columns, odd):
            if (file, split) != at:
                if held:
                    found.append(piece(False))
                at, nth, inside, held = (file, split), 0, starts_inside, []
                began = not inside
            held.append(value)
            inside ^= bool(flips)
            if not inside:
                found.append(piece(True))
                nth, held, began = nth + 1, [], True
        yield _batch(found)
    if held:
        yield _batch([piece(False)])


def _batch(found: list[tuple]) -> pa.RecordBatch:
    kinds = {"file": pa.string(), "split": pa.int64(), "nth": pa.int64(), "kind": pa.int32(), "record": pa.string()}
    columns = zip(*found) if found else [()] * len(kinds)
    return pa.RecordBatch.from_arrays(
        [pa.array(values, kind) for values, kind in zip(columns, kinds.values())], names=list(kinds)
    )


def _typed(spark: SparkSession, path: str, fields: Sequence[Field]) -> DataFrame:
    records = quoted_records(spark, path)
    first = records.filter("split = 0 AND nth = 0").select("record").first()
    if first is None:
        raise ValueError(f"no header in {path}")
    header = first["record"].removeprefix("﻿")
    plain = F.regexp_replace("record", "^﻿", "")
    other = (F.col("split") == 0) & (F.col("nth") == 0) & (plain != header)
    wrong = F.raise_error(F.concat(F.lit("another header in "), F.col("file"))).cast("string")
    body = records.select(F.when(other, wrong).otherwise(plain).alias("value"))
    body = body.filter((F.trim("value") != "") & (F.col("value") != header))
    names = next(csv.reader([header], strict=True))
    schema = ", ".join("`{}` STRING".format(f.name.replace("`", "``")) for f in text_schema(names))
    record = F.from_csv("value", schema, {**CSV_DIALECT, "multiLine": "true", "lineSep": "\x1e"})
    return conform(body.select(record.alias("record")).select("record.*"), fields)
