"""An incident table that grows file by file: a ledger of converted files, and counts kept per run.

``target`` holds three folders: ``data/batch=...`` with the typed rows of each run, ``ledger/batch=...``
with the files that run converted, written after its rows, and ``counts/<name>/batch=...``. Rows of a run
that ended half-way have no entry in the ledger: they are not read, and their files are converted again.
One run at a time may write to a target.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.schemas import INCIDENTS, Field
from blotter.sources.etl import UNREADABLE_COLUMN
from blotter.sources.scan import conform, scan

LEDGER_SCHEMA = "path string, modified timestamp, length bigint, batch string"


@dataclass(frozen=True)
class GrowingTable:
    """A table of CSV files at ``target``, with the columns of ``fields`` and ``unreadable``."""

    spark: SparkSession
    target: str
    fields: Sequence[Field] = INCIDENTS

    def add(self, sources: str | Sequence[str]) -> int:
        """Convert the files of ``sources`` (files, folders or patterns) that are not in the ledger yet,
        and give their number. Files known already are not opened. One that has another size or time than
        when it was converted is an error, as its rows can't be told from those it had. Files of one run
        must have one header."""
        listed = self._listed(sources)
        known = self.ledger()
        changed = listed.join(known.withColumnsRenamed({"modified": "was", "length": "had"}), "path")
        other = changed.filter("modified <> was OR length <> had").select("path").limit(5).collect()
        if other:
            raise ValueError(f"changed since they were converted: {', '.join(row.path for row in other)}")
        # Paths only; Spark's own listing holds as many on the driver.
        new = listed.join(known, "path", "left_anti").collect()
        if not new:
            return 0
        batch = uuid4().hex
        text = scan(self.spark, [row.path for row in new], "csv")
        typed = conform(text, self.fields, unreadable=UNREADABLE_COLUMN)
        typed.write.parquet(f"{self.target}/data/batch={batch}")
        self._enter("ledger", batch, self.spark.createDataFrame([(*row, batch) for row in new], LEDGER_SCHEMA))
        return len(new)

    def ledger(self) -> DataFrame:
        """``path``, ``modified``, ``length``, ``batch`` of every file converted."""
        return self._stored("ledger", LEDGER_SCHEMA)

    def read(self) -> DataFrame:
        """The rows of all runs in the ledger."""
        return self._rows(self._batches(self.ledger()))

    def merged(
        self, name: str, count: Callable[[DataFrame], DataFrame], total: str
    ) -> DataFrame:
        """``count`` of the whole table, kept under ``name``: only runs added since the last call are
        read, each once; counts of the others are taken as stored. ``count`` gives one row per key with
        its number of rows in ``total``; every other column is part of the key. Nulls in keys are keys."""
        batches = self._batches(self.ledger())
        if not batches:
            return count(self._rows(batches))
        folder = f"counts/{name}"
        kept = set(self._batches(self._stored(f"{folder}/ledger", "name string, batch string")))
        for batch in (one for one in batches if one not in kept):
            path = f"{self.target}/{folder}/data/batch={batch}"
            count(self._rows([batch])).write.mode("overwrite").parquet(path)
            entry = self.spark.createDataFrame([(name, batch)], "name string, batch string")
            self._enter(f"{folder}/ledger", batch, entry)
        paths = [f"{self.target}/{folder}/data/batch={batch}" for batch in batches]
        parts = self.spark.read.parquet(*paths)
        keys = [f"`{column}`" for column in parts.columns if column != total]
        return parts.groupBy(*keys).agg(F.sum(total).alias(total)).select(*parts.columns)

    def _rows(self, batches: list[str]) -> DataFrame:
        if not batches:
            names = ", ".join(f"{field.name} {field.type}" for field in self.fields)
            return self.spark.createDataFrame([], f"{names}, {UNREADABLE_COLUMN} map<string,string>")
        # Folders by name: those of runs that ended half-way are never listed. Runs may lack optional columns.
        paths = [f"{self.target}/data/batch={batch}" for batch in batches]
        return self.spark.read.option("mergeSchema", True).parquet(*paths)

    def _enter(self, folder: str, batch: str, entries: DataFrame) -> None:
        """One file, so that a run is in the ledger as a whole or not at all."""
        entries.drop("batch").coalesce(1).write.mode("overwrite").parquet(f"{self.target}/{folder}/batch={batch}")

    @staticmethod
    def _batches(entries: DataFrame) -> list[str]:
        return sorted(row.batch for row in entries.select("batch").distinct().collect())

    def _stored(self, folder: str, schema: str) -> DataFrame:
        try:
            # Names of runs are hexadecimal and could be read as numbers but for the schema.
            return self.spark.read.schema(schema).parquet(f"{self.target}/{folder}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _listed(self, sources: str | Sequence[str]) -> DataFrame:
        """Files with their times and sizes. No content is read: the column isn't asked for."""
        paths = [sources] if isinstance(sources, str) else list(sources)
        found = self.spark.read.format("binaryFile").load(paths)
        return found.select("path", F.col("modificationTime").alias("modified"), "length").distinct()
