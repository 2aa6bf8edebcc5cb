"""Good rows and rejects written in one pass."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

OUTCOME_COLUMN = "outcome"
GOOD, REJECTED = "good", "rejected"


@dataclass(frozen=True)
class Routed:
    """What was written: the table with its ``outcome``, and the rows counted on the way."""

    table: DataFrame
    good_rows: int
    rejected_rows: int

    @property
    def good(self) -> DataFrame:
        return self._of(GOOD)

    @property
    def rejected(self) -> DataFrame:
        return self._of(REJECTED)

    def _of(self, outcome: str) -> DataFrame:
        return self.table.filter(F.col(OUTCOME_COLUMN) == outcome).drop(OUTCOME_COLUMN)


def write_routed(df: DataFrame, target: str, is_reject: Column, mode: str = "errorifexists") -> Routed:
    """Write ``df`` as Parquet with a folder for good rows and one for rejects, reading it once.

    A row is a reject where ``is_reject`` is true; false and null leave it good. Rows are counted by
    outcome while they are written, so a report needs no scan, and a filter on the outcome opens one
    folder only. Rows stay in the task that reads them, which writes up to two files: nothing is shuffled,
    whatever the share of rejects. A table with rows of one outcome only has just that folder.
    """
    if OUTCOME_COLUMN in df.columns:
        raise ValueError(f"{OUTCOME_COLUMN!r} is a column already")
    rejected = F.coalesce(is_reject, F.lit(False))
    counted = Observation()
    routed = df.withColumn(OUTCOME_COLUMN, F.when(rejected, REJECTED).otherwise(GOOD)).observe(
        counted,
        F.count_if(F.col(OUTCOME_COLUMN) == GOOD).alias(GOOD),
        F.count_if(F.col(OUTCOME_COLUMN) == REJECTED).alias(REJECTED),
    )
    routed.write.mode(mode).partitionBy(OUTCOME_COLUMN).parquet(target)
    numbers = counted.get
    table = df.sparkSession.read.schema(routed.schema).parquet(target)
    return Routed(table, numbers[GOOD], numbers[REJECTED])
