"""Tables bucketed by a join key when they are written, so that joins on it shuffle nothing.

The shuffle is paid once, at ingest, and serves every later join. Buckets are part of a table's entry in
the session's catalog: read such tables by name, not by path.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SALT_COLUMN = "bucket_salt"


def write_bucketed_facts(
    df: DataFrame,
    name: str,
    on: str | Sequence[str],
    buckets: int,
    path: str,
    spread: Sequence[str],
    salts: int = 1,
) -> DataFrame:
    """Write ``df`` as the table ``name`` at ``path``, bucketed by key and salt.

    A bucket is read by one task, so a key that holds a share of all rows would make one long task: the
    hash of the columns of ``spread`` deals every key over ``salts`` buckets. Rows alike in all of them
    stay together. A lookup to be joined is written ``salts`` times over, so choose about as many salts
    as the commonest key has buckets' worth of rows.
    """
    salt = F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
    return _write(df.withColumn(SALT_COLUMN, salt), name, on, buckets, path)


def write_bucketed_lookup(
    df: DataFrame, name: str, on: str | Sequence[str], buckets: int, path: str, salts: int = 1
) -> DataFrame:
    """The other side of the join, with the same ``on``, ``buckets`` and ``salts``: each row is there
    once a salt. Keys may repeat."""
    each = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return _write(df.withColumn(SALT_COLUMN, each), name, on, buckets, path)


def bucketed_join(
    spark: SparkSession, facts: str, lookup: str, on: str | Sequence[str], how: str = "inner"
) -> DataFrame:
    """Sort-merge join of two such tables, by name. Neither side is shuffled; null keys match nothing.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``: a right or full join would repeat
    lookup rows that match nothing."""
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"{how!r} is not a join that keeps lookup rows single")
    keys = [*_names(on), SALT_COLUMN]
    return spark.table(facts).join(spark.table(lookup).hint("merge"), keys, how).drop(SALT_COLUMN)


def _write(df: DataFrame, name: str, on: str | Sequence[str], buckets: int, path: str) -> DataFrame:
    keys = [*_names(on), SALT_COLUMN]
    # Dealt as the buckets are, so that each is written by one task as one file.
    dealt = df.repartition(buckets, *(F.col(f"`{key}`") for key in keys))
    dealt.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def _names(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)
