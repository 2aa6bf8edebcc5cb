"""Sorting, numbering and top-k. Ties are always broken, so results do not change between runs."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.sources.scratch import new_folder

_GROUP_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"
_SALT = "__part"


def number_rows(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], rank: str = "rank"
) -> DataFrame:
    """Number the rows of each group from 1, in the order given.

    One task sorts each group, so use it on aggregated rows, or through ``top_n_per_group``.
    """
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def top_n_per_group(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank: str = "rank",
    salts: int = 256,
) -> DataFrame:
    """First ``n`` rows of each group. Spark cuts each task's rows to ``n`` per group before the
    shuffle, so a large group does not reach one task whole.

    It does so up to its threshold for ``n`` only (1000 unless set). Above it, each group is dealt over
    ``salts`` by the hash of its rows and every part is cut to ``n`` first, with the same rows left: up to
    ``salts * n`` rows of a group then go to one task. For larger ``n``, take ``rank_by_ranges``.
    """
    if n > int(df.sparkSession.conf.get(_GROUP_LIMIT, "1000")):
        salt = F.pmod(F.xxhash64(*_hashable(df)), F.lit(salts)).cast("int")
        parts = number_rows(df.withColumn(_SALT, salt), [*by, _SALT], order, rank)
        df = parts.filter(F.col(rank) <= n).drop(rank, _SALT)
    return number_rows(df, by, order, rank).filter(F.col(rank) <= n)


def rank_by_ranges(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int | None = None, rank: str = "rank"
) -> DataFrame:
    """``top_n_per_group`` for any ``n`` and groups of any size, all ranks if ``n`` is None: no task sorts a group.

    The rows are dealt over ranges of group and order, whose bounds Spark takes from a sample, sorted in each
    range, and written. A row's place in its file less the place of its group's first row there, and what ranges
    before hold of the group, is its rank: a prefix sum over one row for each file and group. Rows that are equal in group
    and order are told apart by a number, so that even they are dealt over several ranges; their ranks
    among each other are arbitrary.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    tie = "__tie"
    keys = [*(F.col(f"`{name}`") for name in by), *order, F.col(tie)]
    dealt = df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*keys)
    dealt.sortWithinPartitions(*keys).drop(tie).write.parquet(path)
    # Files are named in order of their range, and their rows numbered in the order written.
    at = [F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__at")]
    rows = spark.read.schema(df.schema).parquet(path).select("*", *at)
    group = [F.col(f"`{name}`").alias(f"__by_{i}") for i, name in enumerate(by)]
    pieces = rows.groupBy(F.col("__file").alias("__of"), *group).agg(
        F.count("*").alias("__rows"), F.min("__at").alias("__first")
    )
    along = Window.partitionBy(*(f"__by_{i}" for i in range(len(by)))).orderBy("__of")
    before = F.coalesce(F.sum("__rows").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.withColumn("__before", before)
    if n is not None:
        pieces = pieces.filter(F.col("__before") < n)
    same = [F.col("__file") == F.col("__of")]
    same += [F.col(f"`{name}`").eqNullSafe(F.col(f"__by_{i}")) for i, name in enumerate(by)]
    place = (F.col("__before") + F.col("__at") - F.col("__first") + 1).cast("long").alias(rank)
    ranked = rows.join(pieces, reduce(Column.__and__, same)).select(*(F.col(f"`{c}`") for c in df.columns), place)
    return ranked if n is None else ranked.filter(F.col(rank) <= n)


def _hashable(df: DataFrame) -> list[Column]:
    """Columns without maps, which have no hash."""
    return [F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()]


def top_k(df: DataFrame, metric: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """``k`` rows of highest metric, null last."""
    return df.orderBy(F.desc_nulls_last(metric), *tie_break).limit(k)


def bottom_k(
    df: DataFrame, metric: str, k: int, tie_break: Sequence[str], skip_nulls: bool = False
) -> DataFrame:
    """``k`` rows of lowest metric. A null metric counts as the lowest unless ``skip_nulls``."""
    known = df.filter(F.col(metric).isNotNull()) if skip_nulls else df
    return known.orderBy(F.asc_nulls_first(metric), *tie_break).limit(k)


def sort_by_count(df: DataFrame, tie_break: Sequence[str], total: str = "count") -> DataFrame:
    return df.orderBy(F.desc(total), *tie_break)
