"""What the operators of this folder share: tables, staging, and joins that a hot key can't slow."""

from __future__ import annotations

import sys
from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.sources.scratch import new_folder

#: The characters `[\x20\x09-\x0D]`, which separate words.
WHITE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"

#: A key is hot if it holds more than one in so many rows; there are fewer hot keys than this.
HOT_ONE_IN = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame) -> DataFrame:
    """``df``, written to the shared folder and read back: its lineage ends here, so what follows
    neither computes it again nor depends on executors that may be lost."""
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def located(staged: DataFrame) -> DataFrame:
    """A staged table with ``file`` and ``position``, which name each of its rows, repeated or not."""
    return staged.select(
        "*",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("position"),
    )


def whole_row(df: DataFrame) -> Column:
    """All columns as the struct ``row``, where their names can't clash with others."""
    return F.struct(*(F.col(f"`{name}`") for name in df.columns)).alias("row")


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    spread: Sequence[Column],
    how: str = "inner",
    counts: DataFrame | None = None,
) -> DataFrame:
    """Join ``rows`` with ``lookup``, which has one row per key. Keys must not be null.

    A key may hold any share of ``rows``. The keys with over a thousandth of all rows, of which
    there are fewer than a thousand, get as many salts as they have thousandths; the list of them is
    the only thing broadcast. Their rows are dealt over the salts by the hash of ``spread``, and
    their lookup row is repeated once per salt, so that no task gets more than about a thousandth of
    the rows for one key. ``rows`` is read twice: stage what is dear to compute. Where the rows of
    each key of the lookup are counted already, ``counts`` has them as ``__rows``.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if counts is None:
        counts = rows.groupBy(*keys).agg(F.count("*").alias("__rows"))
    total = rows.count()
    share = F.lit(max(1, total // HOT_ONE_IN))
    hot = counts.filter(F.col("__rows") > share).select(
        *keys, F.ceil(F.col("__rows") / share).cast("int").alias("__salts")
    )
    salts = F.coalesce(F.col("__salts"), F.lit(1))
    salted_rows = (
        rows.join(F.broadcast(hot), keys, "left")
        .withColumn("__salt", F.pmod(F.xxhash64(*spread), salts).cast("int"))
        .drop("__salts")
    )
    salted_lookup = (
        lookup.join(F.broadcast(hot), keys, "left")
        .withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop("__salts")
    )
    return salted_rows.join(salted_lookup, [*keys, "__salt"], how).drop("__salt")


def ship(module: str) -> None:
    """Send the functions of ``module`` to Python workers by value: executors need not have it."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
