r"""Exact deduplication as a stateful stream.

Documents are appended to a content store. A stream over the store keeps one state entry per digest
on disk (RocksDB), never expired: how many documents had the digest, and the identifier and content
locator (file and row of the store) of the one that stays. Where a digest was hit more than once,
the full bytes behind it are compared before its rows count as equal.

Defined results: a null text is the empty text; texts are equal when identical after deleting every
character of ``[\x20\x09-\x0D]``. Of equal texts the row with the most code points stays, then the
smallest identifier (null last), then the first in the store, so that of repeated rows exactly one
stays. An empty table gives an empty result. Other columns are carried in one struct and can't clash.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import WHITE, attach, located, table, whole_row
from blotter.sources.scratch import new_folder

_LOCATOR = ["file", "position"]

_STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    # All state stores of an executor share this memory; what is beyond it is on disk.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    # Logs grow as they are written: reserved space would be more than the state of a partition.
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"{WHITE}+", "")


@dataclass
class Dedup:
    """A finished run. ``rows``: locator, ``id``, ``n_chars``, ``text_sha256``, ``keep_id``,
    ``group_size``, ``kept``. ``store``: the content store with locators."""

    rows: DataFrame
    store: DataFrame

    def kept(self) -> DataFrame:
        """The documents that stay, with the columns they came with."""
        winners = self.rows.filter("kept").select(*_LOCATOR)
        return self.store.join(winners, _LOCATOR, "left_semi").select("row.*")


def exact_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest_of: Callable[[Column], Column] = lambda sha256: sha256,
    files_per_batch: int | None = None,
) -> Dedup:
    """Find equal texts of ``docs``. ``digest_of`` makes the state key from the SHA-256; a weaker one
    gives the same result, only later. ``files_per_batch`` bounds one micro-batch of the stream.
    """
    spark = docs.sparkSession
    path = new_folder(spark)
    sha256 = F.sha2(normalised(F.col(f"`{text_col}`")), 256)
    docs.select(
        whole_row(docs),
        F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).cast("long").alias("n_chars"),
        sha256.alias("text_sha256"),
    ).write.parquet(path)
    store = located(spark.read.parquet(path))
    rows = store.select(
        *_LOCATOR,
        F.col(f"row.`{id_col}`").alias("id"),
        "n_chars",
        "text_sha256",
        digest_of(F.col("text_sha256")).alias("digest"),
    )
    content = store.select(
        *_LOCATOR,
        digest_of(F.col("text_sha256")).alias("digest"),
        normalised(F.col(f"row.`{text_col}`")).alias("content"),
    )
    if rows.isEmpty():
        return Dedup(_decide(rows, rows.groupBy("digest").agg(*_entry()), ["digest"]), store)

    groups = _stream_state(spark, path, rows.columns, id_col, digest_of, files_per_batch)
    collided = _differing(content, groups.filter("group_size > 1")).persist()
    decided = _decide(rows, groups, ["digest"])
    if not collided.isEmpty():
        # Another text behind the same digest: these few digests are grouped by their bytes.
        exact = rows.join(content, [*_LOCATOR, "digest"]).join(collided, "digest", "left_semi")
        by_bytes = exact.groupBy("digest", "content").agg(*_entry())
        decided = _decide(rows.join(collided, "digest", "left_anti"), groups, ["digest"]).unionByName(
            _decide(exact, by_bytes, ["digest", "content"])
        )
    return Dedup(decided, store)


def _entry() -> list[Column]:
    """What is kept of each digest: number of rows, and the row that stays."""
    best = F.struct(
        (-F.col("n_chars")).alias("shorter"),
        F.col("id").isNull().alias("unnamed"),
        F.col("id").alias("keep_id"),
        F.col("file").alias("keep_file"),
        F.col("position").alias("keep_position"),
    )
    return [F.count("*").alias("group_size"), F.min(best).alias("best")]


def _stream_state(
    spark: SparkSession,
    path: str,
    columns: list[str],
    id_col: str,
    digest_of: Callable[[Column], Column],
    files_per_batch: int | None,
) -> DataFrame:
    """Run the stream over all that is in the store, and read its state."""
    state = new_folder(spark)
    before = {key: spark.conf.get(key, None) for key in _STATE_SETTINGS}
    for key, value in _STATE_SETTINGS.items():
        spark.conf.set(key, value)
    try:
        reader = spark.readStream.schema(spark.read.parquet(path).schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        arriving = located(reader.parquet(path)).select(
            *_LOCATOR,
            F.col(f"row.`{id_col}`").alias("id"),
            "n_chars",
            digest_of(F.col("text_sha256")).alias("digest"),
        )
        query = (
            arriving.groupBy("digest")
            .agg(*_entry())
            .writeStream.outputMode("update")
            .format("noop")
            .option("checkpointLocation", state)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        held = spark.read.format("statestore").load(state)
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    size, best = (f"value.`{name}`" for name in held.schema["value"].dataType.names)
    return held.select(
        F.col("key.digest").alias("digest"), F.col(size).alias("group_size"), F.col(best).alias("best")
    )


def _differing(content: DataFrame, hit: DataFrame) -> DataFrame:
    """Digests with more than one content. The least and the greatest content of a digest are equal
    only if all are; they are found in each task first, so a large group sends one row a task."""
    found = attach(content, hit.select("digest"), "digest", [F.col("file"), F.col("position")])
    extremes = found.groupBy("digest").agg(
        F.min("content").alias("least"), F.max("content").alias("greatest")
    )
    return extremes.filter("least <> greatest").select("digest")


def _decide(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """The group's entry beside each of its rows."""
    joined = attach(rows, groups, keys, [F.col("file"), F.col("position")])
    stays = (F.col("best.keep_file") == F.col("file")) & (
        F.col("best.keep_position") == F.col("position")
    )
    return joined.select(
        *_LOCATOR,
        "id",
        "n_chars",
        "text_sha256",
        F.col("best.keep_id").alias("keep_id"),
        "group_size",
        stays.alias("kept"),
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    columns = ["keep_id", "group_size", "kept", "text_sha256"]
    return exact_dedup(docs).rows.select(F.col("id").alias("doc_id"), *columns)


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
  FROM documents),
g AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST) AS keep_id
  FROM t)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, text_sha256 FROM g
"""
