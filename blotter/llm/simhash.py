r"""SimHash near-duplicates by ball hashing that meets in the middle.

Every distinct fingerprint is sent to all values within half the allowed distance of it. Two
fingerprints within the distance meet at one of these values at least, and those that meet at a value
number at most as many as there are values in a ball (65 for one bit), however many copies there are.

Defined results: a null text is empty; a text without words has the fingerprint zero, linked like any
other; a text with fewer words than a shingle is one shingle. Every row keeps its own line, repeated
rows too; a null identifier counts as none when the smallest is looked for. An empty table gives an
empty result. Only the two named columns are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import attach, located, ship, stage, table, whole_row
from blotter.llm.components import connected_components

ship(__name__)

BITS = 64
SEED = 42

#: Shingles hashed at once, which bounds the memory for a long text.
_CHUNK = 1 << 16

#: Bits of each byte value, lowest first.
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")


def fingerprint(text: bytes, width: int) -> int:
    """The SimHash of the UTF-8 ``text`` over shingles of ``width`` words, as a signed number."""
    words = text.lower().split()  # of bytes: letters A-Z, and white space [\x20\x09-\x0D]
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest = xxhash.xxh64_intdigest
    seen = np.zeros(8 * 256, np.int64)
    place = np.arange(8) * 256
    for i in range(0, len(starts), _CHUNK):
        spans = zip(starts[i : i + _CHUNK].tolist(), ends[i : i + _CHUNK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
        values = hashes.view(np.uint8).reshape(-1, 8) + place
        seen += np.bincount(values.ravel(), minlength=len(seen))
    ones = (seen.reshape(8, 256) @ _BYTE_BITS).ravel()
    bits = np.packbits(2 * ones > len(starts), bitorder="little")
    return int(bits.view("<i8")[0])


def simhash(text: Column, width: int) -> Column:
    """The fingerprint of each text, as a bigint."""

    @F.pandas_udf(T.LongType())
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t or b"", width) for t in texts], dtype="int64")

    return of(text.cast("binary"))


def close_links(distinct: DataFrame, max_bits: int) -> DataFrame:
    """Links (``a`` < ``b``) between the distinct ``fingerprint`` values, enough of them to connect
    all that differ in at most ``max_bits`` bits, an even number.

    All that meet at a value are within half the distance of it, so within the distance of each
    other: linking each with the next one there connects them all.
    """
    if max_bits % 2:
        raise ValueError("the distance is halved, so it must be even")
    masks = [
        sum(1 << bit for bit in chosen)
        for radius in range(max_bits // 2 + 1)
        for chosen in combinations(range(BITS), radius)
    ]
    signed = [mask - (1 << BITS) if mask >> (BITS - 1) else mask for mask in masks]
    ball = F.explode(F.array(*(F.col("fingerprint").bitwiseXOR(F.lit(m)) for m in signed)))
    meeting = distinct.select("fingerprint", ball.alias("value"))
    before = F.lag("fingerprint").over(Window.partitionBy("value").orderBy("fingerprint"))
    met = meeting.select(before.alias("a"), F.col("fingerprint").alias("b")).filter("a IS NOT NULL")
    return met.distinct().filter(_distance(F.col("a"), F.col("b")) <= max_bits)


def _distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def near_duplicates(
    docs: DataFrame,
    width: int,
    max_bits: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: bool = False,
) -> DataFrame:
    """``id``, ``fingerprint``, ``component_id`` (the smallest id that links lead to), and ``kept``:
    true for one row of each component, the first with that id. With ``carry``, also ``row``, a
    struct of the input's columns.
    """
    store = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            simhash(F.col(f"`{text_col}`"), width).alias("fingerprint"),
            *([whole_row(docs)] if carry else []),
        )
    )
    rows = located(store).select("id", "fingerprint", "file", "position")
    first = F.min(F.struct(F.col("id").isNull().alias("unnamed"), "id", "file", "position"))
    distinct = stage(rows.groupBy("fingerprint").agg(first.alias("first")))
    labels = connected_components(close_links(distinct, max_bits))
    roots = stage(
        distinct.join(labels.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
            "fingerprint", "first", F.coalesce("label", "fingerprint").alias("root")
        )
    )
    firsts = roots.groupBy("root").agg(F.min("first").alias("of_all"))
    components = attach(roots, firsts, "root", [F.col("fingerprint")]).select("fingerprint", "of_all")
    joined = attach(rows, components, "fingerprint", [F.col("file"), F.col("position")])
    kept = (F.col("of_all.file") == F.col("file")) & (F.col("of_all.position") == F.col("position"))
    found = joined.select(
        "id", "fingerprint", F.col("of_all.id").alias("component_id"), kept.alias("kept"), "file", "position"
    )
    if carry:
        texts = located(store).select("file", "position", "row")
        found = found.join(texts, ["file", "position"])
    return found.drop("file", "position")


def one_of_each(docs: DataFrame, width: int, max_bits: int) -> DataFrame:
    """``docs`` with one document of each component, and their own columns."""
    return near_duplicates(docs, width, max_bits, carry=True).filter("kept").select("row.*")


#: Words of a shingle, and bits that linked fingerprints may differ in.
WIDTH, MAX_BITS = 3, 2


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), WIDTH, MAX_BITS)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
