"""Equi-joins of facts with a lookup table, under a chosen strategy."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from blotter.operators.ranking import top_n_per_group
from blotter.operators.sizing import (
    BROADCAST_LIMIT_BYTES,
    REPLICATE_LIMIT_BYTES,
    measure_bytes,
)

#: ``default``       no hint: Catalyst and adaptive execution choose.
#: ``broadcast``     the lookup goes to every executor if its measured size allows it; else
#:                   ``replicate``.
#: ``merge``         sort-merge join.
#: ``shuffle_hash``  shuffled hash join, hash table on the lookup.
#: ``replicate``     shuffled join in which a hot key is split over several tasks: its facts get a
#:                   salt, its lookup rows are repeated once per salt. Other keys are left alone.
STRATEGIES = ("default", "broadcast", "merge", "shuffle_hash", "replicate")

DEFAULT_SALTS = 64

#: A key is hot if it holds more than one in so many facts; there are fewer hot keys than this.
HOT_ONE_IN = 1000

_SALT, _SALTS, _ROWS = "__salt", "__salts", "__rows"


def equi_join(
    facts: DataFrame,
    lookup: DataFrame,
    on: str | Sequence[str],
    strategy: str = "default",
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
    salt_by: Sequence[str] = (),
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    part_of: DataFrame | None = None,
    replicate_limit: int | None = None,
    find_hot: bool = True,
) -> DataFrame:
    """Join ``facts`` with ``lookup`` on equal columns; each key column appears once in the result.

    A key may hold any share of the facts. ``broadcast`` and ``replicate`` do not shuffle facts by
    key alone; the other strategies leave such a key to adaptive skew handling. ``how`` may be
    ``inner``, ``left_semi`` or ``left_anti``. For ``salts``, ``salt_by`` and ``replicate_limit`` see
    ``_replicate``, which counts the facts by key when it is called. Where ``facts`` are counted by key
    already, so that no key has many rows, ``find_hot=False`` spares that search: no key is salted then.
    ``broadcast`` measures the lookup when it is called, which runs a job over the lookup. Where the
    lookup takes long to compute and holds only rows of a stored table, pass that table as
    ``part_of``: it is measured instead, as the lookup cannot be larger.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left_semi", "left_anti"):
        raise ValueError(f"unsupported join type {how!r}")
    if strategy == "default":
        return facts.join(lookup, keys, how)
    if strategy == "broadcast":
        size = measure_bytes(lookup if part_of is None else part_of)
        if size <= broadcast_limit:
            return facts.join(F.broadcast(lookup), keys, how)
        strategy = "replicate"
    if strategy == "replicate" and find_hot:
        return _replicate(facts, lookup, keys, how, salts, salt_by, replicate_limit)
    if strategy == "replicate":
        strategy = "merge"
    if strategy in ("merge", "shuffle_hash"):
        return facts.join(lookup.hint(strategy), keys, how)
    raise ValueError(f"unknown strategy {strategy!r}: expected one of {', '.join(STRATEGIES)}")


def _replicate(
    facts: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str,
    salts: int,
    salt_by: Sequence[str],
    limit: int | None,
) -> DataFrame:
    """Every hot key is spread over up to ``salts`` reduce tasks, as many as it has thousandths of the
    facts, and meets its own copies of the lookup rows in each. Only lookup rows of hot keys are
    repeated; they are measured, and the salts are cut so that the copies take ``limit`` bytes at
    most (``REPLICATE_LIMIT_BYTES`` if none is given). Facts with a null key match nothing and are
    spread as well. Without hot keys, or with one salt, this is a plain sort-merge join.

    The salt is the hash of ``salt_by``, columns that differ between the facts of one key. Without
    such columns it is the number of the input partition, so that even equal rows are spread; filters
    put on the result then don't reach the scan of the facts. Both stay the same when a lost task is
    run again.
    """
    hot = _hot_keys(facts, keys, salts)
    if hot is not None:
        size = measure_bytes(lookup.join(F.broadcast(hot), keys, "left_semi"))
        salts = min(salts, (REPLICATE_LIMIT_BYTES if limit is None else limit) // max(size, 1))
    if hot is None or salts <= 1:
        return facts.join(lookup.hint("merge"), keys, how)
    spread = F.xxhash64(*salt_by) if salt_by else F.spark_partition_id()
    own_salts = F.least(F.coalesce(F.col(_SALTS), F.lit(1)), F.lit(salts))
    no_match = reduce(Column.__or__, (F.col(key).isNull() for key in keys))
    salted_facts = (
        facts.join(F.broadcast(hot), keys, "left")
        .withColumn(_SALT, F.pmod(spread, F.when(no_match, salts).otherwise(own_salts)).cast("int"))
        .drop(_SALTS)
    )
    salted_lookup = (
        lookup.join(F.broadcast(hot), keys, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), own_salts - 1)))
        .drop(_SALTS)
    )
    return salted_facts.join(salted_lookup.hint("merge"), [*keys, _SALT], how).drop(_SALT)


def _hot_keys(facts: DataFrame, keys: list[str], salts: int) -> DataFrame | None:
    """The hot keys with ``__salts``, or None if there are none: fewer than ``HOT_ONE_IN`` rows, found
    in one job that shuffles a row per key and task. Keys that hold more than their share are among as
    many that hold most, so the total may be counted along with them."""
    total = Observation()
    most = (
        facts.groupBy(*keys)
        .agg(F.count("*").alias(_ROWS))
        .observe(total, F.sum(_ROWS).alias("all"))
        .orderBy(F.desc(_ROWS))
        .limit(HOT_ONE_IN)
    )
    found = most.collect()
    if not found:
        return None
    share = max(1, total.get["all"] // HOT_ONE_IN)
    hot = [
        (*row[: len(keys)], min(salts, -(-row[_ROWS] // share)))
        for row in found
        if row[_ROWS] > share and None not in row[: len(keys)]
    ]
    if not hot:
        return None
    schema = most.select(*keys, F.col(_ROWS).cast("int").alias(_SALTS)).schema
    return facts.sparkSession.createDataFrame(hot, schema)


#: Bits of a key bitmap for each key, the greatest number of bits (64 MB), and the bits of one chunk of it.
BITS_A_KEY, MOST_BITS, _CHUNK_BITS = 16, 1 << 29, 32768


def bitmap_reduced(facts: DataFrame, lookup: DataFrame, on: str | Sequence[str], bits: int | None = None) -> DataFrame:
    """The ``facts`` whose key may be in ``lookup``, for a lookup beyond the broadcast limit: an inner or semi join
    of the result gives the same rows as one of ``facts``, and shuffles little more than what it matches.

    Every key of the lookup sets one bit, by its hash; the bitmap is built in chunks by ``bitmap_construct_agg``
    and sent to the scan of the facts, where a fact whose bit is not set is dropped. Its size is
    ``bits``; left out, 16 bits a row of the lookup, counted when this is called, and at most ``MOST_BITS``, however
    large the lookup grows: then more facts pass, and the join drops them. Facts with a null key match nothing.
    """
    keys = [on] if isinstance(on, str) else list(on)
    named = reduce(Column.__and__, (F.col(key).isNotNull() for key in keys))
    if bits is None:
        bits = min(MOST_BITS, max(_CHUNK_BITS, BITS_A_KEY * lookup.count()))
    at = F.pmod(F.xxhash64(*keys), F.lit(bits))
    chunks = (
        lookup.filter(named)
        .select(at.alias("__at"))
        .groupBy(F.bitmap_bucket_number("__at").alias("__chunk"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("__at")).alias("__bits"))
    )
    place = F.bitmap_bit_position("__at").cast("int")
    byte = F.conv(F.hex(F.substring("__bits", F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = facts.filter(named).withColumn("__at", at).withColumn("__chunk", F.bitmap_bucket_number("__at"))
    # At most MOST_BITS / 8 bytes, whatever the lookup.
    joined = marked.join(F.broadcast(chunks), "__chunk")
    return joined.filter(F.getbit(byte, place % 8) == 1).select(*(facts[name] for name in facts.columns))


def keep_last(lookup: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """One row per key, the last one in the order given."""
    rank = "__rank"
    last_first = [column.desc_nulls_last() for column in order]
    return top_n_per_group(lookup, [key], last_first, 1, rank).drop(rank)


def restrict_to(
    facts: DataFrame, chosen: DataFrame, on: str, strategy: str = "default"
) -> DataFrame:
    """Facts whose key is among the chosen ones; a key chosen twice does not repeat a fact.

    Keys chosen by a limit are broadcast without a measurement, as Spark knows how few they are.
    """
    return equi_join(facts, chosen.select(on), on, strategy, how="left_semi")


def unmatched(
    facts: DataFrame, lookup: DataFrame, on: str, strategy: str = "broadcast"
) -> DataFrame:
    """Facts whose key the lookup lacks, null keys included."""
    return equi_join(facts, lookup.select(on), on, strategy, how="left_anti")


def unmatched_counts(
    facts: DataFrame, lookup: DataFrame, on: str, total: str = "count"
) -> DataFrame:
    """How many facts each key has that the lookup lacks. The facts are counted before the join, so
    only one row per key and task is shuffled."""
    counted = facts.groupBy(on).agg(F.count("*").alias(total))
    return equi_join(counted, lookup.select(on), on, how="left_anti")
