r"""Mixing sources to target weights by histograms of hash buckets.

Each document has a hash of its id and text. Words are summed by source and hash bucket; the bucket in which a
source's budget ends is split into buckets again, and so on until it holds one hash. Documents whose
hash is below that threshold are in: a filter, without sorting. A larger budget only raises the
threshold, so mixes of growing budgets are nested.

Defined results: a null text has size 0; null is a source of its own, the last one. A source of size
0 has the target 0. A budget above a source's size takes every document once, or twice, and the rest
by the threshold. The document in which the budget ends is in if that brings the sum nearer to it, so
what is taken differs from the target by half a document at most (rows with equal hash, that is
repeated rows, count as one). An empty table gives an empty result. Other columns of the input are
carried in one struct and can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import WORD, attach, stage, table, whole_row

#: Hash bits, and bits a histogram tells apart: six levels at most, of 1024 buckets a source.
HASH_BITS = 60
LEVEL_BITS = 10


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def stable_hash(id_: Column, text: Column) -> Column:
    """60 bits of the MD5 of id and text: a rerun, on any cluster, takes the same documents."""
    named = F.concat(F.coalesce(id_.cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int
) -> DataFrame:
    """``source_key``, ``source_size``, ``target`` per source, from its ``size`` rows.

    The sources in order of ``source_key`` get ``weights`` in turn and divide ``share`` (a fraction)
    of all words by them; none gets over ``most`` times its size. With f the words per weight, a
    source gets min(most * size, weight * f), so the sources by most * size / weight are capped up to
    some place: f is what the capped ones leave, over the other weights.

    The table has one row a source, summed by task before; it is ordered in one task.
    """
    totals = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    place = (F.row_number().over(Window.orderBy("source_key")) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), place + 1)
    cap = F.col("source_size") * most
    by_ratio = Window.orderBy("ratio", "source_key")
    ranked = totals.withColumn("weight", weight).withColumn("ratio", cap / F.col("weight"))
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    from_here = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(whole) * share[0] / share[1]
    left = budget - F.coalesce(F.sum(cap).over(before), F.lit(0))
    rate = left / F.sum("weight").over(from_here)
    filled = ranked.withColumn("rate", rate).withColumn("capped", F.col("rate") >= F.col("ratio"))
    # The rate rises from source to source while they are capped; the first that isn't has it.
    common = F.min(F.when(~F.col("capped"), F.struct("ratio", "source_key", "rate"))).over(whole)
    target = F.when(F.col("capped"), cap.cast("double")).otherwise(F.col("weight") * common["rate"])
    return filled.select("source_key", "source_size", target.alias("target"))


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source_key``, ``threshold``: the documents of ``rows`` (``source_key``, ``hash``, ``size``)
    whose hash is below it are the run from hash 0 whose sizes sum to ``budget`` or come nearest to it."""
    open_ = stage(budgets.select("source_key", F.lit(0).cast("long").alias("prefix"), "budget"))
    done = None
    for level in range(1, HASH_BITS // LEVEL_BITS + 1):
        shift = HASH_BITS - LEVEL_BITS * level
        bucket = F.shiftright("hash", shift)
        prefix = F.shiftright("hash", shift + LEVEL_BITS)
        # Summed in each task first: one row a bucket and task is shuffled, whatever its rows.
        histogram = rows.groupBy("source_key", prefix.alias("prefix"), bucket.alias("bucket")).agg(
            F.sum("size").alias("size"), F.min("hash").alias("low"), F.max("hash").alias("high")
        )
        here = histogram.join(open_, ["source_key", "prefix"])
        order = Window.partitionBy("source_key").orderBy("bucket")
        upto = here.withColumn("upto", F.sum("size").over(order)).filter("upto > budget")
        crossing = upto.groupBy("source_key").agg(
            F.min(F.struct("bucket", "low", "high", "size", "upto", "budget")).alias("at")
        )
        found = stage(
            open_.select("source_key").join(crossing, "source_key", "left").select(
                "source_key",
                F.col("at.bucket").alias("prefix"),
                (F.col("at.budget") - (F.col("at.upto") - F.col("at.size"))).alias("budget"),
                # One hash in the bucket: it is in if no more than half of it is over the budget.
                (F.col("at.low") + (2 * (F.col("at.upto") - F.col("at.budget")) <= F.col("at.size")).cast("long"))
                .alias("low"),
                # No bucket crosses: all are in.
                (F.col("at").isNull() | (F.col("at.low") == F.col("at.high"))).alias("over"),
            )
        )
        ended = found.filter("over").select(
            "source_key", F.coalesce("low", F.lit(1 << HASH_BITS)).alias("threshold")
        )
        done = ended if done is None else done.unionByName(ended)
        open_ = found.filter("NOT over").select("source_key", "prefix", "budget")
        if open_.isEmpty():
            break
        inside = open_.select("source_key", "prefix")
        rows = rows.join(
            inside, (rows.source_key == inside.source_key) & (bucket == inside.prefix), "left_semi"
        )
    return done


def mix(
    docs: DataFrame,
    weights: tuple[int, ...],
    share: tuple[int, int],
    most: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: bool = False,
) -> DataFrame:
    """``id``, ``size``, ``source_size``, ``target``, ``times`` per row: how often the mix takes it.
    With ``carry``, also ``row``, a struct of the input's columns."""
    text = F.col(f"`{text_col}`")
    source = F.col(f"`{source_col}`")
    read = stage(
        docs.select(
            F.col(f"`{id_col}`").alias("id"),
            F.struct(source.isNull().alias("last"), F.coalesce(source, F.lit("")).alias("name")).alias(
                "source_key"
            ),
            word_count(text).alias("size"),
            stable_hash(F.col(f"`{id_col}`"), text).alias("hash"),
            *([whole_row(docs)] if carry else []),
        )
    )
    sizes = read.select("source_key", "hash", "size")
    targets = stage(source_targets(sizes, weights, share, most))
    whole = F.coalesce(F.floor(F.col("target") / F.nullif("source_size", F.lit(0))), F.lit(0))
    budgets = targets.select(
        "*", whole.alias("epochs"), (F.col("target") - whole * F.col("source_size")).alias("budget")
    )
    per_source = stage(budgets.join(thresholds(sizes, budgets), "source_key"))
    joined = attach(read, per_source, "source_key", [F.col("hash")])
    below = (F.col("hash") < F.col("threshold")) & (F.col("epochs") < most)
    extra = F.when(below, 1).otherwise(0)
    times = F.when(F.col("source_size") > 0, F.col("epochs") + extra).otherwise(1)
    return joined.select(
        "id",
        "size",
        "source_size",
        "target",
        times.cast("long").alias("times"),
        *(["row"] if carry else []),
    )


def take(docs: DataFrame, weights: tuple[int, ...], share: tuple[int, int], most: int) -> DataFrame:
    """The mix itself: each document as often as it is taken, with its own columns."""
    mixed = mix(docs, weights, share, most, carry=True).filter("times > 0")
    repeated = mixed.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    return repeated.select("row.*")


#: Weights by place, words of the mix against all words, and the most a document is repeated.
WEIGHTS, SHARE, MOST = (5, 2, 1), (3, 2), 2


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = (F.col("size") * F.col("times")).alias("taken")
    mixed = mix(docs, WEIGHTS, SHARE, MOST)
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))), 1, 15))::BIGINT
      AS h
  FROM documents),
s AS (
  SELECT source, source_size, w, 2 * source_size AS cap, 2 * source_size / w AS ratio,
    sum(source_size) OVER () * 3 / 2 AS budget
  FROM (SELECT source, sum(size)::BIGINT AS source_size,
          [5, 2, 1][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w
        FROM d GROUP BY source)),
r AS (
  SELECT *, (budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
      / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM s WINDOW o AS (ORDER BY ratio, encode(source) NULLS LAST)),
t AS (
  SELECT source, source_size, CASE WHEN rate >= ratio THEN cap::DOUBLE ELSE w * (
      SELECT arg_min(rate, ratio) FROM r WHERE rate < ratio) END AS target
  FROM r),
u AS (
  SELECT d.*, source_size, target, CASE WHEN source_size = 0 THEN 0 ELSE floor(target / source_size) END AS k,
    sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto, sum(size) OVER (PARTITION BY d.source, h) AS own
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
  (size * (k + CASE WHEN 2 * (upto - (target - k * source_size)) <= own THEN 1 ELSE 0 END))::BIGINT AS taken FROM u
"""
