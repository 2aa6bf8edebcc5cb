r"""SpotSigs document fingerprints. Spark functions only.

Common words are anchors; a signature is an anchor with the chain of content words that follow it. The
set of a text's signatures is its fingerprint. Two fingerprints are compared by Jaccard likeness, and
only if their lengths lie in the same or neighbouring length partitions and allow the least likeness
looked for; else they count as unlike.

Defined results: a null text is empty; its set is empty, and two empty sets are alike (1). A text
without anchors takes every word as an anchor; one without words is a single signature of its own.
Documents come in the order of id, then MD5 of the text, null ids first; the next document after the last
is the first, so a lone document follows itself. Repeated rows keep their own lines. An empty table gives
an empty result. Only the two named columns are read. Ids may be of any type that JSON keeps: numbers, text,
dates. The table is read more than once and must come in the same order each time, as stored tables do.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import table

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his in is it its not of on or she that "
    "the their they this to was were which will with "
    "als auch auf aus bei das dem den der des die ein eine einer er es hat im ist mit nach nicht sich "
    "sie und von war wie wird zu zum zur "
    "au aux avec ce dans de du elle en et il la le les mais ne ou par pas pour que qui sa se son sont "
    "sur un une "
    "al como con del el esta las lo los más no para pero por su sus una y"
).split()

#: Content words of a signature.
CHAIN = 2

#: Buckets a shuffle task, the fewest rows they are made for, and sampled rows a bucket for its bounds.
_BUCKETS_A_TASK, _BUCKET_ROWS, _SAMPLED = 4, 100, 16

#: What a row costs beside its characters, in characters.
_ROW_COST = 200


def _steps(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the signature set of its column ``text`` as ``name``. Each step is a column that
    the next ones use more than once, so that none is computed twice."""
    anchor = lambda w: w.isin(*ANCHORS)
    words, places, content = (f"__{part}_{name}" for part in ("words", "places", "content"))
    all_words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    df = df.withColumn(words, all_words)
    df = df.withColumns(
        {
            places: F.filter(
                F.transform(words, lambda w, i: F.when(anchor(w), i).otherwise(-1)), lambda i: i >= 0
            ),
            content: F.filter(words, lambda w: ~anchor(w)),
        }
    )

    def signature(first: Column, chain: str, start: Column) -> Column:
        rest = (F.get(chain, start + k) for k in range(CHAIN))
        return F.substring(F.md5(F.concat_ws(" ", first, *rest)), 1, 8)

    # Before the j-th anchor, at place i, there are i - j content words.
    spots = F.transform(
        places,
        lambda i, j: F.when(i - j < F.size(content), signature(F.get(words, i), content, i - j)),
    )
    plain = F.transform(words, lambda w, i: signature(w, words, i + 1))
    whole = F.when(F.length(text) > 0, F.array(F.substring(F.md5(text), 1, 8))).otherwise(
        F.array().cast("array<string>")
    )
    chosen = (
        F.when(F.size(places) > 0, F.filter(spots, lambda s: s.isNotNull()))
        .when(F.size(words) > 0, plain)
        .otherwise(whole)
    )
    # Anchors alone, with no content after any: the text has words but no chain.
    some = f"__some_{name}"
    df = df.withColumn(some, chosen)
    kept = F.when((F.size(some) == 0) & (F.size(words) > 0), plain).otherwise(F.col(some))
    return df.withColumn(name, F.array_sort(F.array_distinct(kept))).drop(words, places, content, some)


def length_partition(size: Column, least: float) -> Column:
    """Sets that reach the likeness ``least`` lie in the same partition or in neighbours: each covers
    sizes up to 1 / ``least`` times its first."""
    return F.floor(F.log(F.greatest(size, F.lit(1))) / math.log(1 / least))


def likeness(a: str, b: str, least: float) -> Column:
    """Jaccard likeness of two sets, 0 where their lengths can't reach ``least``."""
    size_a, size_b = F.size(a), F.size(b)
    small, large = F.least(size_a, size_b), F.greatest(size_a, size_b)
    near = F.abs(length_partition(size_a, least) - length_partition(size_b, least)) <= 1
    shared = F.size(F.array_intersect(a, b))
    return (
        F.when(large == 0, 1.0)
        .when(~near | (small / large < least), 0.0)
        .otherwise(shared / (size_a + size_b - shared))
    )


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``signatures`` of every row."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    named = docs.select(F.col(f"`{id_col}`").alias("id"), text)
    return _steps(named, "text", "signatures").select("id", "signatures")


def _ring(docs: DataFrame) -> tuple[DataFrame, Window]:
    """``docs`` (``id``, ``text``) in buckets that follow each other in the order of the table, with the
    first row of the next bucket as a guest at the end of each, and the first row of all at the end of
    the last: so every row's next one is in its bucket.

    The order is that of ``key``: id, digest of the text, number of the row. No two rows share one, so
    buckets can end anywhere, also among rows with one id, without one, or equal in all. Bounds are keys
    that occur, taken where a sample's texts add up to equal sizes; rows find their bucket by halving. Texts
    are shuffled once, in ranges of buckets. As many bounds come to the driver as there are buckets, a few a
    shuffle task, and a few sampled keys for each.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = F.struct("id", F.md5("text").alias("digest"), F.monotonically_increasing_id().alias("number"))
    keyed = docs.select("id", "text", key.alias("key"))
    seen = keyed.agg(F.count("*").alias("rows"), F.to_json(F.min("key")).alias("low")).collect()[0]
    buckets = max(1, min(_BUCKETS_A_TASK * tasks, seen["rows"] // _BUCKET_ROWS))
    cuts = _bounds(keyed, buckets, seen["rows"]) if buckets > 1 else []
    kind = keyed.schema["key"].dataType.simpleString()
    bounds = F.from_json(F.lit("[" + ",".join(cuts) + "]"), f"array<{kind}>")
    halves = F.array(*(F.lit(1 << k) for k in reversed(range(max(1, len(cuts).bit_length())))))
    passed = F.aggregate(
        halves,
        F.lit(0),
        lambda at, half: F.when(F.get(bounds, at + half - 1) <= F.col("key"), at + half).otherwise(at),
    )
    placed = keyed.withColumn("home", passed)
    # A bound is the first row of its bucket.
    opens = F.get(bounds, F.col("home") - 1) == F.col("key")
    first = F.from_json(F.lit(seen["low"]).cast("string"), kind) == F.col("key")
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    places = F.filter(
        F.array(
            place(F.col("home"), 0),
            F.when(opens, place(F.col("home") - 1, 1)),
            F.when(first, place(F.lit(len(cuts)), 2)),
        ),
        lambda one: one.isNotNull(),
    )
    dealt = placed.select("id", "text", "key", F.explode(places).alias("place"))
    ranged = dealt.select("id", "text", "key", "place.bucket", "place.guest").repartitionByRange(tasks, "bucket")
    return ranged, Window.partitionBy("bucket").orderBy("guest", "key")


def _bounds(keyed: DataFrame, buckets: int, rows: int) -> list[str]:
    """Keys as JSON, in order, that part the texts into about equal sizes."""
    share = min(1.0, _SAMPLED * buckets / rows)
    chosen = F.pmod(F.xxhash64("key.digest", "key.number"), F.lit(1 << 30)) < int(share * (1 << 30))
    cost = (F.length("text") + _ROW_COST).alias("cost")
    sample = keyed.select("key", cost).filter(chosen).orderBy("key")
    found = sample.select(F.to_json("key").alias("key"), "cost").collect()
    step = sum(row["cost"] for row in found) / buckets
    cuts, before, full = [], 0, step
    for row in found:
        if before >= full:
            cuts.append(row["key"])
            full = before - before % step + step
        before += row["cost"]
    return cuts


def compare_with_edits(
    docs: DataFrame, least: float, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Each text beside its edited form and the next document: ``id``, ``text``, ``edited``, their
    ``signatures`` and ``edited_signatures``, ``near_edited``, ``near_next``."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text")
    ring, order = _ring(docs.select(F.col(f"`{id_col}`").alias("id"), text))
    following = _steps(ring.withColumn("next_text", F.lead("text").over(order)), "text", "signatures")
    following = following.withColumn("next_signatures", F.lead("signatures").over(order))
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), F.length("text") - half), F.substring("next_text", F.lit(1), half)
    )
    both = _steps(following.filter("guest = 0").withColumn("edited", edited), "edited", "edited_signatures")
    return both.select(
        "id", "text", "edited", "signatures", "edited_signatures",
        likeness("signatures", "edited_signatures", least).alias("near_edited"),
        likeness("signatures", "next_signatures", least).alias("near_next"),
    )


#: Likeness below this counts as none.
LEAST = 0.1


def op1_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = compare_with_edits(table(spark, sf_dir, "documents"), LEAST)
    return found.select(
        F.col("id").alias("doc_id"),
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        F.array_join("signatures", ",").alias("fingerprint"),
        F.array_join("edited_signatures", ",").alias("edited_fingerprint"),
        "near_edited",
        "near_next",
    )


_LIST = ", ".join(f"'{word}'" for word in ANCHORS)

ORACLE = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(coalesce(text, ''))) AS r
  FROM documents),
n AS (
  SELECT d.doc_id, d.r, d.t, e.t AS next, (length(d.t) // 2) AS h
  FROM d JOIN d e ON e.r = d.r % (SELECT count(*) FROM d) + 1),
v AS (SELECT *, left(t, length(t) - h) || left(next, h) AS edited FROM n),
x AS (SELECT r, 0 AS k, t FROM v UNION ALL SELECT r, 1, edited FROM v UNION ALL SELECT r, 2, next FROM v),
w AS (SELECT r, k, t, list_filter(string_split_regex(lower(t), '[^\p{{L}}\p{{N}}]+'), lambda a: a <> '') AS w FROM x),
p AS (
  SELECT *, list_filter(range(1, len(w) + 1), lambda i: w[i] IN ({_LIST})) AS p,
    list_filter(w, lambda a: a NOT IN ({_LIST})) AS c
  FROM w),
s AS (
  SELECT *, list_transform(list_filter(list_transform(p, lambda i, j: [i, i - j + 1]), lambda a: a[2] <= len(c)),
      lambda a: concat_ws(' ', w[a[1]], c[a[2]], c[a[2] + 1])) AS spots
  FROM p),
g AS (
  SELECT r, k, list_sort(list_distinct(CASE
      WHEN len(w) = 0 AND t = '' THEN []
      WHEN len(w) = 0 THEN [left(md5(t), 8)]
      WHEN len(spots) > 0 THEN list_transform(spots, lambda a: left(md5(a), 8))
      ELSE list_transform(range(1, len(w) + 1),
        lambda i: left(md5(concat_ws(' ', w[i], w[i + 1], w[i + 2])), 8)) END)) AS g
  FROM s),
l AS (
  SELECT a.r, b.k, CASE WHEN greatest(len(a.g), len(b.g)) = 0 THEN 1.0
      WHEN least(len(a.g), len(b.g)) / greatest(len(a.g), len(b.g)) < {LEAST}::DOUBLE THEN 0.0
      ELSE len(list_intersect(a.g, b.g)) / (len(a.g) + len(b.g) - len(list_intersect(a.g, b.g))) END AS near
  FROM g a JOIN g b ON a.r = b.r AND a.k = 0 AND b.k > 0)
SELECT v.doc_id, length(v.t) AS n_chars, sha256(edited) AS edited_sha256,
  array_to_string(g0.g, ',') AS fingerprint, array_to_string(g1.g, ',') AS edited_fingerprint,
  l1.near::DOUBLE AS near_edited, l2.near::DOUBLE AS near_next
FROM v JOIN g g0 ON g0.r = v.r AND g0.k = 0 JOIN g g1 ON g1.r = v.r AND g1.k = 1
  JOIN l l1 ON l1.r = v.r AND l1.k = 1 JOIN l l2 ON l2.r = v.r AND l2.k = 2
"""
