r"""MinHash near-duplicates by a multi-index Hamming join.

A text's set of distinct word shingles gets a signature: 32 minima of hashes, of which 16 bits are kept. Two
signatures are as far apart as they have places that differ. They are split into eight chunks of four; if at
most ``FARTHEST`` = 15 places differ, some chunk has one of them at most (pigeonhole). So each chunk is sent
out four times, each time with another place left blank, and every pair within the distance meets at one
of these keys at least. The class of the set's size is part of the key, and a size near the next class
is sent out for both: sets whose sizes rule the likeness out don't meet. Pairs that meet are held
against the distance of their signatures, and against a bound: of a set, 1024 bits tell whether an odd
number of its hashes falls on them, and two sets differ in at least as many hashes as these bits differ. What is
left is held against the full sets of 64-bit shingle hashes; nothing is linked without that.

A pair whose likeness is 0.85 differs in 15 % of the places on average; that it differs in more than 15 of 32,
and so doesn't meet, has a chance of 3 in a million, and less above.

Equal sets are one node. Where nodes meet at a key, only links that join different components matter: each round
holds all of them against one pivot a key, joins what is linked, and takes the pivot out. The pivot is the
node that meets most others at all its keys, in a group of near copies the one nearest to their
common form. Keys whose nodes are all joined by then are done. When the pairs that are left are in
proportion to the rows, those of different groups are all held against each other, each pair at the first key
it shares. So no link between different components is lost. Of s nodes at a key that are linked with nothing, all
s * s / 2 pairs are held against each other's signatures, by pivots or at the end: any could be a link.

Defined results: a null text, or one without words, has no shingles and is linked with nothing. A text with
fewer words than a shingle is one shingle. The smallest id of a component ignores null ids; a component of
null ids alone has a null one. Repeated rows keep their own lines. An empty table gives an empty
result. Only the two named columns are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import attach, ship, stage, table
from blotter.llm.components import connected_components

ship(__name__)

#: Places of a signature, bits of each, and places that may differ: fewer than twice as many as chunks.
PLACES, BITS, FARTHEST = 32, 16, 15

#: Places of a chunk, which is a 64-bit number.
CHUNK = 64 // BITS

#: Bits of a key for the class of a set's size.
_CLASS_BITS = 7

#: Pairs whose signatures may be held against each other at once, for each row that meets another.
PAIRS_A_ROW = 512

#: Numbers of 64 bits that hold whether hashes fall on a bit an odd number of times.
PARITIES = 16

#: Rows of a key that ask others in one task, and pairs held against each other at once.
_TOGETHER, _AT_ONCE = 4096, 1 << 17

#: Shingles hashed at once, which bounds the memory for a long text.
_SPAN = 1 << 16

#: Odd factors and summands of the hashes, from a rule.
_RULE = [xxhash.xxh3_64_intdigest(bytes([kind, place])) for kind in (0, 1) for place in range(PLACES)]
_FACTORS = np.array(_RULE[:PLACES], np.uint64) | np.uint64(1)
_SUMMANDS = np.array(_RULE[PLACES:], np.uint64)


def shingle_hashes(text: bytes, width: int) -> np.ndarray:
    """Distinct hashes of the shingles of ``width`` words of the UTF-8 ``text``, in ascending order."""
    words = text.lower().split()  # of bytes: letters A-Z, and white space [\x20\x09-\x0D]
    if not words:
        return np.zeros(0, np.int64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(width, len(words))
    spans = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    digest = xxhash.xxh3_64_intdigest
    found = np.fromiter((digest(joined[a:b]) for a, b in spans), np.uint64, len(words) - width + 1)
    return np.unique(found.view(np.int64))


def signature(hashes: np.ndarray) -> np.ndarray:
    """``PLACES`` minima over the ``hashes``, of each the lowest ``BITS`` bits."""
    least = np.full(PLACES, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(hashes), _SPAN):
        some = hashes[start : start + _SPAN].view(np.uint64)
        for place in range(PLACES):
            mixed = (some * _FACTORS[place] + _SUMMANDS[place]) >> np.uint64(32)
            least[place] = min(least[place], mixed.min())
    return (least & np.uint64((1 << BITS) - 1)).astype("<u2")


def parities(hashes: np.ndarray) -> np.ndarray:
    """For every bit, by the lowest bits of a hash, whether an odd number of ``hashes`` falls on it."""
    counts = np.bincount(hashes & (64 * PARITIES - 1), minlength=64 * PARITIES)
    return np.packbits((counts & 1).astype(np.uint8), bitorder="little").view("<i8")


def keys_of(signature: Column) -> Column:
    """Every chunk, without each of its places in turn: 48 bits, and five above for which it is."""
    keys = []
    for at in range(PLACES // CHUNK):
        chunk = F.get(signature, F.lit(at))
        for blank in range(CHUNK):
            below = chunk.bitwiseAND(F.lit((1 << BITS * blank) - 1))
            above = F.shiftrightunsigned(chunk, BITS * (blank + 1)) if blank < CHUNK - 1 else F.lit(0)
            which = (CHUNK * at + blank) << BITS * (CHUNK - 1)
            keys.append(F.shiftleft(above.cast("long"), BITS * blank).bitwiseOR(below).bitwiseOR(F.lit(which)))
    return F.array(*keys)


def size_classes(n: Column, least: int) -> Column:
    """The class of a set's size, and that of the greatest size it can be linked with. Of sizes that allow the
    likeness, the class of the greater is among those of the lesser."""
    reach = math.log(100 / least) + 1e-9
    classes = F.floor(F.log(n) / (2 * reach)), F.floor((F.log(n) + reach) / (2 * reach))
    return F.array_distinct(F.array(*classes))


def places_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which places (pair, place) of signatures (pair, chunk) differ."""
    return (a.view("<u2") != b.view("<u2")).reshape(len(a), PLACES)


def first_shared(apart: np.ndarray) -> np.ndarray:
    """The number of the first key that a pair shares, for every pair with ``apart`` as above."""
    chunks = apart.reshape(len(apart), PLACES // CHUNK, CHUNK)
    chunk = (chunks.sum(axis=2) <= 1).argmax(axis=1)
    return CHUNK * chunk + chunks[np.arange(len(apart)), chunk].argmax(axis=1)


def _numbers(column: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.ascontiguousarray(column.flatten().to_numpy().reshape(len(column), width))


def _sketched(docs: DataFrame, width: int, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``id``, ``text``, ``n``, ``digest`` (of the whole set), ``signature``, ``parities`` of every row, written."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures, odd = [], [], [], []
            for text in batch.column("text"):
                hashes = shingle_hashes(text.as_py() or b"", width)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                signatures.append(signature(hashes).view("<i8") if len(hashes) else None)
                odd.append(parities(hashes) if len(hashes) else None)
            kinds = pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())
            more = (pa.array(x, kind) for x, kind in zip((sizes, digests, signatures, odd), kinds))
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[f.name for f in schema])

    read = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )
    schema = T.StructType(
        [
            *read.schema,
            T.StructField("n", T.LongType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("signature", T.ArrayType(T.LongType())),
            T.StructField("parities", T.ArrayType(T.LongType())),
        ]
    )
    return stage(read.mapInArrow(each, schema))


def _sets(width: int):
    @F.pandas_udf(T.ArrayType(T.LongType()))
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series([shingle_hashes(text, width) for text in some])

    return of


def _like(a: Column, b: Column, shared: Column, least: int) -> Column:
    return 100 * shared >= least * (a + b - shared)


_SKETCH = ["n", "signature", "parities"]


class _Sketches:
    """The sketches in some rows of Arrow, whose columns end in ``suffix``."""

    def __init__(self, rows: pa.Table | pa.RecordBatch, suffix: str = ""):
        self.n = rows.column(f"n{suffix}").to_numpy()
        self.signature = _numbers(rows.column(f"signature{suffix}"), PLACES // CHUNK)
        self.parities = _numbers(rows.column(f"parities{suffix}"), PARITIES)


def _allowed(n_a: np.ndarray, n_b: np.ndarray, apart: np.ndarray, least: int) -> np.ndarray:
    """Whether sets of these sizes can be alike enough if so many hashes at least are in one of them only."""
    n = n_a + n_b
    return (100 + least) * (n - apart) >= 2 * least * n


def _may_be_linked(
    a: _Sketches, i: np.ndarray, b: _Sketches, j: np.ndarray, least: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of rows ``i`` of ``a`` and ``j`` of ``b``, those that sketches allow to be links (their
    places), and which places of their signatures differ."""
    at = np.flatnonzero(_allowed(a.n[i], b.n[j], np.abs(a.n[i] - b.n[j]), least))
    apart = places_apart(a.signature[i[at]], b.signature[j[at]])
    close = apart.sum(axis=1) <= FARTHEST
    at, apart = at[close], apart[close]
    bits = np.bitwise_count((a.parities[i[at]] ^ b.parities[j[at]]).view(np.uint64)).sum(axis=1, dtype=np.int64)
    allowed = _allowed(a.n[i[at]], b.n[j[at]], bits, least)
    return at[allowed], apart[allowed]


class _Links:
    """Finds which of some pairs of nodes are links."""

    def __init__(self, rows: DataFrame, nodes: DataFrame, width: int, least: int):
        self.rows, self.width, self.least = rows, width, least
        self.sketches = nodes.select("node", *_SKETCH)

    def among(self, pairs: DataFrame) -> DataFrame:
        """The pairs (``a`` < ``b``, each once) whose full sets are alike enough, written."""
        least = self.least

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                every = np.arange(batch.num_rows)
                at, _ = _may_be_linked(_Sketches(batch, "_a"), every, _Sketches(batch, "_b"), every, least)
                yield batch.select(["a", "b"]).take(pa.array(at))

        return self.confirmed(self._beside(pairs, self.sketches).mapInArrow(each, "a long, b long"))

    def confirmed(self, near: DataFrame) -> DataFrame:
        """The same of pairs whose sketches allow a link."""
        near = stage(near)
        wanted = near.select(F.col("a").alias("row")).union(near.select("b")).distinct()
        texts = self.rows.select("row", "text").join(wanted, "row")
        sets = stage(texts.select(F.col("row").alias("node"), _sets(self.width)("text").alias("held")))
        shared = F.size(F.array_intersect("held_a", "held_b"))
        sizes = F.size("held_a"), F.size("held_b")
        return stage(self._beside(near, sets).filter(_like(*sizes, shared, self.least)).select("a", "b"))

    @staticmethod
    def _beside(pairs: DataFrame, of_nodes: DataFrame) -> DataFrame:
        """A node of many pairs is left to adaptive skew joins: there is one row for it to repeat."""
        for side in ("b", "a"):
            named = (F.col(c).alias(f"{c}_{side}") for c in of_nodes.columns[1:])
            pairs = pairs.join(of_nodes.select(F.col("node").alias(side), *named), side)
        return pairs

    def of_different_groups(self, left: DataFrame, open_keys: DataFrame) -> DataFrame:
        """The links between nodes of ``left`` that meet at one of ``open_keys`` and have different labels.

        Of each key, the nodes outside its greatest group meet all: four times the pairs that count, at most. Of a
        key with many nodes, the former are dealt over several tasks, and the latter repeated.
        """
        least = self.least
        at_keys = _at_keys(left, open_keys.withColumn("of_key", F.col("__rows")), ["greatest", "of_key"])
        sketched = at_keys.join(self.sketches, "node")
        salts = F.ceil(F.col("of_key") / _TOGETHER).cast("int")
        own = F.pmod(F.xxhash64("node"), salts) == F.col("salt")
        rows = stage(
            sketched.withColumn("class", F.get(size_classes(F.col("n"), least), F.lit(0)))
            .withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1)))
            .withColumn("asks", own & (F.col("label") != F.col("greatest")))
            .select("key", "salt", "node", "label", "class", "asks", *_SKETCH)
        )
        slots = F.lit(max(1, rows.count() // _TOGETHER))

        def each(found: pa.Table) -> pa.Table:
            found = found.sort_by([("key", "ascending"), ("salt", "ascending")])
            sketches = _Sketches(found)
            key, salt, node, label, kind = (found.column(c).to_numpy() for c in ("key", "salt", "node", "label", "class"))
            asks = found.column("asks").to_numpy()
            new = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1
            pairs = [np.zeros((0, 2), np.int64)]
            for begin, end in zip([0, *new.tolist()], [*new.tolist(), len(key)]):
                those = np.arange(begin, end)
                asking = those[asks[begin:end]]
                for one in range(0, len(asking), step := max(1, _AT_ONCE // (end - begin))):
                    few = asking[one : one + step]
                    i, j = np.repeat(few, len(those)), np.tile(those, len(few))
                    here = (label[i] != label[j]) & (np.maximum(kind[i], kind[j]) == key[i] % (1 << _CLASS_BITS))
                    i, j = i[here], j[here]
                    at, apart = _may_be_linked(sketches, i, sketches, j, least)
                    at = at[first_shared(apart) == key[i[at]] >> _CLASS_BITS + BITS * (CHUNK - 1)]
                    pairs.append(np.sort(np.stack([node[i[at]], node[j[at]]], axis=1), axis=1))
            both = np.unique(np.concatenate(pairs), axis=0)
            return pa.table({"a": both[:, 0], "b": both[:, 1]})

        dealt = rows.withColumn("slot", F.pmod(F.xxhash64("key", "salt"), slots))
        near = dealt.groupBy("slot").applyInArrow(each, "a long, b long")
        return self.confirmed(near.distinct())


def _pair(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def components(rows: DataFrame, nodes: DataFrame, width: int, least: int) -> DataFrame | None:
    """``node``, ``label`` of every node with a link, or None if there are none."""
    classes = size_classes(F.col("n"), least)
    classed = nodes.select(
        "node", keys_of(F.col("signature")).alias("keys"), F.size(classes).alias("classes"), F.explode(classes).alias("class")
    )
    key = F.shiftleft("key", _CLASS_BITS).bitwiseOR(F.col("class")).alias("key")
    keyed = classed.select("node", "classes", "class", F.explode("keys").alias("key")).select("node", "classes", key)
    groups = stage(keyed.groupBy("key").agg(F.count("*").alias("__rows")).filter("__rows > 1"))
    met = stage(_at_keys(keyed, groups.withColumn("others", F.col("__rows")), ["others"]))
    weights = met.groupBy("node").agg((F.sum("others") / F.first("classes")).alias("weight"))
    left = stage(met.drop("others", "classes").join(weights, "node").withColumn("label", F.col("node")))
    find = _Links(rows, nodes, width, least)
    budget = PAIRS_A_ROW * left.count()
    links, open_keys = [], _open(left)
    while True:
        met = stage(_at_keys(left, open_keys, ["pivot", "pivot_label"]))
        unlike = met.filter("label <> pivot_label")
        links.append(find.among(unlike.select(*_pair("node", "pivot")).distinct()))
        left = met.filter("node <> pivot").select("node", "key", "weight").join(_neighbours(links), "node", "left")
        left = stage(left.withColumn("label", F.coalesce("label", "node")))
        open_keys = _open(left)
        pairs = open_keys.agg(F.sum("pairs")).collect()[0][0]
        if not pairs:
            break
        if pairs <= budget:
            links.append(find.of_different_groups(left, open_keys))
            break
    return None if _all(links).isEmpty() else connected_components(_thinned(links))


def _all(links: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, links)


def _thinned(links: list[DataFrame]) -> DataFrame:
    """Fewer links that connect the same nodes: each node to its label, and labels that a link joins, once."""
    labels = stage(_neighbours(links))
    pairs = _all(links)
    for side in ("a", "b"):
        of_side = labels.select(F.col("node").alias(side), F.col("label").alias(f"label_{side}"))
        pairs = pairs.join(of_side, side)
    between = pairs.filter("label_a <> label_b").select(*_pair("label_a", "label_b")).distinct()
    own = labels.filter("node <> label").select(*_pair("node", "label"))
    return stage(own.unionByName(between))


def _neighbours(links: list[DataFrame]) -> DataFrame:
    """``node`` and ``label``, the least node it is linked with in one or two steps, or itself: nodes of equal
    labels are joined by links."""
    found = _all(links)
    both = found.unionByName(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    nearest = stage(both.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("label")))
    nearest = nearest.withColumn("label", F.least("node", "label"))
    onward = nearest.select(F.col("node").alias("label"), F.col("label").alias("next"))
    return nearest.join(onward, "label").select("node", F.col("next").alias("label"))


def _at_keys(rows: DataFrame, keys: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` of the ``keys``, with ``columns`` of these."""
    return attach(rows, keys.select("key", *columns), "key", [F.col("node")], counts=keys.select("key", "__rows"))


def _open(left: DataFrame) -> DataFrame:
    """Keys whose nodes aren't all joined: ``pivot`` and its label, the label most nodes have, and the number of
    ``pairs`` that aren't joined."""
    heavy = F.max(F.struct("weight", F.col("node").alias("pivot"), F.col("label").alias("pivot_label")))
    by_label = left.groupBy("key", "label").agg(F.count("*").alias("rows"), heavy.alias("heavy"))
    by_key = by_label.groupBy("key").agg(
        F.sum("rows").alias("__rows"),
        F.sum(F.col("rows") * F.col("rows")).alias("joined"),
        F.max(F.struct("rows", "label")).alias("greatest"),
        F.max("heavy").alias("heavy"),
    )
    pairs = ((F.col("__rows") * F.col("__rows") - F.col("joined")) / 2).alias("pairs")
    found = by_key.select("key", "__rows", "heavy.pivot", "heavy.pivot_label", "greatest.label", pairs)
    return stage(found.withColumnRenamed("label", "greatest").filter("pairs > 0"))


def near_duplicates(
    docs: DataFrame, width: int, least: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``id``, ``n_shingles``, ``component_id`` (the smallest id that links lead to) and ``kept`` (it is its
    own) of every row. Sets are linked at a likeness of ``least`` hundredths."""
    rows = _sketched(docs, width, id_col, text_col)
    some = rows.filter("digest IS NOT NULL")
    nodes = stage(
        some.groupBy("digest").agg(
            F.min("row").alias("node"),
            F.min("id").alias("least_id"),
            F.first("n").alias("n"),
            F.first("signature").alias("signature"),
            F.first("parities").alias("parities"),
            F.count("*").alias("__rows"),
        )
    )
    labels = components(rows, nodes, width, least)
    if labels is None:
        roots = nodes.select("digest", F.col("least_id").alias("component_id"))
    else:
        named = nodes.select("digest", "node", "least_id").join(labels, "node", "left")
        named = stage(named.withColumn("label", F.coalesce("label", "node")))
        of_label = named.groupBy("label").agg(F.min("least_id").alias("component_id"))
        roots = attach(named, of_label, "label", [F.col("node")]).select("digest", "component_id")
    counts = nodes.select("digest", "__rows")
    found = attach(some.select("row", "id", "n", "digest"), roots, "digest", [F.col("row")], counts=counts)
    columns = "id", F.col("n").alias("n_shingles"), "component_id"
    alone = rows.filter("digest IS NULL").withColumn("component_id", F.col("id")).select(*columns)
    return found.select(*columns).unionByName(alone).withColumn(
        "kept", F.col("id").eqNullSafe(F.col("component_id"))
    )


#: Words of a shingle, and hundredths of likeness from which documents are linked.
WIDTH, LEAST = 5, 85


def op13_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), WIDTH, LEAST)
    return found.withColumnRenamed("id", "doc_id")


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words
  FROM documents),
s AS (
  SELECT doc_id, r, CASE WHEN len(words) = 0 THEN []
    ELSE list_distinct(list_transform(range(1, greatest(len(words) - 4, 1) + 1),
      lambda i: array_to_string(words[i:i + 4], ' '))) END AS held
  FROM w),
e AS (SELECT r, len(held) AS n, md5(unnest(held)) AS h FROM s),
c AS (SELECT a.r AS a, b.r AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM e a JOIN e b ON a.h = b.h AND a.r <> b.r GROUP BY ALL),
l AS (SELECT a, b FROM c WHERE 100 * shared >= 85 * (na + nb - shared)),
reach AS (SELECT r AS a, r AS b FROM s UNION SELECT reach.a, l.b FROM reach JOIN l ON l.a = reach.b),
m AS (SELECT reach.a AS r, min(s.doc_id) AS component_id FROM reach JOIN s ON s.r = reach.b GROUP BY reach.a)
SELECT doc_id, len(held) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
FROM s JOIN m USING (r)
"""
