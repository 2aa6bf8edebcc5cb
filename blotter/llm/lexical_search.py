r"""Ranked lexical search by Block-Max MaxScore over a sharded inverted index.

Documents are indexed in shards of a bounded number of bytes. In a shard, a term's list is cut into blocks of
256 documents; a block holds one byte a posting for the document and one for the occurrences, and apart
from them the pairs of occurrences and document length that no other pair of the block beats. Any
score that grows with occurrences and falls with length has its block maximum at one of these
pairs, so the index needs no counts of the whole corpus and stays right when it grows.

A search sends each shard's lists of the terms asked for, and a block of queries, to one cell. There the
lists stand in order of their greatest score. The longest tail whose greatest scores together
can't reach the tenth best document so far is not essential: only documents of the other lists are
candidates. Through the tail, a candidate whose score and the maxima of its remaining blocks stay
below that bar is dropped, and blocks without a candidate are never unpacked. The best ones of the
shards are merged.

Defined results: a null text has no terms; documents without terms are not counted. Equal scores come in
order of id, null last, then of shard and place; repeated rows are documents of their own. A query
without terms, or whose terms no document holds, has no rows; repeated queries are answered each. An
empty table gives an empty result. Only the named columns are read. Identifiers are integers.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import ship, stage, table
from blotter.operators.joins import equi_join
from blotter.operators.ranking import top_n_per_group

ship(__name__)

#: Bytes of text and documents of a shard, about; documents of a block; queries answered in one cell.
SHARD_BYTES, SHARD_DOCS, BLOCK, QUERIES = 16 << 20, 1 << 16, 256, 256

#: Occurrences from here on are kept apart from their byte.
_MANY = 255

#: Index rows sent on at once.
_ROWS = 20_000

#: What separates terms becomes a blank; of the rest, A-Z becomes a-z.
_PLAIN = bytes(
    b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)
).lower()

_POSTINGS = ("blocks", "sizes", "places", "times", "many", "pair_sizes", "pair_times", "pair_lengths")
_KINDS = {
    "blocks": "<u2", "sizes": "u1", "places": "u1", "times": "u1", "many": "<u4", "pair_sizes": "u1",
    "pair_times": "<u4", "pair_lengths": "<u4",
}


def split_terms(texts: list[bytes]) -> tuple[pa.Array, np.ndarray]:
    """All terms of the texts, one after the other, and how many each text has."""
    plain = pa.array([text.translate(_PLAIN) for text in texts], pa.large_binary()).view(pa.large_string())
    lists = pc.ascii_split_whitespace(plain)
    terms = lists.flatten()
    counts = lists.value_lengths().to_numpy().astype(np.int64)
    named = pc.not_equal(terms, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), counts)
    return terms.filter(pa.array(named)), np.bincount(owner[named], minlength=len(texts))


def _binaries(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """``values`` cut into binary values of ``counts`` items each."""
    ends = np.concatenate([[0], np.cumsum(counts)]) * values.itemsize
    buffers = [None, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(values.tobytes())]
    return pa.Array.from_buffers(pa.large_binary(), len(counts), buffers).cast(pa.binary())


def _starts(*keys: np.ndarray) -> np.ndarray:
    """Where sorted rows begin a new value of any key."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def index_shard(shard: int, ids: pa.Array, texts: list[bytes]) -> Iterator[pa.RecordBatch]:
    """Rows of the index: one without a term for the shard's documents, then one for each term."""
    terms, lengths = split_terms(texts)
    names = ["shard", "term", "docs", "total", "ids", "lengths", *_POSTINGS]
    empty = pa.array([None], pa.binary())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([shard]), empty, pa.array([int((lengths > 0).sum())], pa.int64()),
            pa.array([int(lengths.sum())], pa.int64()), pa.ListArray.from_arrays([0, len(ids)], ids),
            pa.array([lengths.astype("<u4").tobytes()]), *[empty] * len(_POSTINGS),
        ],
        names=names,
    )
    if not len(terms):
        return
    coded = terms.dictionary_encode()
    codes = coded.indices.to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), lengths)
    keys, times = np.unique((codes << 32) | owner, return_counts=True)
    term, doc = keys >> 32, keys & 0xFFFFFFFF
    block = doc // BLOCK
    opens = _starts(term, block)
    block_sizes = np.diff(np.append(opens, len(term)))
    block_terms = term[opens]
    # Pairs that no other beats: along a block by rising length, those with more occurrences than all before.
    numbered = np.repeat(np.arange(len(opens)), block_sizes)
    order = np.lexsort((-times, lengths[doc], numbered))
    upto = np.maximum.accumulate((numbered[order] << 32) | times[order])
    pair = order[np.append(True, upto[1:] > upto[:-1])]
    per_block = np.bincount(numbered[pair], minlength=len(opens))
    n = len(coded.dictionary)
    per_term = np.bincount(term, minlength=n)
    many = times >= _MANY
    columns = {
        "blocks": (block[opens], np.bincount(block_terms, minlength=n)),
        "sizes": (block_sizes - 1, np.bincount(block_terms, minlength=n)),
        "places": (doc % BLOCK, per_term),
        "times": (np.minimum(times, _MANY), per_term),
        "many": (times[many], np.bincount(term[many], minlength=n)),
        "pair_sizes": (per_block - 1, np.bincount(block_terms, minlength=n)),
        "pair_times": (times[pair], np.bincount(term[pair], minlength=n)),
        "pair_lengths": (lengths[doc[pair]], np.bincount(term[pair], minlength=n)),
    }
    whole = pa.RecordBatch.from_arrays(
        [
            pa.array(np.full(n, shard)), coded.dictionary.view(pa.large_binary()).cast(pa.binary()),
            pa.array(per_term), pa.array(np.bincount(codes, minlength=n)),
            pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.binary()),
            *[_binaries(v.astype(_KINDS[name]), counts) for name, (v, counts) in columns.items()],
        ],
        names=names,
    )
    for start in range(0, n, _ROWS):
        yield whole.slice(start, _ROWS)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The index of every row of ``docs``, written: ``shard``, ``term`` (null in the row that lists the
    shard's documents), ``docs`` (that hold it, or any term), ``total`` (occurrences of it, or of all),
    ``ids``, ``lengths``, and the parts of the list."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32
        ids, texts, size = [], [], 0
        for batch in batches:
            for id_, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or b""
                ids.append(id_.as_py())
                texts.append(text)
                size += len(text)
                if size >= SHARD_BYTES or len(texts) >= SHARD_DOCS:
                    yield from index_shard(shard, pa.array(ids, pa.int64()), texts)
                    shard, ids, texts, size = shard + 1, [], [], 0
        if texts:
            yield from index_shard(shard, pa.array(ids, pa.int64()), texts)

    named = docs.select(F.col(f"`{id_col}`").cast("long"), F.col(f"`{text_col}`").cast("binary"))
    parts = ", ".join(f"{name} binary" for name in _POSTINGS)
    schema = f"shard long, term binary, docs long, total long, ids array<long>, lengths binary, {parts}"
    return stage(named.mapInArrow(each, schema))


@dataclass
class Corpus:
    """Counts over all documents: documents with a term, and terms with repeats."""

    docs: int
    terms: int


def corpus_counts(index: DataFrame) -> Corpus:
    shards = index.filter("term IS NULL")
    sums = shards.agg(F.sum("docs").alias("docs"), F.sum("total").alias("terms")).collect()[0]
    return Corpus(sums["docs"] or 0, sums["terms"] or 0)


def impact(times: np.ndarray, length_part: np.ndarray) -> np.ndarray:
    """(1000000000 * tf) div (1000 * tf + 8 * m)."""
    times = times.astype(np.int64)
    return 1_000_000_000 * times // (1000 * times + 8 * length_part)


def length_parts(lengths: np.ndarray, corpus: Corpus) -> np.ndarray:
    """100 - 75 + ((75 * n * N) div L), for every length n."""
    lengths = lengths.astype(np.int64)
    if 75 * int(lengths.max(initial=0)) * corpus.docs < 1 << 63:
        return 25 + 75 * lengths * corpus.docs // corpus.terms
    return np.array([25 + 75 * n * corpus.docs // corpus.terms for n in lengths.tolist()], np.int64)


class PostingList:
    """A term's list in a shard: block maxima at hand, postings packed until they are asked for."""

    def __init__(self, row: dict, corpus: Corpus, n_blocks: int):
        parts = {name: np.frombuffer(row[name], kind) for name, kind in _KINDS.items()}
        self.blocks = parts["blocks"].astype(np.int64)
        sizes = parts["sizes"].astype(np.int64) + 1
        self.opens = np.concatenate([[0], np.cumsum(sizes)])
        self.places, self.times, self.many = parts["places"], parts["times"], parts["many"]
        pairs = impact(parts["pair_times"], length_parts(parts["pair_lengths"], corpus))
        at = np.concatenate([[0], np.cumsum(parts["pair_sizes"].astype(np.int64) + 1)[:-1]])
        self.block_max = np.zeros(n_blocks, np.int64)
        self.block_max[self.blocks] = np.maximum.reduceat(pairs, at)
        self.list_max = int(self.block_max.max())
        self.unpacked: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def postings(self, block: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block that hold the term, and their impacts."""
        if block not in self.unpacked:
            at = int(np.searchsorted(self.blocks, block))
            own = slice(self.opens[at], self.opens[at + 1])
            docs = self.places[own].astype(np.int64) + block * BLOCK
            times = self.times[own].astype(np.int64)
            large = np.flatnonzero(times == _MANY)
            if len(large):
                before = int((self.times[: own.start] == _MANY).sum())
                times[large] = self.many[before : before + len(large)]
            self.unpacked[block] = docs, impact(times, parts[docs])
        return self.unpacked[block]


def best_of_shard(
    weights: list[int], lists: list[PostingList], parts: np.ndarray, n_blocks: int, most: int, before
) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers in the shard) that may be among the ``most`` best, with their whole scores,
    best first. ``before`` gives the place of documents among equal scores."""
    order = sorted(range(len(lists)), key=lambda i: -weights[i] * lists[i].list_max)
    lists, weights = [lists[i] for i in order], [weights[i] for i in order]
    # What the lists from each one on can add at most, anywhere and in each block.
    rest = np.cumsum([0] + [w * x.list_max for w, x in zip(weights[::-1], lists[::-1])])[::-1]
    rest_in_block = np.zeros((len(lists) + 1, n_blocks), np.int64)
    for i in range(len(lists) - 1, -1, -1):
        rest_in_block[i] = rest_in_block[i + 1] + weights[i] * lists[i].block_max
    score = np.zeros(len(parts), np.int64)
    bar, essential = 0, 0
    while essential < len(lists) and rest[essential] >= max(bar, 1):
        for block in lists[essential].blocks.tolist():
            docs, impacts = lists[essential].postings(block, parts)
            score[docs] += weights[essential] * impacts
        essential += 1
        if len(score) > most:
            bar = int(np.partition(score, len(score) - most)[len(score) - most])
    found = np.flatnonzero(score)
    for i in range(essential, len(lists)):
        found = found[score[found] + rest_in_block[i][found // BLOCK] >= bar]
        live = np.unique(found // BLOCK)
        wanted = np.zeros(len(score), bool)
        wanted[found] = True
        for block in np.intersect1d(live, lists[i].blocks, assume_unique=True).tolist():
            docs, impacts = lists[i].postings(block, parts)
            hit = wanted[docs]
            score[docs[hit]] += weights[i] * impacts[hit]
        if len(found) > most:
            bar = max(bar, int(np.partition(score[found], len(found) - most)[len(found) - most]))
    found = found[score[found] >= max(bar, 1)]
    found = found[np.lexsort((before[found], -score[found]))][:most]
    return found, score[found]


def search(index: DataFrame, queries: DataFrame, most: int, id_col: str, text_col: str) -> DataFrame:
    """The ``most`` best documents of each query: ``query`` (its row), ``query_id``, ``rank``, ``doc_id``,
    ``score``."""

    def terms_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() or b"" for text in batch.column(2)]
            terms, counts = split_terms(texts)
            owner = np.repeat(np.arange(len(texts)), counts)
            coded = terms.dictionary_encode()
            keys, times = np.unique((owner << 32) | coded.indices.to_numpy(), return_counts=True)
            rows = pa.array(keys >> 32)
            named = coded.dictionary.view(pa.large_binary()).cast(pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), batch.column(1).take(rows),
                 named.take(pa.array(keys & 0xFFFFFFFF)), pa.array(times)],
                names=["query", "query_id", "term", "times"],
            )

    corpus = corpus_counts(index)
    numbered = stage(
        queries.select(
            F.monotonically_increasing_id().alias("query"),
            F.col(f"`{id_col}`").cast("long").alias("query_id"),
            F.col(f"`{text_col}`").cast("binary").alias("text"),
        )
    )
    asked = stage(numbered.mapInArrow(terms_of, "query long, query_id long, term binary, times long"))
    terms = asked.select("term").distinct()
    lists = index.filter("term IS NOT NULL").select("shard", "term", "docs", *_POSTINGS)
    held = stage(equi_join(lists, terms, "term", "broadcast", salt_by=["shard"]))
    by_term = held.groupBy("term").agg(F.sum("docs").alias("df"))
    odds = F.lit(2.0 * corpus.docs + 2) / (2 * F.col("df") + 1)
    weight = (F.col("times") * F.floor(1000 * F.log(odds))).alias("weight")
    blocks = max(1, -(-numbered.count() // QUERIES))
    block = F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int").alias("block")
    weighed = stage(
        asked.join(by_term, "term").select("query", "query_id", "term", weight, block).filter("weight > 0")
    )
    # A cell: a shard and a block of queries. The queries of a block, which are few, are one value.
    query_blocks = weighed.groupBy("block").agg(
        F.collect_list(F.struct("query", "query_id", "term", "weight")).alias("asked")
    )
    listed = index.filter("term IS NULL").select("shard", "ids", "lengths")
    cells = listed.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    left = equi_join(cells, query_blocks, "block", "broadcast", salt_by=["shard"])
    of_block = weighed.select("term", "block").distinct()
    right = equi_join(held.drop("docs"), of_block, "term", "broadcast", salt_by=["shard"])

    def answer(cell: pa.Table, found: pa.Table) -> pa.Table:
        return _answer(cell, found, corpus, most)

    schema = "query long, query_id long, doc_id long, score long, shard long, place long"
    near = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(answer, schema)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.col("shard"), F.col("place")]
    best = top_n_per_group(near, ["query"], order, most)
    return best.select("query", "query_id", "rank", "doc_id", "score")


def _answer(cell: pa.Table, found: pa.Table, corpus: Corpus, most: int) -> pa.Table:
    """The best documents of a shard for each query of a block."""
    out = {name: [] for name in ("query", "query_id", "doc_id", "score", "shard", "place")}
    if cell.num_rows and found.num_rows:
        lengths = np.frombuffer(cell.column("lengths")[0].as_py(), "<u4")
        ids = cell.column("ids")[0].values
        n_blocks = -(-len(lengths) // BLOCK)
        parts = length_parts(lengths, corpus)
        unnamed = ids.is_null().to_numpy(zero_copy_only=False)
        before = np.empty(len(lengths), np.int64)
        before[np.lexsort((ids.fill_null(0).to_numpy(), unnamed))] = np.arange(len(lengths))
        lists = {row["term"]: PostingList(row, corpus, n_blocks) for row in found.to_pylist()}
        asked: dict[tuple, list] = {}
        for one in cell.column("asked")[0].as_py():
            if one["term"] in lists:
                asked.setdefault((one["query"], one["query_id"]), []).append(one)
        for (query, query_id), terms in asked.items():
            own = [lists[t["term"]] for t in terms]
            places, score = best_of_shard([t["weight"] for t in terms], own, parts, n_blocks, most, before)
            out["query"] += [query] * len(places)
            out["query_id"] += [query_id] * len(places)
            out["doc_id"] += ids.take(pa.array(places)).to_pylist()
            out["score"] += score.tolist()
            out["shard"] += cell.column("shard").take(pa.array([0] * len(places), pa.int64())).to_pylist()
            out["place"] += places.tolist()
    return pa.table({name: pa.array(values, pa.int64()) for name, values in out.items()})


#: Documents returned for each query.
MOST = 10


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"))
    found = search(index, table(spark, sf_dir, "benchmark"), MOST, "item_id", "text")
    return found.select(F.col("query_id").alias("item_id"), "rank", "doc_id", "score")


ORACLE = r"""
WITH t AS (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id NULLS LAST) AS r, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents),
c AS (SELECT count(*) FILTER (len(words) > 0) AS n, sum(len(words))::BIGINT AS l FROM t),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM t) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(n) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, c GROUP BY term),
q AS (
  SELECT item_id, i, term, count(*) AS times FROM (
    SELECT item_id, row_number() OVER () AS i, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark) GROUP BY ALL),
s AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
    sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * len(words) * n) // l))))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN p USING (term) JOIN t USING (r), c GROUP BY i, r)
SELECT item_id, (row_number() OVER o)::INT AS rank, doc_id, score FROM s WHERE score > 0
WINDOW o AS (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST, r) QUALIFY rank <= 10
"""
