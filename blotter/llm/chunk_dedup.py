r"""Repeated passages by content-defined chunking, judged on exact matches.

A gear hash rolls over the bytes of a text; a chunk ends behind a word at whose end the hash is lower than at the ends of
the ``REACH`` words on each side. Ends depend on nearby bytes alone, so the same passage is cut alike wherever it
stands. Chunks are deduplicated by digest over all documents. A chunk that stands in one document only proves that no
passage covers it and the words that decide its ends, so most places are ruled out by chunks alone. At every place left, the
window of ``least_words`` words is deduplicated by a 96-bit digest, and what the repeated windows of a document
cover without a gap is a passage. Hence a passage is found if and only if it has that many words and stands in several
documents, however short its words, and its ends are exact.

Defined results: words are the maximal runs of bytes other than ``[\x20\x09-\x0D]``, and two passages are equal if their words
are, whatever white space is between them. A null or empty text and one of fewer than ``least_words`` words have no
passages. A passage repeated only within its own row does not count; repeated rows are documents of their own. ``first_id``
is the smallest id that holds the passage's first window, null if none of them has an id. An empty table gives an
empty result. Only the two named columns are read, twice: stage what is dear to compute. The
windows of one document are put in order in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import attach, ship, stage, table
from blotter.operators.joins import bitmap_reduced

ship(__name__)

#: Values of the gear, one a byte, from a rule.
GEAR = np.array([xxhash.xxh32_intdigest(bytes([b])) for b in range(256)], np.uint32)

#: Bytes the hash depends on, a power of two; words on each side among which an end is lowest.
WINDOW, REACH = 8, 4

#: Bits of the bitmap of repeated chunks: so many a chunk, at most 64 MB in all, in parts of so many.
BITS_A_CHUNK, MOST_BITS, _PART_BITS = 8, 1 << 29, 32768

#: Bytes of a text hashed together; rows handed to Spark together.
_SPAN, _ROWS = 1 << 22, 1 << 16

_DIGEST = ["high", "low"]


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """The rolling hash h = 2 h + GEAR[byte] over the last WINDOW bytes, at every place."""
    hashed, width = GEAR[raw], 1
    while width < WINDOW:
        hashed[width:] = hashed[width:] + (hashed[:-width] << np.uint32(width))
        width *= 2
    return hashed


class Words:
    """The words of a text. ``plain`` is the text with one space before each word and no other white space, ``starts`` and
    ``ends`` are places in it, ``first`` and ``last`` bytes of each word in the text itself."""

    def __init__(self, text: bytes):
        raw = np.frombuffer(text, np.uint8)
        white = (raw == 32) | ((raw >= 9) & (raw <= 13))
        begins, closes = ~white, ~white
        begins[1:] &= white[:-1]
        closes[:-1] &= white[1:]
        self.first, self.last = np.flatnonzero(begins), np.flatnonzero(closes)
        self.raw = raw
        lengths = self.last + 1 - self.first
        self.ends = np.cumsum(lengths + 1)
        self.starts = self.ends - lengths
        plain = np.full(int(self.ends[-1]) if len(lengths) else 0, 32, np.uint8)
        inside = np.ones(len(plain), bool)
        inside[self.starts - 1] = False
        plain[inside] = raw[~white]
        self.plain = plain

    def chunk_ends(self) -> np.ndarray:
        """Numbers of the words that end a chunk."""
        hashed = np.zeros(len(self.ends), np.uint32)
        for low in range(0, len(self.plain), _SPAN):
            begin = max(0, low - WINDOW)
            part = gear_hash(self.plain[begin : low + _SPAN])
            one, other = np.searchsorted(self.ends, [low + 1, low + _SPAN + 1])
            hashed[one:other] = part[self.ends[one:other] - 1 - begin]
        lowest = np.ones(len(hashed), bool)
        for apart in range(1, REACH + 1):
            lowest[apart:] &= hashed[apart:] < hashed[:-apart]
            lowest[:-apart] &= hashed[:-apart] < hashed[apart:]
        return np.flatnonzero(lowest)

    def chunks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Chunks between two ends: digest, the last word before each, and its last word."""
        ends = self.chunk_ends()
        before, last = ends[:-1], ends[1:]
        text = memoryview(self.plain)
        bounds = zip(self.starts[before + 1].tolist(), self.ends[last].tolist())
        digests = [xxhash.xxh3_64_intdigest(text[a:b]) for a, b in bounds]
        return np.array(digests, np.uint64).astype(np.int64), before, last


def open_places(words: Words, least_words: int, repeated: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """Numbers of words at which a passage may begin: all but those whose next ``least_words`` words hold a
    chunk that isn't ``repeated``, and what decides both of its ends."""
    places = len(words.ends) - least_words + 1
    digests, before, last = words.chunks()
    alone = ~repeated(digests)
    # The hash at a word's end depends on as many words as half its bytes, at most, each with the space before it.
    low = np.maximum(last[alone] - (least_words - 1 - REACH), 0)
    high = np.minimum(before[alone] - (WINDOW // 2 - 1 + REACH), places - 1)
    some = low <= high
    ruled_out = np.zeros(places + 1, np.int64)
    np.add.at(ruled_out, low[some], 1)
    np.add.at(ruled_out, high[some] + 1, -1)
    return np.flatnonzero(np.cumsum(ruled_out[:-1]) == 0)


def _read(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").alias("id"),
        F.col(f"`{text_col}`").cast("binary").alias("text"),
    )


def _long_enough(batches: Iterator[pa.RecordBatch], least_words: int) -> Iterator[tuple[pa.Scalar, pa.Scalar, Words]]:
    for batch in batches:
        for one in range(batch.num_rows):
            text = batch.column(2)[one].as_py()
            if text and len(text) >= 2 * least_words - 1:
                words = Words(text)
                if len(words.ends) >= least_words:
                    yield batch.column(0)[one], batch.column(1)[one], words


def _gathered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of some size."""
    held, rows = [], 0
    for part in parts:
        held.append(part)
        rows += part.num_rows
        if rows >= _ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, rows = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def chunks(docs: DataFrame, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """``row`` and ``digest`` of every chunk of the documents that have ``least_words`` words."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def parts() -> Iterator[pa.RecordBatch]:
            for row, _, words in _long_enough(batches, least_words):
                digests = words.chunks()[0]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row, len(digests)), pa.array(digests)], names=["row", "digest"]
                )

        return _gathered(parts())

    return _read(docs, id_col, text_col).mapInArrow(each, "row long, digest long")


def _bitmap(digests: DataFrame) -> np.ndarray:
    """One bit a digest, in at most ``MOST_BITS``. Where digests share a bit, more places stay open; none is lost."""
    wanted = max(_PART_BITS, BITS_A_CHUNK * digests.count())
    bits = min(MOST_BITS, 1 << (wanted - 1).bit_length())
    at = F.pmod("digest", F.lit(bits))
    parts = digests.groupBy(F.floor(at / _PART_BITS).alias("part")).agg(
        F.bitmap_construct_agg((at % _PART_BITS).cast("long")).alias("bits")
    )
    bitmap = np.zeros(bits // 8, np.uint8)
    for part in parts.toLocalIterator():
        begin = part.part * _PART_BITS // 8
        bitmap[begin : begin + len(part.bits)] = np.frombuffer(part.bits, np.uint8)
    return bitmap


def _is_set(bitmap: np.ndarray, digests: np.ndarray) -> np.ndarray:
    at = np.mod(digests, 8 * len(bitmap))
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)


def windows(docs: DataFrame, repeated: DataFrame, least_words: int, id_col: str, text_col: str) -> DataFrame:
    """``row``, ``id``, ``at`` (number of its first word), ``start``, ``end`` (code points), ``high`` and ``low`` (digest) of
    every window of ``least_words`` words that ``repeated`` chunks don't rule out."""
    read = _read(docs, id_col, text_col)
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(repeated))
    names = ["row", "id", "at", "start", "end", *_DIGEST]
    kind = read.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, at int, start int, end int, high long, low int"

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = sent.value

        def parts() -> Iterator[pa.RecordBatch]:
            for row, id_, words in _long_enough(batches, least_words):
                at = open_places(words, least_words, lambda digests: _is_set(bitmap, digests))
                if len(at):
                    points = np.cumsum((words.raw & 0xC0) != 0x80, dtype=np.int32)
                    for begin in range(0, len(at), _ROWS):
                        yield _of_places(row, id_, words, points, at[begin : begin + _ROWS])

        return _gathered(parts())

    def _of_places(
        row: pa.Scalar, id_: pa.Scalar, words: Words, points: np.ndarray, at: np.ndarray
    ) -> pa.RecordBatch:
        last = at + least_words - 1
        text = memoryview(words.plain)
        bounds = zip(words.starts[at].tolist(), words.ends[last].tolist())
        digests = b"".join([xxhash.xxh3_128_digest(text[a:b]) for a, b in bounds])
        halves = np.frombuffer(digests, ">i8").astype(np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays(
            [
                pa.repeat(row, len(at)),
                pa.repeat(id_, len(at)),
                pa.array(at.astype(np.int32)),
                pa.array(points[words.first[at]] - 1),
                pa.array(points[words.last[last]]),
                pa.array(halves[:, 0].copy()),
                pa.array((halves[:, 1] >> 32).astype(np.int32)),
            ],
            names=names,
        )

    return read.mapInArrow(each, schema)


def repeated_passages(
    docs: DataFrame, least_words: int, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Passages of at least ``least_words`` words that stand in several documents: ``id``, ``start``, ``end``, ``words``,
    ``first_id``, ``copies`` (most times that a window of it occurs), ``first`` (no smaller id has its first
    window). All places are listed, the first one too; passages may overlap."""
    rows = [F.min("row").alias("least_row"), F.max("row").alias("greatest_row")]
    several = "least_row < greatest_row"
    known = chunks(docs, least_words, id_col, text_col).groupBy("digest").agg(*rows).filter(several)
    found = stage(windows(docs, stage(known.select("digest")), least_words, id_col, text_col))
    groups = found.groupBy(*_DIGEST).agg(*rows, F.count("*").alias("copies"), F.min("id").alias("first_id"))
    repeated = stage(groups.filter(several).select(*_DIGEST, "copies", "first_id"))
    counts = repeated.select(*_DIGEST, F.col("copies").alias("__rows"))
    # Only what tells where windows stand is shuffled for all of them.
    held = attach(
        found.select(*_DIGEST, "row", "at"),
        repeated.select(*_DIGEST, "copies"),
        _DIGEST,
        [F.col("row"), F.col("at")],
        counts=counts,
    )
    # Numbers of windows that follow each other minus their rank stay the same.
    along = Window.partitionBy("row").orderBy("at")
    runs = held.select("row", "at", "copies").withColumn("run", F.col("at") - F.row_number().over(along))
    passages = stage(
        runs.groupBy("row", "run").agg(
            F.min("at").alias("opens"),
            F.max("at").alias("closes"),
            (F.count("*") + (least_words - 1)).alias("words"),
            F.max("copies").alias("copies"),
        )
    )
    return _placed(passages, found, repeated)


def _placed(passages: DataFrame, found: DataFrame, repeated: DataFrame) -> DataFrame:
    """Passages with what their first and last windows hold. A bitmap of these windows drops nearly all others where
    they are read."""
    opens = passages.select("row", F.col("opens").alias("at"))
    edges = opens.unionByName(passages.select("row", F.col("closes").alias("at"))).distinct()
    # An inner join: Spark would move a semi join before the bitmap and shuffle all windows.
    edge = stage(bitmap_reduced(found, edges, ["row", "at"]).join(edges, ["row", "at"]))
    first = edge.select("row", F.col("at").alias("opens"), "id", "start", *_DIGEST)
    last = edge.select("row", F.col("at").alias("closes"), "end")
    placed = stage(passages.join(first, ["row", "opens"]).join(last, ["row", "closes"]))
    opening = bitmap_reduced(repeated.select(*_DIGEST, "first_id"), placed.select(*_DIGEST), _DIGEST)
    # Any number of passages may begin with the same window.
    named = attach(placed, opening, _DIGEST, [F.col("row"), F.col("opens")])
    return named.select(
        "id", "start", "end", "words", "first_id", "copies",
        F.coalesce(F.col("id") == F.col("first_id"), F.lit(False)).alias("first"),
    )


LEAST_WORDS = 50


def op5_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    passages = repeated_passages(table(spark, sf_dir, "documents"), LEAST_WORDS)
    return passages.withColumnsRenamed({"id": "doc_id", "first_id": "first_doc_id"})
