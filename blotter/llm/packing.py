r"""Packing of tokenized documents into sequences: shortest-pack-first over the length histogram.

A document is cut into pieces of a whole sequence and one remainder. Lengths are placed longest
first, each into the pack that is shortest so far, if it fits there, and into a new one else; whole
counts of a length go to whole counts of equal packs, so the work depends on the number of different
lengths alone. The resulting patterns are then joined back to the pieces by their rank among the
pieces of their length.

Defined results: a null or empty text is the end id alone; special tokens written in a text are
ordinary text; repeated rows are packed as often as they come; a null identifier stays null. An empty
table gives an empty result. Only the two named columns are read.
"""

from __future__ import annotations

import base64
import os
import re
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from blotter.llm.common import ship, stage, table

ship(__name__)

END_ID = 0

#: Pieces of one length are ranked in shares of about this many.
RANK_SHARE = 100_000

Pattern = tuple[int, ...]


#: Runs of white space over which tiktoken's look-ahead isn't tried: its stack ends at a million.
LONGEST_RUN = 100_000


class ByteTokenizer:
    """Ids of a byte-level vocabulary given as a file of ranks: the same ids as by its JSON form, which
    lies beside it, with special tokens taken as ordinary text. Texts with very long runs of white
    space are encoded by the JSON form itself."""

    def __init__(self, ranks_path: str):
        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        whole = public_tokenizers.PATTERN
        # The look-ahead only matters where white space comes in runs, and is slow.
        plain = whole.replace(r"|\s+(?!\S)", "")
        self._whole, self._plain = (
            tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={})
            for p in (whole, plain)
        )
        self._run = re.compile(r"\s\s+")
        self._json_path, self._json = os.path.splitext(ranks_path)[0] + ".json", None

    def encode(self, text: str) -> list[int]:
        if not self._run.search(text):
            return self._plain.encode_ordinary(text)
        if len(text) > LONGEST_RUN and any(
            m.end() - m.start() > LONGEST_RUN for m in self._run.finditer(text)
        ):
            return self._by_json(text)
        return self._whole.encode_ordinary(text)

    def _by_json(self, text: str) -> list[int]:
        if self._json is None:
            self._json = Tokenizer.from_file(self._json_path)
            self._json.encode_special_tokens = True
        return self._json.encode(text, add_special_tokens=False).ids


def cut(docs: DataFrame, capacity: int, ranks_path: str, id_col: str, text_col: str) -> DataFrame:
    """``id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens`` of every piece."""
    read = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    schema = T.StructType(
        [T.StructField("id", read.schema["id"].dataType)]
        + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens")]
    )

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = ByteTokenizer(ranks_path)
        for batch in batches:
            of, pieces = [], []
            for row, text in enumerate(batch.column(1)):
                ids = array("I", tokenizer.encode(text.as_py() or ""))
                ids.append(END_ID)
                if sys.byteorder == "big":
                    ids.byteswap()
                for start in range(0, len(ids), capacity):
                    piece = ids[start : start + capacity]
                    pieces.append((start, len(piece), zlib.crc32(piece), len(ids)))
                    of.append(row)
            columns = zip(*pieces) if pieces else ([], [], [], [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(of, pa.int64()))]
                + [pa.array(column, pa.int64()) for column in columns],
                names=["id", "start", "length", "ids_crc32", "doc_tokens"],
            )

    return read.mapInArrow(each, schema)


def pack_lengths(histogram: dict[int, int], capacity: int) -> Counter[Pattern]:
    """How many packs of each pattern (lengths, longest first) hold all pieces of ``histogram``.

    Longest first, each into the shortest pack that exists, else into a new pack. Equal packs are
    counted, not listed: a step fills as many packs of one pattern as there are, or as pieces last.
    """
    by_total: dict[int, Counter[Pattern]] = {}
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        # Packs that got a piece of this length in this pass come later in the order of totals.
        while left:
            total = min(by_total, default=capacity)
            if total + length > capacity:
                _put(by_total, 0, (), length, left)
                break
            packs = by_total[total]
            pattern = min(packs)
            moved = min(left, packs[pattern])
            packs[pattern] -= moved
            if not packs[pattern]:
                del packs[pattern]
            if not packs:
                del by_total[total]
            _put(by_total, total, pattern, length, moved)
            left -= moved
    return sum(by_total.values(), Counter())


def _put(by_total: dict, total: int, pattern: Pattern, length: int, count: int) -> None:
    grown = by_total.setdefault(total + length, Counter())
    grown[(*pattern, length)] += count


def _places(patterns: Counter[Pattern]) -> list[tuple[int, int, int, int, int]]:
    """``length``, first rank, rank after the last, sequence of the first, offset: which ranks of a
    length fill which slot of which pattern."""
    used, first, places = Counter(), 0, []
    for pattern in sorted(patterns, reverse=True):
        count, offset = patterns[pattern], 0
        for length in pattern:
            places.append((length, used[length], used[length] + count, first, offset))
            used[length] += count
            offset += length
        first += count
    return places


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``rank`` from 0 among those of equal ``length``. A length may hold any part of
    the pieces: it is ranked in shares by a hash, and the sizes of the shares before are added."""
    shares = max(1, -(-pieces.count() // RANK_SHARE))
    share = F.pmod(F.xxhash64("id", "start", "ids_crc32"), F.lit(shares)).cast("int")
    dealt = pieces.withColumn("share", share)
    sizes = dealt.groupBy("length", "share").agg(F.count("*").alias("pieces"))
    before = Window.partitionBy("length").orderBy("share").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select(
        "length", "share", F.coalesce(F.sum("pieces").over(before), F.lit(0)).alias("first")
    )
    order = Window.partitionBy("length", "share").orderBy("id", "start", "ids_crc32", "doc_tokens")
    inside = dealt.withColumn("rank", F.row_number().over(order) - 1)
    joined = inside.join(first, ["length", "share"])
    return joined.withColumn("rank", F.col("rank") + F.col("first")).drop("share", "first")


def pack(
    docs: DataFrame,
    capacity: int,
    ranks_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every piece with its ``sequence_id`` and ``offset``.

    The histogram that comes to the driver has ``capacity`` rows at most, whatever the input; the
    table of places that goes out depends on it alone.
    """
    spark = docs.sparkSession
    pieces = stage(cut(docs, capacity, ranks_path, id_col, text_col))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    places = spark.createDataFrame(
        _places(pack_lengths(histogram, capacity)),
        "length long, low long, high long, sequence long, offset long",
    )
    piece, place = ranked(pieces).alias("piece"), F.broadcast(places).alias("place")
    here = (F.col("piece.length") == F.col("place.length")) & F.col("rank").between(
        F.col("low"), F.col("high") - 1
    )
    return piece.join(place, here).select(
        "piece.*", (F.col("sequence") + F.col("rank") - F.col("low")).alias("sequence_id"), "offset"
    ).drop("rank")


CAPACITY = 1024


def default_ranks_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack(table(spark, sf_dir, "documents"), CAPACITY, default_ranks_path())
    columns = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return packed.select(F.col("id").alias("doc_id"), *columns)
