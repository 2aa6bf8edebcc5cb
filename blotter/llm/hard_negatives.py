r"""Hard negatives of anchors by Four-Russians scoring.

Components become integers, and an integer its two's-complement bits. Eight dimensions make a group: of a
candidate, each bit plane of a group is one byte. Of an anchor, a group is a table of the 256 sums of
subsets of its eight components. An inner product is then a sum of table entries, looked up by the
candidate's bytes, shifted and added plane by plane. The scores are exact.

Anchors meet all rows in cells of a bounded block of anchors and a bounded slot of candidates, dealt by hash
of a row number, so that neither a common vector nor a common label makes a large task. A cell sends
on what may be among the first ones of each anchor, and these are merged. The rows are scored twice:
to find the positives, and, once these are known, the negatives their scores allow.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part. Vectors of different length count as filled up with zeros; an empty vector scores 0. An integer component
whose square, summed over the dimensions, could pass 2^62 is taken as the limit for that. Equal
scores come in order of id, null last, then of the row number; a repeated row is a row of its own, and its
copy can be its positive. An anchor without positives, or a positive without negatives, gives no row.
An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm.common import ship, stage, table
from blotter.operators.ranking import top_n_per_group

ship(__name__)

#: Dimensions of a group, so that a bit plane of it is a byte.
GROUP = 8

#: Rows of a slot of candidates and of a block of anchors, about; anchors scored together.
SLOT_ROWS, BLOCK_ROWS, TOGETHER = 2048, 4096, 64

_NONE = -(1 << 62)


@dataclass
class Index:
    """``rows``: ``row``, ``id``, ``label``, ``anchor`` and ``planes``, the bytes of the bit planes, of
    every row that takes part; ``groups`` of dimensions and ``bits`` of a component."""

    rows: DataFrame
    groups: int
    bits: int
    count: int
    anchors: int


def pack(values: np.ndarray, bits: int) -> np.ndarray:
    """Bytes (row, group, plane) of integers (row, dimension), lowest plane first."""
    n, dims = values.shape
    planes = (values[:, :, None] >> np.arange(bits)) & 1
    by_group = planes.reshape(n, dims // GROUP, GROUP, bits).astype(np.uint8)
    return np.packbits(by_group, axis=2, bitorder="little")[:, :, 0, :]


def unpack(planes: np.ndarray) -> np.ndarray:
    """The integers (row, dimension) behind ``pack``."""
    n, groups, bits = planes.shape
    ones = np.unpackbits(planes[:, :, None, :], axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(bits, dtype=np.int64)
    weights[-1] = -weights[-1]
    return (ones @ weights).reshape(n, groups * GROUP)


def subset_sums(values: np.ndarray) -> np.ndarray:
    """Tables (group, byte, anchor): for each byte, the sum of the components whose bits it has."""
    n, dims = values.shape
    tables = np.zeros((dims // GROUP, 1 << GROUP, n), values.dtype)
    for bit in range(GROUP):
        half = 1 << bit
        tables[:, half : 2 * half] = tables[:, :half] + values.T[bit::GROUP, None, :]
    return tables


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Inner products (candidate, anchor): tables looked up by bytes, shifted and added."""
    n, groups, bits = planes.shape
    found = np.zeros((n, tables.shape[2]), tables.dtype)
    looked_up = np.empty_like(found)
    for plane in range(bits - 1, -1, -1):
        found <<= 1
        for group in range(groups):
            np.take(tables[group], planes[:, group, plane], axis=0, out=looked_up, mode="clip")
            if plane == bits - 1:
                found -= looked_up
            else:
                found += looked_up
    return found


def build_index(
    vectors: DataFrame, is_anchor: Column, scale: int, id_col: str, label: Column, vector_col: str
) -> Index:
    """Quantise and pack every row that takes part."""
    vector = F.col(f"`{vector_col}`")
    unfit = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    known = vectors.filter(label.isNotNull() & vector.isNotNull() & ~F.coalesce(unfit, F.lit(False)))
    scaled = F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))
    rows = stage(
        known.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(f"`{id_col}`").cast("long").alias("id"),
            label.cast("long").alias("label"),
            F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
            scaled.alias("values"),
        )
    )
    size = rows.agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.col("anchor").cast("int")), F.lit(0)).alias("anchors"),
        F.max(F.size("values")).alias("dims"),
        F.min(F.array_min("values")).alias("low"),
        F.max(F.array_max("values")).alias("high"),
    ).collect()[0]
    groups = max(1, -(-(size["dims"] or 0) // GROUP))
    most = 1 << (62 - (groups * GROUP - 1).bit_length()) // 2
    reach = min(most, max(-(size["low"] or 0), (size["high"] or 0) + 1, 1))
    bits = (reach - 1).bit_length() + 1

    def each(batches):
        for batch in batches:
            lists = batch.column("values")
            lengths = lists.value_lengths().to_numpy()
            filled = np.zeros((len(lengths), groups * GROUP), np.int64)
            inside = np.arange(groups * GROUP) < lengths[:, None]
            filled[inside] = np.clip(lists.flatten().to_numpy(), -most, most - 1)
            planes = pack(filled, bits).reshape(len(lengths), -1)
            packed = pa.array([p.tobytes() for p in planes], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in ("row", "id", "label", "anchor")] + [packed],
                names=["row", "id", "label", "anchor", "planes"],
            )

    packed = rows.mapInArrow(each, "row long, id long, label long, anchor boolean, planes binary")
    return Index(stage(packed), groups, bits, size["rows"], size["anchors"])


def _cells(index: Index, anchors: DataFrame):
    """Anchors and candidates, grouped by the cells in which each anchor meets each candidate once."""
    slots, blocks = -(-index.count // SLOT_ROWS), -(-index.anchors // BLOCK_ROWS)
    dealt = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select("*", dealt(blocks).alias("block"), each(slots).alias("slot"))
    own = [F.col(name).alias(name) for name in ("row", "id", "label", "planes")]  # apart from those of left
    right = index.rows.select(*own, dealt(slots).alias("slot"), each(blocks).alias("block"))
    return left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot"))


class _Slot:
    """The candidates of a cell, in order of id."""

    def __init__(self, found: pa.Table, groups: int, bits: int):
        rows = found.column("row").to_numpy()
        ids = found.column("id")
        unnamed = ids.is_null().to_numpy()
        order = np.lexsort((rows, ids.fill_null(0).to_numpy(), unnamed))
        self.rows = rows[order]
        self.ids = ids.take(pa.array(order))
        self.labels = found.column("label").to_numpy()[order]
        self.planes = _planes(found, groups, bits)[order]
        self.bits = max(1, (len(rows) - 1).bit_length())

    def ranked(self, found: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores (anchor, rank) of the valid candidates, best first, and their places; scores below
        all others where there are no more."""
        places = np.arange(found.shape[1])
        if int(np.abs(found).max(initial=0)) >> (61 - self.bits):
            masked = np.where(valid, found, _NONE)
            order = np.argsort(-masked, axis=1, kind="stable")
            return np.take_along_axis(masked, order, 1), order
        last = (1 << self.bits) - 1
        keys = np.where(valid, (found.astype(np.int64) << self.bits) + (last - places), _NONE)
        keys.sort(axis=1)
        keys = keys[:, ::-1]
        return np.where(keys == _NONE, _NONE, keys >> self.bits), last - (keys & last)


def _planes(found: pa.Table, groups: int, bits: int) -> np.ndarray:
    joined = b"".join(found.column("planes").to_pylist())
    return np.frombuffer(joined, np.uint8).reshape(found.num_rows, groups, bits)


def _scored(anchors: pa.Table, slot: _Slot, groups: int, bits: int):
    """(first anchor, scores (anchor, candidate)) for a few anchors at a time."""
    values = unpack(_planes(anchors, groups, bits))
    greatest = groups * GROUP << 2 * bits
    values = values.astype(np.int32 if greatest < 1 << 31 else np.int64)
    for start in range(0, len(values), TOGETHER):
        yield start, scores(subset_sums(values[start : start + TOGETHER]), slot.planes).T


def positives(index: Index, most: int) -> DataFrame:
    """The first ``most`` other rows with an anchor's label: ``row``, ``id`` of the anchor,
    ``positive_row``, ``positive_id``, ``positive_score``, ``nth``."""
    groups, bits = index.groups, index.bits

    def each(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        slot = _Slot(candidates, groups, bits)
        rows, labels = (anchors.column(n).to_numpy() for n in ("row", "label"))
        who, place, score = [], [], []
        for start, found in _scored(anchors, slot, groups, bits):
            own = slice(start, start + len(found))
            valid = (labels[own, None] == slot.labels) & (rows[own, None] != slot.rows)
            best, places = (part[:, :most] for part in slot.ranked(found, valid))
            anchor, rank = np.nonzero(best > _NONE)
            who.append(anchor + start)
            place.append(places[anchor, rank])
            score.append(best[anchor, rank])
        who, place, score = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (who, place, score))
        return pa.table(
            {
                "row": rows[who],
                "id": anchors.column("id").take(pa.array(who)),
                "positive_row": slot.rows[place],
                "positive_id": slot.ids.take(pa.array(place)),
                "positive_score": score,
            }
        )

    anchors = index.rows.filter("anchor").select("row", "id", "label", "planes")
    schema = "row long, id long, positive_row long, positive_id long, positive_score long"
    found = _cells(index, anchors).applyInArrow(each, schema)
    order = [F.desc("positive_score"), F.asc_nulls_last("positive_id"), F.col("positive_row")]
    return top_n_per_group(found, ["row"], order, most, "nth")


def negatives(index: Index, chosen: DataFrame, most: int, low: int, high: int) -> DataFrame:
    """For each positive of ``chosen``, the first ``most`` rows of another label whose score is from
    ``low`` to ``high`` hundredths of the positive's."""
    groups, bits = index.groups, index.bits

    def each(anchors: pa.Table, candidates: pa.Table) -> pa.Table:
        slot = _Slot(candidates, groups, bits)
        labels = anchors.column("label").to_numpy()
        listed = anchors.column("positives").to_pylist()
        out = {name: [] for name in ("who", "positive_row", "positive_id", "positive_score", "place", "score")}
        for start, found in _scored(anchors, slot, groups, bits):
            valid = labels[start : start + len(found), None] != slot.labels
            best, places = slot.ranked(found, valid)
            for one in range(len(found)):
                down = -best[one]
                for positive in listed[start + one]:
                    score = positive["positive_score"]
                    least, greatest = -(-low * score // 100), high * score // 100
                    a = int(np.searchsorted(down, -greatest, "left"))
                    b = min(a + most, int(np.searchsorted(down, -max(least, _NONE + 1), "right")))
                    for at in range(a, b):
                        out["who"].append(start + one)
                        for name in ("positive_row", "positive_id", "positive_score"):
                            out[name].append(positive[name])
                        out["place"].append(int(places[one, at]))
                        out["score"].append(int(best[one, at]))
        who, place = (pa.array(out[n], pa.int64()) for n in ("who", "place"))
        return pa.table(
            {
                "row": anchors.column("row").take(who),
                "anchor_id": anchors.column("id").take(who),
                **{n: pa.array(out[n], pa.int64()) for n in ("positive_row", "positive_id", "positive_score")},
                "negative_row": pa.array(slot.rows).take(place),
                "negative_id": slot.ids.take(place),
                "negative_score": pa.array(out["score"], pa.int64()),
            }
        )

    listed = chosen.groupBy("row").agg(
        F.collect_list(F.struct("positive_row", "positive_id", "positive_score")).alias("positives")
    )
    anchors = index.rows.filter("anchor").select("row", "id", "label", "planes").join(listed, "row")
    schema = (
        "row long, anchor_id long, positive_row long, positive_id long, positive_score long, "
        "negative_row long, negative_id long, negative_score long"
    )
    found = _cells(index, anchors).applyInArrow(each, schema)
    order = [F.desc("negative_score"), F.asc_nulls_last("negative_id"), F.col("negative_row")]
    return top_n_per_group(found, ["row", "positive_row"], order, most, "rank")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    low: int = 50,
    high: int = 95,
    scale: int = 256,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score``, ``negative_score``: of
    each row that ``is_anchor``, its positives and their negatives."""
    index = build_index(vectors, is_anchor, scale, id_col, label, vector_col)
    columns = "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    if not index.anchors:
        kinds = (f"{name} {'int' if name == 'rank' else 'long'}" for name in columns)
        return vectors.sparkSession.createDataFrame([], ", ".join(kinds))
    chosen = stage(positives(index, n_positives))
    return negatives(index, chosen, n_negatives, low, high).select(*columns)


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    id_, label = F.col("vec_id"), F.col("label")
    return hard_negatives(
        table(spark, sf_dir, "embeddings"),
        is_anchor=id_ % 50 == 0,
        label=F.when(id_ % 7 == 0, (label + 1) % 10).otherwise(label),
    )


ORACLE = """
WITH q AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v,
    row_number() OVER (ORDER BY vec_id NULLS LAST) AS r
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
  FROM q a JOIN q b ON a.r <> b.r WHERE a.vec_id % 50 = 0),
p AS (
  SELECT * FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, id NULLS LAST, b) <= 5)
SELECT p.anchor_id, p.id AS positive_id,
  (row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.id NULLS LAST, s.b))::INT AS rank,
  s.id AS negative_id, p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON s.a = p.a AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score
QUALIFY rank <= 3
"""
