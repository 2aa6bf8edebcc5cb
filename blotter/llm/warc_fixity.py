r"""Fixity audit of WARC replicas by Merkle trees.

Records of an archive are leaves: file, number in the file, range of offsets, and SHA-256. A node
above covers ``FAN_OUT`` neighbours, its hash made of their ranges and hashes; the tree goes on from
the files' roots to one root for the archive. Replicas are compared at the root, and only children
of nodes that differ are looked at, down to the records that are damaged, missing or surplus.

Defined results: null url and html are empty strings in a record, a null id is the text ``null``.
Identical records stand behind each other in a file and are told apart by their number. Equal replicas
give an empty result, and so do two empty ones; with one replica empty all records of the other
are reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import attach, stage, table

FAN_OUT = 16

_NODE = ["file", "node"]


def warc_record(id_: Column, url: Column, body: Column) -> Column:
    """A WARC response record as text; lengths are in bytes."""
    body = F.coalesce(body, F.lit(""))
    header = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(id_.cast("string"), F.lit("null")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(header, body, F.lit("\r\n\r\n"))


def record_index(records: DataFrame, *more: Column) -> DataFrame:
    """What the layout and the trees need of ``records`` (``id``, ``name``, ``record``): ``size``, ``hash``
    (SHA-256), and ``more`` columns made from them. The bytes themselves are not moved."""
    size = F.octet_length("record").cast("long").alias("size")
    return records.select("id", "name", size, F.sha2("record", 256).alias("hash"), *more)


def archive(index: DataFrame, files: int) -> DataFrame:
    """Lay out the records of ``index``, which is read more than once, in ``files`` files: adds ``file``, ``number``,
    ``start``, ``end``.

    The file comes from a hash of the whole record, the order in it from id and record. Records that are
    there several times are dealt by a number as well, as many numbers as copies, so that a file holds about
    as many records as any other.
    """
    key = F.concat_ws(":", F.coalesce(F.col("id").cast("string"), F.lit("null")), "hash")
    keyed = index.withColumn("__key", key)
    counts = keyed.groupBy("__key").agg(F.count("*").alias("__rows"))
    repeated = stage(counts.filter("__rows > 1"))
    dealt_by = F.col("__key")
    if not repeated.isEmpty():
        numbered = keyed.withColumn("__at", F.monotonically_increasing_id())
        copies = repeated.withColumn("__copies", F.col("__rows"))
        keyed = attach(
            numbered, copies.select("__key", "__copies"), "__key", [F.col("__at")], "left", counts=repeated
        )
        number = F.pmod(F.xxhash64("__at"), F.coalesce("__copies", F.lit(1)))
        dealt_by = F.when(number == 0, F.col("__key")).otherwise(F.concat_ws(":", "__key", number))
    hashed = F.conv(F.substring(F.md5(dealt_by), 1, 8), 16, 10).cast("long")
    inside = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "name", "hash")
    dealt = keyed.select(*(F.col(f"`{c}`") for c in index.columns), F.pmod(hashed, F.lit(files)).alias("file"))
    placed = dealt.withColumn("number", (F.row_number().over(inside) - 1).cast("long"))
    upto = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.withColumn("end", upto).withColumn("start", F.col("end") - F.col("size"))


def leaves(archived: DataFrame) -> DataFrame:
    """``file``, ``node`` (the record's number), ``start``, ``end``, ``hash``, ``id``."""
    return archived.select("file", F.col("number").alias("node"), "start", "end", "hash", "id")


@dataclass
class Tree:
    """Levels of nodes from the leaves up. In a level above the files, ``file`` is the number of a
    group of files."""

    levels: list[DataFrame]


def _parent(depth: int, file_levels: int) -> list[Column]:
    """Where a node of the level ``depth`` belongs in the next one."""
    if depth < file_levels:
        return [F.col("file"), F.floor(F.col("node") / FAN_OUT).alias("node")]
    return [F.floor(F.col("file") / FAN_OUT).alias("file"), F.col("node")]


def heights(*replicas: DataFrame) -> tuple[int, int]:
    """Levels that join the records of a file, and those that join the files, for all replicas."""
    most = [r.agg(F.max("node").alias("node"), F.max("file").alias("file")).collect()[0] for r in replicas]
    node, file = (max([m[k] for m in most if m[k] is not None], default=0) for k in ("node", "file"))
    return tuple(_height(n + 1) for n in (node, file))


def _height(count: int) -> int:
    levels = 0
    while count > 1:
        count, levels = -(-count // FAN_OUT), levels + 1
    return levels


def build(replica_leaves: DataFrame, file_levels: int, archive_levels: int) -> Tree:
    """The tree over ``leaves``. A node gathers ``FAN_OUT`` children at most."""
    levels = [stage(replica_leaves)]
    for depth in range(file_levels + archive_levels):
        child = F.struct(*_NODE, "start", "end", "hash")
        listed = F.transform(
            F.array_sort(F.collect_list(child)), lambda c: F.concat_ws(":", c["start"], c["end"], c["hash"])
        )
        up = levels[-1].groupBy(*_parent(depth, file_levels)).agg(
            F.min("start").alias("start"),
            F.max("end").alias("end"),
            F.sha2(F.array_join(listed, ","), 256).alias("hash"),
        )
        levels.append(stage(up))
    return Tree(levels)


def audit(primary: Tree, replica: Tree, file_levels: int) -> DataFrame:
    """Leaves that differ: ``file``, ``number``, ``start``, ``end``, ``id``, ``status``, both hashes."""
    top = len(primary.levels) - 1
    differing = None
    for depth in range(top, -1, -1):
        mine, theirs = primary.levels[depth], replica.levels[depth]
        if differing is not None:
            mine, theirs = (_below(level, differing, depth, file_levels) for level in (mine, theirs))
        a, b = (_renamed(level, prefix) for level, prefix in ((mine, "a_"), (theirs, "b_")))
        at = (a.a_file == b.b_file) & (a.a_node == b.b_node)
        if depth == 0:
            at &= a.a_start == b.b_start
        pairs = a.join(b, at, "full_outer").filter(
            ~(F.col("a_hash").eqNullSafe(F.col("b_hash")) & F.col("a_end").eqNullSafe(F.col("b_end")))
        )
        if depth == 0:
            return pairs.select(
                F.coalesce("a_file", "b_file").alias("file"),
                F.coalesce("a_node", "b_node").alias("number"),
                F.coalesce("a_start", "b_start").alias("start"),
                F.coalesce("a_end", "b_end").alias("end"),
                F.coalesce("a_id", "b_id").alias("id"),
                F.when(F.col("b_hash").isNull(), "missing")
                .when(F.col("a_hash").isNull(), "surplus")
                .otherwise("damaged")
                .alias("status"),
                F.col("a_hash").alias("sha256"),
                F.col("b_hash").alias("replica_sha256"),
            )
        differing = stage(
            pairs.select(*(F.coalesce(f"a_{n}", f"b_{n}").alias(f"up_{n}") for n in _NODE)).distinct()
        )
    raise ValueError("a tree has at least the level of its leaves")


def _below(level: DataFrame, differing: DataFrame, depth: int, file_levels: int) -> DataFrame:
    file, node = _parent(depth, file_levels)
    at = (F.col("up_file") == file) & (F.col("up_node") == node)
    return level.join(differing, at, "left_semi")


def _renamed(level: DataFrame, prefix: str) -> DataFrame:
    return level.select(*(F.col(name).alias(prefix + name) for name in level.columns))


def audit_replicas(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Compare two replicas given as ``leaves``."""
    file_levels, archive_levels = heights(primary, replica)
    trees = [build(r, file_levels, archive_levels) for r in (primary, replica)]
    return audit(*trees, file_levels)


def damage(rules: Sequence[int]) -> Column:
    """What a derived replica holds instead of ``record``: of the ids whose remainders by the three
    ``rules`` are 1, records have their last byte lost, a sign changed, or are missing (null)."""
    short, changed, lost = (F.coalesce(F.col("id") % rule == 1, F.lit(False)) for rule in rules)
    length = F.length("record")
    return (
        F.when(lost, None)
        .when(short, F.substring("record", F.lit(1), length - 1))
        .when(changed, F.concat(F.lit("w"), F.substring("record", F.lit(2), length)))
        .otherwise(F.col("record"))
    )


#: Records of a file, about; which ids the derived replica has short, changed, and not at all.
FILE_RECORDS, DAMAGE = 1000, (97, 193, 389)


def op10_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    records = pages.select(
        F.col("page_id").alias("id"),
        F.coalesce("url", F.lit("")).alias("name"),
        warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"),
    )
    copy = damage(DAMAGE)
    index = stage(
        record_index(
            records,
            F.sha2(copy, 256).alias("copy_hash"),
            F.octet_length(copy).cast("long").alias("copy_size"),
        )
    )
    archived = stage(archive(index, max(1, -(-pages.count() // FILE_RECORDS))))
    # Offsets stay those of the archive's index.
    replica = archived.filter("copy_hash IS NOT NULL").withColumns(
        {"hash": F.col("copy_hash"), "end": F.col("start") + F.col("copy_size")}
    )
    found = audit_replicas(leaves(archived), leaves(replica))
    return found.withColumnRenamed("id", "page_id")


ORACLE = r"""
WITH r AS (
  SELECT page_id, coalesce(url, '') AS name,
    'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) ||
    'WARC-Record-ID: <urn:page:' || coalesce(page_id::VARCHAR, 'null') || '>' || chr(13) || chr(10) ||
    'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10) ||
    'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) ||
    coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
  FROM pages),
f AS (
  SELECT *, ('0x' || substr(md5(coalesce(page_id::VARCHAR, 'null') || ':' || sha256(record)), 1, 8))::BIGINT
      % greatest(1, ceil((SELECT count(*) FROM pages) / 1000))::BIGINT AS file
  FROM r),
p AS (
  SELECT *, row_number() OVER o - 1 AS number,
    (sum(strlen(record)) OVER (o ROWS UNBOUNDED PRECEDING))::BIGINT AS "end"
  FROM f WINDOW o AS (PARTITION BY file ORDER BY page_id NULLS FIRST, name, sha256(record))),
c AS (
  SELECT *, CASE WHEN page_id % 97 = 1 THEN left(record, length(record) - 1)
      WHEN page_id % 193 = 1 THEN 'w' || substr(record, 2) ELSE record END AS copy
  FROM p)
SELECT file, number, "end" - strlen(record) AS start, "end", page_id,
  CASE WHEN coalesce(page_id % 389 = 1, false) THEN 'missing' ELSE 'damaged' END AS status, sha256(record) AS sha256,
  CASE WHEN coalesce(page_id % 389 = 1, false) THEN NULL ELSE sha256(copy) END AS replica_sha256
FROM c WHERE copy <> record OR page_id % 389 = 1
"""
