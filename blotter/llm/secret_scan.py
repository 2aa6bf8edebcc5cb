r"""Secrets in texts, told apart by how widely they are copied. Spark functions only.

Spans of known forms are found in each text. Their values, and long tokens of no known form, are
candidates: their hashes are aggregated over all documents into the distinct repositories and owners
that hold them. What many hold is an example that was copied; what few hold and looks random is live.
Long tokens that are live become spans of the kind ``live`` if no other span overlaps them.

Defined results: a null text is empty; a text without secrets has no spans and the digest of the empty
string. Null repositories and owners don't count as holders. Every row keeps its own line, repeated
rows too. An empty table gives an empty result. Only the named columns are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from blotter.llm.common import attach, located, stage, table

#: The forms of secrets. A match must be as long as given, or its last group.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs of at least so many characters: the same spans as all runs with the shorter ones dropped.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9_-]{20,}"

#: In the order in which spans with one start are listed.
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "live": TOKEN}
_LEAST_ASSIGNED = 6

_ROW = ["file", "position"]


def _found(text: Column, pattern: str) -> Column:
    """The matches of ``pattern``, and the lengths of what is before each and after the last."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda gap: F.length(gap))
    return F.when(text.rlike(pattern), F.struct(matches.alias("matches"), gaps.alias("gaps")))


def _candidates(scanned: DataFrame) -> DataFrame:
    """One row per match, with its place. Places are sums of lengths along a text, in code points."""
    each = None
    for order, kind in enumerate(KINDS):
        pairs = F.arrays_zip(
            F.col(f"{kind}.matches").alias("match"),
            F.slice(f"{kind}.gaps", 1, F.size(f"{kind}.matches")).alias("gap"),
        )
        rows = scanned.filter(F.col(kind).isNotNull()).select(
            *_ROW, "repo", "owner", F.posexplode(pairs).alias("nth", "pair")
        ).select(*_ROW, "repo", "owner", F.lit(order).alias("order"), "nth", "pair.match", "pair.gap")
        each = rows if each is None else each.unionByName(rows)
    along = Window.partitionBy(*_ROW, "order").orderBy("nth")
    length = F.length("match")
    end = F.sum(F.col("gap") + length).over(along)
    value = F.when(F.col("order") == 0, F.regexp_extract("match", ASSIGN, 1)).otherwise(F.col("match"))
    placed = each.withColumn("end", end).withColumn("value", value)
    return placed.withColumn("start", F.col("end") - length).filter(
        (F.col("order") > 0) | (F.length("value") >= _LEAST_ASSIGNED)
    )


def _looks_live(value: Column) -> Column:
    """Letters and digits mixed, and many different characters."""
    variety = F.size(F.array_distinct(F.split(value, "")))
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (variety >= 8)


def _free_of_others(candidates: DataFrame) -> DataFrame:
    """Without the long tokens that overlap a span of another kind."""
    known = F.col("order") < len(KINDS) - 1
    by_start = Window.partitionBy(*_ROW).orderBy("start", "order")
    before = F.max(F.when(known, F.col("end"))).over(by_start)
    after = F.min(F.when(known, F.col("start"))).over(
        by_start.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    )
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (
        F.coalesce(after, F.col("end")) >= F.col("end")
    )
    marked = candidates.withColumn("clear", clear)
    return marked.filter(known | F.col("clear")).drop("clear")


def ownership(candidates: DataFrame, by_text: bool = False) -> DataFrame:
    """``digest``, ``repos``, ``owners``: distinct holders of each candidate value. With ``by_text``
    the owner is the text itself, and each distinct text has one repository, the least of its copies'."""
    if by_text:
        holders = candidates.groupBy("digest", "owner").agg(F.min("repo").alias("repo"))
    else:
        holders = candidates.select("digest", "repo", "owner").distinct()
    return holders.groupBy("digest").agg(
        F.count_distinct("repo").alias("repos"), F.count_distinct("owner").alias("owners")
    )


def scan_secrets(
    docs: DataFrame,
    id_col: str,
    text_col: str,
    repo_col: str,
    owner_col: str | None,
    example_repos: int,
    example_owners: int,
) -> DataFrame:
    """Per row ``id`` and ``found``, its spans by start: ``kind``, ``start``, ``end`` (code points, end
    exclusive), ``digest`` of the value, ``repos``, ``owners``, ``verdict``: ``example`` from so
    many repositories or owners on, else ``live`` if it looks random, else ``plain``.

    Tables without owners take None: each distinct text then stands for its owner, so that exact
    copies of one text, from whatever repositories, are one holder.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    owner = F.sha2(text, 256) if owner_col is None else F.col(f"`{owner_col}`")
    scanned = located(
        stage(
            docs.select(
                F.col(f"`{id_col}`").alias("id"),
                F.col(f"`{repo_col}`").alias("repo"),
                owner.alias("owner"),
                *(_found(text, pattern).alias(kind) for kind, pattern in KINDS.items()),
            )
        )
    )
    looks_live = _looks_live(F.col("value"))
    tokens_live = (F.col("order") < len(KINDS) - 1) | looks_live
    candidates = stage(
        _free_of_others(_candidates(scanned).filter(tokens_live)).select(
            *_ROW, "repo", "owner", "order", "start", "end",
            looks_live.alias("looks_live"), F.sha2("value", 256).alias("digest"),
        )
    )
    example = (F.col("repos") >= example_repos) | (F.col("owners") >= example_owners)
    verdict = F.when(example, "example").when(F.col("looks_live"), "live").otherwise("plain")
    held = attach(
        candidates,
        ownership(candidates, owner_col is None),
        "digest",
        [F.col("file"), F.col("position"), F.col("start")],
    ).withColumn("verdict", verdict)
    kept = held.filter((F.col("order") < len(KINDS) - 1) | (F.col("verdict") == "live"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("order") + 1)
    span = F.struct("start", "order", kind.alias("kind"), "end", "digest", "repos", "owners", "verdict")
    # One document's spans, and no more, come together.
    by_row = kept.groupBy(*_ROW).agg(F.sort_array(F.collect_list(span)).alias("found"))
    none = F.array().cast(by_row.schema["found"].dataType)
    return (
        scanned.select("id", *_ROW)
        .join(by_row, _ROW, "left")
        .select("id", F.coalesce("found", none).alias("found"))
    )


def _listed(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


#: Found in different texts of so many sources, or in so many different texts, a value is an example.
EXAMPLE_REPOS, EXAMPLE_OWNERS = 3, 5


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = scan_secrets(docs, "doc_id", "text", "source", None, EXAMPLE_REPOS, EXAMPLE_OWNERS)

    def count(field: str, value: str) -> Column:
        return F.size(F.filter("found", lambda s: s[field] == value)).cast("long")

    base = F.filter("found", lambda s: s["kind"] != "live")
    return found.select(
        F.col("id").alias("doc_id"),
        *(count("kind", k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("found")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )
