"""Lexical search, hard negatives and MinHash near-duplicates against plain Python, with edge rows."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from blotter.llm import hard_negatives, lexical_search, minhash, toxicity, warc_fixity

WORDS = "the of and river Stone mountain cloud is forest bright harbour silent in quiet window garden été ß 7up".split()


def words(seed, n, vocabulary=WORDS):
    rng = random.Random(seed)
    return " ".join(rng.choice(vocabulary) + rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(n))


def changed(text, seed, n):
    rng = random.Random(seed)
    parts = text.split(" ")
    for at in rng.sample(range(len(parts)), n):
        parts[at] = f"x{rng.randint(0, 10**9)}"
    return " ".join(parts)


# ---- search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(low)


def brute_search(docs, queries, most):
    held = [Counter(terms(t)) for _, t in docs]
    n, length = sum(map(bool, held)), sum(sum(h.values()) for h in held)
    df = Counter(t for h in held for t in h)
    found = []
    for query_id, text in queries:
        scores = []
        for (doc_id, _), h in zip(docs, held):
            m = 25 + 75 * sum(h.values()) * n // length if length else 25
            score = 0
            for t in terms(text):
                if h[t]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                    score += w * (1_000_000_000 * h[t] // (1000 * h[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        found += [(query_id, i + 1, s[3], -s[0]) for i, s in enumerate(sorted(scores)[:most])]
    return found


@pytest.fixture
def small_shards(monkeypatch):
    monkeypatch.setattr(lexical_search, "SHARD_BYTES", 3000)
    monkeypatch.setattr(lexical_search, "QUERIES", 3)


DOCS = [
    (1, None), (2, ""), (3, " ?! "), (None, words(3, 40)), (5, words(4, 30)), (5, words(4, 30)), (None, words(4, 30)),
    (7, "river " * 700 + words(5, 3000)), (8, "River-stone; RIVER\x00stone\x7fÉté"), *((i, words(i, i % 90)) for i in range(9, 700)),
]
ASKED = [
    (1, "river stone"), (2, None), (2, ""), (3, "nothing1 of2 this3"), (4, words(4, 30)), (4, words(4, 30)),
    (None, "RIVER river river ÉTÉ été"), (6, words(6, 60)), (7, "the"),
]


def test_search_equals_brute_force(spark, small_shards):
    docs = spark.createDataFrame([(i, t, "a", 1) for i, t in DOCS], "doc_id long, text string, term string, shard int")
    queries = spark.createDataFrame([(i, t, 0) for i, t in ASKED], "item_id long, text string, query int")
    index = lexical_search.build_index(docs.repartition(3))
    assert index.filter("term IS NULL").count() > 6
    for most in (1, 10):
        found = lexical_search.search(index, queries, most, "item_id", "text")
        got = Counter((r.query_id, r.rank, r.doc_id, r.score) for r in found.collect())
        assert got == Counter(brute_search(DOCS, ASKED, most))


def test_blocks_without_candidates_stay_packed(spark, monkeypatch):
    """A rare term decides: of the common one's list, few blocks are unpacked."""
    rng = random.Random(1)
    texts = [f"common {rng.choice('abc')} filler{i}".encode() for i in range(3000)]
    for i in range(0, 40, 3):
        texts[i] = b"common rare rare"
    import pyarrow as pa

    batches = list(lexical_search.index_shard(0, pa.array(range(3000)), texts))
    rows = [r for b in batches for r in b.to_pylist()]
    corpus = lexical_search.Corpus(3000, sum(len(t.split()) for t in texts))
    parts = lexical_search.length_parts(np.frombuffer(rows[0]["lengths"], "<u4"), corpus)
    lists = [lexical_search.PostingList(r, corpus, 12) for r in rows if r["term"] in (b"common", b"rare")]
    weights = [5000 if len(x.places) < 100 else 1 for x in lists]
    places, score = lexical_search.best_of_shard(weights, lists, parts, 12, 10, np.arange(3000))
    assert places.tolist() == list(range(0, 30, 3)) and len(set(score.tolist())) == 1
    common = max(lists, key=lambda x: len(x.places))
    assert len(common.blocks) == 12 and list(common.unpacked) == [0]


def test_block_maxima_bound_all_postings():
    import pyarrow as pa

    texts = [("w " * random.Random(i).choice([1, 3, 300, 260]) + "z " * (i % 50)).encode() for i in range(700)]
    rows = [r for b in lexical_search.index_shard(0, pa.array(range(700)), texts) for r in b.to_pylist()]
    for corpus in (lexical_search.Corpus(700, 10_000), lexical_search.Corpus(10**9, 10**11)):
        parts = lexical_search.length_parts(np.frombuffer(rows[0]["lengths"], "<u4"), corpus)
        for row in rows[1:]:
            found = lexical_search.PostingList(row, corpus, 3)
            for block in found.blocks.tolist():
                docs, impacts = found.postings(block, parts)
                assert found.block_max[block] == impacts.max()
                times = [texts[d].split().count(row["term"]) for d in docs]
                assert impacts.tolist() == lexical_search.impact(np.array(times), parts[docs]).tolist()


def test_search_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    asked = spark.createDataFrame([(1, "river")], "item_id long, text string")
    assert lexical_search.search(lexical_search.build_index(none), asked, 10, "item_id", "text").count() == 0
    some = lexical_search.build_index(spark.createDataFrame([(1, "river"), (2, "stone")], "doc_id long, text string"))
    assert lexical_search.search(some, asked.limit(0), 10, "item_id", "text").count() == 0


# ---- hard negatives


def brute_negatives(rows, is_anchor, n_positives, n_negatives, low, high, scale=256):
    known = []
    for at, (id_, vector, label) in enumerate(rows):
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        known.append((at, id_, [math.floor(scale * x) for x in vector], label))
    order = lambda s: (-s[0], s[1] is None, s[1] or 0)
    found = []
    for at, id_, vector, label in known:
        if not is_anchor(id_):
            continue
        scores = [
            (sum(a * b for a, b in zip(vector, v)), i, own) for other, i, v, own in known if other != at
        ]
        alike = sorted((s for s in scores if s[2] == label), key=order)[:n_positives]
        for score, positive, _ in alike:
            fit = [s for s in scores if s[2] != label and low * score <= 100 * s[0] <= high * score]
            for rank, s in enumerate(sorted(fit, key=order)[:n_negatives], 1):
                found.append((id_, positive, rank, s[1], score, s[0]))
    return Counter(found)


@pytest.mark.parametrize("scale", [256, 40_000_000])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, scale):
    monkeypatch.setattr(hard_negatives, "SLOT_ROWS", 60)
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 7)
    rng = random.Random(4)
    vector = lambda n=11: [rng.choice([rng.uniform(-1, 1), 0.5, -0.25]) for _ in range(n)]
    common = vector()
    rows = [(i, common if i % 3 == 0 else vector(), rng.randint(0, 2)) for i in range(300)]
    rows += [(None, vector(), 1), (300, None, 1), (310, vector(), None), (320, [], 1), (330, vector(4), 2)]
    rows += [(340, [1.0, None], 1), (350, [float("nan")] * 11, 1), (360, [float("inf")] * 11, 1), (370, vector(30), 0)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, row string")
    found = hard_negatives.hard_negatives(df, F.col("vec_id") % 10 == 0, F.col("label"), 4, 2, 50, 95, scale)
    expected = brute_negatives(rows, lambda i: i is not None and i % 10 == 0, 4, 2, 50, 95, scale)
    got = found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    assert Counter(map(tuple, got.collect())) == expected and len(expected) > 50


def test_table_scores_are_inner_products():
    rng = np.random.default_rng(2)
    for bits in (1, 2, 9, 20):
        reach = 1 << bits - 1
        a, b = (rng.integers(-reach, reach, (n, 24)) for n in (5, 40))
        packed = hard_negatives.pack(b, bits)
        assert (hard_negatives.unpack(packed) == b).all()
        assert (hard_negatives.scores(hard_negatives.subset_sums(a), packed) == b @ a.T).all()


def test_hard_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(none, F.col("vec_id") > 0, F.col("label")).count() == 0
    one = spark.createDataFrame([(0, [1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.hard_negatives(one, F.col("vec_id") == 0, F.col("label")).count() == 0


# ---- near-duplicates


def brute_components(rows, width, least):
    sets = []
    for _, text in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        found = re.findall(r"[^\x20\x09-\x0D]+", low)
        n = min(width, len(found))
        sets.append({" ".join(found[i : i + n]) for i in range(len(found) - n + 1)} if found else set())
    group = list(range(len(rows)))

    def root(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= least * (len(sets[i]) + len(sets[j]) - both):
                group[root(i)] = root(j)
    least_id = defaultdict(list)
    for i, (id_, _) in enumerate(rows):
        least_id[root(i)].append(id_)
    smallest = {r: min((x for x in ids if x is not None), default=None) for r, ids in least_id.items()}
    return Counter((id_, len(sets[i]), smallest[root(i)], smallest[root(i)] == id_) for i, (id_, _) in enumerate(rows))


def near_rows():
    base = [words(100 + i, 60 + 15 * i) for i in range(6)]
    rows = [(i, changed(base[i % 6], i, i % 5)) for i in range(120)]
    passage = words(7, 70)  # in many documents that aren't near each other
    rows += [(200 + i, f"{words(300 + i, 60)} {passage} {words(400 + i, 60)}") for i in range(60)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "one two"), (504, "ONE  two"), (505, "one"), (506, "one")]
    rows += [(5, rows[5][1]), (5, rows[5][1]), (None, rows[7][1]), (None, "alone in here with nobody at all")]
    rows += [(900, words(9, 9000)), (890, changed(words(9, 9000), 1, 40))]
    return rows


@pytest.mark.parametrize("pairs_a_row", [0, 512])
def test_minhash_equals_brute_force(spark, monkeypatch, pairs_a_row):
    """Also by pivots alone, round by round, where no pairs may be left to the end."""
    rows = near_rows() if pairs_a_row else near_rows()[:40]
    monkeypatch.setattr(minhash, "PAIRS_A_ROW", pairs_a_row)
    monkeypatch.setattr(minhash, "_AT_ONCE", 100)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, row int, key string")
    found = minhash.near_duplicates(df, 5, 85)
    assert found.columns == ["id", "n_shingles", "component_id", "kept"]
    assert Counter(map(tuple, found.collect())) == brute_components(rows, 5, 85)


def test_pairs_within_the_distance_share_a_key(spark):
    """Every pair of signatures up to the distance, whichever places differ, with equal classes."""
    rng = np.random.default_rng(1)
    a = rng.integers(0, 1 << 16, (300, 32)).astype("<u2")
    b = a.copy()
    for row in range(300):
        b[row, rng.choice(32, 15, replace=False)] ^= 1
    numbers = [[s.view("<i8").tolist() for s in sides] for sides in zip(a, b)]
    df = spark.createDataFrame(numbers, "a array<long>, b array<long>")
    keys = df.select(minhash.keys_of(F.col("a")).alias("a"), minhash.keys_of(F.col("b")).alias("b")).collect()
    apart = minhash.places_apart(a.view("<i8"), b.view("<i8"))
    assert (apart.sum(axis=1) == 15).all()
    for row, first in zip(keys, minhash.first_shared(apart)):
        shared = sorted({x >> 48 for x in set(row.a) & set(row.b)})
        assert shared and shared[0] == first


def test_sketch_bounds_lose_no_link():
    rng = random.Random(3)
    for n in (1, 5, 30, 200, 3000):
        text = words(n, n)
        for times in range(0, max(1, n // 60) + 1):
            other = changed(text, times, times)
            x, y = (minhash.shingle_hashes(t.encode(), 5) for t in (text, other))
            differ = len(np.setxor1d(x, y))
            bits = (minhash.parities(x) ^ minhash.parities(y)).view(np.uint64)
            assert np.bitwise_count(bits).sum() <= differ
    assert rng


def test_minhash_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(none, 5, 85).collect() == []
    lone = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert sorted(map(tuple, minhash.near_duplicates(lone, 5, 85).collect())) == [(1, 1, 1, True), (2, 0, 2, True)]


# ---- earlier operators


def test_toxicity_learns_alike_whatever_the_partitioning(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    scores = set()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in (2, 200):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            scorer = toxicity.fit_on_labels(docs.repartition(parts // 2), labels.repartition(parts))
            featured = scorer.featurize(docs, "text", "features").drop("text")
            scores.add(tuple(sorted(map(tuple, scorer.score(featured, "features").select("doc_id", "score").collect()))))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(scores) == 1


def test_records_that_repeat_fill_no_file(spark):
    rows = [(None if i < 2000 else i, "u", "same" if i < 2000 else f"record {i}") for i in range(4000)]
    records = spark.createDataFrame(rows, "id long, name string, record string")
    index = warc_fixity.record_index(records)
    placed = warc_fixity.archive(index, 20).groupBy("file").agg(
        F.count("*").alias("n"), F.max("end").alias("end"), F.sum("size").alias("size"), F.max("number").alias("last")
    ).collect()
    assert sum(r.n for r in placed) == 4000 and len(placed) == 20
    assert max(r.n for r in placed) < 2 * 200
    assert all(r.end == r["size"] and r["last"] == r.n - 1 for r in placed)
