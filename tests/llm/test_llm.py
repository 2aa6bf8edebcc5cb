"""The training-data operators on edge rows, against plain Python and SQL."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from blotter.llm import chunk_dedup, language_id, mixing, packing, secret_scan, simhash, spotsigs, toxicity
from blotter.llm import warc_fixity
from blotter.llm.components import connected_components
from blotter.llm.exact_dedup import exact_dedup
from blotter.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id string"

WORDS = "the of and river stone mountain cloud is forest bright harbour silent in quiet window garden".split()


def words(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice("abcdefgh") * rng.randint(0, 2) for _ in range(n))


ROWS = [
    (1, None, None, None, None, "x", "y"),
    (2, "", "en", "a", 0, "x", "y"),
    (3, words(1, 300), "en", "a", 1, "x", "y"),
    (4, words(1, 300) + " \n", "en", "b", 1, "x", "y"),
    (5, words(1, 300), None, None, 1, "x", "y"),
    (5, words(1, 300), None, None, 1, "x", "y"),
    (None, words(2, 40), "de", "c", 1, "x", "y"),
    (7, "aé" * 20_000 + " 日本 password = 'hunter22x'", "fr", "a", 1, None, None),
    (8, words(3, 60) + " " + words(1, 300)[:700] + " " + words(4, 30), "en", "é", 1, "x", "y"),
    (9, "!!! \t\r\n ???", "en", "b", 1, "x", "y"),
    (10, words(5, 5000), "en", "b", 1, "x", "y"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(text):
    return re.sub(r"[\x20\x09-\x0D]+", "", text or "")


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(docs, weak):
    digest = {"digest_of": lambda sha: F.substring(sha, 1, 1)} if weak else {}
    done = exact_dedup(docs, **digest, files_per_batch=2)
    rows = done.rows.collect()
    groups = defaultdict(list)
    for r in ROWS:
        groups[plain(r[1])].append(r)
    assert len(rows) == len(ROWS)
    for r in rows:
        group = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == r.text_sha256)
        best = min(group, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))
        assert (r.group_size, r.keep_id) == (len(group), best[0])
    assert sum(r.kept for r in rows) == len(groups)
    kept = done.kept()
    assert kept.columns == docs.columns and kept.count() == len(groups)


def simhash_of(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(found[i : i + 3]) for i in range(len(found) - 2)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs):
    rows = simhash.near_duplicates(docs, 3, 2).collect()
    expected = Counter((r[0], simhash_of(r[1])) for r in ROWS)
    assert Counter((r.id, r.fingerprint % 2**64) for r in rows) == expected
    assert {r.component_id for r in rows if r.id in (3, 4, 5)} == {3}
    assert len({r.component_id for r in rows}) == sum(r.kept for r in rows)
    assert simhash.one_of_each(docs, 3, 2).columns == docs.columns


def test_close_links_connect_all_within_two_bits(spark):
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(150)]
    for v in list(values):
        for _ in range(rng.randint(0, 3)):
            values.append(v ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    values = sorted({v - 2**64 if v >> 63 else v for v in values})
    links = simhash.close_links(spark.createDataFrame([(v,) for v in values], "fingerprint long"), 2)
    label = {r.node: r.label for r in connected_components(links).collect()}
    parent = {v: v for v in values}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if ((a ^ b) % 2**64).bit_count() <= 2:
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert all(label.get(v, v) == root(v) for v in values)


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(100)]
    hub = [(1000, 1000 + i) for i in range(1, 300)]
    rows = connected_components(spark.createDataFrame(chain + hub, "a long, b long")).collect()
    assert {(r.node <= 100, r.label) for r in rows} == {(True, 0), (False, 1000)} and len(rows) == 401


def test_mixing(docs):
    rows = mixing.mix(docs, (5, 2, 1), (3, 2), 2).collect()
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))
    assert sorted(r.size for r in rows) == sorted(len((r[1] or "").split()) for r in ROWS)
    assert {r.source_size for r in rows} == set(sizes.values())
    targets = {r.source_size: r.target for r in rows}
    assert sum(targets[s] for s in sizes.values()) == pytest.approx(1.5 * sum(sizes.values()))
    assert all(r.target <= 2 * r.source_size + 1e-6 and 0 <= r.times <= 2 for r in rows)
    taken = mixing.take(docs, (5, 2, 1), (3, 2), 2)
    assert taken.columns == docs.columns


def test_mixing_comes_nearest_to_the_target(spark):
    rng = random.Random(9)
    many = [(i, "w " * rng.choice([1, 3, 8, 400]), rng.choice("abcd")) for i in range(300)] + [(300, "w " * 900, "e")]
    rows = mixing.mix(spark.createDataFrame(many, "doc_id long, text string, source string"), (5, 2, 1), (3, 2), 2).collect()
    source = {i: s for i, _, s in many}
    for name in "abcde":
        own = [r for r in rows if source[r.id] == name]
        taken = sum(r.size * r.times for r in own)
        assert abs(taken - own[0].target) <= max(r.size for r in own) / 2
        assert all(r.times <= 2 for r in own)


def test_mixing_keeps_repeated_rows_together(spark):
    same = spark.createDataFrame([(1, "a b", "s")] * 50 + [(i, "c d", "t") for i in range(50)], "doc_id long, text string, source string")
    rows = mixing.mix(same, (1, 1), (1, 2), 2).collect()
    taken = Counter()
    for r in rows:
        taken[r.id == 1 and r.times] += r.size * r.times
    assert len(rows) == 100 and all(r.times in (0, 1) for r in rows)


def test_packing(docs):
    rows = packing.pack(docs, 64, packing.default_ranks_path()).collect()
    tokenizer = packing.ByteTokenizer(packing.default_ranks_path())
    expected = Counter()
    for r in ROWS:
        ids = np.array([*tokenizer.encode(r[1] or ""), 0], "<u4")
        for start in range(0, len(ids), 64):
            piece = ids[start : start + 64]
            expected[r[0], start, len(piece), zlib.crc32(piece.tobytes()), len(ids)] += 1
    assert Counter((r.id, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 64


def test_tokenizer_files_agree():
    import public_tokenizers
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    theirs.encode_special_tokens = True
    ours = packing.ByteTokenizer(packing.default_ranks_path())
    texts = [r[1] or "" for r in ROWS if len(r[1] or "") < 5000]
    for text in [*texts, "a  b \n\n c\t", "it's <|endoftext|> 12.5%", "é ñ  ", " x"]:
        assert ours.encode(text) == theirs.encode(text, add_special_tokens=False).ids


def test_runs_of_over_a_million_blanks_are_encoded(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    theirs.encode_special_tokens = True
    ours = packing.ByteTokenizer(packing.default_ranks_path())
    many = " " * 1_000_001
    edge = packing.LONGEST_RUN
    texts = [many, f"a{many}word", "\n" * 1_000_001 + "x", " " * edge + "b", " " * (edge + 1) + "b", "it  is <|endoftext|>\t" * 5_000]
    expected = [theirs.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ours.encode(text) for text in texts] == expected
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    packed = packing.pack(docs, 1024, packing.default_ranks_path())
    assert {r.id: r.doc_tokens for r in packed.collect()} == {i: len(e) + 1 for i, e in enumerate(expected)}


def test_patterns_hold_every_piece():
    histogram = {1: 7, 3: 50, 30: 4, 33: 9, 64: 2}
    packs = packing.pack_lengths(histogram, 64)
    held = Counter()
    for pattern, count in packs.items():
        assert sum(pattern) <= 64
        for length in pattern:
            held[length] += count
    assert held == histogram


def spotsigs_order(row):
    return row[0] is not None, row[0] or 0, hashlib.md5(row[1].encode()).hexdigest()


def test_spotsigs(docs):
    rows = spotsigs.compare_with_edits(docs, 0.1).collect()
    order = sorted(((r[0], r[1] or "") for r in ROWS), key=spotsigs_order)
    edited = Counter()
    for (id_, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited[id_, text[: len(text) - half] + following[:half]] += 1
    assert Counter((r.id, r.edited) for r in rows) == edited
    by_text = defaultdict(set)
    for r in rows:
        by_text[r.text].add(tuple(r.signatures))
    assert all(len(s) == 1 for s in by_text.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in rows)


def test_spotsigs_buckets(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "_BUCKET_ROWS", 3)
    rows = [(i * i, f"the word{i} is here{i}") for i in range(20)]
    found = spotsigs.compare_with_edits(spark.createDataFrame(rows, "doc_id long, text string"), 0.1).collect()
    following = {a[0]: b[1] for a, b in zip(rows, rows[1:] + rows[:1])}
    assert len(found) == 20
    assert all(r.edited.endswith(following[r.id][: len(r.text) // 2]) for r in found)


@pytest.mark.parametrize("hot", ["null", "5", "cast(-id AS bigint)"])
def test_spotsigs_splits_hot_ids_and_equal_rows(spark, hot):
    docs = spark.range(16000, numPartitions=4).selectExpr(
        f"if(id % 2 = 0, {hot}, id) AS doc_id",
        "if(id % 4 = 0, 'the same word here', concat('the word', id, ' is here')) AS text",
    )
    ring, _ = spotsigs._ring(docs.selectExpr("doc_id AS id", "text"))
    sizes = sorted(r["count"] for r in ring.groupBy(F.spark_partition_id()).count().collect())
    assert len(sizes) == 8 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    order = sorted(((r.doc_id, r.text) for r in docs.collect()), key=spotsigs_order)
    edited = Counter()
    for (id_, text), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(text) // 2
        edited[id_, text[: len(text) - half] + following[:half]] += 1
    found = spotsigs.compare_with_edits(docs, 0.1).select("id", "edited").collect()
    assert Counter((r.id, r.edited) for r in found) == edited


def test_spotsigs_takes_ids_of_other_types(spark, monkeypatch):
    monkeypatch.setattr(spotsigs, "_BUCKET_ROWS", 3)
    docs = spark.range(50).selectExpr("concat('k', lpad(id, 3, '0')) AS name", "concat('the text ', id) AS body")
    found = spotsigs.compare_with_edits(docs, 0.1, "name", "body").collect()
    texts = [f"the text {i}" for i in range(50)]
    half = [len(text) // 2 for text in texts]
    expected = {
        f"k{i:03}": texts[i][: len(texts[i]) - half[i]] + texts[(i + 1) % 50][: half[i]] for i in range(50)
    }
    assert {r.id: r.edited for r in found} == expected
    again = spotsigs.compare_with_edits(
        docs.selectExpr("date_add(DATE'2020-01-01', cast(right(name, 3) AS int)) AS name", "body"), 0.1, "name", "body"
    ).collect()
    assert sorted(r.edited for r in again) == sorted(r.edited for r in found)


def test_secret_scan(docs, spark):
    texts = [
        "password=token=abcdefgh", "password: a secret=abcdefg", "token=abc:defghijk", "ééé AKIA" + "A1" * 9,
        "api_key : 'zz/zz==zz' Passwd=abcdef", "f" * 24 + " " + "0" * 23, "aB3dE5gH7jK9mN1pQ3sT5",
    ]
    rows = [*ROWS, *((100 + i, t, "en", "a", 1, "x", "y") for i, t in enumerate(texts))]
    found = secret_scan.scan_secrets(
        spark.createDataFrame(rows, SCHEMA), "doc_id", "text", "source", "doc_id", 3, 5
    ).collect()
    assign = re.compile(
        r"""((?ia:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    )
    expected = Counter()
    for r in rows:
        text = r[1] or ""
        spans = [("assign", m) for m in assign.finditer(text) if len(m[2]) >= 6]
        spans += [("access", m) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        spans += [("hex", m) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        expected[r[0], tuple(sorted((m.start(), k, m.end()) for k, m in spans))] += 1
    got = Counter(
        (r.id, tuple(sorted((s.start, s.kind, s.end) for s in r.found if s.kind != "live"))) for r in found
    )
    assert got == expected
    assert [s.kind for r in found if r.id == 106 for s in r.found] == ["live"]


def test_secrets_held_by_many_are_examples(spark):
    key = "AKIA" + "Q7" * 8
    rows = [(i, f"key {key}", f"s{i}") for i in range(5)] + [(9, "AKIA" + "ABCDEFGH12345678", "s")]
    found = secret_scan.scan_secrets(
        spark.createDataFrame(rows, "doc_id long, text string, source string"), "doc_id", "text", "source", "doc_id", 3, 5
    )
    verdicts = {r.id: r.found[0].verdict for r in found.collect()}
    assert verdicts == {**dict.fromkeys(range(5), "example"), 9: "live"}


def test_copies_of_one_text_do_not_make_an_example(spark, tmp_path):
    leaked, token, shown = "AKIA" + "Q7W8E9R2" * 2, "aB3dE5gH7jK9mN1pQ3sT5", "AKIA" + "Z5X4C3V2" * 2
    rows = [(i, f"key {leaked} and {token}", f"s{i}") for i in range(7)]
    rows += [(10 + i, f"text {i} has {shown}", "s") for i in range(5)]
    rows += [(20 + i, f"text {i} has AKIA{'M6N7B8V9' * 2}", f"s{i}") for i in range(3)]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r.doc_id: r for r in secret_scan.op9_secret_scan(spark, str(tmp_path)).collect()}
    assert {(found[i].n_live, found[i].n_example) for i in range(7)} == {(2, 0)}
    assert all("live:" in found[i].spans for i in range(7))
    assert {(r.n_live, r.n_example) for i, r in found.items() if i >= 10} == {(0, 1)}


def test_chunk_ends_do_not_depend_on_where_a_passage_stands():
    passage = words(7, 80)
    ends = []
    for before in ("", words(8, 13) + "\n", "z" * 500 + "  "):
        cut = chunk_dedup.Words(f"{before}{passage} {'tail ' * 20}".encode()).chunk_ends() - len(before.split())
        ends.append({int(e) for e in cut})
    low, high = chunk_dedup.WINDOW // 2 - 1 + chunk_dedup.REACH, 79 - chunk_dedup.REACH
    inside = [{e for e in some if low <= e <= high} for some in ends]
    assert inside[0] == inside[1] == inside[2] and inside[0]


def passages_of(rows, least):
    """All runs of windows that stand in several rows: id, start, end, words, first id, copies."""
    places, seen, copies = [], defaultdict(set), Counter()
    for row, (_, text) in enumerate(rows):
        places.append([(m.start(), m.end(), m.group()) for m in re.finditer(r"[^\x20\x09-\x0D]+", text or "")])
        for at in range(len(places[row]) - least + 1):
            window = tuple(w for _, _, w in places[row][at : at + least])
            seen[window].add(row)
            copies[window] += 1
    out = Counter()
    for row, (id_, _) in enumerate(rows):
        found, run = places[row], []
        for at in range(len(found) - least + 2):
            window = tuple(w for _, _, w in found[at : at + least]) if at <= len(found) - least else None
            if window and len(seen[window]) > 1:
                run.append((at, window))
            elif run:
                ids = [rows[r][0] for r in seen[run[0][1]] if rows[r][0] is not None]
                end = run[-1][0] + least - 1
                most = max(copies[w] for _, w in run)
                out[id_, found[run[0][0]][0], found[end][1], len(run) + least - 1, min(ids, default=None), most] += 1
                run = []
    return out


def short_words(rng, n, longest):
    return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randint(1, longest))) for _ in range(n))


def check_passages(spark, rows, least):
    found = chunk_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), least)
    columns = ["id", "start", "end", "words", "first_id", "copies"]
    expected = passages_of(rows, least)
    assert Counter(map(tuple, found.select(*columns).collect())) == expected
    return expected


@pytest.mark.parametrize("longest", [1, 2, 3, 5, 9])
def test_passages_equal_brute_force(spark, longest):
    """Of 20 to 80 words with different neighbours, overlapping, in three rows, and with other white space."""
    rng, rows = random.Random(longest), []
    for i in range(120):
        n = rng.choice([20, 40, 48, 49, 50, 51, 52, 60, 80])
        passage = short_words(rng, n, longest)
        parts = passage.split()
        sides = [short_words(rng, rng.randint(0, 90), longest) for _ in range(6)]
        rows.append((3 * i, f"{sides[0]} {passage} {sides[1]}"))
        rows.append((3 * i + 1, f"{sides[2]}\n\t{'  '.join(parts)} {sides[3]}"))
        if i % 3 == 0:
            rows.append((None if i % 2 else 3 * i + 2, f"{sides[4]} {' '.join(parts[5:])} {sides[5]} é日 {' '.join(parts[:-3])}"))
    expected = check_passages(spark, rows, 50)
    assert len(expected) > 60 and min(k[3] for k in expected) == 50


def test_passages_of_edge_rows(docs, spark):
    check_passages(spark, [(r[0], r[1]) for r in ROWS], 50)
    one = words(31, 70)
    check_passages(spark, [(1, one), (1, one), (2, f"{one} {one}"), (3, f"{words(32, 60)} " * 2), (4, "a " * 200), (5, "b a " * 99)], 50)
    check_passages(spark, [(1, "na " * 120), (2, "x" + " na" * 90), (None, "na"), (4, " \n "), (5, "z" * 70_000)], 50)


def test_passages_of_texts_over_a_span(spark, monkeypatch):
    monkeypatch.setattr(chunk_dedup, "_SPAN", 64)
    monkeypatch.setattr(chunk_dedup, "_ROWS", 10)
    rng = random.Random(5)
    one = short_words(rng, 300, 6)
    check_passages(spark, [(1, one), (2, f"{short_words(rng, 70, 30)} {one}"), (3, short_words(rng, 400, 4))], 50)


def test_repeated_passages(docs, spark):
    found = chunk_dedup.repeated_passages(docs, 15).collect()
    assert {3, 4, 5, 8} <= {r.id for r in found}
    texts = {r[0]: r[1] for r in ROWS}
    inside = [texts[8][r.start : r.end] for r in found if r.id == 8]
    assert all(part in texts[3] for part in inside)
    alone = spark.createDataFrame([(1, words(11, 400)), (2, words(12, 400)), (3, "a" * 3000)], "doc_id long, text string")
    assert chunk_dedup.repeated_passages(alone, 15).count() == 0


def test_passages_of_fifty_words_are_found(spark):
    rows = []
    for i in range(60):
        passage = words(1000 + i, 51)
        rows += [(2 * i, f"{words(2000 + i, 80)} {passage} {words(3000 + i, 60)}")]
        rows += [(2 * i + 1, f"{words(4000 + i, 33)} {passage} {words(5000 + i, 20)}")]
    found = chunk_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 15)
    assert len({r.id for r in found.collect()}) == 120


def test_periodic_passages_are_found_at_any_offset(spark):
    rows = []
    for i, cell in enumerate(["na ", "word ", "| - ", "no yes ", "longer words "]):
        for j in range(2):
            rows.append((2 * i + j, words(6000 + 2 * i + j, 20 + 13 * j) + " " + cell * 110 + words(7000 + 2 * i + j, 20)))
    found = chunk_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string"), 15).collect()
    assert {r.id for r in found if r.words >= 50} == set(range(10))


def test_language_id(spark):
    rows = QUERIES["op2_language_id"](spark, "/root/testdata/sf0.01").collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.lang_pred == lang[r.doc_id] for r in held) > 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_id_edges(docs, none):
    nothing = language_id.fit(none, "doc_id", "text", "lang", 10)
    assert nothing.predict("some text") == ("und", 0.0)
    fitted = language_id.fit(docs, "doc_id", "text", "lang", 1000)
    found = [r.p.lang for r in docs.select(fitted.column(F.col("text")).alias("p")).collect()]
    assert [f == "und" for f in found] == [not any(map(str.isalpha, r[1] or "")) for r in ROWS]


def test_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES["op7_toxicity"](spark, sf).collect()
    label = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in label]
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert sum(r.predicted == label[r.doc_id] for r in held) > 0.9 * len(held)
    assert not any(r.predicted for r in held if label[r.doc_id] == 0)


def test_toxicity_edges(docs, none, spark):
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    assert toxicity.reject_toxic(docs, labels.limit(0)).columns == docs.columns
    assert toxicity.reject_toxic(docs, labels.limit(0)).count() == len(ROWS)
    assert toxicity.fit_on_labels(docs, labels).share == 1.0
    both = spark.createDataFrame([(3, 1), (10, 0), (9, 0), (1, 1)], "doc_id long, toxic int")
    assert toxicity.reject_toxic(docs, both).columns == docs.columns
    assert toxicity.reject_toxic(none, both).count() == 0
    assert toxicity.features("", toxicity.Worth({})) == [0.0] * len(toxicity.FEATURES)


def test_disguised_words():
    worth = toxicity.Worth({"idiot": 4.0})
    assert all(worth[t] >> 12 & 1 and worth[t] >> 10 & 1 for t in ("1d1ot", "i.d.i.o.t", "id!ot,"))
    assert worth["don't"] == 0 and worth["idiot."] >= 64


def test_warc(spark):
    pages = [(i, f"http://h/{i}", "x" * i) for i in range(400)] + [(None, None, None)] * 3
    records = spark.createDataFrame(pages, "id long, url string, html string").select(
        "id", F.coalesce("url", F.lit("")).alias("name"),
        warc_fixity.warc_record(F.col("id"), F.col("url"), F.col("html")).alias("record"),
    )
    archived = warc_fixity.archive(warc_fixity.record_index(records), 20)
    mine = warc_fixity.leaves(archived)
    assert warc_fixity.audit_replicas(mine, mine).count() == 0
    theirs = mine.filter("id IS NULL OR id <> 7").withColumn(
        "hash", F.when(F.col("id") == 200, F.lit("bad")).otherwise(F.col("hash"))
    )
    found = {(r.id, r.status) for r in warc_fixity.audit_replicas(mine, theirs).collect()}
    assert found == {(7, "missing"), (200, "damaged")}
    assert warc_fixity.audit_replicas(mine, mine.limit(0)).count() == 403
    assert warc_fixity.audit_replicas(mine.limit(0), mine.limit(0)).count() == 0


def test_empty_tables(none):
    assert exact_dedup(none).rows.count() == 0
    assert simhash.near_duplicates(none, 3, 2).count() == 0
    assert mixing.mix(none, (5, 2, 1), (3, 2), 2).count() == 0
    assert packing.pack(none, 64, packing.default_ranks_path()).count() == 0
    assert spotsigs.compare_with_edits(none, 0.1).count() == 0
    assert chunk_dedup.repeated_passages(none, 15).count() == 0
    assert secret_scan.scan_secrets(none, "doc_id", "text", "source", "doc_id", 3, 5).count() == 0


@pytest.mark.parametrize("name", list(ORACLES))
def test_matches_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    found = QUERIES[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, found), key=repr) == sorted(cursor.fetchall(), key=repr)


def test_pipeline(spark):
    import corpus_pipeline

    rows = corpus_pipeline.run(spark, SF).collect()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]
    assert rows and max(r.offset + r.length for r in rows) <= packing.CAPACITY
