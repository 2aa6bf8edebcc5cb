"""Parallel quoted records, exact sums, ranks by ranges, bitmap reduction, and joins of counted sides."""

import csv
import random
from collections import Counter, defaultdict
from contextlib import contextmanager
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from blotter import fixtures as fx
from blotter.operators.aggregates import exact_mean, exact_sum
from blotter.operators.joins import bitmap_reduced, equi_join
from blotter.operators.ranking import rank_by_ranges
from blotter.plans import descent, stations
from blotter.schemas import STATIONS
from blotter.sources.incidents import read_incidents
from blotter.sources.lines import read_csv_lines
from blotter.sources.quoted import quoted_records, read_quoted_records
from blotter.sources.scan import scan

SF = "/root/testdata/sf0.01"


@contextmanager
def settings(spark, **values):
    names = {key.replace("__", "."): str(value) for key, value in values.items()}
    before = {key: spark.conf.get(key, None) for key in names}
    for key, value in names.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def small_splits(spark, size):
    return settings(spark, spark__sql__files__maxPartitionBytes=size, spark__sql__files__openCostInBytes=1)


def plan_of(df):
    return df._jdf.queryExecution().toString()


# ---- records with line breaks


def write_csv(path, rows, header=("X", "Y", "DIVISION", "PREC"), **options):
    path.parent.mkdir(exist_ok=True)
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator="\n", **options)
        writer.writerow(header)
        writer.writerows(rows)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("size", [97, 700, 1 << 20])
def test_quoted_records_in_any_split(spark, tmp_path, seed, size):
    rng = random.Random(seed)
    rows = [
        (i, i + 0.5, "s" + "".join(rng.choice('ab"\n, é') for _ in range(rng.randint(0, 60))) + "e", i)
        for i in range(60)
    ]
    rows[30] = (30, 30.5, "line\n" * 300 + '"', 30)  # longer than some splits
    for part in (0, 1):
        write_csv(tmp_path / "folder" / f"{part}.csv", rows[part::2])
    with small_splits(spark, size):
        found = read_quoted_records(spark, str(tmp_path / "folder"), STATIONS)
        assert sorted((r.x, r.y, r.division, r.prec) for r in found.collect()) == rows
        if size < 100:
            records = quoted_records(spark, str(tmp_path / "folder" / "0.csv"))
            assert records.select("split").distinct().count() > 10
            assert "CartesianProduct" not in plan_of(records)


def test_a_quote_that_never_closes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('X,Y,DIVISION,PREC\n1,2,"open,3\n4,5,b,6\n')
    with pytest.raises(Exception, match="quote isn't closed"):
        read_quoted_records(spark, str(tmp_path / "a.csv"), STATIONS).collect()
    with pytest.raises(Exception, match="quote isn't closed"):
        read_csv_lines(spark, str(tmp_path / "a.csv"), STATIONS).collect()


def test_another_header_in_a_folder_of_quoted_records(spark, tmp_path):
    write_csv(tmp_path / "f" / "a.csv", [(1, 2, "a", 3)])
    write_csv(tmp_path / "f" / "b.csv", [(1, 2, "a", 3)], header=("Y", "X", "DIVISION", "PREC"))
    with pytest.raises(Exception, match="another header"):
        read_quoted_records(spark, str(tmp_path / "f"), STATIONS).collect()


def test_headers_that_end_in_their_place(spark, tmp_path):
    for name, header in (("a", "id,cd1,v"), ("b", "id,v,cd1")):
        (tmp_path / f"{name}.csv").write_text(f"{header}\n1,2,3\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        scan(spark, str(tmp_path)).collect()
    assert scan(spark, str(tmp_path / "a.csv")).columns == ["id", "cd1", "v"]


def test_unreadable_text_of_direct_reads(spark, tmp_path):
    header = "DR_NO,Date Rptd,TIME OCC,AREA ,Premis Desc,Vict Descent,Weapon Used Cd,LAT,LON"
    (tmp_path / "a.csv").write_text(f"{header}\n1,not a date,5,01,STREET,B,101.0,34.1,x\n")
    for read in (read_incidents(spark, str(tmp_path / "a.csv"), unreadable="bad"),
                 read_csv_lines(spark, str(tmp_path / "a.csv"), unreadable="bad")):
        (row,) = read.collect()
        assert row.bad == {"date_rptd": "not a date", "lon": "x"} and row.weapon_cd == 101


# ---- sums that don't depend on order


def numbers(seed, n):
    rng = random.Random(seed)
    return [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-9, 12) for _ in range(n)]


def test_exact_sums_have_the_same_bits(spark):
    values = numbers(3, 4000)
    rows = [(i % 3, v) for i, v in enumerate(values)] + [(3, None), (4, 0.1), (4, None), (5, 1e308), (5, -1.0)]
    results = set()
    for order, parts in ((1, 2), (-1, 200), (1, 17)):
        df = spark.createDataFrame(rows[::order], "k int, v double").repartition(parts)
        with settings(spark, spark__sql__shuffle__partitions=parts):
            found = df.groupBy("k").agg(exact_sum(F.col("v")).alias("s"), exact_mean(F.col("v")).alias("m")).collect()
        results.add(tuple(sorted((r.k, None if r.s is None else r.s.hex(), None if r.m is None else r.m.hex()) for r in found)))
    assert len(results) == 1
    by_key = {r.k: r for r in found}
    for k in range(3):
        true = sum((Fraction(v) for v in values[k::3]), Fraction())
        assert abs(Fraction(by_key[k].s) - true) <= abs(true) * Fraction(1, 2**51) + Fraction(4000, 2**70)
    assert by_key[3].s is None and by_key[3].m is None
    assert by_key[4].s == 0.1 and by_key[4].m == 0.1
    assert by_key[5].s == 1e308


def test_exact_sums_of_what_is_not_finite(spark):
    df = spark.createDataFrame([(1, float("nan")), (1, 1.0), (2, float("inf")), (2, 1.0)], "k int, v double")
    found = {r.k: r.s for r in df.groupBy("k").agg(exact_sum(F.col("v")).alias("s")).collect()}
    assert found[1] != found[1] and found[2] == float("inf")


# ---- ranks of any n


@pytest.mark.parametrize("n", [1, 7, 2500, None])
def test_rank_by_ranges(spark, n):
    rng = random.Random(5)
    rows = [(None if i % 10 == 0 else "hot" if i % 3 else f"g{i % 40}", rng.randint(0, 50), i) for i in range(6000)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(5)
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        found = rank_by_ranges(df, ["g"], [F.desc("v"), F.col("i")], n).collect()
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    expected = {
        (*row, rank)
        for group in groups.values()
        for rank, row in enumerate(sorted(group, key=lambda r: (-r[1], r[2])), 1)
        if n is None or rank <= n
    }
    assert len(found) == len(expected) and {tuple(r) for r in found} == expected


def test_no_task_ranks_a_group(spark):
    """One group of equal rows, in shares."""
    df = spark.range(40_000).select(F.lit("a").alias("g"), F.lit(1).alias("v"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        ranked = rank_by_ranges(df, ["g"], [F.col("v")])
        found = ranked.select("rank").collect()
    assert sorted(r["rank"] for r in found) == list(range(1, 40_001))
    # Windows only run over one row for each file and group.
    plan = plan_of(ranked).split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert plan.count("Window [") == 1 and "Aggregate" in plan.split("Window [")[1]
    files = ranked.inputFiles()
    sizes = [spark.read.parquet(f).count() for f in files]
    assert len(sizes) >= 8 and max(sizes) < 3 * 40_000 / len(sizes)


def test_rank_of_no_rows(spark):
    assert rank_by_ranges(spark.createDataFrame([], "g string, v int"), ["g"], [F.col("v")], 3).count() == 0


# ---- bitmap reduction


def test_bitmap_reduction_keeps_what_matches(spark):
    facts = spark.range(20_000).select((F.col("id") % 4000).alias("k"), F.col("id").alias("i"))
    facts = facts.withColumn("k", F.when(F.col("i") % 11 != 0, F.col("k")))
    lookup = spark.range(0, 4000, 40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    reduced = bitmap_reduced(facts, lookup, "k")
    assert reduced.columns == facts.columns
    full = equi_join(facts, lookup, "k", "merge")
    assert Counter(map(tuple, equi_join(reduced, lookup, "k", "merge").collect())) == Counter(map(tuple, full.collect()))
    assert full.count() <= reduced.count() < 1.3 * full.count()
    # With few bits more facts pass, and the join still drops them.
    poor = bitmap_reduced(facts, lookup, "k", bits=64)
    assert reduced.count() < poor.count()
    assert equi_join(poor, lookup, "k", "merge").count() == full.count()
    assert bitmap_reduced(facts, lookup.limit(0), "k").count() == 0


# ---- joins of counted sides


def scans(df, table):
    return plan_of(df).split("== Physical Plan ==")[1].count(f"{table}.parquet")


@pytest.mark.parametrize("strategy", ["replicate", "merge", "broadcast"])
def test_incidents_are_scanned_once(spark, strategy):
    tracker = spark.sparkContext.statusTracker()
    lookups = fx.geocode(spark, SF), fx.income(spark, SF)
    spark.sparkContext.setJobGroup(f"build {strategy}", "")
    result = descent.descent_counts(fx.incidents(spark, SF), *lookups, fx.YEAR, "top", strategy)
    spark.sparkContext.setJobGroup("other", "")
    # Only a broadcast runs jobs when it is built, to measure the two lookups.
    jobs = len(tracker.getJobIdsForGroup(f"build {strategy}"))
    assert jobs == 0 if strategy != "broadcast" else jobs <= 6
    assert scans(result, "orders") == 1


def test_repartition_reads_incidents_once(spark):
    result = stations.station_distances_repartition(fx.incidents(spark, SF), fx.stations(spark, SF))
    assert scans(result, "orders") == 0  # the counts are written, and read by the search and the join
