"""Bucketed joins, ledgers of converted files, counts kept per run, routed writes, and the analyses as SQL text."""

import csv

import pytest
from pyspark.sql import functions as F

from blotter import fixtures as fx
from blotter.operators.aggregates import count_by_label
from blotter.plans import sql_text
from blotter.schemas import STATIONS
from blotter.sources.bucketed import bucketed_join, write_bucketed_facts, write_bucketed_lookup
from blotter.sources.ledger import GrowingTable
from blotter.sources.routed import write_routed

SF = "/root/testdata/sf0.01"
HEADER = ("X", "Y", "DIVISION", "PREC")


def write_csv(path, rows, header=HEADER):
    path.parent.mkdir(exist_ok=True)
    with open(path, "w", newline="") as out:
        csv.writer(out).writerows([header, *rows])


def grown(spark, tmp_path):
    return GrowingTable(spark, str(tmp_path / "table"), STATIONS)


def by_division(df):
    return count_by_label(df, "division", "stations")


def test_second_run_opens_new_files_only(spark, tmp_path):
    table, source = grown(spark, tmp_path), tmp_path / "csv"
    assert table.read().count() == 0 and table.merged("n", by_division, "stations").count() == 0
    write_csv(source / "a.csv", [(1, 2, "North", 3), (1, "n/a", "South", 4)])
    assert table.add(str(source)) == 1
    assert table.add(str(source)) == 0
    write_csv(source / "b.csv", [(5, 6, "North", 7)])
    assert table.add([str(source), str(source / "b.csv")]) == 1
    assert sorted(table.read().select("x", "division", "prec").collect()) == [
        (1.0, "North", 3), (1.0, "South", 4), (5.0, "North", 7),
    ]
    assert table.read().filter("unreadable IS NOT NULL").count() == 1
    assert {row.path.rsplit("/")[-1] for row in table.ledger().collect()} == {"a.csv", "b.csv"}


def test_run_that_ended_half_way(spark, tmp_path, monkeypatch):
    table, source = grown(spark, tmp_path), tmp_path / "csv"
    write_csv(source / "a.csv", [(1, 2, "North", 3)])
    with monkeypatch.context() as patch:
        patch.setattr(GrowingTable, "_enter", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.add(str(source))
    assert table.read().count() == 0
    assert table.add(str(source)) == 1
    assert table.read().count() == 1
    with monkeypatch.context() as patch:
        patch.setattr(GrowingTable, "_enter", lambda *_: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            table.merged("n", by_division, "stations")
    assert table.merged("n", by_division, "stations").collect() == [("North", 1)]


def test_file_that_changed_is_an_error(spark, tmp_path):
    table, source = grown(spark, tmp_path), tmp_path / "csv"
    write_csv(source / "a.csv", [(1, 2, "North", 3)])
    table.add(str(source))
    write_csv(source / "a.csv", [(1, 2, "North", 3), (1, 2, "West", 4)])
    with pytest.raises(ValueError, match="a.csv"):
        table.add(str(source))


def test_other_header_in_the_same_run_fails(spark, tmp_path):
    table, source = grown(spark, tmp_path), tmp_path / "csv"
    write_csv(source / "a.csv", [(1, 2, "North", 3)])
    write_csv(source / "b.csv", [("South", 4, 1, 2)], ("DIVISION", "PREC", "X", "Y"))
    with pytest.raises(Exception, match="(?i)header"):
        table.add(str(source))
    assert table.read().count() == 0
    assert table.add(str(source / "a.csv")) == 1 and table.add(str(source / "b.csv")) == 1
    assert table.read().select("division", "prec").orderBy("prec").collect() == [("North", 3), ("South", 4)]


def test_merged_counts_read_each_run_once(spark, tmp_path):
    table, source = grown(spark, tmp_path), tmp_path / "csv"
    seen = []

    def count(df):
        seen.append(sorted({path.split("batch=")[1].split("/")[0] for path in df.inputFiles()}))
        return by_division(df)

    expected = {}
    for nth in range(4):
        rows = [(1, 2, name, nth) for name in ("North", "", "West")[: nth + 1] for _ in range(nth + 1)]
        write_csv(source / f"{nth}.csv", rows)
        table.add(str(source))
        for row in rows:
            expected[row[2] or None] = expected.get(row[2] or None, 0) + 1
        if nth != 1:  # two runs are new at the next call
            assert {r.division: r.stations for r in table.merged("n", count, "stations").collect()} == expected
    assert [len(batches) for batches in seen] == [1] * 4
    assert len({batch for batches in seen for batch in batches}) == 4
    full = {r.division: r.stations for r in by_division(table.read()).collect()}
    assert full == expected


def test_routed_write_reads_once_and_counts(spark, tmp_path):
    scans = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def seen(value):
        scans.add(1)
        return value

    df = spark.range(1000, numPartitions=4).select(seen("id").alias("id"), (F.col("id") % 10).alias("digit"))
    reject = F.when(F.col("digit") == 3, True).when(F.col("digit") == 4, None).otherwise(False)
    routed = write_routed(df, str(tmp_path / "out"), reject)
    assert (routed.good_rows, routed.rejected_rows) == (900, 100)
    assert scans.value == 1000
    assert routed.good.columns == ["id", "digit"]
    assert {r.digit for r in routed.rejected.collect()} == {3} and routed.good.count() == 900
    assert all("outcome=rejected" in path for path in routed.rejected.select("id").inputFiles()) or (
        "PartitionFilters" in routed.rejected._jdf.queryExecution().toString()
    )


def test_routed_write_of_one_outcome_and_none(spark, tmp_path):
    good = write_routed(spark.range(3), str(tmp_path / "good"), F.lit(False))
    assert (good.good_rows, good.rejected_rows, good.rejected.count()) == (3, 0, 0)
    none = write_routed(spark.range(0), str(tmp_path / "none"), F.lit(True))
    assert (none.good_rows, none.rejected_rows, none.table.count()) == (0, 0, 0)
    with pytest.raises(ValueError):
        write_routed(spark.range(1).withColumn("outcome", F.lit(1)), str(tmp_path / "clash"), F.lit(True))


def test_sql_functions_are_inlined(spark):
    sql_text.register(spark, incidents=fx.incidents(spark, SF), stations=fx.stations(spark, SF))
    plan = spark.sql("SELECT dr_no FROM incidents WHERE is_firearm(weapon_cd)")._jdf.queryExecution().toString()
    assert "StartsWith" in plan.split("== Optimized Logical Plan ==")[1] and "Python" not in plan
    label = spark.sql("SELECT part_of_day(1159), part_of_day(500), part_of_day(NULL), descent_label(' B '), "
                      "descent_label('q'), descent_label(NULL)").first()  # fmt: skip
    assert tuple(label) == ("Night", "Morning", "Night", "Black", "None", "None")
    assert spark.sql("SELECT haversine_km(0, 0, 0, 180)").first()[0] == pytest.approx(20015.0868, abs=1e-3)
    assert spark.sql("SELECT * FROM busiest_months(1)").count() == spark.sql("SELECT * FROM busiest_months(2)").filter(
        "rank = 1"
    ).count() > 0


def test_sql_distance_of_unknown_and_opposite_points(spark):
    sql_text.register(spark)
    found = spark.sql("SELECT haversine_km(NULL, 0, 0, 180), haversine_km(90, 0, -90, 0), haversine_km(1, 2, 1, 2)")
    assert found.first()[0] is None
    assert found.first()[1:] == (pytest.approx(20015.0868, abs=1e-3), 0.0)


def test_bucketed_join_shuffles_nothing_and_splits_a_hot_key(spark, tmp_path):
    # Key 0 holds half of all rows; some keys are null, some match nothing, some lookup keys repeat.
    facts = spark.range(4000).selectExpr(
        "id", "CASE WHEN id % 2 = 0 THEN 0 WHEN id % 101 = 1 THEN NULL ELSE id % 50 END AS area"
    )
    posts = [*((k, f"d{k}") for k in range(30)), (0, "again"), (None, "none")]
    lookup = spark.createDataFrame(posts, "area int, name string")
    facts = facts.withColumn("area", F.col("area").cast("int"))
    write_bucketed_facts(facts, "hot_facts", "area", 8, str(tmp_path / "facts"), ["id"], 8)
    write_bucketed_lookup(lookup, "hot_lookup", "area", 8, str(tmp_path / "lookup"), 8)
    for how in ("inner", "left", "left_semi", "left_anti"):
        joined = bucketed_join(spark, "hot_facts", "hot_lookup", "area", how)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan, plan
        expected = facts.join(lookup, "area", how)
        assert joined.columns == expected.columns
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, expected.collect()))
    hot = spark.table("hot_facts").filter("area = 0").select("_metadata.file_name").distinct().count()
    assert hot >= 4
    with pytest.raises(ValueError):
        bucketed_join(spark, "hot_facts", "hot_lookup", "area", "full")
