"""Joins, ranking and rejects on small tables, against plain Python."""

import contextlib
import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from blotter import (
    STRATEGIES,
    average_income_by_zip,
    bottom_k,
    count_by_month,
    drop_rejects,
    equi_join,
    keep_last,
    number_rows,
    reject_rows,
    restrict_to,
    row_count,
    sort_by_count,
    top_k,
    top_n_per_group,
    unmatched,
    unmatched_counts,
)
from blotter.operators import joins
from blotter.operators.sizing import measure_bytes


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return Counter(tuple(row) for row in df.collect())


@contextlib.contextmanager
def setting(spark, name, value):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


@pytest.fixture(scope="module")
def facts(spark):
    """900 facts in 8 partitions, a third of them with key 7 and all of those alike."""
    data = [(0 if i % 3 == 0 else i, 7 if i % 3 == 0 else i % 40) for i in range(900)]
    data += [(-1, None), (-2, None)]
    return spark.createDataFrame(data, "id int, k int").repartition(8).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    """Keys 0 to 29, key 7 twice, key 11 three times, and a null key."""
    keys = [*range(30), 7, 11, 11, None]
    return spark.createDataFrame([(k, f"v{i}") for i, k in enumerate(keys)], "k int, v string")


def joined(facts, lookup):
    right = [tuple(row) for row in lookup.collect()]
    return Counter(
        (k, i, v) for i, k in map(tuple, facts.collect()) for rk, v in right if k is not None and rk == k
    )


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_inner_join(facts, lookup, strategy):
    result = equi_join(facts, lookup, "k", strategy, salts=5)
    assert result.columns == ["k", "id", "v"]
    assert rows(result) == joined(facts, lookup)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_semi_and_anti_join(facts, lookup, strategy):
    keys = {row.k for row in lookup.collect()} - {None}
    for how, keep in (("left_semi", True), ("left_anti", False)):
        result = equi_join(facts, lookup, "k", strategy, how=how, salts=5)
        expected = Counter(tuple(row) for row in facts.collect() if (row.k in keys) == keep)
        assert rows(result.select("id", "k")) == expected


@pytest.mark.parametrize(
    ("strategy", "node"),
    [
        ("broadcast", "BroadcastHashJoin"),
        ("merge", "SortMergeJoin"),
        ("shuffle_hash", "ShuffledHashJoin"),
        ("replicate", "SortMergeJoin"),
    ],
)
def test_strategy_is_planned(facts, lookup, strategy, node):
    plan = plan_of(equi_join(facts, lookup, "k", strategy))
    assert node in plan
    assert ("__salt" in plan) == (strategy == "replicate")
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_lookup_too_large_to_broadcast(facts, lookup):
    result = equi_join(facts, lookup, "k", "broadcast", broadcast_limit=100)
    plan = plan_of(result)
    first = min((name for name in ("SortMergeJoin", "BroadcastHashJoin") if name in plan), key=plan.index)
    assert first == "SortMergeJoin" and "__salt" in plan
    # What is broadcast, once for each side, is the list of hot keys.
    sent = [part.split("Scan ")[1] for part in plan.split("BroadcastExchange")[1:]]
    assert len(sent) == 2 and all("__salts" in scan.splitlines()[0] for scan in sent)
    assert rows(result) == joined(facts, lookup)


def test_salts_shrink_with_the_lookup(facts, lookup, monkeypatch):
    monkeypatch.setattr("blotter.operators.joins.REPLICATE_LIMIT_BYTES", 100)
    result = equi_join(facts, lookup, "k", "broadcast", broadcast_limit=100)
    assert "SortMergeJoin" in plan_of(result) and "__salt" not in plan_of(result)
    assert rows(result) == joined(facts, lookup)


@pytest.mark.parametrize("salt_by", [(), ("id",)])
def test_hot_key_is_split_over_tasks(spark, facts, lookup, salt_by):
    data = facts if not salt_by else facts.withColumn("id", F.col("id") + F.rand(1) * 1000)
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        result = equi_join(data, lookup, "k", "replicate", salts=8, salt_by=salt_by)
        hot = result.filter("k = 7").groupBy(F.spark_partition_id()).count().collect()
    assert len(hot) >= 3
    assert max(row["count"] for row in hot) < sum(row["count"] for row in hot) * 2 / 3


def test_only_hot_keys_are_repeated(spark):
    n = 3000
    facts = spark.range(3 * n).select(
        F.when(F.col("id") < n, 7).when(F.col("id") < n + 9, None).otherwise(F.col("id")).alias("k"), "id"
    )
    lookup = spark.range(2 * n).select(F.col("id").alias("k"), F.lit("v").alias("v"))
    result = equi_join(facts, lookup, "k", "replicate", salts=8, salt_by=["id"])
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        tasks = result.filter("k = 7").groupBy(F.spark_partition_id()).count().count()
    assert tasks >= 3 and rows(result) == rows(facts.join(lookup, "k"))
    hot = joins._hot_keys(facts, ["k"], 8).collect()
    assert [tuple(r) for r in hot] == [(7, 8)]
    anti = equi_join(facts, lookup, "k", "replicate", how="left_anti", salt_by=["id"])
    assert anti.count() == facts.filter(f"k IS NULL OR k >= {2 * n}").count()


def test_no_hot_key_no_salt(spark):
    facts = spark.range(5000).select(F.col("id").alias("k"))
    result = equi_join(facts, facts, "k", "replicate")
    assert "__salt" not in plan_of(result) and result.count() == 5000
    assert equi_join(facts.limit(0), facts, "k", "replicate").count() == 0


def test_join_arguments(facts, lookup):
    with pytest.raises(ValueError, match="strategy"):
        equi_join(facts, lookup, "k", "nested_loop")
    with pytest.raises(ValueError, match="join type"):
        equi_join(facts, lookup, "k", how="left_outer")


def test_measure_bytes(spark):
    df = spark.createDataFrame([(1, "abcd"), (2, None), (3, "é")], "a int, s string")
    assert measure_bytes(df) == 3 * 24 + (4 + 8) + 8 - 8 + 8 + (2 + 8)
    assert measure_bytes(df.limit(0)) == 0
    assert measure_bytes(df.select("a")) == 3 * 16


def test_keep_last(lookup):
    last = keep_last(lookup, "k", [F.col("v")])
    assert last.columns == ["k", "v"]
    expected = {}
    for row in sorted(lookup.collect(), key=lambda row: row.v):
        expected[row.k] = row.v
    assert dict(tuple(row) for row in last.collect()) == expected


def test_restrict_and_unmatched(spark, facts, lookup):
    chosen = spark.createDataFrame([(7,), (7,), (8,)], "k int")
    assert rows(restrict_to(facts, chosen, "k").select("k")) == Counter(
        (row.k,) for row in facts.collect() if row.k in (7, 8)
    )
    missing = Counter(row.k for row in facts.collect() if row.k is None or row.k >= 30)
    assert Counter(row.k for row in unmatched(facts, lookup, "k").collect()) == missing
    counted = {row.k: row["count"] for row in unmatched_counts(facts, lookup, "k").collect()}
    assert counted == missing


def test_keys_chosen_by_a_limit_are_broadcast(facts, lookup):
    restricted = restrict_to(facts, lookup.orderBy("v").limit(3), "k")
    assert "BroadcastHashJoin" in plan_of(restricted) and "LeftSemi" in plan_of(restricted)


def test_unmatched_counts_before_it_joins(facts, lookup):
    plan = plan_of(unmatched_counts(facts, lookup, "k"))
    assert plan.index("LeftAnti") < plan.index("HashAggregate")


def test_top_n_per_group_breaks_ties(spark):
    months = [(2015, 7, 5), (2015, 3, 5), (2015, 1, 4), (2015, 2, 9), (2016, 12, 1), (None, None, 2)]
    df = spark.createDataFrame(months, "year int, month int, n int")
    order = [F.desc("n"), F.col("month")]
    top = top_n_per_group(df, ["year"], order, 3)
    assert [tuple(row) for row in top.orderBy("year", "rank").collect()] == [
        (None, None, 2, 1), (2015, 2, 9, 1), (2015, 3, 5, 2), (2015, 7, 5, 3), (2016, 12, 1, 1),
    ]
    assert plan_of(top).count("WindowGroupLimit") == 2
    assert number_rows(df, ["year"], order).count() == len(months)


def test_top_n_of_any_size(spark):
    df = spark.range(6000).selectExpr("id % 2 AS g", "id % 7 AS n", "id").repartition(4)
    order = [F.desc("n"), F.col("id")]
    every = number_rows(df, ["g"], order)
    top = top_n_per_group(df, ["g"], order, 1001)
    assert rows(top) == rows(every.filter("rank <= 1001"))
    assert top.columns == every.columns and plan_of(top).count("row_number") > plan_of(every).count("row_number")


def test_year_filter_passes_a_salted_join(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_custkey", "k")
    lookup = spark.range(9).select(F.col("id").alias("k"))
    joined = equi_join(orders, lookup, "k", "replicate", salt_by=["o_orderkey"])
    plan = plan_of(joined.filter("o_totalprice > 1000"))
    assert "GreaterThan(o_totalprice,1000.0)" in plan


def test_top_k_and_bottom_k(spark):
    means = [(1, 50.0), (2, 70.0), (3, None), (4, 70.0), (5, 10.0), (6, None)]
    df = spark.createDataFrame(means, "zip int, m double").repartition(4)

    def zips(result):
        return [row.zip for row in result.collect()]

    assert zips(top_k(df, "m", 3, ["zip"])) == [2, 4, 1]
    assert zips(top_k(df, "m", 9, ["zip"])) == [2, 4, 1, 5, 3, 6]
    assert zips(bottom_k(df, "m", 3, ["zip"])) == [3, 6, 5]
    assert zips(bottom_k(df, "m", 3, ["zip"], skip_nulls=True)) == [5, 1, 2]
    assert "TakeOrderedAndProject" in plan_of(top_k(df, "m", 3, ["zip"]))


def test_sort_by_count(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), ("c", 9)], "label string, count long")
    assert [row.label for row in sort_by_count(df, ["label"]).collect()] == ["c", "a", "b"]


def test_aggregates(spark):
    days = [dt.datetime(2015, 1, 31, 23, 59), dt.datetime(2015, 1, 1), dt.datetime(2014, 1, 5), None]
    df = spark.createDataFrame([(day,) for day in days], "date_rptd timestamp_ntz")
    assert rows(count_by_month(df)) == Counter([(2015, 1, 2), (2014, 1, 1), (None, None, 1)])
    assert row_count(df).collect() == [(4,)]
    incomes = [(1, 10.0), (1, None), (1, 20.0), (2, None)]
    df = spark.createDataFrame(incomes, "zip int, income double")
    assert rows(average_income_by_zip(df)) == Counter([(1, 15.0), (2, None)])


def test_rejects(spark):
    data = [(1, "34.0", "-118.0"), (2, "", "-118.0"), (3, "34.0", "n/a"), (4, None, "1"), (5, " 1 ", "2")]
    df = spark.createDataFrame(data, "id int, lat string, lon string")
    assert sorted(row.id for row in reject_rows(df, ["lat", "lon"]).collect()) == [2, 3, 4]
    kept = drop_rejects(df, ["lat", "lon"])
    assert rows(kept) == Counter([(1, 34.0, -118.0), (5, 1.0, 2.0)])
