"""The four analyses: their forms agree, and agree with plain Python on hand-made tables."""

import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from blotter import STRATEGIES, fixtures, read_incidents
from blotter.operators.sizing import measure_bytes
from blotter.plans import descent, monthly, stations, street

from .test_functions import plain_haversine
from .test_operators import plan_of

SF_DIR = "/root/testdata/sf0.001"

INCIDENTS = (
    "date_rptd timestamp_ntz, time_occ int, area int, premis string, vict_descent string,"
    " weapon_cd int, lat double, lon double"
)


@pytest.fixture(scope="module")
def incidents(spark):
    """1200 incidents; a third are alike, in one place, area and month."""
    draw = random.Random(3)
    alike = (dt.datetime(2015, 6, 1), 900, 4, "STREET", "H", 101, 34.02, -118.2)
    data = [alike] * 400
    for _ in range(800):
        data.append(
            (
                draw.choice([None, dt.datetime(draw.choice([2014, 2015]), draw.randint(1, 12), 5)]),
                draw.choice([None, 30, 700, 1300, 1800]),
                draw.choice([None, 1, 2, 3, 4, 9]),
                draw.choice([None, "STREET", "SHOP"]),
                draw.choice(["H", "B ", "W", "Q", "", None]),
                draw.choice([None, 101, 102, 205]),
                draw.choice([None, 0.0, 34.0, 34.01, 34.02]),
                draw.choice([None, 0.0, -118.2, -118.3]),
            )
        )
    return spark.createDataFrame(data, INCIDENTS).repartition(6).cache()


@pytest.fixture(scope="module")
def geocode(spark):
    """One cell twice with one ZIP, one cell with two ZIPs, one cell without incidents."""
    data = [
        (34.0, -118.2, 90001), (34.0, -118.2, 90001), (34.01, -118.2, 90002),
        (34.01, -118.2, 90003), (34.02, -118.2, 90004), (34.0, -118.3, 90005),
        (34.01, -118.3, 90006), (34.02, -118.3, 90007), (35.0, -118.3, 90008),
    ]
    return spark.createDataFrame(data, "lat double, lon double, zip int")


@pytest.fixture(scope="module")
def income(spark):
    """A ZIP with two entries, one with only an unknown, one tie, one without incidents."""
    data = [
        (90001, 40.0), (90001, 60.0), (90002, 70.0), (90003, None), (90004, 50.0),
        (90005, 20.0), (90006, 30.0), (90006, None), (90008, 90.0),
    ]
    return spark.createDataFrame(data, "zip int, income double")


@pytest.fixture(scope="module")
def posts(spark):
    """Area 2 has two stations, station 3 no position, and station 5 no incidents."""
    data = [
        (-118.25, 34.05, "A", 1), (-118.2, 34.0, "B", 2), (-118.1, 34.1, "C", 2),
        (0.0, 34.0, "D", 3), (-118.3, 34.2, "E", 4), (-118.0, 33.9, "F", 5),
    ]
    return spark.createDataFrame(data, "x double, y double, division string, prec int")


def tuples(df):
    return [tuple(row) for row in df.collect()]


def test_months(spark, incidents):
    counts = Counter(
        (day.year, day.month) if day else (None, None)
        for day in (row.date_rptd for row in incidents.collect())
    )
    expected = []
    for year in (None, 2014, 2015):
        months = [(-n, month) for (y, month), n in counts.items() if y == year]
        best = sorted(months, key=lambda pair: (pair[0], pair[1] or 0))[:3]
        expected += [(year, month, -n, i + 1) for i, (n, month) in enumerate(best)]
    assert tuples(monthly.top_months(incidents)) == expected
    assert tuples(monthly.top_months_sql(spark, incidents)) == expected


def test_street(spark, incidents):
    names = {30: "Night", None: "Night", 700: "Morning", 900: "Morning", 1300: "Afternoon", 1800: "Evening"}
    counts = Counter(names[row.time_occ] for row in incidents.collect() if row.premis == "STREET")
    expected = sorted(counts.items(), key=lambda item: (-item[1], item[0]))
    assert tuples(street.street_by_part_of_day(incidents)) == expected
    assert tuples(street.street_by_part_of_day_sql(spark, incidents)) == expected


def expected_descents(incidents, geocode, income, end, k=3, skip_nulls=False):
    labels = {"H": "Hispanic/Latin/Mexican", "B ": "Black", "W": "White"}
    cells, entries = geocode.collect(), income.collect()
    joined = [
        (entry.zip, entry.income, labels.get(row.vict_descent, "None"))
        for row in incidents.collect()
        if row.date_rptd and row.date_rptd.year == 2015
        for cell in cells
        if (cell.lat, cell.lon) == (row.lat, row.lon)
        for entry in entries
        if entry.zip == cell.zip
    ]
    incomes = defaultdict(list)
    for zip_code, amount, _ in joined:
        incomes[zip_code].append(amount)
    means = {}
    for zip_code, amounts in incomes.items():
        known = [amount for amount in amounts if amount is not None]
        means[zip_code] = sum(known) / len(known) if known else None
    if end == "top":
        order = sorted(means, key=lambda z: (means[z] is None, -(means[z] or 0), z))
    else:
        order = sorted(means, key=lambda z: (means[z] is not None, means[z] or 0, z))
        if skip_nulls:
            order = [z for z in order if means[z] is not None]
    chosen = set(order[:k])
    counts = Counter(label for z, _, label in joined if z in chosen and label != "None")
    return sorted(counts.items(), key=lambda item: (-item[1], item[0]))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_descents(incidents, geocode, income, strategy):
    for end in ("top", "bottom"):
        found = descent.descent_counts(incidents, geocode, income, 2015, end, strategy)
        assert tuples(found) == expected_descents(incidents, geocode, income, end)


def test_descents_from_one_profile(spark, incidents, geocode, income):
    facts = descent.labelled_facts(incidents, 2015)
    profile = descent.zip_profile(facts, geocode, income).cache()
    for end, k, skip in (("top", 1, False), ("bottom", 2, False), ("bottom", 2, True)):
        found = descent.descents_at_end(profile, end, k, skip)
        assert tuples(found) == expected_descents(incidents, geocode, income, end, k, skip)
    with pytest.raises(ValueError, match="end"):
        descent.descents_at_end(profile, "middle")
    for end in ("top", "bottom"):
        sql = descent.descent_counts_sql(spark, incidents, geocode, income, 2015, end)
        assert tuples(sql) == expected_descents(incidents, geocode, income, end)


def test_profile_means_are_those_of_the_joined_rows(incidents, geocode, income):
    facts = descent.labelled_facts(incidents, 2015)
    joined = descent.geocoded_facts(facts, geocode, income)
    profile = descent.zip_profile(facts, geocode, income)
    for pick in (descent.top_zips, descent.bottom_zips):
        for zip_code, mean in tuples(pick(joined)):
            (row,) = profile.filter(F.col("zip") == zip_code).collect()
            assert row.avg_income == (None if mean is None else pytest.approx(mean))


def test_geocoded_facts_at_end(spark, incidents, geocode, income):
    facts = descent.labelled_facts(incidents, 2015)
    joined = descent.geocoded_facts(facts, geocode, income)
    for end, pick in (("top", descent.top_zips), ("bottom", descent.bottom_zips)):
        chosen = {row.zip for row in pick(joined).collect()}
        expected = Counter(tuple(row) for row in joined.collect() if row.zip in chosen)
        found = descent.geocoded_facts_at_end(facts, geocode, income, end)
        assert found.columns == joined.columns
        assert Counter(tuples(found)) == expected


def test_facts_at_end_measure_what_is_sent(spark, incidents, geocode, income):
    """The limit is below the geocode table and above the cells of the chosen ZIPs."""
    facts = descent.labelled_facts(incidents, 2015)
    limit = measure_bytes(geocode) - 1
    found = descent.geocoded_facts_at_end(facts, geocode, income, "top", broadcast_limit=limit)
    plan = plan_of(found)
    assert plan.count("BroadcastHashJoin") == 2 and "hashpartitioning" not in plan
    assert Counter(tuples(found)) == Counter(
        tuples(descent.geocoded_facts_at_end(facts, geocode, income, "top"))
    )


def test_year_folders_reach_the_scan(spark):
    folder = fixtures.StagedFiles.of(spark, SF_DIR).by_year
    incidents = read_incidents(spark, folder, "parquet", year=fixtures.YEAR)
    lookups = fixtures.geocode(spark, SF_DIR), fixtures.income(spark, SF_DIR)
    plan = plan_of(descent.descent_counts(incidents, *lookups, fixtures.YEAR))
    assert "PartitionFilters: [isnotnull(report_year" in plan


def test_descents_scan_incidents_once_and_join_as_asked(spark):
    tables = [table(spark, SF_DIR) for table in (fixtures.incidents, fixtures.geocode, fixtures.income)]
    nodes = {
        "broadcast": "BroadcastHashJoin",
        "merge": "SortMergeJoin",
        "shuffle_hash": "ShuffledHashJoin",
        "replicate": "SortMergeJoin",
    }
    for strategy, node in nodes.items():
        plan = plan_of(descent.descent_counts(*tables, fixtures.YEAR, "top", strategy))
        assert plan.count(node) == 2
        assert plan.count("orders.parquet") == 1
        assert "GreaterThanOrEqual(o_orderdate" in plan
        assert "Cartesian" not in plan and "NestedLoop" not in plan
        # Facts are counted where they are read, before any shuffle or join.
        assert plan.index("partial_count(1)") > plan.index(node)


def expected_distances(incidents, posts, known_only=False):
    sums = defaultdict(lambda: [0.0, 0])
    for row in incidents.collect():
        if not str(row.weapon_cd).startswith("1") or not row.lat or not row.lon:
            continue
        for post in posts:
            if post.prec == row.area and not (known_only and 0 in (post.x, post.y)):
                sums[post.division][0] += plain_haversine(row.lat, row.lon, post.y, post.x)
                sums[post.division][1] += 1
    means = [(division, pytest.approx(total / n), n) for division, (total, n) in sums.items()]
    return sorted(means, key=lambda row: (-row[2], row[0]))


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_station_distances(incidents, posts, strategy):
    every = posts.collect()
    found = tuples(stations.station_distances(incidents, posts, strategy))
    assert found == expected_distances(incidents, every)
    found = tuples(stations.station_distances_repartition(incidents, posts, strategy))
    assert found == expected_distances(incidents, every, known_only=True)


def test_station_distances_keep_last(incidents, posts):
    found = stations.station_distances_keep_last(incidents, posts, [F.col("division")])
    single = [post for post in posts.collect() if post.division != "B"]
    assert tuples(found) == expected_distances(incidents, single, known_only=True)


def test_forms_agree_where_station_keys_are_unique(spark):
    incidents = fixtures.incidents(spark, SF_DIR)
    # The first 22; those after them repeat a precinct.
    posts = fixtures.stations(spark, SF_DIR).filter("x <> 0 AND y < 33.7 + 21.5 * 0.012")
    first = tuples(stations.station_distances(incidents, posts))
    approx = [(division, pytest.approx(mean, rel=1e-12), n) for division, mean, n in first]
    assert tuples(stations.station_distances_keep_last(incidents, posts, [F.col("y")])) == approx
    assert tuples(stations.station_distances_repartition(incidents, posts)) == approx


def test_station_without_position_has_no_mean(incidents, posts):
    missing = posts.withColumn("x", F.when(F.col("prec") != 1, F.col("x")))
    by_division = {row[0]: row for row in tuples(stations.station_distances(incidents, missing))}
    assert by_division["A"][1] is None and by_division["A"][2] > 0


def test_repartition_form_splits_an_area(spark):
    plan = plan_of(
        stations.station_distances_repartition(
            fixtures.incidents(spark, SF_DIR), fixtures.stations(spark, SF_DIR)
        )
    )
    assert "hashpartitioning(area" in plan and "__salt" in plan
    # The stations are not broadcast, only the list of hot areas, once for each side.
    sent = [part.split("Scan ")[1] for part in plan.split("BroadcastExchange")[1:]]
    assert len(sent) == 2 and all("__salts" in scan.splitlines()[0] for scan in sent)
