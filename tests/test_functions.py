"""Column expressions on edge rows."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from blotter import (
    area_key,
    descent_label,
    has_known_position,
    haversine_km,
    haversine_km_float,
    in_year,
    is_firearm,
    on_street,
    parse_double,
    parse_int,
    parse_money,
    parse_report_ts,
    part_of_day,
    strip_leading_zeros,
    without_labels,
)


def apply(spark, values, kind, function):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [row[0] for row in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_part_of_day(spark):
    expected = {
        0: "Night", 499: "Night", 500: "Morning", 1158: "Morning", 1159: "Night", 1160: "Night",
        1199: "Night", 1200: "Afternoon", 1658: "Afternoon", 1659: "Night", 1660: "Night",
        1700: "Evening", 2058: "Evening", 2059: "Night", 2359: "Night", None: "Night",
    }
    assert apply(spark, expected, "int", part_of_day) == list(expected.values())


def test_part_of_day_with_other_bounds(spark):
    halves = [("AM", 0, 1200), ("PM", 1200, 2400)]
    found = apply(spark, [0, 1159, 1200, 2359, None], "int", lambda c: part_of_day(c, halves, "?"))
    assert found == ["AM", "AM", "PM", "PM", "?"]
    assert apply(spark, [1, None], "int", lambda c: part_of_day(c, [], "?")) == ["?", "?"]


def test_descent_label(spark):
    expected = {
        "B": "Black", "B ": "Black", " Z": "Asian Indian", "H": "Hispanic/Latin/Mexican",
        "Q": "None", "b": "None", "BB": "None", "": "None", " ": "None", None: "None",
    }
    assert apply(spark, expected, "string", descent_label) == list(expected.values())


REPORT_DATES = {
    "01/02/2015 12:00:00 AM": dt.datetime(2015, 1, 2),
    "01/02/2015 12:00:01 PM": dt.datetime(2015, 1, 2, 12, 0, 1),
    "12/31/2015 01:30:00 PM": dt.datetime(2015, 12, 31, 13, 30),
    "03/08/2015 02:30:00 AM": dt.datetime(2015, 3, 8, 2, 30),
    "02/30/2015 01:00:00 AM": None,
    "13/01/2015 01:00:00 AM": None,
    "01/02/2015 13:00:00 PM": None,
    "01/02/2015": dt.datetime(2015, 1, 2),
    "bad": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_parse_report_ts_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = apply(spark, REPORT_DATES, "string", parse_report_ts)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert found == list(REPORT_DATES.values())


def test_parse_numbers(spark):
    money = {"$1,234": 1234.0, "$12,345,678.90": 12345678.9, "0": 0.0, "": None, "n/a": None, None: None}
    assert apply(spark, money, "string", parse_money) == list(money.values())
    double = {"34.05": 34.05, " -118.25 ": -118.25, "": None, "north": None, None: None}
    assert apply(spark, double, "string", parse_double) == list(double.values())
    integer = {"0102": 102, " 7 ": 7, "": None, "x1": None, "99999999999": None, None: None}
    assert apply(spark, integer, "string", parse_int) == list(integer.values())


def test_area_key(spark):
    numbers = {" 01 ": 1, "14": 14, "00": 0, "": None, "x": None, None: None}
    assert apply(spark, numbers, "string", area_key) == list(numbers.values())
    text = {" 01 ": "1", "14": "14", "00": "", "0x0": "x0", None: None}
    assert apply(spark, text, "string", strip_leading_zeros) == list(text.values())


def test_predicates(spark):
    codes = {101: True, 1: True, 210: False, -1: False, None: None}
    assert apply(spark, codes, "int", is_firearm) == list(codes.values())
    premises = {"STREET": True, "street": False, "": False, None: None}
    assert apply(spark, premises, "string", on_street) == list(premises.values())
    labels = {"None": False, "Other": True, None: None}
    assert apply(spark, labels, "string", without_labels) == list(labels.values())
    both = apply(spark, labels, "string", lambda c: without_labels(c, "None", "Other"))
    assert both == [False, False, None]


def test_in_year(spark):
    days = {
        dt.datetime(2014, 12, 31, 23, 59, 59): False,
        dt.datetime(2015, 1, 1): True,
        dt.datetime(2015, 12, 31, 23, 59, 59, 999999): True,
        dt.datetime(2016, 1, 1): False,
        None: None,
    }
    assert apply(spark, days, "timestamp_ntz", lambda c: in_year(c, 2015)) == list(days.values())


def test_has_known_position(spark):
    rows = [(0.0, 0.0), (34.0, 0.0), (None, -118.0), (34.0, None), (-0.0, 1.0), (34.0, -118.0)]
    df = spark.createDataFrame(rows, "lat double, lon double")
    kept = df.filter(has_known_position(F.col("lat"), F.col("lon"))).collect()
    assert [tuple(row) for row in kept] == [(34.0, -118.0)]


def plain_haversine(lat1, lon1, lat2, lon2):
    """Same distance by the spherical law of cosines in vector form, for comparison."""
    def unit(lat, lon):
        lat, lon = math.radians(lat), math.radians(lon)
        return math.cos(lat) * math.cos(lon), math.cos(lat) * math.sin(lon), math.sin(lat)

    a, b = unit(lat1, lon1), unit(lat2, lon2)
    cross = (
        a[1] * b[2] - a[2] * b[1],
        a[2] * b[0] - a[0] * b[2],
        a[0] * b[1] - a[1] * b[0],
    )
    return 6371.0 * math.atan2(math.hypot(*cross), sum(x * y for x, y in zip(a, b)))


POINTS = "lat1 double, lon1 double, lat2 double, lon2 double"


def distances(spark, points, function):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(points)], f"i int, {POINTS}")
    columns = [F.col(name) for name in ("lat1", "lon1", "lat2", "lon2")]
    return [row[0] for row in df.orderBy("i").select(function(*columns)).collect()]


def test_haversine_on_known_points(spark):
    half = 6371.0 * math.pi
    points = [(5.0, 7.0, 5.0, 7.0), (0.0, 0.0, 0.0, 180.0), (90.0, 0.0, -90.0, 55.0)]
    assert distances(spark, points, haversine_km) == pytest.approx([0.0, half, half], rel=1e-12)
    missing = [(None, 0.0, 0.0, 1.0), (0.0, None, 0.0, 1.0), (0.0, 0.0, None, 1.0), (0.0, 0.0, 0.0, None)]
    assert distances(spark, missing, haversine_km) == [None] * 4
    assert distances(spark, missing, haversine_km_float) == [None] * 4


def test_haversine_on_random_points(spark):
    draw = random.Random(7).uniform
    points = [(draw(-90, 90), draw(-180, 180), draw(-90, 90), draw(-180, 180)) for _ in range(3000)]
    opposite = [(a, b, -a, b + 180) for a, b, _, _ in points[:500]]
    expected = [plain_haversine(*point) for point in points + opposite]
    found = distances(spark, points + opposite, haversine_km)
    assert all(map(math.isfinite, found))
    assert found[:3000] == pytest.approx(expected[:3000], rel=1e-9)
    assert found[3000:] == pytest.approx(expected[3000:], abs=1e-3)
    single = distances(spark, points, haversine_km_float)
    assert single == pytest.approx(expected[:3000], rel=1e-4, abs=1e-2)


@pytest.mark.parametrize("policy", ["CORRECTED", "LEGACY", "EXCEPTION"])
def test_report_dates_of_any_form_under_any_policy(spark, policy):
    key = "spark.sql.legacy.timeParserPolicy"
    before = spark.conf.get(key)
    spark.conf.set(key, policy)
    try:
        forms = {
            "01/02/2015": dt.datetime(2015, 1, 2),
            "1/2/2015": dt.datetime(2015, 1, 2),
            "1/2/2015 1:30:00 PM": dt.datetime(2015, 1, 2, 13, 30),
            "01/02/2015 12:00:00 AM": dt.datetime(2015, 1, 2),
            "bad": None,
        }
        assert apply(spark, forms, "string", parse_report_ts) == list(forms.values())
    finally:
        spark.conf.set(key, before)


def test_codes_written_as_decimals(spark):
    codes = {"101.0": 101, " 01.00 ": 1, "1.5": None, "x": None}
    assert apply(spark, codes, "string", parse_int) == list(codes.values())
