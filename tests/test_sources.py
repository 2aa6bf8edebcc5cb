"""Readers and the CSV-to-Parquet job on hand-written files."""

import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from blotter import (
    csv_to_parquet,
    in_year,
    on_street,
    read_csv_lines,
    read_geocode,
    read_incidents,
    read_income,
    read_stations,
    union_years,
    unreadable_rows,
    unreadable_values,
)
from blotter.schemas import INCIDENTS
from blotter.sources.scan import conform, scan
from blotter.sources.scratch import new_folder

HEADER = "DR_NO,Date Rptd,TIME OCC,AREA ,Premis Desc,Vict Descent,Weapon Used Cd,LOCATION,LAT,LON"
FIRST = [
    HEADER,
    "1,01/02/2015 12:00:00 AM,0500,01,STREET,B,101,\"5TH, \"\"OLD\"\" ST\",34.05,-118.25",
    "",
    "2,12/31/2015 01:30:00 PM,1159,14,,,,MAIN ST,0,0",
    "3,bad,late,x,OTHER,Z,n/a,,north,",
]
# Another column order, another spelling of a header, no number column.
SECOND = [
    "LON,LAT,AREA,Date Rptd,Time Occ,Premis Desc,Vict Descent,Weapon Used Cd",
    "-118.3,34.1,21,03/08/2016 02:30:00 AM,2359,STREET,H ,210",
]
FIRST_ROWS = [
    (1, dt.datetime(2015, 1, 2), 500, 1, "STREET", "B", 101, 34.05, -118.25),
    (2, dt.datetime(2015, 12, 31, 13, 30), 1159, 14, None, None, None, 0.0, 0.0),
    (3, None, None, None, "OTHER", "Z", None, None, None),
]
SECOND_ROW = (dt.datetime(2016, 3, 8, 2, 30), 2359, 21, "STREET", "H ", 210, 34.1, -118.3)


def write(path, lines):
    path.write_text("\n".join(lines) + "\n")
    return str(path)


@pytest.fixture
def first(tmp_path):
    return write(tmp_path / "first.csv", FIRST)


def tuples(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_read_csv(spark, first):
    df = read_incidents(spark, first)
    assert tuples(df) == FIRST_ROWS
    assert dict(df.dtypes) == {field.name: field.type for field in INCIDENTS}


def test_read_csv_with_given_header(spark, first, tmp_path):
    assert tuples(read_incidents(spark, first, header=HEADER.split(","))) == FIRST_ROWS
    wrong = HEADER.replace("LAT,LON", "LON,LAT").split(",")
    with pytest.raises(Exception, match="header does not conform"):
        read_incidents(spark, first, header=wrong).collect()


def test_union_is_by_name(spark, first, tmp_path):
    second = write(tmp_path / "second.csv", SECOND)
    columns = [field.name for field in INCIDENTS if field.name != "dr_no"]
    frames = [read_incidents(spark, path).select(*columns) for path in (first, second)]
    expected = sorted([row[1:] for row in FIRST_ROWS] + [SECOND_ROW], key=repr)
    assert tuples(union_years(frames)) == expected
    same_twice = read_incidents(spark, [first, first])
    assert tuples(same_twice) == sorted(FIRST_ROWS * 2, key=repr)
    with pytest.raises(ValueError):
        union_years([])


def test_read_arguments(spark, first, tmp_path):
    with pytest.raises(ValueError, match="format"):
        read_incidents(spark, first, "json")
    incomplete = write(tmp_path / "incomplete.csv", ["LAT,LON", "1,2"])
    with pytest.raises(ValueError, match="Date Rptd"):
        read_incidents(spark, incomplete)
    unclear = write(tmp_path / "unclear.csv", ["LAT,lat ,LON,ZIPcode", "1,2,3,4"])
    with pytest.raises(ValueError, match="plain name"):
        read_geocode(spark, unclear)


def test_line_breaks_in_quotes(spark, tmp_path):
    lines = [HEADER, "9,01/02/2015 12:00:00 AM,1,1,\"A\nB\",B,101,HERE,1.5,2.5"]
    path = write(tmp_path / "multi.csv", lines)
    (row,) = read_incidents(spark, path, multi_line=True).collect()
    assert (row.premis, row.lon) == ("A\nB", 2.5)


def test_lines(spark, first, tmp_path):
    assert tuples(read_csv_lines(spark, first)) == FIRST_ROWS
    assert tuples(read_csv_lines(spark, first, header=HEADER)) == FIRST_ROWS
    folder = tmp_path / "folder"
    folder.mkdir()
    for name in ("a.csv", "b.csv"):
        write(folder / name, FIRST)
    assert tuples(read_csv_lines(spark, str(folder))) == sorted(FIRST_ROWS * 2, key=repr)
    empty = write(tmp_path / "empty.csv", [])
    (tmp_path / "empty.csv").write_text("")
    with pytest.raises(ValueError, match="no header"):
        read_csv_lines(spark, empty)


def test_lookup_tables(spark, tmp_path):
    geocode = write(tmp_path / "geo.csv", ["LAT,LON,ZIPcode", "34.05,-118.25,90001"])
    assert tuples(read_geocode(spark, geocode)) == [(34.05, -118.25, 90001)]
    income = write(
        tmp_path / "income.csv",
        ["Zip Code,Community,Estimated Median Income", "90001,\"Here, there\",\"$12,345\"", "90002,X,"],
    )
    assert tuples(read_income(spark, income)) == [(90001, 12345.0), (90002, None)]
    stations = write(
        tmp_path / "st.csv", ["X,Y,FID,DIVISION,LOCATION,PREC", "-118.2,34.0,5,HARBOR,\"1, A\",5"]
    )
    assert tuples(read_stations(spark, stations)) == [(-118.2, 34.0, "HARBOR", 5)]


def test_csv_to_parquet(spark, first):
    target = new_folder(spark) + "/out.parquet"
    written = csv_to_parquet(spark, first, target)
    assert written.columns == [field.name for field in INCIDENTS] + ["location", "unreadable"]
    assert tuples(read_incidents(spark, target, "parquet")) == FIRST_ROWS
    places = {row.location for row in written.collect()}
    assert places == {'5TH, "OLD" ST', "MAIN ST", None}
    with pytest.raises(AnalysisException):
        csv_to_parquet(spark, first, target)
    assert csv_to_parquet(spark, first, target, mode="overwrite").count() == 3


def test_text_that_does_not_parse_is_kept(spark, first):
    written = csv_to_parquet(spark, first, new_folder(spark) + "/out.parquet")
    kept = {
        ("date_rptd", "bad"), ("time_occ", "late"), ("area", "x"), ("weapon_cd", "n/a"), ("lat", "north")
    }
    values = unreadable_values(written, "dr_no").collect()
    assert len(values) == len(kept) and {(v.field, v.text) for v in values} == kept
    assert [row.dr_no for row in unreadable_rows(written).collect()] == [3]
    bare = csv_to_parquet(spark, first, new_folder(spark) + "/out.parquet", unreadable=None)
    assert "unreadable" not in bare.columns


@pytest.mark.parametrize("read", (read_incidents, read_csv_lines))
def test_differing_headers(spark, first, tmp_path, read):
    second = write(tmp_path / "second.csv", SECOND)
    expected = sorted([*FIRST_ROWS, (None, *SECOND_ROW)], key=repr)
    assert tuples(read(spark, [first, second])) == expected
    folder = tmp_path / "both"
    folder.mkdir()
    write(folder / "a.csv", FIRST)
    write(folder / "b.csv", [HEADER.replace("LAT,LON", "LON,LAT"), *FIRST[1:]])
    with pytest.raises(Exception, match="header does not conform"):
        read(spark, str(folder)).collect()


def test_headers_without_a_name(spark, tmp_path):
    path = write(tmp_path / "geo.csv", ["LAT,,LON,ZIPcode,LAT", "34.05,x,-118.25,90001,1"])
    assert scan(spark, path).collect()[0][:4] == ("34.05", "x", "-118.25", "90001")


def test_csv_to_parquet_with_source_names(spark, first):
    target = new_folder(spark) + "/out.parquet"
    written = csv_to_parquet(spark, first, target, source_names=True)
    assert sorted(written.columns) == sorted([*HEADER.split(","), "unreadable"])
    assert dict(written.dtypes)["AREA "] == "int"
    assert tuples(read_incidents(spark, target, "parquet")) == FIRST_ROWS


def test_csv_to_parquet_by_year(spark, first):
    target = new_folder(spark) + "/out.parquet"
    written = csv_to_parquet(spark, first, target, by_year="date_rptd")
    assert tuples(read_incidents(spark, target, "parquet")) == FIRST_ROWS
    plan = written.filter("report_year = 2015")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_year" in plan
    assert written.filter("report_year = 2015").count() == 2
    one_year = read_incidents(spark, [target, target], "parquet", year=2015)
    assert tuples(one_year) == sorted(FIRST_ROWS[:2] * 2, key=repr)
    plan = one_year._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: [isnotnull(report_year") == 2
    plain = csv_to_parquet(spark, first, new_folder(spark) + "/out.parquet")
    assert plain.count() == 3 and read_incidents(spark, first, year=2015).count() == 2


def test_parquet_with_inferred_types(spark, first):
    """A file written from inferred types, its date text and its names with blanks, reads the same."""
    target = new_folder(spark) + "/inferred.parquet"
    spark.read.csv(first, header=True, inferSchema=True, escape='"').filter(
        "`TIME OCC` <> 'late'"
    ).write.parquet(target)
    assert tuples(read_incidents(spark, target, "parquet")) == FIRST_ROWS[:2]


def test_filters_reach_the_scan(spark, first):
    target = new_folder(spark) + "/out.parquet"
    df = conform(csv_to_parquet(spark, first, target), INCIDENTS)
    plan = (
        df.filter(in_year(F.col("date_rptd"), 2015) & on_street(F.col("premis")))
        .select("dr_no")
        ._jdf.queryExecution().executedPlan().toString()
    )
    pushed = plan[plan.index("PushedFilters:") :]
    for part in (
        "GreaterThanOrEqual(date_rptd,2015-01-01T00:00",
        "LessThan(date_rptd,2016-01-01T00:00",
        "EqualTo(premis,STREET)",
    ):
        assert part in pushed
    assert "ReadSchema: struct<dr_no:bigint,date_rptd:timestamp_ntz,premis:string>" in pushed
    text = scan(spark, first).filter(F.col("Premis Desc") == "STREET").select("LAT")
    plan = text._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Premis Desc,STREET)" in plan
    assert "ReadSchema: struct<Premis Desc:string,LAT:string>" in plan


def test_scratch_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark).startswith(shared)
    assert new_folder(spark) != new_folder(spark)
