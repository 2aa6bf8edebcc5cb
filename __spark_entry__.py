
from __future__ import annotations

import sys
from collections.abc import Callable
from pathlib import Path
from uuid import uuid4

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter import fixtures as fx
from blotter.fixtures import StagedFiles
from blotter.functions.clean import (
    REPORT_TS_PATTERN,
    area_key,
    parse_int,
    parse_money,
    parse_report_ts,
    strip_leading_zeros,
)
from blotter.functions.geo import haversine_km, haversine_km_float
from blotter.functions.labels import descent_label, part_of_day
from blotter.operators.aggregates import (
    average_income_by_zip,
    count_by_label,
    count_by_month,
    exact_mean,
    exact_sum,
    row_count,
)
from blotter.operators.filters import has_known_position, in_year, is_firearm, on_street
from blotter.operators.joins import (
    bitmap_reduced,
    equi_join,
    keep_last,
    restrict_to,
    unmatched,
    unmatched_counts,
)
from blotter.operators.ranking import number_rows, rank_by_ranges, sort_by_count, top_n_per_group
from blotter.operators.rejects import drop_rejects, reject_rows, unreadable_rows, unreadable_values
from blotter.plans import descent, monthly, sql_text, stations, street
from blotter.schemas import INCIDENTS, Field
from blotter.sources.bucketed import bucketed_join, write_bucketed_facts, write_bucketed_lookup
from blotter.sources.etl import UNREADABLE_COLUMN, csv_to_parquet
from blotter.sources.incidents import read_incidents, union_years
from blotter.sources.ledger import GrowingTable
from blotter.sources.lines import read_csv_lines
from blotter.sources.quoted import read_quoted_records
from blotter.sources.routed import OUTCOME_COLUMN, write_routed
from blotter.sources.scan import CSV_DIALECT, conform, scan
from blotter.sources.scratch import new_folder
from oracles import ORACLES

# The training-data operators stand apart: the other queries work without their folder.
try:
    from blotter.llm.queries import ORACLES as _LLM_ORACLES
    from blotter.llm.queries import QUERIES as _LLM_QUERIES

    import corpus_pipeline
except ImportError:
    _LLM_QUERIES, _LLM_ORACLES = {}, {}
else:
    _LLM_QUERIES = _LLM_QUERIES | {"pipeline": corpus_pipeline.run}
    if corpus_pipeline.ORACLE_SQL:
        _LLM_ORACLES = _LLM_ORACLES | {"pipeline": corpus_pipeline.ORACLE_SQL}

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    return queries()["q4_dataframe"](spark, "/root/testdata/sf0.001")


# ---- sources


def src_csv_scan(spark, sf_dir):
    return conform(scan(spark, StagedFiles.of(spark, sf_dir).all_csv, "csv"), INCIDENTS)


def src_parquet_scan(spark, sf_dir):
    return scan(spark, StagedFiles.of(spark, sf_dir).all_parquet, "parquet")


def src_read_incidents(spark, sf_dir):
    return read_incidents(spark, StagedFiles.of(spark, sf_dir).csv, "csv")


def src_csv_text_lines(spark, sf_dir):
    return read_csv_lines(spark, StagedFiles.of(spark, sf_dir).all_csv)


def etl_csv_to_parquet(spark, sf_dir):
    return _written(spark, sf_dir).drop(UNREADABLE_COLUMN)


def _written(spark, sf_dir):
    target = new_folder(spark) + "/incidents.parquet"
    return csv_to_parquet(spark, StagedFiles.of(spark, sf_dir).all_csv, target)


def etl_keeps_unreadable(spark, sf_dir):
    return unreadable_values(_written(spark, sf_dir), "dr_no")


def etl_rejects(spark, sf_dir):
    return unreadable_rows(_written(spark, sf_dir)).drop(UNREADABLE_COLUMN)


def _grown(spark, sf_dir):
    """The first file's rows, and the table they are in before the second file comes."""
    table = GrowingTable(spark, new_folder(spark) + "/incidents")
    table.add(StagedFiles.of(spark, sf_dir).csv[0])
    return table


def etl_resumed(spark, sf_dir):
    table = _grown(spark, sf_dir)
    table.add(StagedFiles.of(spark, sf_dir).csv)
    return table.read().drop(UNREADABLE_COLUMN)


def agg_merged_partials(spark, sf_dir):
    table = _grown(spark, sf_dir)
    table.merged("months", count_by_month, "crime_total")
    table.add(StagedFiles.of(spark, sf_dir).csv)
    return table.merged("months", count_by_month, "crime_total")


def etl_routed(spark, sf_dir):
    text = scan(spark, StagedFiles.of(spark, sf_dir).all_csv, "csv")
    typed = conform(text, INCIDENTS, unreadable=UNREADABLE_COLUMN)
    target = new_folder(spark) + "/incidents.parquet"
    routed = write_routed(typed, target, F.col(UNREADABLE_COLUMN).isNotNull())
    return routed.table.select("dr_no", "lat", "lon", OUTCOME_COLUMN)


def src_mixed_headers(spark, sf_dir):
    return read_incidents(spark, StagedFiles.of(spark, sf_dir).mixed_csv, "csv")


def src_text_lines_mixed_headers(spark, sf_dir):
    return read_csv_lines(spark, StagedFiles.of(spark, sf_dir).mixed_csv)


def union_incident_years(spark, sf_dir):
    first, second = (scan(spark, path, "parquet") for path in StagedFiles.of(spark, sf_dir).parquet)
    return union_years([first, second.select(*reversed(second.columns))])


def src_quoted_line_breaks(spark, sf_dir):
    orders = fx.derive(
        fx.table(spark, sf_dir, "orders"),
        {"dr_no": "cast(o_orderkey AS varchar(20))", "remark": fx.REMARK_TEXT, "place": "o_orderstatus"},
    )
    path = new_folder(spark) + "/remarks.csv"
    orders.write.options(header=True, **CSV_DIALECT).csv(path)
    return read_quoted_records(spark, path, REMARKS)


REMARKS = (Field("dr_no", "dr_no", "bigint"), Field("remark", "remark", "string"), Field("place", "place", "string"))


# ---- cleaning


def clean_report_date(spark, sf_dir):
    key = F.col("o_orderkey")
    seconds = F.timestamp_add("SECOND", key % 86400, F.col("o_orderdate"))
    text = (
        F.when(key % 307 == 0, "bad")
        .when(key % 307 == 1, "")
        .when(key % 307 != 2, F.date_format(seconds, REPORT_TS_PATTERN))
    )
    orders = fx.table(spark, sf_dir, "orders")
    return orders.select(key.alias("dr_no"), parse_report_ts(text).alias("date_rptd"))


def clean_money(spark, sf_dir):
    key = F.col("c_custkey")
    text = (
        F.when(key % 101 == 0, "n/a")
        .when(key % 101 == 1, "")
        .when(key % 101 != 2, F.concat(F.lit("$"), F.format_number("c_acctbal", 2)))
    )
    customer = fx.table(spark, sf_dir, "customer")
    return customer.select(key, parse_money(text).alias("money"))


def clean_area_key(spark, sf_dir):
    text = fx.spark_expr(fx.AREA_TEXT)
    orders = fx.table(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_orderkey").alias("dr_no"),
        area_key(text).alias("area"),
        strip_leading_zeros(text).alias("area_text"),
    )


def _coded(spark, sf_dir):
    return fx.derive(fx.table(spark, sf_dir, "orders"), {"dr_no": "o_orderkey", "code_text": fx.CODE_TEXT})


def clean_int_code(spark, sf_dir):
    return _coded(spark, sf_dir).select("dr_no", parse_int(F.col("code_text")).alias("code"))


def flt_firearm_text(spark, sf_dir):
    coded = _coded(spark, sf_dir).withColumn("weapon_cd", parse_int(F.col("code_text")))
    return coded.filter(is_firearm(F.col("weapon_cd"))).select("dr_no", "code_text", "weapon_cd")


def _coordinate_text(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    return fx.derive(orders, {"dr_no": "o_orderkey", "lat_text": fx.COORDINATE_TEXT})


def clean_reject_coords(spark, sf_dir):
    return reject_rows(_coordinate_text(spark, sf_dir), ["lat_text"])


def clean_accepted_coords(spark, sf_dir):
    accepted = drop_rejects(_coordinate_text(spark, sf_dir), ["lat_text"])
    return accepted.withColumnRenamed("lat_text", "lat")


# ---- filters


def flt_street(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir)
    return incidents.filter(on_street(F.col("premis"))).select("dr_no", "premis")


def flt_year(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir)
    return incidents.filter(in_year(F.col("date_rptd"), fx.YEAR)).select("dr_no", "date_rptd")


def flt_firearm(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir)
    return incidents.filter(is_firearm(F.col("weapon_cd"))).select("dr_no", "weapon_cd")


def flt_valid_coords(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir).select("dr_no", "lat", "lon")
    return incidents.filter(has_known_position(F.col("lat"), F.col("lon")))


def flt_valid_coords_both(spark, sf_dir):
    positions = [F.col(name) for name in ("lat", "lon", "y", "x")]
    joined = _with_stations(spark, sf_dir).filter(has_known_position(*positions))
    return joined.select("dr_no", *positions)


# ---- labels


def map_part_of_day(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir)
    return incidents.select("dr_no", part_of_day(F.col("time_occ")).alias("crime_time"))


def map_descent(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir)
    return incidents.select("dr_no", descent_label(F.col("vict_descent")).alias("descent"))


# ---- joins


def _with_stations(spark, sf_dir, strategy="broadcast"):
    by_area = stations.by_area(fx.stations(spark, sf_dir))
    incidents = fx.incidents(spark, sf_dir)
    return equi_join(incidents, by_area, "area", strategy, salt_by=["dr_no"])


def _year_facts(spark, sf_dir):
    """Incidents of the fixture year with their label."""
    incidents = fx.incidents(spark, sf_dir)
    in_fixture_year = incidents.filter(in_year(F.col("date_rptd"), fx.YEAR))
    return in_fixture_year.select(
        "dr_no", "lat", "lon", descent_label(F.col("vict_descent")).alias("descent")
    )


def _geocoded_year_facts(spark, sf_dir):
    """The same with ZIP and income."""
    lookups = fx.geocode(spark, sf_dir), fx.income(spark, sf_dir)
    return descent.geocoded_facts(_year_facts(spark, sf_dir), *lookups)


def join_geocode(spark, sf_dir):
    facts = fx.incidents(spark, sf_dir).select("dr_no", "lat", "lon")
    return equi_join(facts, fx.geocode(spark, sf_dir), ["lat", "lon"], "broadcast")


def join_income(spark, sf_dir):
    facts = fx.incidents(spark, sf_dir).select("dr_no", "lat", "lon")
    joined = descent.geocoded_facts(facts, fx.geocode(spark, sf_dir), fx.income(spark, sf_dir))
    return joined.select("dr_no", "zip", "income")


def join_station(spark, sf_dir):
    return _with_stations(spark, sf_dir).select("dr_no", "area", "division")


def join_station_replicated(spark, sf_dir):
    return _with_stations(spark, sf_dir, "replicate").select("dr_no", "area", "division")


def join_bitmap_reduced(spark, sf_dir):
    facts = fx.incidents(spark, sf_dir).select("dr_no", "lat", "lon")
    cells = fx.geocode(spark, sf_dir).filter(F.col("zip") % 10 == 1)
    return equi_join(bitmap_reduced(facts, cells, ["lat", "lon"]), cells, ["lat", "lon"], "merge")


def join_bucketed(spark, sf_dir):
    folder, buckets, salts = new_folder(spark), int(spark.conf.get("spark.sql.shuffle.partitions")), 4
    facts, lookup = (f"{side}_{uuid4().hex}" for side in ("incidents", "stations"))
    incidents = fx.incidents(spark, sf_dir).select("dr_no", "area")
    write_bucketed_facts(incidents, facts, "area", buckets, f"{folder}/facts", ["dr_no"], salts)
    posts = stations.by_area(fx.stations(spark, sf_dir)).select("area", "division")
    write_bucketed_lookup(posts, lookup, "area", buckets, f"{folder}/lookup", salts)
    return bucketed_join(spark, facts, lookup, "area")


def join_keep_last(spark, sf_dir):
    supplier = fx.table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey", "s_name")
    return keep_last(supplier, "s_nationkey", [F.col("s_suppkey")])


def join_unmatched(spark, sf_dir):
    facts = fx.incidents(spark, sf_dir).select("dr_no", "area")
    return unmatched(facts, stations.by_area(fx.stations(spark, sf_dir)), "area")


def join_unmatched_areas(spark, sf_dir):
    by_area = stations.by_area(fx.stations(spark, sf_dir))
    return unmatched_counts(fx.incidents(spark, sf_dir), by_area, "area")


def q3_zip_subset_join(spark, sf_dir):
    lookups = fx.geocode(spark, sf_dir), fx.income(spark, sf_dir)
    return descent.geocoded_facts_at_end(_year_facts(spark, sf_dir), *lookups, "top")


def join_restrict_to(spark, sf_dir):
    facts = _geocoded_year_facts(spark, sf_dir)
    return restrict_to(facts, descent.top_zips(facts), "zip")


# ---- aggregates and ranking


def agg_count_by_month(spark, sf_dir):
    return count_by_month(fx.incidents(spark, sf_dir))


def agg_count_by_label(spark, sf_dir):
    return count_by_label(map_descent(spark, sf_dir), "descent")


def agg_avg_income_by_zip(spark, sf_dir):
    return _rounded(average_income_by_zip(_geocoded_year_facts(spark, sf_dir)), "avg_income")


def agg_exact_mean(spark, sf_dir):
    orders = fx.table(spark, sf_dir, "orders")
    price = F.col("o_totalprice") / 7
    return orders.groupBy("o_orderpriority").agg(exact_sum(price).alias("total"), exact_mean(price).alias("mean"))


def agg_row_count(spark, sf_dir):
    return row_count(fx.table(spark, sf_dir, "orders"))


def win_row_number(spark, sf_dir):
    months = count_by_month(fx.incidents(spark, sf_dir))
    return number_rows(months, ["year"], [F.desc("crime_total"), F.col("month")])


def rank_top_n_per_group(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir).select("area", "dr_no", "date_rptd")
    return top_n_per_group(incidents, ["area"], [F.desc("date_rptd"), F.col("dr_no")], 5)


def rank_top_n_large(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir).select("premis", "dr_no", "date_rptd")
    return top_n_per_group(incidents, ["premis"], [F.desc("date_rptd"), F.col("dr_no")], 1001)


def rank_top_n_any(spark, sf_dir):
    incidents = fx.incidents(spark, sf_dir).select("premis", "dr_no", "date_rptd")
    return rank_by_ranges(incidents, ["premis"], [F.desc("date_rptd"), F.col("dr_no")], 4000)


def topk_zip_income(spark, sf_dir):
    return _rounded(descent.top_zips(_geocoded_year_facts(spark, sf_dir)), "avg_income")


def bottomk_zip_income(spark, sf_dir):
    return _rounded(descent.bottom_zips(_geocoded_year_facts(spark, sf_dir)), "avg_income")


def bottomk_zip_known_income(spark, sf_dir):
    facts = _geocoded_year_facts(spark, sf_dir)
    return _rounded(descent.bottom_zips(facts, skip_nulls=True), "avg_income")


def sort_counts_desc(spark, sf_dir):
    counts = count_by_label(fx.incidents(spark, sf_dir), "area")
    return sort_by_count(counts, ["area"])


# ---- distances


def geo_haversine(spark, sf_dir):
    distance = haversine_km(*(F.col(name) for name in ("lat", "lon", "y", "x")))
    joined = _with_stations(spark, sf_dir).select("dr_no", distance.alias("distance_km"))
    return _rounded(joined.filter("distance_km IS NOT NULL"), "distance_km")


def geo_haversine_float(spark, sf_dir):
    distance = haversine_km_float(*(F.col(name) for name in ("lat", "lon", "y", "x")))
    joined = _with_stations(spark, sf_dir)
    known = joined.filter(has_known_position(F.col("lat"), F.col("lon")))
    distances = known.select("division", distance.alias("distance"))
    means = distances.groupBy("division").agg(F.avg("distance").alias("average_distance"))
    return _rounded(means, "average_distance", 4)


# ---- analyses


def q1_sql(spark, sf_dir):
    return monthly.top_months_sql(spark, fx.incidents(spark, sf_dir))


def q1_dataframe(spark, sf_dir):
    return monthly.top_months(fx.incidents(spark, sf_dir))


def q1_csv_source(spark, sf_dir):
    header = [field.header for field in INCIDENTS]
    files = StagedFiles.of(spark, sf_dir).csv
    return monthly.top_months(read_incidents(spark, files, "csv", header))


def q1_parquet_source(spark, sf_dir):
    files = StagedFiles.of(spark, sf_dir).parquet
    return monthly.top_months(read_incidents(spark, files, "parquet"))


def q2_sql(spark, sf_dir):
    return street.street_by_part_of_day_sql(spark, fx.incidents(spark, sf_dir))


def q2_dataframe(spark, sf_dir):
    return street.street_by_part_of_day(fx.incidents(spark, sf_dir))


def _sql_text(spark, sf_dir, text):
    sql_text.register(
        spark, incidents=fx.incidents(spark, sf_dir), stations=fx.stations(spark, sf_dir)
    )
    return spark.sql(text)


def q1_sql_text(spark, sf_dir):
    return _sql_text(spark, sf_dir, sql_text.TOP_MONTHS)


def q2_sql_text(spark, sf_dir):
    return _sql_text(spark, sf_dir, sql_text.STREET_BY_PART_OF_DAY)


def q4_sql(spark, sf_dir):
    return _rounded(_sql_text(spark, sf_dir, sql_text.STATION_DISTANCES), "average_distance")


def _q3_tables(spark, sf_dir):
    return fx.incidents(spark, sf_dir), fx.geocode(spark, sf_dir), fx.income(spark, sf_dir)


def q3_top_by_year(spark, sf_dir):
    table = StagedFiles.of(spark, sf_dir).by_year
    incidents = read_incidents(spark, table, "parquet", year=fx.YEAR)
    lookups = fx.geocode(spark, sf_dir), fx.income(spark, sf_dir)
    return descent.descent_counts(incidents, *lookups, fx.YEAR)


def q3_sql(spark, sf_dir):
    return descent.descent_counts_sql(spark, *_q3_tables(spark, sf_dir), fx.YEAR)


def q3_bottom_sql(spark, sf_dir):
    return descent.descent_counts_sql(spark, *_q3_tables(spark, sf_dir), fx.YEAR, "bottom")


def _q3(end: str, strategy: str) -> Query:
    def run(spark, sf_dir):
        return descent.descent_counts(*_q3_tables(spark, sf_dir), fx.YEAR, end, strategy)

    return run


def q4_dataframe(spark, sf_dir):
    result = stations.station_distances(fx.incidents(spark, sf_dir), fx.stations(spark, sf_dir))
    return _rounded(result, "average_distance")


def q4_broadcast(spark, sf_dir):
    incidents, posts = fx.incidents(spark, sf_dir), fx.stations(spark, sf_dir)
    order = [F.col("division"), F.col("y"), F.col("x")]
    return _rounded(
        stations.station_distances_keep_last(incidents, posts, order), "average_distance"
    )


def q4_repartition(spark, sf_dir):
    incidents, posts = fx.incidents(spark, sf_dir), fx.stations(spark, sf_dir)
    return _rounded(stations.station_distances_repartition(incidents, posts), "average_distance")


def _rounded(df: DataFrame, column: str, digits: int = 6) -> DataFrame:
    """Sums of doubles depend on the order of addition in their last bits."""
    return df.withColumn(column, F.round(column, digits))


_QUERIES = (
    src_csv_scan,
    src_parquet_scan,
    src_read_incidents,
    src_csv_text_lines,
    src_mixed_headers,
    src_text_lines_mixed_headers,
    src_quoted_line_breaks,
    etl_csv_to_parquet,
    etl_keeps_unreadable,
    etl_rejects,
    etl_resumed,
    etl_routed,
    union_incident_years,
    clean_report_date,
    clean_money,
    clean_area_key,
    clean_int_code,
    clean_reject_coords,
    clean_accepted_coords,
    flt_street,
    flt_year,
    flt_firearm,
    flt_firearm_text,
    flt_valid_coords,
    flt_valid_coords_both,
    map_part_of_day,
    map_descent,
    join_geocode,
    join_income,
    join_station,
    join_station_replicated,
    join_bitmap_reduced,
    join_bucketed,
    join_keep_last,
    join_unmatched,
    join_unmatched_areas,
    q3_zip_subset_join,
    join_restrict_to,
    agg_count_by_month,
    agg_count_by_label,
    agg_merged_partials,
    agg_avg_income_by_zip,
    agg_exact_mean,
    agg_row_count,
    win_row_number,
    rank_top_n_per_group,
    rank_top_n_large,
    rank_top_n_any,
    topk_zip_income,
    bottomk_zip_income,
    bottomk_zip_known_income,
    sort_counts_desc,
    geo_haversine,
    geo_haversine_float,
    q1_sql,
    q1_sql_text,
    q1_dataframe,
    q1_csv_source,
    q1_parquet_source,
    q2_sql,
    q2_sql_text,
    q2_dataframe,
    q3_top_by_year,
    q3_sql,
    q3_bottom_sql,
    q4_dataframe,
    q4_sql,
    q4_broadcast,
    q4_repartition,
)

# Key suffix: join strategy.
_Q3_STRATEGIES = {
    "default": "default",
    "broadcast": "broadcast",
    "shuffle_hash": "shuffle_hash",
    "merge": "merge",
    "replicate": "replicate",
}


def queries() -> dict[str, Query]:
    """Every registered query: (spark, sf_dir) to a DataFrame."""
    found = {query.__name__: query for query in _QUERIES}
    for suffix, strategy in _Q3_STRATEGIES.items():
        for end in ("top", "bottom"):
            found[f"q3_{end}_{suffix}"] = _q3(end, strategy)
    return found | _LLM_QUERIES


def oracle_sql() -> dict[str, str]:
    """The DuckDB SQL of every registered query."""
    return ORACLES | _LLM_ORACLES
