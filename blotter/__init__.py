"""Incident analytics on Spark: typed ingest, cleaning, labelling, ranking, geo joins."""

from blotter.functions.clean import (
    area_key,
    parse_double,
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
    row_count,
)
from blotter.operators.filters import (
    has_known_position,
    in_year,
    is_firearm,
    on_street,
    without_labels,
)
from blotter.operators.joins import (
    STRATEGIES,
    equi_join,
    keep_last,
    restrict_to,
    unmatched,
    unmatched_counts,
)
from blotter.operators.ranking import (
    bottom_k,
    number_rows,
    sort_by_count,
    top_k,
    top_n_per_group,
)
from blotter.operators.rejects import (
    drop_rejects,
    reject_rows,
    unreadable_rows,
    unreadable_values,
)
from blotter.sources.incidents import (
    read_geocode,
    read_incidents,
    read_income,
    read_stations,
    union_years,
)
from blotter.sources.etl import csv_to_parquet
from blotter.sources.lines import read_csv_lines

__all__ = [
    "STRATEGIES",
    "area_key",
    "average_income_by_zip",
    "bottom_k",
    "count_by_label",
    "count_by_month",
    "csv_to_parquet",
    "descent_label",
    "drop_rejects",
    "equi_join",
    "has_known_position",
    "haversine_km",
    "haversine_km_float",
    "in_year",
    "is_firearm",
    "keep_last",
    "number_rows",
    "on_street",
    "parse_double",
    "parse_int",
    "parse_money",
    "parse_report_ts",
    "part_of_day",
    "read_csv_lines",
    "read_geocode",
    "read_incidents",
    "read_income",
    "read_stations",
    "reject_rows",
    "restrict_to",
    "row_count",
    "sort_by_count",
    "strip_leading_zeros",
    "top_k",
    "top_n_per_group",
    "union_years",
    "unmatched",
    "unmatched_counts",
    "unreadable_rows",
    "unreadable_values",
    "without_labels",
]
