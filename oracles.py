"""The registered queries as DuckDB SQL, written apart from the package's operators.

Only the table derivations are shared with the Spark side.
"""

from __future__ import annotations

from blotter.fixtures import (
    AREA_TEXT,
    CODE_TEXT,
    COORDINATE_TEXT,
    GEOCODE_COLUMNS,
    GEOCODE_REPEATED,
    INCIDENT_COLUMNS,
    INCOME_REPEATED,
    INCOME_SECOND_TENS,
    INCOME_TENS,
    INCOME_TEXT_EMPTY,
    INCOME_TEXT_MISSING,
    INCOME_ZIP,
    REMARK_TEXT,
    SPLIT_DATE,
    STATION_COLUMNS,
    YEAR,
    cell_zip,
    select_list,
)

_TABLES = {
    "incidents": f"SELECT {select_list(INCIDENT_COLUMNS)} FROM orders",
    "geocode": f"""
        SELECT {select_list(GEOCODE_COLUMNS)} FROM customer
        UNION ALL
        SELECT {select_list(GEOCODE_COLUMNS)} FROM customer WHERE {GEOCODE_REPEATED}""",
    "income_text": f"""
        SELECT {INCOME_ZIP} AS zip, CASE
            WHEN {INCOME_TEXT_MISSING} THEN NULL
            WHEN {INCOME_TEXT_EMPTY} THEN ''
            ELSE '$' || format('{{:,}}', tens) END AS income_text
        FROM (
            WITH one AS (
                SELECT {cell_zip("c_custkey")} AS zip, {INCOME_TENS} AS tens
                FROM customer GROUP BY 1
            )
            SELECT zip, tens FROM one
            UNION ALL SELECT zip, {INCOME_SECOND_TENS} FROM one WHERE {INCOME_REPEATED}
        )""",
    "income": """
        SELECT zip, try_cast(regexp_replace(income_text, '[$,]', '', 'g') AS double) AS income
        FROM income_text""",
    "stations": f"SELECT {select_list(STATION_COLUMNS)} FROM nation",
}

# Codes of descent and bounds of the parts of the day, as the result names them.
_DESCENT = """CASE trim(vict_descent)
    WHEN 'B' THEN 'Black' WHEN 'W' THEN 'White' WHEN 'A' THEN 'Other Asian'
    WHEN 'C' THEN 'Chinese' WHEN 'D' THEN 'Cambodian' WHEN 'F' THEN 'Filipino'
    WHEN 'G' THEN 'Guamanian' WHEN 'H' THEN 'Hispanic/Latin/Mexican' WHEN 'J' THEN 'Japanese'
    WHEN 'K' THEN 'Korean' WHEN 'L' THEN 'Laotian' WHEN 'P' THEN 'Pacific' WHEN 'S' THEN 'Samoan'
    WHEN 'U' THEN 'Hawaiian' WHEN 'V' THEN 'Vietnamese' WHEN 'Z' THEN 'Asian Indian'
    WHEN 'X' THEN 'Unknown' WHEN 'I' THEN 'American Indian/Alaskan Native' WHEN 'O' THEN 'Other'
    ELSE 'None' END"""

_PART_OF_DAY = """CASE
    WHEN time_occ >= 500 AND time_occ < 1159 THEN 'Morning'
    WHEN time_occ >= 1200 AND time_occ < 1659 THEN 'Afternoon'
    WHEN time_occ >= 1700 AND time_occ < 2059 THEN 'Evening'
    ELSE 'Night' END"""

# Codes written as 101 or 101.0; one with a fraction is none.
_CODE = """CASE WHEN try_cast(trim(code_text) AS double) = floor(try_cast(trim(code_text) AS double))
    THEN cast(try_cast(trim(code_text) AS double) AS int) END"""

_ARMED = "starts_with(cast(weapon_cd AS varchar), '1')"


def _haversine(lat2: str, lon2: str) -> str:
    a = (
        f"pow(sin((radians({lat2}) - radians(lat)) / 2), 2)"
        f" + cos(radians(lat)) * cos(radians({lat2}))"
        f" * pow(sin((radians({lon2}) - radians(lon)) / 2), 2)"
    )
    return f"(6371e0 * 2e0 * atan2(sqrt({a}), sqrt(1e0 - ({a}))))"


_DISTANCE = _haversine("y", "x")


def _with(tables: str, body: str, more: str = "") -> str:
    """``body`` over the named tables; ``more`` holds further WITH members."""
    members = [f"{name} AS ({_TABLES[name]})" for name in tables.split()]
    if more:
        members.append(more)
    return f"WITH {', '.join(members)}\n{body}"


def _incidents(columns: str, where: str = "true") -> str:
    return _with("incidents", f"SELECT {columns} FROM incidents WHERE {where}")


_MONTHS = """months AS (
    SELECT
        cast(year(date_rptd) AS int) AS year,
        cast(month(date_rptd) AS int) AS month,
        count(*) AS crime_total
    FROM incidents GROUP BY 1, 2
)"""
_RANKED = f"""{_MONTHS}, ranked AS (
    SELECT *, cast(row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS int)
        AS rank
    FROM months
)"""
_TOP_MONTHS = _with("incidents", "SELECT * FROM ranked WHERE rank <= 3", _RANKED)

_STREET_PARTS = _with(
    "incidents",
    f"""SELECT {_PART_OF_DAY} AS crime_time, count(*) AS "count"
    FROM incidents WHERE premis = 'STREET' GROUP BY 1""",
)

_FACT_TABLES = "incidents geocode income_text income"
_FACTS = f"""facts AS (
    SELECT i.dr_no, g.lat, g.lon, g.zip, m.income, {_DESCENT} AS descent
    FROM incidents i
    JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon
    JOIN income m ON m.zip = g.zip
    WHERE year(i.date_rptd) = {YEAR}
)"""
_TOP_ZIPS = """SELECT zip, avg(income) AS avg_income FROM facts GROUP BY zip
    ORDER BY avg_income DESC NULLS LAST, zip LIMIT 3"""
_BOTTOM_ZIPS = """SELECT zip, avg(income) AS avg_income FROM facts GROUP BY zip
    ORDER BY avg_income ASC NULLS FIRST, zip LIMIT 3"""


def _descents(zips: str) -> str:
    return _with(
        _FACT_TABLES,
        """SELECT f.descent, count(*) AS "count"
        FROM facts f JOIN chosen c ON f.zip = c.zip
        WHERE f.descent <> 'None' GROUP BY f.descent""",
        f"{_FACTS}, chosen AS ({zips})",
    )


_TOP_DESCENTS = _descents(_TOP_ZIPS)
_BOTTOM_DESCENTS = _descents(_BOTTOM_ZIPS)


def _stations(where: str) -> str:
    return _with(
        "incidents stations",
        f"""SELECT division, round(avg({_DISTANCE}), 6) AS average_distance,
            count(*) AS incidents_total
        FROM incidents JOIN stations ON area = prec
        WHERE {_ARMED} AND lat <> 0 AND lon <> 0 AND {where}
        GROUP BY division""",
    )


_LAST_STATIONS = f"""last_stations AS (
    SELECT prec, arg_max(division, k) AS division, arg_max(y, k) AS y, arg_max(x, k) AS x
    FROM (SELECT *, {{'division': division, 'y': y, 'x': x}} AS k FROM stations) GROUP BY prec
)"""
_LAST_STATION_DISTANCES = _with(
    "incidents stations",
    f"""SELECT division, round(avg({_DISTANCE}), 6) AS average_distance, count(*) AS incidents_total
    FROM incidents JOIN last_stations ON area = prec
    WHERE {_ARMED} AND lat <> 0 AND lon <> 0 AND x <> 0 AND y <> 0
    GROUP BY division""",
    _LAST_STATIONS,
)

_MIXED_INCIDENTS = _incidents(
    f"* REPLACE (CASE WHEN date_rptd < TIMESTAMP '{SPLIT_DATE}' THEN dr_no END AS dr_no)"
)
_UNREADABLE = """SELECT o_orderkey AS dr_no, field, 'n/a' AS text
    FROM orders, (VALUES ('lat'), ('lon')) AS f(field)
    WHERE o_orderkey % 50 <> 0 AND o_orderkey % 211 = 0 AND o_orderkey % 2 = 1"""

_ALL_INCIDENTS = _incidents("*")
_KNOWN_STATION = "x <> 0 AND y <> 0"

ORACLES = {
    # sources
    "src_csv_scan": _ALL_INCIDENTS,
    "src_parquet_scan": _ALL_INCIDENTS,
    "src_read_incidents": _ALL_INCIDENTS,
    "src_csv_text_lines": _ALL_INCIDENTS,
    "src_mixed_headers": _MIXED_INCIDENTS,
    "src_text_lines_mixed_headers": _MIXED_INCIDENTS,
    "etl_csv_to_parquet": _ALL_INCIDENTS,
    "etl_keeps_unreadable": _UNREADABLE,
    "etl_rejects": _incidents(
        "*", "dr_no % 50 <> 0 AND dr_no % 211 = 0 AND dr_no % 2 = 1"
    ),
    "etl_resumed": _ALL_INCIDENTS,
    "etl_routed": _incidents(
        """dr_no, lat, lon, CASE WHEN dr_no % 50 <> 0 AND dr_no % 211 = 0 AND dr_no % 2 = 1
            THEN 'rejected' ELSE 'good' END AS outcome"""
    ),
    "union_incident_years": _ALL_INCIDENTS,
    # cleaning
    "clean_report_date": """
        SELECT dr_no, try_strptime(text, '%m/%d/%Y %I:%M:%S %p') AS date_rptd
        FROM (
            SELECT o_orderkey AS dr_no, CASE
                WHEN o_orderkey % 307 = 0 THEN 'bad'
                WHEN o_orderkey % 307 = 1 THEN ''
                WHEN o_orderkey % 307 <> 2
                THEN strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%m/%d/%Y %I:%M:%S %p')
                END AS text
            FROM orders
        )""",
    "clean_money": """
        SELECT c_custkey, try_cast(regexp_replace(text, '[$,]', '', 'g') AS double) AS money
        FROM (
            SELECT c_custkey, CASE
                WHEN c_custkey % 101 = 0 THEN 'n/a'
                WHEN c_custkey % 101 = 1 THEN ''
                WHEN c_custkey % 101 <> 2 THEN '$' || format('{:,.2f}', c_acctbal) END AS text
            FROM customer
        )""",
    "clean_area_key": f"""
        SELECT dr_no, cast(trim(text) AS int) AS area, ltrim(trim(text), '0') AS area_text
        FROM (SELECT o_orderkey AS dr_no, {AREA_TEXT} AS text FROM orders)""",
    "clean_reject_coords": f"""
        SELECT * FROM (SELECT o_orderkey AS dr_no, {COORDINATE_TEXT} AS lat_text FROM orders)
        WHERE try_cast(lat_text AS double) IS NULL""",
    "clean_accepted_coords": f"""
        SELECT dr_no, try_cast(lat_text AS double) AS lat
        FROM (SELECT o_orderkey AS dr_no, {COORDINATE_TEXT} AS lat_text FROM orders)
        WHERE try_cast(lat_text AS double) IS NOT NULL""",
    # filters
    "flt_street": _incidents("dr_no, premis", "premis = 'STREET'"),
    "flt_year": _incidents("dr_no, date_rptd", f"year(date_rptd) = {YEAR}"),
    "src_quoted_line_breaks": f"""
        SELECT o_orderkey AS dr_no, {REMARK_TEXT} AS remark, o_orderstatus AS place FROM orders""",
    "clean_int_code": f"""
        SELECT dr_no, {_CODE} AS code FROM (SELECT o_orderkey AS dr_no, {CODE_TEXT} AS code_text FROM orders)""",
    "flt_firearm_text": f"""
        SELECT dr_no, code_text, {_CODE} AS weapon_cd
        FROM (SELECT o_orderkey AS dr_no, {CODE_TEXT} AS code_text FROM orders)
        WHERE starts_with(cast({_CODE} AS varchar), '1')""",
    "join_bitmap_reduced": _with(
        "incidents geocode",
        """SELECT lat, lon, dr_no, zip FROM incidents JOIN geocode USING (lat, lon) WHERE zip % 10 = 1""",
    ),
    "agg_exact_mean": f"""
        SELECT o_orderpriority, total, total / n AS mean FROM (
            SELECT o_orderpriority, count(price) AS n,
                cast(sum(cast(a AS hugeint)) AS double) * {2.0**10!r}::DOUBLE
                + cast(sum(cast(b AS hugeint)) AS double) * {2.0**-30!r}::DOUBLE
                + cast(sum(cast(floor((rest - b * {2.0**-30!r}::DOUBLE) / {2.0**-70!r}::DOUBLE) AS hugeint)) AS double)
                * {2.0**-70!r}::DOUBLE AS total
            FROM (
                SELECT *, floor(rest / {2.0**-30!r}::DOUBLE) AS b FROM (
                    SELECT *, floor(price / 1024::DOUBLE) AS a, price - floor(price / 1024::DOUBLE) * 1024::DOUBLE AS rest
                    FROM (SELECT o_orderpriority, o_totalprice / 7::DOUBLE AS price FROM orders)))
            GROUP BY o_orderpriority)""",
    "rank_top_n_any": _with(
        "incidents",
        """SELECT * FROM (
            SELECT premis, dr_no, date_rptd,
                row_number() OVER (PARTITION BY premis ORDER BY date_rptd DESC, dr_no) AS rank
            FROM incidents
        ) WHERE rank <= 4000""",
    ),
    "flt_firearm": _incidents("dr_no, weapon_cd", _ARMED),
    "flt_valid_coords": _incidents("dr_no, lat, lon", "lat <> 0 AND lon <> 0"),
    "flt_valid_coords_both": _with(
        "incidents stations",
        f"""SELECT dr_no, lat, lon, y, x FROM incidents JOIN stations ON area = prec
        WHERE lat <> 0 AND lon <> 0 AND {_KNOWN_STATION}""",
    ),
    # labels
    "map_part_of_day": _incidents(f"dr_no, {_PART_OF_DAY} AS crime_time"),
    "map_descent": _incidents(f"dr_no, {_DESCENT} AS descent"),
    # joins
    "join_geocode": _with(
        "incidents geocode",
        """SELECT i.dr_no, g.lat, g.lon, g.zip
        FROM incidents i JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon""",
    ),
    "join_income": _with(
        "incidents geocode income_text income",
        """SELECT i.dr_no, g.zip, m.income
        FROM incidents i
        JOIN geocode g ON i.lat = g.lat AND i.lon = g.lon
        JOIN income m ON m.zip = g.zip""",
    ),
    "join_station": _with(
        "incidents stations",
        "SELECT dr_no, area, division FROM incidents JOIN stations ON area = prec",
    ),
    "join_station_replicated": _with(
        "incidents stations",
        "SELECT dr_no, area, division FROM incidents JOIN stations ON area = prec",
    ),
    "join_bucketed": _with(
        "incidents stations",
        "SELECT dr_no, area, division FROM incidents JOIN stations ON area = prec",
    ),
    "join_keep_last": """
        SELECT s_nationkey, s_suppkey, s_name FROM supplier
        WHERE s_suppkey IN (SELECT max(s_suppkey) FROM supplier GROUP BY s_nationkey)""",
    "join_unmatched": _with(
        "incidents stations",
        """SELECT dr_no, area FROM incidents
        WHERE NOT EXISTS (SELECT 1 FROM stations WHERE prec = area)""",
    ),
    "join_unmatched_areas": _with(
        "incidents stations",
        """SELECT area, count(*) AS "count" FROM incidents
        WHERE NOT EXISTS (SELECT 1 FROM stations WHERE prec = area) GROUP BY area""",
    ),
    "q3_zip_subset_join": _with(
        _FACT_TABLES,
        "SELECT f.* FROM facts f JOIN chosen c ON f.zip = c.zip",
        f"{_FACTS}, chosen AS ({_TOP_ZIPS})",
    ),
    "join_restrict_to": _with(
        _FACT_TABLES,
        "SELECT * FROM facts WHERE zip IN (SELECT zip FROM chosen)",
        f"{_FACTS}, chosen AS ({_TOP_ZIPS})",
    ),
    # aggregates and ranking
    "agg_count_by_month": _with("incidents", "SELECT * FROM months", _MONTHS),
    "agg_merged_partials": _with("incidents", "SELECT * FROM months", _MONTHS),
    "agg_count_by_label": _with(
        "incidents", f'SELECT {_DESCENT} AS descent, count(*) AS "count" FROM incidents GROUP BY 1'
    ),
    "agg_avg_income_by_zip": _with(
        _FACT_TABLES,
        "SELECT zip, round(avg(income), 6) AS avg_income FROM facts GROUP BY zip",
        _FACTS,
    ),
    "agg_row_count": 'SELECT count(*) AS "rows" FROM orders',
    "win_row_number": _with("incidents", "SELECT * FROM ranked", _RANKED),
    "rank_top_n_per_group": _with(
        "incidents",
        """SELECT * FROM (
            SELECT area, dr_no, date_rptd, cast(row_number()
                OVER (PARTITION BY area ORDER BY date_rptd DESC, dr_no) AS int) AS rank
            FROM incidents
        ) WHERE rank <= 5""",
    ),
    "rank_top_n_large": _with(
        "incidents",
        """SELECT * FROM (
            SELECT premis, dr_no, date_rptd, cast(row_number()
                OVER (PARTITION BY premis ORDER BY date_rptd DESC, dr_no) AS int) AS rank
            FROM incidents
        ) WHERE rank <= 1001""",
    ),
    "topk_zip_income": _with(
        _FACT_TABLES,
        "SELECT zip, round(avg_income, 6) AS avg_income FROM chosen",
        f"{_FACTS}, chosen AS ({_TOP_ZIPS})",
    ),
    "bottomk_zip_income": _with(
        _FACT_TABLES,
        "SELECT zip, round(avg_income, 6) AS avg_income FROM chosen",
        f"{_FACTS}, chosen AS ({_BOTTOM_ZIPS})",
    ),
    "bottomk_zip_known_income": _with(
        _FACT_TABLES,
        "SELECT zip, round(avg_income, 6) AS avg_income FROM chosen",
        f"""{_FACTS}, chosen AS (
            SELECT zip, avg(income) AS avg_income FROM facts GROUP BY zip
            HAVING count(income) > 0 ORDER BY avg_income, zip LIMIT 3
        )""",
    ),
    "sort_counts_desc": _with(
        "incidents", 'SELECT area, count(*) AS "count" FROM incidents GROUP BY area'
    ),
    # distances
    "geo_haversine": _with(
        "incidents stations",
        f"""SELECT dr_no, round({_DISTANCE}, 6) AS distance_km
        FROM incidents JOIN stations ON area = prec WHERE lat IS NOT NULL AND lon IS NOT NULL""",
    ),
    "geo_haversine_float": _with(
        "incidents stations",
        f"""SELECT division,
            round(avg(cast({_haversine("cast(cast(y AS float) AS double)",
                                       "cast(cast(x AS float) AS double)")} AS float)), 4)
                AS average_distance
        FROM incidents JOIN stations ON area = prec
        WHERE lat <> 0 AND lon <> 0 GROUP BY division""",
    ),
    # analyses
    "q1_sql": _TOP_MONTHS,
    "q1_sql_text": _TOP_MONTHS,
    "q1_dataframe": _TOP_MONTHS,
    "q1_csv_source": _TOP_MONTHS,
    "q1_parquet_source": _TOP_MONTHS,
    "q2_sql": _STREET_PARTS,
    "q2_sql_text": _STREET_PARTS,
    "q2_dataframe": _STREET_PARTS,
    "q3_top_by_year": _TOP_DESCENTS,
    "q3_sql": _TOP_DESCENTS,
    "q3_bottom_sql": _BOTTOM_DESCENTS,
    **{
        f"q3_{end}_{strategy}": sql
        for end, sql in (("top", _TOP_DESCENTS), ("bottom", _BOTTOM_DESCENTS))
        for strategy in ("default", "broadcast", "shuffle_hash", "merge", "replicate")
    },
    "q4_dataframe": _stations("true"),
    "q4_sql": _stations("true"),
    "q4_broadcast": _LAST_STATION_DISTANCES,
    "q4_repartition": _stations(_KNOWN_STATION),
}
