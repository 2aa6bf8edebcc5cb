"""The analyses as SQL text alone, for callers without Python: functions and views of the session."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.functions.geo import EARTH_RADIUS_KM
from blotter.functions.labels import DESCENT_LABELS, NO_DESCENT, PARTS_OF_DAY, REST_OF_DAY
from blotter.operators.filters import FIREARM_PREFIX, STREET


def register(spark: SparkSession, **views: DataFrame) -> None:
    """Make the tables of ``views`` and these functions known to the session's SQL:

    ``part_of_day(hhmm)``, ``descent_label(code)``, ``is_firearm(code)``, ``known_position(lat, lon)``,
    ``haversine_km(lat1, lon1, lat2, lon2)`` and its ``haversine_chord``, and, if there is a view ``incidents``, the table function
    ``busiest_months(n)``. They are SQL functions: Catalyst puts their bodies into the plan, so filters reach
    the scan and nothing runs in Python. ``busiest_months`` reads the view as it is when it is registered.
    """
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    parts = " ".join(
        f"WHEN hhmm >= {start} AND hhmm < {end} THEN '{name}'" for name, start, end in PARTS_OF_DAY
    )
    labels = ", ".join(f"'{code}', '{label}'" for code, label in DESCENT_LABELS.items())
    bodies = {
        "part_of_day(hhmm INT) RETURNS STRING": f"CASE {parts} ELSE '{REST_OF_DAY}' END",
        "descent_label(code STRING) RETURNS STRING": f"coalesce(map({labels})[trim(code)], '{NO_DESCENT}')",
        "is_firearm(code INT) RETURNS BOOLEAN": f"startswith(cast(code AS STRING), '{FIREARM_PREFIX}')",
        "known_position(lat DOUBLE, lon DOUBLE) RETURNS BOOLEAN": "lat <> 0 AND lon <> 0",
        "haversine_chord(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": """
            pow(sin(radians(lat2 - lat1) / 2), 2)
            + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2)""",
        # Rounding can lift the chord over 1; least() would take 1 for an unknown one.
        "haversine_km(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": f"""
            2 * {EARTH_RADIUS_KM}D * asin(CASE WHEN haversine_chord(lat1, lon1, lat2, lon2) > 1 THEN 1D
            ELSE sqrt(haversine_chord(lat1, lon1, lat2, lon2)) END)""",
    }
    if "incidents" in views:
        # LIMIT takes no parameter; the rank does, and becomes a limit per group in every task.
        bodies["busiest_months(n INT) RETURNS TABLE (year INT, month INT, crime_total BIGINT, rank INT)"] = """
            SELECT year, month, crime_total, rank FROM (
                SELECT *, row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS rank
                FROM (
                    SELECT year(first_day) AS year, month(first_day) AS month, crime_total FROM (
                        SELECT trunc(date_rptd, 'MM') AS first_day, count(*) AS crime_total
                        FROM incidents GROUP BY ALL)))
            WHERE rank <= busiest_months.n"""
    for head, body in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


TOP_MONTHS = "SELECT * FROM busiest_months(3) ORDER BY year, rank"

STREET_BY_PART_OF_DAY = f"""
SELECT part_of_day(time_occ) AS crime_time, count(*) AS count
FROM incidents
WHERE premis = '{STREET}'
GROUP BY ALL
ORDER BY count DESC, crime_time
"""

STATION_DISTANCES = """
SELECT division, avg(haversine_km(lat, lon, y, x)) AS average_distance, count(*) AS incidents_total
FROM incidents JOIN stations ON area = prec
WHERE is_firearm(weapon_cd) AND known_position(lat, lon)
GROUP BY division
ORDER BY incidents_total DESC, division
"""
