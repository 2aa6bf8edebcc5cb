"""Street incidents per part of day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.labels import part_of_day
from blotter.operators.aggregates import count_by_label
from blotter.operators.filters import STREET, on_street
from blotter.operators.ranking import sort_by_count


def street_by_part_of_day(incidents: DataFrame) -> DataFrame:
    """Incidents on the street by part of day, most frequent first."""
    on_streets = incidents.filter(on_street(F.col("premis")))
    labelled = on_streets.select(part_of_day(F.col("time_occ")).alias("crime_time"))
    return sort_by_count(count_by_label(labelled, "crime_time"), ["crime_time"])


def street_by_part_of_day_sql(spark: SparkSession, incidents: DataFrame) -> DataFrame:
    """The same as SQL."""
    return spark.sql(
        """
        SELECT crime_time, count(*) AS count
        FROM {labelled}
        WHERE premis = {street}
        GROUP BY crime_time
        ORDER BY count DESC, crime_time
        """,
        labelled=incidents.withColumn("crime_time", part_of_day(F.col("time_occ"))),
        street=STREET,
    )
