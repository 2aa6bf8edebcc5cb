"""Months with most incidents, per year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.operators.aggregates import count_by_month
from blotter.operators.ranking import top_n_per_group


def top_months(incidents: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` months with most incidents of each year; the earlier month wins a tie."""
    ranked = top_n_per_group(
        count_by_month(incidents), ["year"], [F.desc("crime_total"), F.col("month")], n
    )
    return ranked.orderBy("year", "rank")


def top_months_sql(spark: SparkSession, incidents: DataFrame, n: int = 3) -> DataFrame:
    """The same as SQL."""
    return spark.sql(
        """
        SELECT year, month, crime_total, rank
        FROM (
            SELECT
                *,
                row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS rank
            FROM (
                SELECT year(first_day) AS year, month(first_day) AS month, crime_total
                FROM (
                    SELECT trunc(date_rptd, 'MM') AS first_day, count(*) AS crime_total
                    FROM {incidents}
                    GROUP BY ALL
                )
            )
        )
        WHERE rank <= {n}
        ORDER BY year, rank
        """,
        incidents=incidents,
        n=n,
    )
