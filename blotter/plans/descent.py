"""Victim descents in the ZIP areas of highest and lowest income.

The result only holds counts, so nothing is joined row by row. Incidents are first counted per place
and descent, lookups per key; the joins then multiply counts. What reaches them grows with the map of
the city and not with the number of incidents, a place with a third of all incidents is one row per
task, and repeated lookup rows are multiplied without being paired. Incidents are scanned once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.labels import NO_DESCENT, descent_label
from blotter.operators.aggregates import average_income_by_zip, exact_mean
from blotter.operators.filters import in_year, without_labels
from blotter.operators.joins import equi_join
from blotter.operators.ranking import bottom_k, sort_by_count, top_k
from blotter.operators.sizing import BROADCAST_LIMIT_BYTES

# A counted place or ZIP has at most one row per descent label, so no key has many.
_COUNTED = {"find_hot": False}


def labelled_facts(incidents: DataFrame, year: int) -> DataFrame:
    """Incidents of one year with the columns the analysis needs."""
    return incidents.filter(in_year(F.col("date_rptd"), year)).select(
        "date_rptd", "lat", "lon", descent_label(F.col("vict_descent")).alias("descent")
    )


def geocoded_facts(
    facts: DataFrame, geocode: DataFrame, income: DataFrame, strategy: str = "broadcast"
) -> DataFrame:
    """One row per incident, place and income entry, for uses that need the rows themselves."""
    placed = equi_join(facts, geocode, ["lat", "lon"], strategy)
    return equi_join(placed, income, "zip", strategy)


def geocoded_facts_at_end(
    facts: DataFrame,
    geocode: DataFrame,
    income: DataFrame,
    end: str,
    k: int = 3,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """The geocoded facts of the ``k`` ZIPs at one end of the income scale.

    The ``k`` ZIPs come to the driver, so that the scans of the lookups are filtered by them; only what
    is left is measured and sent, and a fact elsewhere is dropped where it is read. The facts are
    scanned twice, the first time only to be counted.
    """
    profile = zip_profile(facts, geocode, income)
    chosen = [row["zip"] for row in zips_at_end(profile, end, k).select("zip").collect()]
    cells = geocode.filter(F.col("zip").isin(chosen))
    placed = equi_join(
        facts, cells, ["lat", "lon"], "broadcast", broadcast_limit=broadcast_limit
    )
    entries = income.filter(F.col("zip").isin(chosen))
    return equi_join(placed, entries, "zip", "broadcast", broadcast_limit=broadcast_limit)


def zip_profile(
    facts: DataFrame, geocode: DataFrame, income: DataFrame, strategy: str = "default"
) -> DataFrame:
    """One row per ZIP with incidents and an income entry: its mean income, and how many incidents
    each descent has there (``descents``, one entry per label).

    Persist it to ask for both ends of the income scale without a second scan.
    """
    places = facts.groupBy("lat", "lon", "descent").agg(F.count("*").alias("incidents"))
    cells = geocode.groupBy("lat", "lon", "zip").agg(F.count("*").alias("copies"))
    # All income entries of a ZIP meet the same incidents, so weighting by incidents changes nothing.
    incomes = income.groupBy("zip").agg(
        exact_mean(F.col("income")).alias("avg_income"), F.count("*").alias("entries")
    )
    by_zip = (
        equi_join(places, cells, ["lat", "lon"], strategy, part_of=_with_count(geocode), **_COUNTED)
        .groupBy("zip", "descent")
        .agg(F.sum(F.col("incidents") * F.col("copies")).alias("incidents"))
    )
    # A list holds one entry per label, so its length is bounded however many incidents a ZIP has.
    entry = F.struct("descent", (F.col("incidents") * F.col("entries")).alias("count"))
    return (
        equi_join(by_zip, incomes, "zip", strategy, part_of=_with_count(income), **_COUNTED)
        .groupBy("zip", "avg_income")
        .agg(F.collect_list(entry).alias("descents"))
    )


def _with_count(lookup: DataFrame) -> DataFrame:
    """No smaller than the lookup counted by key, and measured without counting it."""
    return lookup.withColumn("__count", F.lit(0).cast("bigint"))


def zips_at_end(
    profile: DataFrame, end: str, k: int = 3, skip_nulls: bool = False
) -> DataFrame:
    """The ``k`` rows of the profile of highest (``top``) or lowest (``bottom``) income."""
    if end == "top":
        return top_k(profile, "avg_income", k, ["zip"])
    if end == "bottom":
        return bottom_k(profile, "avg_income", k, ["zip"], skip_nulls)
    raise ValueError(f"unknown end {end!r}: expected top or bottom")


def descents_at_end(
    profile: DataFrame, end: str, k: int = 3, skip_nulls: bool = False
) -> DataFrame:
    """Incidents per descent in the ``k`` ZIPs of highest (``top``) or lowest (``bottom``) income.

    ZIPs of unknown income come first at the bottom unless ``skip_nulls``.
    """
    counts = (
        zips_at_end(profile, end, k, skip_nulls)
        .select(F.inline("descents"))
        .filter(without_labels(F.col("descent"), NO_DESCENT))
        .groupBy("descent")
        .agg(F.sum("count").alias("count"))
    )
    return sort_by_count(counts, ["descent"])


def descent_counts(
    incidents: DataFrame,
    geocode: DataFrame,
    income: DataFrame,
    year: int,
    end: str = "top",
    strategy: str = "default",
    k: int = 3,
) -> DataFrame:
    """The whole analysis for one end of the income scale."""
    facts = labelled_facts(incidents, year)
    return descents_at_end(zip_profile(facts, geocode, income, strategy), end, k)


def descent_counts_sql(
    spark: SparkSession,
    incidents: DataFrame,
    geocode: DataFrame,
    income: DataFrame,
    year: int,
    end: str = "top",
    k: int = 3,
) -> DataFrame:
    """The whole analysis as SQL."""
    order = {"top": "avg_income DESC NULLS LAST", "bottom": "avg_income ASC NULLS FIRST"}[end]
    return spark.sql(
        f"""
        WITH places AS (
            SELECT lat, lon, descent, count(*) AS incidents FROM {{facts}} GROUP BY ALL
        ), cells AS (
            SELECT lat, lon, zip, count(*) AS copies FROM {{geocode}} GROUP BY ALL
        ), incomes AS (
            SELECT zip, avg(income) AS avg_income, count(*) AS entries FROM {{income}} GROUP BY zip
        ), by_zip AS (
            SELECT zip, descent, sum(incidents * copies) AS incidents
            FROM places JOIN cells USING (lat, lon)
            GROUP BY ALL
        ), chosen AS (
            SELECT
                zip,
                avg_income,
                collect_list(struct(descent, incidents * entries AS count)) AS descents
            FROM by_zip JOIN incomes USING (zip)
            GROUP BY zip, avg_income
            ORDER BY {order}, zip
            LIMIT {{k}}
        )
        SELECT descent, sum(count) AS count
        FROM (SELECT inline(descents) FROM chosen)
        WHERE descent NOT IN ({{no_descent}})
        GROUP BY descent
        ORDER BY count DESC, descent
        """,
        facts=labelled_facts(incidents, year),
        geocode=geocode,
        income=income,
        k=k,
        no_descent=NO_DESCENT,
    )


def top_zips(joined: DataFrame, k: int = 3) -> DataFrame:
    """The ZIPs of highest mean income among joined rows."""
    return top_k(average_income_by_zip(joined), "avg_income", k, ["zip"])


def bottom_zips(joined: DataFrame, k: int = 3, skip_nulls: bool = False) -> DataFrame:
    """The ZIPs of lowest mean income among joined rows, unknown incomes first."""
    return bottom_k(average_income_by_zip(joined), "avg_income", k, ["zip"], skip_nulls)
