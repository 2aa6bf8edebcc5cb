"""Armed incidents per police division, with their mean distance to its station."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.geo import haversine_km
from blotter.operators.filters import has_known_position, is_firearm
from blotter.operators.joins import equi_join, keep_last
from blotter.operators.ranking import sort_by_count
from blotter.sources.scratch import staged

_POSITIONS = ("lat", "lon", "y", "x")


def armed_incidents(incidents: DataFrame) -> DataFrame:
    """Incidents with a firearm and a known position, with the columns the analysis needs."""
    return incidents.filter(
        is_firearm(F.col("weapon_cd")) & has_known_position(F.col("lat"), F.col("lon"))
    ).select("area", "lat", "lon")


def by_area(stations: DataFrame) -> DataFrame:
    return stations.select(F.col("prec").alias("area"), "division", "x", "y")


def distance_to_station() -> Column:
    return haversine_km(*(F.col(name) for name in _POSITIONS))


def station_distances(
    incidents: DataFrame, stations: DataFrame, strategy: str = "broadcast"
) -> DataFrame:
    """One pass over the incidents: each is joined where it is read, and every task sends one sum and
    count per division. A repeated station key counts an incident once for each station."""
    joined = equi_join(armed_incidents(incidents), by_area(stations), "area", strategy)
    return _summary(joined)


def station_distances_keep_last(
    incidents: DataFrame,
    stations: DataFrame,
    order: Sequence[Column],
    strategy: str = "broadcast",
) -> DataFrame:
    """As above, but of stations with one key only the last in ``order`` counts, and stations
    without a known position are left out."""
    single = keep_last(by_area(stations), "area", order)
    joined = equi_join(armed_incidents(incidents), single, "area", strategy, part_of=stations)
    return _summary(joined.filter(_all_known()))


def station_distances_repartition(
    incidents: DataFrame, stations: DataFrame, strategy: str = "replicate"
) -> DataFrame:
    """Shuffled form, for a station table of any size. Incidents of one area and position are counted
    before they are shuffled; an area is then split by position over many tasks. Repeated station keys
    count as in ``station_distances``; stations without a known position are left out."""
    places = (
        armed_incidents(incidents)
        .groupBy("area", "lat", "lon")
        .agg(F.count("*").alias("incidents"))
    )
    # Read once: the search for hot areas and the join both take the counts that are written here.
    joined = equi_join(
        staged(places), by_area(stations), "area", strategy, salt_by=["lat", "lon"]
    ).filter(_all_known())
    weighted = joined.select(
        "division", "incidents", (distance_to_station() * F.col("incidents")).alias("distance")
    )
    summary = weighted.groupBy("division").agg(
        (F.sum("distance") / F.sum("incidents")).alias("average_distance"),
        F.sum("incidents").alias("incidents_total"),
    )
    return sort_by_count(summary, ["division"], "incidents_total")


def _summary(joined: DataFrame) -> DataFrame:
    summary = (
        joined.select("division", distance_to_station().alias("distance"))
        .groupBy("division")
        .agg(
            F.avg("distance").alias("average_distance"),
            F.count("*").alias("incidents_total"),
        )
    )
    return sort_by_count(summary, ["division"], "incidents_total")


def _all_known() -> Column:
    return has_known_position(*(F.col(name) for name in _POSITIONS))
