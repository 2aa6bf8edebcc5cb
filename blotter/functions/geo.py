"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in kilometres.
EARTH_RADIUS_KM = 6371.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance in kilometres between two points in degrees; null if any coordinate is null."""
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    across = F.cos(F.radians(lat1)) * F.cos(F.radians(lat2))
    chord = F.pow(F.sin(half_dlat), 2) + across * F.pow(F.sin(half_dlon), 2)
    # Rounding can lift the chord of antipodal points just over 1. A branch here would keep Spark from
    # computing the chord once for both roots.
    rest = F.greatest(1 - chord, F.lit(0.0))
    return F.atan2(F.sqrt(chord), F.sqrt(rest)) * (2 * EARTH_RADIUS_KM)


def haversine_km_float(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """The single-precision form: the second point and the result are cut to ``float``."""
    cut_lat2 = lat2.cast("float").cast("double")
    cut_lon2 = lon2.cast("float").cast("double")
    return haversine_km(lat1, lon1, cut_lat2, cut_lon2).cast("float")
