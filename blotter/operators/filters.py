"""Predicates, for ``DataFrame.filter``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions.labels import NO_DESCENT

# Fixed values.
STREET = "STREET"
FIREARM_PREFIX = "1"


def on_street(premis: Column) -> Column:
    return premis == STREET


def in_year(ts: Column, year: int) -> Column:
    """Timestamp lies in ``year``. Written as a range, which the Parquet scan can use, where
    ``year(ts) = y`` could not."""
    start = F.lit(f"{year:04d}-01-01 00:00:00").cast("timestamp_ntz")
    end = F.lit(f"{year + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (ts >= start) & (ts < end)


def is_firearm(weapon_cd: Column) -> Column:
    """Weapon codes that begin with 1; an unknown code is not one of them."""
    return weapon_cd.cast("string").startswith(FIREARM_PREFIX)


def has_known_position(*coordinates: Column) -> Column:
    """No coordinate is 0, which stands for an unknown position, and none is null."""
    return reduce(Column.__and__, [coordinate != 0 for coordinate in coordinates])


def without_labels(label: Column, *labels: str) -> Column:
    """Label is none of ``labels``, by default the one of unknown descents."""
    return ~label.isin(*(labels or (NO_DESCENT,)))
