"""Tables of the package: build names, source headers and types."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from blotter.functions.clean import (
    area_key,
    parse_double,
    parse_int,
    parse_money,
    parse_report_ts,
)

_PARSERS = {
    "string": lambda text: text,
    "bigint": lambda text: F.trim(text).try_cast("bigint"),
    "int": parse_int,
    "double": parse_double,
    "timestamp_ntz": parse_report_ts,
    "area": area_key,
    "money": parse_money,
}

_STORED_TYPE = {"area": "int", "money": "double"}


@dataclass(frozen=True)
class Field:
    """One column: its name here, its header in the source file, and how its text is read."""

    name: str
    header: str
    kind: str
    required: bool = True

    @property
    def type(self) -> str:
        return _STORED_TYPE.get(self.kind, self.kind)

    def parse(self, column: Column, found_type: str) -> Column:
        """``column`` in the stored type. A column already in it is passed through, so that filters
        on it still reach the scan."""
        if found_type == self.type:
            return column
        if found_type == "string":
            return _PARSERS[self.kind](column)
        return column.try_cast(self.type)


INCIDENTS = (
    Field("dr_no", "DR_NO", "bigint", required=False),
    Field("date_rptd", "Date Rptd", "timestamp_ntz"),
    Field("time_occ", "TIME OCC", "int"),
    Field("area", "AREA ", "area"),
    Field("premis", "Premis Desc", "string"),
    Field("vict_descent", "Vict Descent", "string"),
    Field("weapon_cd", "Weapon Used Cd", "int"),
    Field("lat", "LAT", "double"),
    Field("lon", "LON", "double"),
)

GEOCODE = (
    Field("lat", "LAT", "double"),
    Field("lon", "LON", "double"),
    Field("zip", "ZIPcode", "int"),
)

INCOME = (
    Field("zip", "Zip Code", "int"),
    Field("income", "Estimated Median Income", "money"),
)

STATIONS = (
    Field("x", "X", "double"),
    Field("y", "Y", "double"),
    Field("division", "DIVISION", "string"),
    Field("prec", "PREC", "int"),
)


def plain_name(header: str) -> str:
    """``'AREA '`` to ``area``, ``'Date Rptd'`` to ``date_rptd``."""
    return re.sub(r"[^0-9a-z]+", "_", header.strip().lower()).strip("_")
