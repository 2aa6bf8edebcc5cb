"""Codes to labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Label, first minute (HHMM) included, last minute excluded.
PARTS_OF_DAY = (
    ("Morning", 500, 1159),
    ("Afternoon", 1200, 1659),
    ("Evening", 1700, 2059),
)

# Fixed value: label of every other time, an unknown one included.
REST_OF_DAY = "Night"

# Victim descent codes.
DESCENT_LABELS = {
    "A": "Other Asian",
    "B": "Black",
    "C": "Chinese",
    "D": "Cambodian",
    "F": "Filipino",
    "G": "Guamanian",
    "H": "Hispanic/Latin/Mexican",
    "I": "American Indian/Alaskan Native",
    "J": "Japanese",
    "K": "Korean",
    "L": "Laotian",
    "O": "Other",
    "P": "Pacific",
    "S": "Samoan",
    "U": "Hawaiian",
    "V": "Vietnamese",
    "W": "White",
    "X": "Unknown",
    "Z": "Asian Indian",
}

# Fixed value: label of a blank, missing or unlisted code.
NO_DESCENT = "None"


def part_of_day(
    hhmm: Column,
    parts: Sequence[tuple[str, int, int]] = PARTS_OF_DAY,
    rest: str = REST_OF_DAY,
) -> Column:
    """Part of day of an HHMM integer.

    The default bounds leave 1159-1199, 1659-1699 and 2059-2099 to ``rest``; pass ``parts`` to close
    those gaps.
    """
    if not parts:
        return F.lit(rest)
    label = F
    for name, start, end in parts:
        label = label.when((hhmm >= start) & (hhmm < end), name)
    return label.otherwise(rest)


def descent_label(code: Column) -> Column:
    """Label of a descent code, ignoring blanks around it."""
    pairs = ", ".join(f"'{key}', '{label}'" for key, label in DESCENT_LABELS.items())
    return F.coalesce(F.expr(f"map({pairs})")[F.trim(code)], F.lit(NO_DESCENT))
