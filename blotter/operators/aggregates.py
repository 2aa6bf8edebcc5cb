"""Counts and means. All combine on the map side, so a key's share of the rows does not matter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by_month(df: DataFrame, ts: str = "date_rptd", total: str = "crime_total") -> DataFrame:
    """Rows per year and month. Rows without a date are counted under a null year and month.

    Rows are grouped by the first day of their month, so that a row's date is taken apart once.
    """
    counts = df.groupBy(F.trunc(ts, "MM").alias("first_day")).agg(F.count("*").alias(total))
    return counts.select(
        F.year("first_day").alias("year"), F.month("first_day").alias("month"), total
    )


def count_by_label(df: DataFrame, label: str, total: str = "count") -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias(total))


#: A number is taken apart into whole multiples of these, each a count that a sum of integers keeps exactly.
SUM_UNITS = (2.0**10, 2.0**-30, 2.0**-70)


def exact_sum(number: Column) -> Column:
    """The sum of doubles, the same to the last bit however the rows are dealt to tasks and in any order.

    Each number is split without rounding into multiples of ``SUM_UNITS``, the multiples are added up as integers, and
    only the three totals are put together as doubles. It holds for numbers below 2^73; what a number has below
    2^-70 is left out. With a NaN or an infinity among them it is what plain addition gives.
    """
    rest, totals = number.cast("double"), []
    finite = F.abs(rest) < F.lit(2.0**73)
    rest = F.when(finite, rest)
    for unit in SUM_UNITS:
        whole = F.floor(rest / F.lit(unit))
        totals.append(F.sum(whole.cast("decimal(20,0)")).cast("double") * F.lit(unit))
        rest = rest - whole.cast("double") * F.lit(unit)
    exact = totals[0] + totals[1] + totals[2]
    return F.when(F.bool_and(finite), exact).otherwise(F.sum(number.cast("double")))


def exact_mean(number: Column) -> Column:
    """The mean of doubles by ``exact_sum``, nulls left out."""
    return exact_sum(number) / F.count(number)


def average_income_by_zip(df: DataFrame, zip_col: str = "zip", income: str = "income") -> DataFrame:
    """Mean income per ZIP over the rows given, unknown incomes left out of the mean."""
    return df.groupBy(zip_col).agg(exact_mean(F.col(income)).alias("avg_income"))


def row_count(df: DataFrame, total: str = "rows") -> DataFrame:
    return df.agg(F.count("*").alias(total))
