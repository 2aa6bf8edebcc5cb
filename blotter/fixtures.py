"""The package's tables, derived from the driver's tables (see FIXTURES.md).

Every derivation reads the whole driver table. The expressions are written once, in SQL both Spark
and DuckDB read; ``//`` is integer division and becomes ``div`` for Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.clean import REPORT_TS_PATTERN, parse_money
from blotter.schemas import INCIDENTS
from blotter.sources.etl import csv_to_parquet
from blotter.sources.scan import CSV_DIALECT
from blotter.sources.scratch import new_folder

# Stated, so that reading a table starts no job to look them up.
DRIVER_SCHEMAS = {
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,"
    " c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}

YEAR = 1997

# Reports before this date make the first of the two incident files.
SPLIT_DATE = "1998-01-01"


def cell_lat(key: str) -> str:
    return f"33.7e0 + cast({key} % 1000 AS double) * 0.0004e0"


def cell_lon(key: str) -> str:
    return f"-118.6e0 + cast({key} // 1000 AS double) * 0.00001e0"


def cell_zip(key: str) -> str:
    """A ZIP has twelve cells; a table of more customers has more of both."""
    return f"cast(90001 + {key} // 12 AS int)"


def known(coordinate: str) -> str:
    return (
        "CASE WHEN o_orderkey % 50 = 0 THEN 0e0"
        f" WHEN o_orderkey % 211 <> 0 THEN {coordinate} END"
    )


INCIDENT_COLUMNS = {
    "dr_no": "o_orderkey",
    "date_rptd": "o_orderdate",
    "time_occ": "CASE WHEN o_orderkey % 97 <> 0 THEN"
    " cast(((o_orderkey % 1440) // 60) * 100 + o_orderkey % 60 AS int) END",
    "area": "cast(o_custkey % 27 AS int)",
    "premis": "CASE o_orderpriority WHEN '1-URGENT' THEN 'STREET' WHEN '5-LOW' THEN NULL"
    " ELSE 'OTHER PREMISE' END",
    "vict_descent": "CASE WHEN o_orderkey % 23 < 19 THEN"
    " substr('BWACDFGHJKLPSUVZXIO', cast(o_orderkey % 23 + 1 AS int), 1)"
    " || CASE WHEN o_orderkey % 2 = 1 THEN ' ' ELSE '' END"
    " WHEN o_orderkey % 23 = 21 THEN 'Q' WHEN o_orderkey % 23 = 22 THEN ' ' END",
    "weapon_cd": "CASE WHEN o_orderkey % 3 <> 0 THEN cast(100 + o_orderkey % 420 AS int) END",
    "lat": known(cell_lat("o_custkey")),
    "lon": known(cell_lon("o_custkey")),
}

# Some geocode cells lie a little beside those of the incidents, so these find no ZIP.
GEOCODE_COLUMNS = {
    "lat": cell_lat("c_custkey") + " + CASE WHEN c_custkey % 20 = 9 THEN 0.0001e0 ELSE 0e0 END",
    "lon": cell_lon("c_custkey"),
    "zip": cell_zip("c_custkey"),
}
# These cells are in the geocode table twice.
GEOCODE_REPEATED = "c_custkey % 16 = 3"

# Entries of some ZIPs are missing, of some empty, of some under a ZIP that no cell has, of some there
# twice with different incomes.
INCOME_TEXT_MISSING = "zip % 40 = 6"
INCOME_TEXT_EMPTY = "zip % 40 = 7"
INCOME_ZIP = "cast(CASE WHEN zip % 20 = 9 THEN -zip ELSE zip END AS int)"
INCOME_REPEATED = "zip % 8 = 5"
INCOME_SECOND_TENS = "tens + 500"
INCOME_TENS = (
    "cast(sum(cast(round(c_acctbal * 100) AS bigint) + 100000) // (10 * count(*)) AS bigint)"
)

STATION_COLUMNS = {
    "x": "CASE WHEN n_nationkey = 24 THEN 0e0"
    " ELSE -118.6e0 + cast(n_nationkey AS double) * 0.01e0 END",
    "y": "33.7e0 + cast(n_nationkey AS double) * 0.012e0",
    "division": "n_name",
    # Three precincts have two stations.
    "prec": "cast(CASE WHEN n_nationkey > 21 THEN n_nationkey - 20 ELSE n_nationkey END AS int)",
}

# Text an area, date or coordinate may have in a source file.
AREA_TEXT = "' ' || lpad(cast(o_custkey % 27 AS varchar(9)), 2, '0') || ' '"
CODE_TEXT = (
    "CASE WHEN o_orderkey % 3 <> 0 THEN ' ' || cast(100 + o_orderkey % 420 AS varchar(9))"
    " || CASE WHEN o_orderkey % 2 = 1 THEN '.0' WHEN o_orderkey % 4 = 2 THEN '.5' ELSE '' END END"
)
# A value of several lines.
REMARK_TEXT = (
    "'at ' || chr(10) || '\"' || o_orderpriority || '\", order' || chr(13) || chr(10)"
    " || cast(o_orderkey AS varchar(20))"
)
COORDINATE_TEXT = (
    "CASE WHEN o_orderkey % 211 <> 0 THEN '34.05' WHEN o_orderkey % 2 = 1 THEN 'n/a'"
    " WHEN o_orderkey % 4 = 0 THEN '' END"
)


def select_list(columns: dict[str, str]) -> str:
    return ", ".join(f"{expression} AS {name}" for name, expression in columns.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def derive(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*(spark_sql(f"{text} AS {name}") for name, text in columns.items()))


def spark_expr(text: str) -> Column:
    return F.expr(spark_sql(text))


def spark_sql(text: str) -> str:
    return text.replace("//", "div")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "orders"), INCIDENT_COLUMNS)


def geocode(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    return derive(_twice(customer, GEOCODE_REPEATED), GEOCODE_COLUMNS)


def _twice(df: DataFrame, condition: str) -> DataFrame:
    """``df`` with the rows that meet the condition repeated, and which of the two a row is."""
    entries = F.when(F.expr(condition), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return df.withColumn("entry", F.explode(entries))


def income_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    tens = (
        table(spark, sf_dir, "customer")
        .groupBy(spark_expr(cell_zip("c_custkey")).alias("zip"))
        .agg(spark_expr(INCOME_TENS).alias("tens"))
    )
    entries = _twice(tens, INCOME_REPEATED)
    second = F.col("entry") == 2
    amount = F.when(second, spark_expr(INCOME_SECOND_TENS)).otherwise(F.col("tens"))
    text = F.concat(F.lit("$"), F.format_number(amount, 0))
    return entries.select(
        spark_expr(INCOME_ZIP).alias("zip"),
        F.when(F.expr(INCOME_TEXT_EMPTY), "")
        .when(~F.expr(INCOME_TEXT_MISSING), text)
        .alias("income_text"),
    )


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    return income_text(spark, sf_dir).select(
        "zip", parse_money(F.col("income_text")).alias("income")
    )


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derive(table(spark, sf_dir, "nation"), STATION_COLUMNS)


def incident_text(typed: DataFrame) -> DataFrame:
    """Incidents as the source files hold them: source headers, every value text."""
    unreadable = F.when(F.col("dr_no") % 2 == 1, "n/a")
    text = {field.name: F.col(field.name).cast("string") for field in INCIDENTS}
    text["date_rptd"] = F.date_format("date_rptd", REPORT_TS_PATTERN)
    text["area"] = F.lpad(text["area"], 2, "0")
    text["lat"] = F.coalesce(text["lat"], unreadable)
    text["lon"] = F.coalesce(text["lon"], unreadable)
    return typed.select(*(text[field.name].alias(field.header) for field in INCIDENTS))


def respelled(text: DataFrame) -> DataFrame:
    """The same in another column order and spelling, without the optional column."""
    fields = [field for field in reversed(INCIDENTS) if field.required]
    return text.select(
        *(F.col(f"`{f.header}`").alias(f" {f.header.strip().upper().replace(' ', '_')}") for f in fields)
    )


class StagedFiles:
    """The two incident files as CSV and Parquet, written once per session and scale."""

    _written: dict[tuple[str, str], StagedFiles] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        folder = new_folder(spark)
        self.csv = [f"{folder}/csv/first", f"{folder}/csv/second"]
        self.parquet = [f"{folder}/parquet/first", f"{folder}/parquet/second"]
        self.mixed_csv = [self.csv[0], f"{folder}/mixed/second"]
        self.by_year = f"{folder}/by_year"
        self.all_csv = f"{folder}/csv/*"
        self.all_parquet = f"{folder}/parquet/*"
        typed = incidents(spark, sf_dir)
        early = F.col("date_rptd") < F.lit(SPLIT_DATE).cast("timestamp_ntz")
        first = F.coalesce(early, F.lit(False))
        parts = [incident_text(typed.filter(part)) for part in (first, ~first)]
        other = respelled(parts[1])
        for path, part in zip([*self.csv, self.mixed_csv[1]], [*parts, other]):
            part.write.options(
                header=True,
                ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False,
                **CSV_DIALECT,
            ).csv(path)
        for source, target in zip(self.csv, self.parquet):
            csv_to_parquet(spark, source, target, unreadable=None)
        csv_to_parquet(spark, self.all_csv, self.by_year, by_year="date_rptd")

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> StagedFiles:
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._written:
            cls._written[key] = cls(spark, sf_dir)
        return cls._written[key]
