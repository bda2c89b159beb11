"""Scans of the input tables (parquet, or JDBC) and slices of them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from returns_analytics.errors import MissingTable
from returns_analytics.functions.periods import parse_period, quarter_of


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Scan with a declared schema.

    The schema also fixes the type of partition columns: ``ret_period=062000`` stays text.
    """
    return spark.read.schema(schema).parquet(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    periods: Iterable[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a database table with one query (and so one task) per return period."""
    predicates = []
    for period in periods:
        parse_period(period)
        predicates.append(f"ret_period = '{period}'")
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def read_jdbc_by_key(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    bounds: Sequence[str],
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a database table without periods, such as a master, by ranges of a text key.

    ``bounds`` are ascending keys (operators.ranges gives them); n of them make n + 1 queries and tasks that
    share no row and leave none out, rows without a key included.
    """
    texts = ["'" + bound.replace("'", "''") + "'" for bound in bounds]
    if not texts:
        return spark.read.jdbc(url, table, properties=properties or {})
    ranges = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(texts, texts[1:], strict=False)]
    predicates = [f"{column} < {texts[0]} OR {column} IS NULL", *ranges, f"{column} >= {texts[-1]}"]
    return spark.read.jdbc(url, table, predicates=predicates, properties=properties or {})


def period_slice(summary: DataFrame, period: str) -> DataFrame:
    """Rows of one period; a partition filter where the table is partitioned by ret_period."""
    parse_period(period)
    return summary.filter(F.col("ret_period") == period)


def period_slices(table: DataFrame, periods: Iterable[str] | None) -> DataFrame:
    """Rows of the given periods, or all rows for None."""
    if periods is None:
        return table
    wanted = list(periods)
    for period in wanted:
        parse_period(period)
    return table.filter(F.col("ret_period").isin(wanted))


def registration_slice(registration: DataFrame, period: str) -> DataFrame:
    """Registrations in force for the quarter of a period.

    A dataset without quarter columns is one fixed table that serves every period.
    """
    if not {"yy", "quarter"} <= set(registration.columns):
        return registration
    yy, quarter = quarter_of(period)
    return registration.filter((F.col("yy") == yy) & (F.col("quarter") == quarter)).drop("yy", "quarter")


def require_rows(table: DataFrame, name: str) -> None:
    """Stop with a clear message if a required input is empty. Runs a one-row action."""
    if table.isEmpty():
        raise MissingTable(f"{name} holds no rows; load it before running")


def require_registration(registration: DataFrame, period: str) -> None:
    """Stop if the registrations of the period's quarter are not loaded. Runs a one-row action."""
    yy, quarter = quarter_of(period)
    require_rows(registration_slice(registration, period), f"registration of {quarter} {yy} (period {period})")


def require_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table, or a clear error if it is not there."""
    if not spark.catalog.tableExists(name):
        raise MissingTable(f"table {name} does not exist or is not accessible")
    return spark.table(name)


# --- stored office table -------------------------------------------------------------------

def office_exact(offices: DataFrame, office: str, period: str) -> DataFrame:
    return period_slice(offices, period).filter(F.col("st_juri") == office)


def office_history(offices: DataFrame, period: str, office: str | None = None) -> DataFrame:
    """The 13 months that end with the period, for one office or all, ordered."""
    day = F.lit(parse_period(period))
    rows = offices.filter(F.col("period_date").between(F.add_months(day, -12), day))
    if office is None:
        return rows.orderBy("st_juri", "period_date")
    return rows.filter(F.col("st_juri") == office).orderBy("period_date")


def office_list(offices: DataFrame, period: str) -> DataFrame:
    """Codes of the offices stored for a period, ordered."""
    return period_slice(offices, period).select("st_juri").distinct().orderBy("st_juri")
