"""Growth and trailing averages per taxpayer.

A month is compared with the exact dates one and twelve months before, and averaged over the
3, 6 and 12 months that end with it. All of that comes from interval frames over one ordered
history per taxpayer, never from a self-join.

Three plans give the same rows:

* default: the table may hold any number of rows per taxpayer and date. They are reduced to one
  row per (taxpayer, date) before the windows, so a window partition is bounded by the number of
  dates even if one taxpayer holds a third of the table. The result is joined back on
  (taxpayer, date): a taxpayer's rows spread over its dates, and AQE splits a date that is
  still too big.
* ``unique_rows=True``: the caller knows that (gstin, date) is unique (operators.quality
  checks it); the windows then run on the rows themselves, with a single shuffle by gstin.
* ``most_rows=n``: taxpayers with at most n rows take the second plan, which is right for repeated rows as well
  (interval frames hold all rows of a date); the others, found by a count per taxpayer, take the default one. A
  window partition has at most n rows, or one per date.

For a list of periods only the history their rows reach back to is read, each row by its own date: a row
dated outside the months of the periods brings the history of its taxpayer at that date, and nobody else's.

Months are added as Spark does: 28 February plus one month is 28 March. Periods start on day 1,
where this plays no part.
"""

from __future__ import annotations

import calendar
import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returns_analytics.functions.amounts import growth_ratio, zero_if_null
from returns_analytics.functions.bands import growth_trend
from returns_analytics.functions.periods import effective_date, is_valid_period, parse_period
from returns_analytics.schemas import AVERAGE, RATIO
from returns_analytics.sources.tables import period_slices

# Metrics with growth (input column, name in the output), the ones with averages,
# and the averaged spans in months.
GROWTH_METRICS = (
    ("taxable_value", "taxable"),
    ("total_output_tax", "output_tax"),
    ("eligible_itc", "itc"),
    ("cash_tax_paid", "cash"),
)
AVERAGE_METRICS = GROWTH_METRICS[:3]
AVERAGE_MONTHS = (3, 6, 12)
BASES = (("mom", 1), ("yoy", 12))
#: more returns than any history of months holds; a taxpayer above it is reduced to dates first
MOST_ROWS = 4096

_KEY = ["gstin", "compare_date"]


def growth_columns() -> list[str]:
    return [f"{base}_{name}_growth" for base, _ in BASES for _, name in GROWTH_METRICS]


def average_columns() -> list[str]:
    return [f"avg_{months}m_{name}" for _, name in AVERAGE_METRICS for months in AVERAGE_MONTHS]


def dated_rows(summary: DataFrame) -> DataFrame:
    """Rows with the date they are compared at; the date is NULL only for a bad period without one."""
    return summary.filter(F.col("gstin").isNotNull()).withColumn(
        "compare_date", effective_date(F.col("period_date"), F.col("ret_period"))
    )


def month_bounds(periods: list[str]) -> tuple[dt.date, dt.date]:
    """First and last day of the months of the periods."""
    first = parse_period(min(periods, key=lambda p: p[2:] + p[:2]))
    last = parse_period(max(periods, key=lambda p: p[2:] + p[:2]))
    return first, last.replace(day=calendar.monthrange(last.year, last.month)[1])


def dates_elsewhere(summary: DataFrame, periods: list[str]) -> DataFrame:
    """(gstin, compare_date) of the periods' rows that are dated outside the months of the periods."""
    first, last = month_bounds(periods)
    outside = ~F.col("compare_date").between(F.lit(first), F.lit(last))
    return period_slices(dated_rows(summary), periods).filter(outside).select(*_KEY).distinct()


def earliest(dates: DataFrame, date: Column) -> Column:
    """The first of a column of dates as a scalar subquery; the end of time if there is none.

    Written as a one-row limit: Spark merges two aggregates over one table into one subquery, whose parts it
    then no longer holds against the statistics of the files it scans.
    """
    return _edge(dates, date, "9999-12-31", F.col("date").asc())


def latest(dates: DataFrame, date: Column) -> Column:
    """The last of a column of dates as a scalar subquery; the beginning of time if there is none."""
    return _edge(dates, date, "0001-01-01", F.col("date").desc())


def _edge(dates: DataFrame, date: Column, none: str, order: Column) -> Column:
    known = dates.select(date.alias("date")).filter("date is not null")
    return known.unionAll(dates.sparkSession.range(1).select(F.lit(none).cast("date").alias("date"))).orderBy(order).limit(1).scalar()


def farther_rows(summary: DataFrame, periods: list[str]) -> DataFrame:
    """History of the rows of dates_elsewhere that lies beyond the twelve months before the periods.

    The least and the greatest date are scalar subqueries, so the range is known when the scan starts and
    held against the files' statistics; without such rows it is empty. What is left is kept by taxpayer and date.
    """
    first, last = month_bounds(periods)
    dates = dates_elsewhere(summary, periods)
    lowest, highest = earliest(dates, F.add_months("compare_date", -12)), latest(dates, F.col("compare_date"))
    near = F.col("period_date").between(F.add_months(F.lit(first), -12), F.lit(last))
    rows = dated_rows(summary).filter(
        _in_other_partitions(periods) & ~near & (F.col("period_date") >= lowest) & (F.col("period_date") <= highest))
    reach = dates.select(F.col("gstin").alias("late_gstin"), F.col("compare_date").alias("until"))
    reached = F.col("period_date").between(F.add_months("until", -12), F.col("until"))
    return rows.join(reach, (F.col("gstin") == F.col("late_gstin")) & reached, "left_semi")


def _in_other_partitions(periods: list[str]) -> Column:
    return F.col("ret_period").isNull() | ~F.col("ret_period").isin(periods)


def history_rows(summary: DataFrame, periods: list[str] | None) -> DataFrame:
    """The dated rows that growth of the periods reads: theirs, and those up to twelve months before each.

    Three scans that share no row: the partitions of the periods; in the other partitions the rows dated
    from twelve months before the periods to their end, a range the files' statistics can be held against; and
    what rows dated elsewhere reach back to (farther_rows).
    """
    rows = dated_rows(summary)
    if periods is None:
        return rows
    if not periods:
        return rows.filter(F.lit(False))
    first, last = month_bounds(periods)
    near = F.col("period_date").between(F.add_months(F.lit(first), -12), F.lit(last))
    earlier = rows.filter(_in_other_partitions(periods) & near)
    return period_slices(rows, periods).unionByName(earlier).unionByName(farther_rows(summary, periods))


def _in_history(column: str) -> Column:
    """A value as later months see it: rows without a stored date are never seen."""
    return F.when(F.col("period_date").isNotNull(), F.col(column))


def _one_row_per_date(rows: DataFrame) -> DataFrame:
    """Partial sums per taxpayer and date; combined on the map side before the shuffle."""
    parts = [F.max(_in_history(column)).alias(f"max_{column}") for column, _ in GROWTH_METRICS]
    for column, _ in AVERAGE_METRICS:
        parts.append(F.sum(_in_history(column)).alias(f"sum_{column}"))
        parts.append(F.count(_in_history(column)).alias(f"count_{column}"))
    return rows.groupBy(*_KEY).agg(*parts)


def _with_parts(rows: DataFrame) -> DataFrame:
    """The same columns of each row by itself."""
    parts = {f"max_{column}": _in_history(column) for column, _ in GROWTH_METRICS}
    for column, _ in AVERAGE_METRICS:
        parts[f"sum_{column}"] = _in_history(column)
        parts[f"count_{column}"] = _in_history(column).isNotNull().cast("bigint")
    return rows.withColumns(parts)


def _over(function: str, first: str, last: str) -> Column:
    return F.expr(f"{function} OVER (PARTITION BY gstin ORDER BY compare_date RANGE BETWEEN {first} AND {last})")


def _months_before(months: int) -> str:
    return f"INTERVAL '{months}' MONTH PRECEDING"


def _history_columns() -> dict[str, Column]:
    columns: dict[str, Column] = {}
    for base, months in BASES:
        there = _months_before(months)
        for column, _ in GROWTH_METRICS:
            columns[f"{base}_{column}"] = _over(f"max(max_{column})", there, there)
    for column, name in AVERAGE_METRICS:
        for months in AVERAGE_MONTHS:
            frame = (_months_before(months - 1), "CURRENT ROW")
            total = _over(f"sum(sum_{column})", *frame)
            count = _over(f"sum(count_{column})", *frame)
            columns[f"avg_{months}m_{name}"] = F.when(count > 0, total / count).cast(AVERAGE)
    return columns


def growth_history(
    summary: DataFrame,
    periods: Iterable[str] | None = None,
    unique_rows: bool = False,
    most_rows: int | None = None,
) -> DataFrame:
    """Summary rows with the value one and twelve months before and the trailing averages. Lazy.

    For a list of periods the scan is limited to what they reach back to (history_rows), before the
    windows, and to the periods themselves after them.
    """
    wanted = None if periods is None else list(periods)
    rows = history_rows(summary, wanted)
    current = period_slices(dated_rows(summary), wanted).filter(is_valid_period(F.col("ret_period")))
    if unique_rows:
        return _windows_on_rows(rows, wanted)
    if most_rows is None:
        return rows_with_history(current, rows)
    # at most one taxpayer in most_rows rows, so the list is always small
    large = F.broadcast(taxpayers_above(rows, most_rows))
    few = _windows_on_rows(rows.join(large, "gstin", "left_anti"), wanted)
    many = rows_with_history(current.join(large, "gstin", "left_semi"), rows.join(large, "gstin", "left_semi"))
    return few.unionByName(many)


def taxpayers_above(rows: DataFrame, most_rows: int) -> DataFrame:
    """(gstin) of the taxpayers with more dated rows than that."""
    counts = rows.filter(F.col("compare_date").isNotNull()).groupBy("gstin").agg(F.count(F.lit(1)).alias("rows"))
    return counts.filter(F.col("rows") > most_rows).select("gstin")


def _windows_on_rows(rows: DataFrame, wanted: list[str] | None) -> DataFrame:
    """The windows over the dated rows themselves, and of the result the rows of the periods."""
    parts = [c for c in _with_parts(rows).columns if c not in rows.columns]
    history = _with_parts(rows).filter(F.col("compare_date").isNotNull()).withColumns(_history_columns())
    return period_slices(history, wanted).filter(is_valid_period(F.col("ret_period"))).drop(*parts)


def rows_with_history(current: DataFrame, rows: DataFrame) -> DataFrame:
    """Dated rows with what ``rows`` hold of their taxpayers up to their date; any number of rows per date."""
    history = (
        _one_row_per_date(rows.filter(F.col("compare_date").isNotNull()))
        .withColumns(_history_columns())
        .select(*_KEY, *_history_columns())
    )
    return current.join(history, _KEY, "left")


def growth_ratios(history: DataFrame) -> DataFrame:
    """Eight growth ratios (unrounded) from the values of growth_history."""
    return history.withColumns({
        f"{base}_{name}_growth": growth_ratio(F.col(column), F.col(f"{base}_{column}"))
        for base, _ in BASES
        for column, name in GROWTH_METRICS
    })


def growth_table(history: DataFrame) -> DataFrame:
    """The growth table: current amounts (NULL as 0), ratios, averages, delay and trend."""
    ratios = growth_ratios(history)
    return ratios.select(
        "gstin",
        "ret_period",
        F.col("compare_date").alias("period_date"),
        *[
            zero_if_null(F.col(column)).alias(name)
            for column, name in (
                ("taxable_value", "taxable_value"),
                ("total_output_tax", "output_tax"),
                ("eligible_itc", "eligible_itc"),
                ("utilized_itc", "utilized_itc"),
                ("cash_tax_paid", "cash_tax_paid"),
                ("rcm_total_tax", "rcm_total_tax"),
            )
        ],
        *[F.col(name).cast(RATIO).alias(name) for name in growth_columns()],
        *average_columns(),
        "filing_delay_days",
        # the band is read from the unrounded ratio
        growth_trend(F.col("yoy_taxable_growth")).alias("growth_trend"),
    )
