"""Monthly totals per jurisdiction office, and their growth."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.functions.amounts import growth_percent, zero_if_null
from returns_analytics.functions.bands import office_status, office_trend
from returns_analytics.functions.periods import effective_date, first_day, is_valid_period, month_index
from returns_analytics.schemas import OFFICE_KEY, TOTAL
from returns_analytics.sources.tables import period_slices

# Summed columns of the summary and their names in the office table.
TOTALS = (
    ("taxable_value", "taxable_value"),
    ("total_output_tax", "output_tax"),
    ("output_igst", "igst"),
    ("output_cgst", "cgst"),
    ("output_sgst", "sgst"),
    ("output_cess", "cess"),
    ("eligible_itc", "eligible_itc"),
    ("utilized_itc", "utilized_itc"),
    ("cash_tax_paid", "cash_tax_paid"),
)
GROWTH_BASES = (("mom", 1), ("yoy", 12))
METRICS = (("output", "output_tax"), ("cash", "cash_tax_paid"))
AVERAGE_METRICS = (("output_tax", "output_tax"), ("cash_tax", "cash_tax_paid"))
AVERAGE_MONTHS = (3, 6, 12)

TOTAL_COLUMNS = ["period_date", "office_name", "filed_gstins", *[name for _, name in TOTALS]]
GROWTH_COLUMNS = [
    *[f"{base}_{metric}_growth" for metric, _ in METRICS for base, _ in GROWTH_BASES],
    *[f"avg_{metric}_{months}m" for metric, _ in AVERAGE_METRICS for months in AVERAGE_MONTHS],
    "growth_trend",
    "growth_status",
]


def dealer_offices(dealer: DataFrame) -> DataFrame:
    """One office per taxpayer: the largest code among its registrations."""
    return (
        dealer.filter(F.col("gstin").isNotNull() & F.col("st_juri").isNotNull())
        .groupBy("gstin")
        .agg(F.max("st_juri").alias("st_juri"))
    )


def office_names(juri: DataFrame, name_column: str = "jurisdiction_name") -> DataFrame:
    """One name per jurisdiction code."""
    return (
        juri.filter(F.col("jurisdiction_code").isNotNull())
        .groupBy(F.col("jurisdiction_code").alias("st_juri"))
        .agg(F.max(name_column).alias("office_name"))
    )


def dealers_in_period(dealer: DataFrame, summary: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """Registrations of taxpayers with a return in the periods; all of them where no periods are given.

    Filers are reduced to one narrow row each on the map side, so a month's list is mostly small enough
    for Spark to broadcast, and the master is then cut where it is scanned.
    """
    if periods is None:
        return dealer
    filers = period_slices(summary, periods).select("gstin").distinct()
    return dealer.join(filers, "gstin", "left_semi")


def _totals_of_returns(rows: DataFrame, offices: DataFrame, sums: list[Column]) -> DataFrame:
    """Sums and number of filers per (ret_period, st_juri) and block of 32,768 taxpayers.

    Taxpayers are numbered where their registrations are grouped, in the order of their keys so that a number is
    the same whenever a task is run again. A row per period, office and block leaves each task, with the
    numbers seen as bits: a taxpayer with several returns sets the same bit, and no list of taxpayers is moved.
    """
    number = F.monotonically_increasing_id()
    placed = offices.sortWithinPartitions("gstin").withColumn("number", number).select(
        "gstin", "st_juri", F.bitmap_bucket_number("number").alias("block"), F.bitmap_bit_position("number").alias("bit"))
    return (
        rows.join(placed, "gstin")
        .groupBy(*OFFICE_KEY, "block")
        .agg(F.bitmap_construct_agg("bit").alias("bits"), *sums)
        .withColumn("filers", F.bitmap_count("bits"))
    )


def office_totals(
    summary: DataFrame,
    dealer: DataFrame,
    juri: DataFrame,
    periods: Iterable[str] | None = None,
    name_column: str = "jurisdiction_name",
) -> DataFrame:
    """Totals and number of filers per (ret_period, st_juri).

    Returns meet the office of their taxpayer as they are and are added up per office on the map side, however
    few offices there are; filers are counted as bits of a bitmap (_totals_of_returns). Offices are named last, on
    the already small result. No side is hinted: Spark broadcasts one when its measured size allows.

    For one period the taxpayer is the whole key: returns are first reduced to one row per taxpayer, so sums and join
    share one exchange per side. For a list of periods only registrations of their filers are grouped.
    """
    wanted = None if periods is None else list(periods)
    rows = period_slices(summary, wanted).filter(F.col("gstin").isNotNull() & is_valid_period(F.col("ret_period")))
    offices = dealer_offices(dealers_in_period(dealer, summary, wanted))
    sums = [F.sum(zero_if_null(F.col(column))).alias(name) for column, name in TOTALS]
    if wanted is not None and len(wanted) == 1:
        returns = rows.groupBy("gstin").agg(*sums).withColumn("ret_period", F.lit(wanted[0]))
        parts = returns.join(offices, "gstin").withColumn("filers", F.lit(1).cast("bigint"))
    else:
        parts = _totals_of_returns(rows, offices, sums)
    return (
        parts.groupBy(*OFFICE_KEY)
        .agg(
            F.sum("filers").alias("filed_gstins"),
            *[F.sum(name).cast(TOTAL).alias(name) for _, name in TOTALS],
        )
        .join(office_names(juri, name_column), "st_juri")
        .select(
            "ret_period",
            "st_juri",
            first_day(F.col("ret_period")).alias("period_date"),
            "office_name",
            "filed_gstins",
            *[name for _, name in TOTALS],
        )
    )


def merge_history(totals: DataFrame, stored: DataFrame | None, periods: Iterable[str] | None = None) -> DataFrame:
    """Produced months together with the stored months of other periods, flagged ``produced``.

    Every stored row of a produced period is replaced: by the new row of the office, or by
    nothing if the office is no longer produced.
    """
    fresh = totals.withColumn("produced", F.lit(True))
    if stored is None:
        return fresh
    kept = stored.select("ret_period", "st_juri", "period_date", "output_tax", "cash_tax_paid").withColumn(
        "produced", F.lit(False))
    if periods is not None:
        kept = kept.filter(~F.col("ret_period").isin(list(periods)))
        return fresh.unionByName(kept, allowMissingColumns=True)
    # without a list, a period is produced if any office of it is; asking the union for that
    # spares a second evaluation of the totals, and its partitions are as small as the list of offices
    produced_period = F.max("produced").over(Window.partitionBy("ret_period"))
    return (
        fresh.unionByName(kept, allowMissingColumns=True)
        .withColumn("produced_period", produced_period)
        .filter("produced or not produced_period")
        .drop("produced_period")
    )


def _at(column: str, months_before: int) -> Column:
    frame = Window.partitionBy("st_juri").orderBy("month_idx").rangeBetween(-months_before, -months_before)
    return F.max(column).over(frame)


def _average(column: str, months: int) -> Column:
    """Over the months present; at most twelve, so two-step rounding cannot move a tie."""
    frame = Window.partitionBy("st_juri").orderBy("month_idx").rangeBetween(1 - months, 0)
    return F.round(F.sum(column).over(frame) / F.count(column).over(frame), 2).cast(TOTAL)


def office_growth(
    totals: DataFrame, stored: DataFrame | None = None, periods: Iterable[str] | None = None
) -> DataFrame:
    """The produced rows with their twelve growth columns; the totals are evaluated once.

    One window partition holds an office's months, one row each (operators.quality checks that).
    Stored NULL amounts count as 0.
    """
    kept = totals.columns
    values = {f"{base}_{name}": _at(f"nz_{name}", lag) for base, lag in GROWTH_BASES for _, name in METRICS}
    averages = {
        f"avg_{metric}_{span}m": _average(f"nz_{name}", span)
        for metric, name in AVERAGE_METRICS
        for span in AVERAGE_MONTHS
    }
    growths = {
        f"{base}_{metric}_growth": growth_percent(F.col(f"nz_{name}"), F.col(f"{base}_{name}"))
        for metric, name in METRICS
        for base, _ in GROWTH_BASES
    }
    monthly, yearly = F.col("mom_output_growth"), F.col("yoy_output_growth")
    return (
        merge_history(totals, stored, periods)
        .withColumn("month_idx", month_index(effective_date(F.col("period_date"), F.col("ret_period"))))
        .withColumns({f"nz_{name}": F.coalesce(F.col(name), F.lit(0)).cast(TOTAL) for _, name in METRICS})
        .withColumns(values | averages)
        .filter("produced")
        .withColumns(growths)
        .withColumns({
            "growth_trend": office_trend(monthly, yearly),
            "growth_status": office_status(monthly, yearly),
        })
        .select(*kept, *GROWTH_COLUMNS)
    )
