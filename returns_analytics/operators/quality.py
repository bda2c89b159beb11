"""Data-quality counts and the gates built on them.

Counts are given for every period in one pass. Each starts from one row per (period, taxpayer) or
per taxpayer, so a taxpayer with very many rows is reduced before it meets a join.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returns_analytics.errors import DuplicateKeys, GateFailed
from returns_analytics.functions.keys import normalise
from returns_analytics.functions.periods import effective_date, is_valid_period, month_index, shift_period
from returns_analytics.operators.growth import history_rows
from returns_analytics.operators.office import dealers_in_period
from returns_analytics.sources.tables import period_slice, period_slices


def _count(flag: Column) -> Column:
    return F.count(F.when(flag, 1))


def _period_taxpayers(summary: DataFrame, periods: Iterable[str] | None) -> DataFrame:
    """Number of source rows per period and taxpayer; rows without a taxpayer form a group too."""
    return period_slices(summary, periods).groupBy("ret_period", "gstin").agg(F.count(F.lit(1)).alias("n"))


def _registration_flags(dealer: DataFrame, juri: DataFrame) -> DataFrame:
    """Per taxpayer: has a registration without office, has one at an unknown office, has several offices."""
    codes = (
        juri.filter(F.col("jurisdiction_code").isNotNull())
        .select(F.col("jurisdiction_code").alias("st_juri"))
        .distinct()
        .withColumn("known", F.lit(True))
    )
    offices = dealer.filter(F.col("gstin").isNotNull()).groupBy("gstin", "st_juri").agg(F.count(F.lit(1)).alias("n"))
    office = F.col("st_juri")
    return (
        offices.join(codes, "st_juri", "left")
        .groupBy("gstin")
        .agg(
            F.max(office.isNull()).alias("no_office"),
            F.max(office.isNotNull() & F.col("known").isNull()).alias("unknown_office"),
            # rows are distinct by (gstin, st_juri), so a plain count does
            (F.count(office) > 1).alias("several_offices"),
        )
    )


def source_counts(summary: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """Rows and distinct taxpayers per period."""
    return (
        _period_taxpayers(summary, periods)
        .groupBy("ret_period")
        .agg(F.sum("n").alias("source_rows"), F.count("gstin").alias("source_gstins"))
    )


def duplicate_source(summary: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """Taxpayers with more than one row in a period, counted per period."""
    return (
        _period_taxpayers(summary, periods)
        .groupBy("ret_period")
        .agg(_count(F.col("gstin").isNotNull() & (F.col("n") > 1)).alias("duplicate_gstins"))
    )


def missing_period_dates(summary: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """Rows without a stored date per period."""
    return (
        period_slices(summary, periods)
        .groupBy("ret_period")
        .agg(_count(F.col("period_date").isNull()).alias("missing_dates"))
    )


def _checked_taxpayers(
    summary: DataFrame, dealer: DataFrame, juri: DataFrame, periods: Iterable[str] | None
) -> DataFrame:
    filers = dealers_in_period(dealer, summary, periods)
    flags = _registration_flags(filers, juri).withColumn("registered", F.lit(True))
    return _period_taxpayers(summary, periods).join(flags, "gstin", "left")


_HAS_KEY = "gstin is not null"
_UNMAPPED_REGISTRATION = "gstin is not null and (registered is null or no_office)"
_PRECHECK = {
    "unmapped_registrations": _UNMAPPED_REGISTRATION,
    "unmapped_jurisdictions": "coalesce(unknown_office, false)",
    "duplicate_mappings": "coalesce(several_offices, false)",
    "duplicate_source_gstins": "gstin is not null and n > 1",
}


def office_precheck(
    summary: DataFrame, dealer: DataFrame, juri: DataFrame, periods: Iterable[str] | None = None
) -> DataFrame:
    """One row per period with the six counts of the office pre-check, from one pass over each input."""
    return (
        _checked_taxpayers(summary, dealer, juri, periods)
        .groupBy("ret_period")
        .agg(
            F.sum("n").alias("source_rows"),
            F.count("gstin").alias("source_gstins"),
            *[_count(F.expr(test)).alias(name) for name, test in _PRECHECK.items()],
        )
    )


def unmapped_registrations(
    summary: DataFrame, dealer: DataFrame, periods: Iterable[str] | None = None
) -> DataFrame:
    """Taxpayers per period without a registration, or with any registration that has no office."""
    offices = dealer.filter(F.col("gstin").isNotNull()).groupBy("gstin").agg(
        F.max(F.col("st_juri").isNull()).alias("no_office"), F.first(F.lit(True)).alias("registered")
    )
    return (
        _period_taxpayers(summary, periods)
        .join(offices, "gstin", "left")
        .groupBy("ret_period")
        .agg(_count(F.expr(_UNMAPPED_REGISTRATION)).alias("unmapped_registrations"))
    )


def unmapped_jurisdictions(
    summary: DataFrame, dealer: DataFrame, juri: DataFrame, periods: Iterable[str] | None = None
) -> DataFrame:
    """Taxpayers per period with a registration at an office that the master does not know."""
    codes = juri.select(F.col("jurisdiction_code").alias("st_juri"))
    unknown = (
        dealer.filter(F.col("gstin").isNotNull() & F.col("st_juri").isNotNull())
        .select("gstin", "st_juri")
        .distinct()
        .join(codes, "st_juri", "left_anti")
        .select("gstin")
        .distinct()
    )
    return (
        _period_taxpayers(summary, periods)
        .join(unknown, "gstin")
        .groupBy("ret_period")
        .agg(F.count(F.lit(1)).alias("unmapped_jurisdictions"))
    )


def duplicate_mappings(summary: DataFrame, dealer: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """Filers with registrations at more than one office, with the number of filed periods."""
    several = (
        dealer.filter(F.col("gstin").isNotNull() & F.col("st_juri").isNotNull())
        .select("gstin", "st_juri")
        .distinct()
        .groupBy("gstin")
        .agg(F.count(F.lit(1)).alias("offices"))
        .filter("offices > 1")
    )
    return (
        _period_taxpayers(summary, periods)
        .join(several, "gstin")
        .groupBy("ret_period")
        .agg(F.count(F.lit(1)).alias("duplicate_mappings"))
    )


def enforce_precheck(counts: DataFrame) -> list[str]:
    """Stop on periods without data or with duplicate mappings; return warnings for the rest. Eager.

    ``counts`` is the result of office_precheck for the requested periods; only rows that need
    attention reach the driver, at most one per period.
    """
    gaps = " or ".join(f"{name} > 0" for name in _PRECHECK)
    warnings = []
    for row in counts.filter(f"source_gstins = 0 or {gaps}").collect():
        if row.source_gstins == 0:
            raise GateFailed(f"no valid source data for {row.ret_period}")
        if row.duplicate_mappings:
            raise GateFailed(f"{row.ret_period}: {row.duplicate_mappings} taxpayers map to several offices")
        if row.unmapped_registrations or row.unmapped_jurisdictions:
            warnings.append(
                f"{row.ret_period}: {row.unmapped_registrations} taxpayers without office and "
                f"{row.unmapped_jurisdictions} at unknown offices are left out of the totals"
            )
        if row.duplicate_source_gstins:
            warnings.append(f"{row.ret_period}: amounts of {row.duplicate_source_gstins} taxpayers are summed per row")
    return warnings


# --- keys ----------------------------------------------------------------------------------

def duplicate_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def bad_taxpayer_keys(rows: DataFrame) -> DataFrame:
    """Taxpayer keys that are blank, or repeated once normalised."""
    return (
        rows.groupBy(normalise(F.col("gstin")).alias("gstin"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("gstin").isNull() | (F.col("n") > 1))
    )


def require_unique(rows: DataFrame, keys: Sequence[str]) -> None:
    """Stop if a key is repeated. Runs an action that fetches at most one row."""
    first = duplicate_keys(rows, keys).first()
    if first is not None:
        raise DuplicateKeys(f"{first.n} rows for {first.asDict()}")


def duplicate_office_months(offices: DataFrame) -> DataFrame:
    """Offices with more than one row for a calendar month."""
    month = month_index(effective_date(F.col("period_date"), F.col("ret_period")))
    return duplicate_keys(offices.withColumn("month_idx", month), ["st_juri", "month_idx"])


def has_unique_dates(summary: DataFrame, periods: list[str] | None = None) -> bool:
    """Whether no taxpayer has two rows at one date, which allows the one-shuffle growth plan. Eager.

    For a list of periods, only the rows that their growth reads are looked at.
    """
    return duplicate_keys(history_rows(summary, periods), ["gstin", "compare_date"]).isEmpty()


def invalid_periods(summary: DataFrame) -> DataFrame:
    """Rows whose return period is none, by its text: no computation produces a row for them."""
    bad = F.col("ret_period").isNull() | ~is_valid_period(F.col("ret_period"))
    return summary.filter(bad).groupBy("ret_period").agg(F.count(F.lit(1)).alias("rows"))


# --- coverage and failure rate -------------------------------------------------------------

def growth_coverage(growth: DataFrame, summary: DataFrame) -> DataFrame:
    """Growth rows against summary rows of every period a summary or growth row exists for.

    A run for one period looks at the row of the period before.
    """
    counts = [
        rows.groupBy("ret_period").agg(F.count(F.lit(1)).alias("n")).withColumn("side", F.lit(side))
        for side, rows in (("growth", growth), ("summary", summary))
    ]
    return (
        counts[0].unionByName(counts[1])
        .groupBy("ret_period")
        .agg(*[
            F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0)).alias(f"{side}_rows")
            for side in ("growth", "summary")
        ])
        .withColumn("incomplete", F.col("growth_rows") < F.col("summary_rows"))
    )


def coverage_warning(growth: DataFrame, summary: DataFrame, period: str) -> str | None:
    """Warning if growth is incomplete for the period before. Eager; one row reaches the driver."""
    previous = shift_period(period, -1)
    row = growth_coverage(period_slice(growth, previous), period_slice(summary, previous)).first()
    if row is None or not row.incomplete:
        return None
    return (
        f"growth of {previous} is incomplete ({row.growth_rows} of {row.summary_rows} rows): "
        "averages of the missing taxpayers will be 0"
    )


def enforce_failure_limit(rows_read: int, rows_failed: int, max_percent: float = 1.0) -> None:
    """Stop if more than the allowed share of rows failed (strictly more)."""
    if rows_read and rows_failed * 100.0 / rows_read > max_percent:
        raise GateFailed(f"{rows_failed} of {rows_read} rows failed, more than {max_percent} percent")
