"""Late, corrected and withdrawn returns: growth of what they reach, and of nothing else.

A change at a date is seen by its taxpayer's rows of that date and of the twelve months behind it. Growth of these
rows is computed again from the histories of the changed taxpayers, cut to the dates that can matter, and takes
the place of the stored rows with the same taxpayer and date. Everything follows from (gstin, date), so a row
that was withdrawn goes, one that moved to another date is taken out at the old and put in at the new one,
and repeated rows of a date are replaced together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returns_analytics.functions.periods import is_valid_period
from returns_analytics.operators.growth import GROWTH_METRICS, dated_rows, earliest, growth_table, latest, rows_with_history
from returns_analytics.operators.upsert import upsert, with_audit
from returns_analytics.schemas import TAXPAYER_KEY

#: Columns growth is computed from or shows; a change elsewhere changes no growth row.
READ = ("period_date", *[column for column, _ in GROWTH_METRICS], "utilized_itc", "rcm_total_tax", "filing_delay_days")
#: Months a change reaches forward, and days by which month ends can move a reach.
_REACH, _SLACK = 12, 3


def changed_dates(before: DataFrame, after: DataFrame, columns: Sequence[str] = READ) -> DataFrame:
    """(gstin, changed_date): the dates at which two states of the summary differ for a taxpayer.

    Rows of a (taxpayer, date) are reduced on the map side to their number and the sum of their hashes, so order
    plays no part and repeated rows count. Rows without a date, bad periods, are compared at no date.
    """
    digest = F.xxhash64("ret_period", *columns).cast("decimal(38,0)")

    def state(summary: DataFrame, sign: int) -> DataFrame:
        rows = dated_rows(summary).filter(F.col("compare_date").isNotNull())
        return rows.select("gstin", "compare_date", F.lit(sign).alias("n"), (digest * sign).alias("digest"))

    return (
        state(before, -1).unionByName(state(after, 1))
        .groupBy("gstin", "compare_date")
        .agg(F.sum("n").alias("n"), F.sum("digest").alias("digest"))
        .filter("n <> 0 or digest <> 0")
        .select("gstin", F.col("compare_date").alias("changed_date"))
    )


def late_dates(late: DataFrame) -> DataFrame:
    """(gstin, changed_date) of returns that arrived since the table was computed."""
    rows = dated_rows(late).filter(F.col("compare_date").isNotNull())
    return rows.select("gstin", F.col("compare_date").alias("changed_date")).distinct()


def _reached(rows: DataFrame, changes: DataFrame, date: str, how: str) -> DataFrame:
    """Rows (semi) within twelve months behind a change of their taxpayer, or the others (anti)."""
    changed = changes.select(F.col("gstin").alias("changed_gstin"), "changed_date")
    reach = F.col("changed_date").between(F.add_months(date, -_REACH), F.col(date))
    return rows.join(changed, (F.col("gstin") == F.col("changed_gstin")) & reach, how)


def reached_rows(stored: DataFrame, changes: DataFrame) -> DataFrame:
    """The stored growth rows a change reaches."""
    return _reached(stored, changes, "period_date", "left_semi")


def affected_history(summary: DataFrame, changes: DataFrame) -> DataFrame:
    """The rows the windows need: those of changed taxpayers, from a year before to a year behind the changes.

    First and last date over all changes are scalar subqueries, which the scan holds against the files'
    statistics; rows without a stored date have none and are kept by taxpayer.
    """
    first, last = F.add_months("changed_date", -_REACH), F.add_months("changed_date", _REACH)
    lowest, highest = earliest(changes, F.date_sub(first, _SLACK)), latest(changes, F.date_add(last, _SLACK))
    spans = changes.groupBy(F.col("gstin").alias("changed_gstin")).agg(
        F.date_sub(F.min(first), _SLACK).alias("first"), F.date_add(F.max(last), _SLACK).alias("last"))
    stored = F.col("period_date").isNull() | ((F.col("period_date") >= lowest) & (F.col("period_date") <= highest))
    inside = F.col("compare_date").between(F.col("first"), F.col("last"))
    return dated_rows(summary.filter(stored)).join(spans, (F.col("gstin") == F.col("changed_gstin")) & inside, "left_semi")


def late_growth(summary: DataFrame, changes: DataFrame) -> DataFrame:
    """Growth rows, computed anew, of everything the changes reach. ``changes``: gstin, changed_date."""
    history = affected_history(summary, changes)
    current = _reached(history, changes, "compare_date", "left_semi").filter(is_valid_period(F.col("ret_period")))
    return growth_table(rows_with_history(current, history))


def merge_late_growth(stored: DataFrame, rows: DataFrame, changes: DataFrame, run_at: dt.datetime) -> DataFrame:
    """The stored growth table with the reached rows replaced.

    Stored rows within reach that are not computed again are withdrawn; the time of creation is kept. For a table
    without audit columns the replaced rows are simply put in.
    """
    kept = _reached(stored, changes, "period_date", "left_anti")
    if "updated_at" not in stored.columns:
        return kept.unionByName(rows)
    now = F.lit(run_at)
    reached = reached_rows(stored, changes)
    update = [name for name in rows.columns if name not in TAXPAYER_KEY]
    fresh = upsert(reached, with_audit(rows, now), TAXPAYER_KEY, [*update, "updated_at"], {"created_at": now}, True)
    # a row that moved into reach from a date outside of it is one row still
    moved = fresh.select(*[F.col(key).alias(f"new_{key}") for key in TAXPAYER_KEY])
    same: Column = F.lit(True)
    for key in TAXPAYER_KEY:
        same = same & (F.col(key) == F.col(f"new_{key}"))
    return kept.join(moved, same, "left_anti").unionByName(fresh)
