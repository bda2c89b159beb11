"""Whole computations, lazy: tables in, tables out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.functions.bands import RISK_THRESHOLDS
from returns_analytics.operators import defaulters, growth, office, risk
from returns_analytics.operators.trees import TreeModel
from returns_analytics.operators.upsert import update_columns, upsert, with_audit
from returns_analytics.schemas import OFFICE_KEY, TAXPAYER_KEY


def growth_analytics(
    summary: DataFrame,
    periods: Iterable[str] | None = None,
    unique_rows: bool = False,
    most_rows: int | None = None,
) -> DataFrame:
    """Growth table of the periods (all for None) in one pass over the history their rows reach back to."""
    return growth.growth_table(growth.growth_history(summary, periods, unique_rows, most_rows))


def risk_profile(
    summary: DataFrame,
    model: TreeModel,
    periods: Iterable[str] | None = None,
    thresholds: Sequence[float] = RISK_THRESHOLDS,
    arrow: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """(profile, rejects) of the periods."""
    return risk.risk_profile_of(risk.scored_returns(summary, model, periods, arrow), model, thresholds)


def return_defaulters(
    registration: DataFrame,
    summary: DataFrame,
    growth_rows: DataFrame,
    risk_rows: DataFrame,
    history: DataFrame,
    juri: DataFrame,
    period: str,
    due_date: dt.date,
    as_of: dt.date,
    months: int = defaulters.HISTORY_MONTHS_DEFAULT,
) -> tuple[DataFrame, DataFrame]:
    """(results, rejects) of one period at an evaluation date."""
    candidates = defaulters.defaulter_candidates(
        registration, summary, growth_rows, risk_rows, history, juri, period, due_date, months
    )
    return defaulters.evaluate_defaulters(candidates, as_of)


def office_revenue(
    summary: DataFrame,
    dealer: DataFrame,
    juri: DataFrame,
    stored: DataFrame | None = None,
    periods: Iterable[str] | None = None,
    name_column: str = "jurisdiction_name",
) -> DataFrame:
    """Office table of the periods: totals, growth, trend and status.

    Growth looks back into ``stored`` for months outside the periods.
    """
    wanted = None if periods is None else list(periods)
    totals = office.office_totals(summary, dealer, juri, wanted, name_column)
    return office.office_growth(totals, stored, wanted)


# --- merges into stored tables -------------------------------------------------------------

def merge_growth(target: DataFrame, rows: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Growth rows replace the stored ones; the time of creation is kept."""
    now = F.lit(run_at)
    update = [name for name in rows.columns if name not in TAXPAYER_KEY]
    return upsert(target, with_audit(rows, now), TAXPAYER_KEY, [*update, "updated_at"], {"created_at": now})


def merge_growth_period(target: DataFrame, rows: DataFrame, period: str, run_at: dt.datetime) -> DataFrame:
    """merge_growth where both sides hold one period only: the taxpayer alone is the key.

    A target bucketed by gstin (sources.bucketed) then stays where it is.
    """
    now = F.lit(run_at)
    update = [name for name in rows.columns if name not in TAXPAYER_KEY]
    defaults = {"ret_period": F.lit(period), "created_at": now}
    return upsert(target, with_audit(rows, now), ["gstin"], [*update, "updated_at"], defaults)


def merge_risk(target: DataFrame, profile: DataFrame, run_at: dt.datetime, batch_id: int) -> DataFrame:
    """Scores, bands and model identity replace the stored ones; the time of creation is kept."""
    now = F.lit(run_at)
    source = with_audit(profile.withColumn("batch_id", F.lit(batch_id).cast("bigint")), now,
                        ("processed_at", "updated_at"))
    update = [name for name in source.columns if name not in TAXPAYER_KEY]
    return upsert(target, source, TAXPAYER_KEY, update, {"created_at": now})


def merge_defaulters(target: DataFrame, results: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Evaluated columns replace the stored ones and the row is active again.

    The state of the notice and the times of detection and creation belong to the workflow and are
    only set when a row is new.
    """
    now = F.lit(run_at)
    source = with_audit(results.withColumn("active_flag", F.lit("Y")), now, ("last_evaluated_at", "updated_at"))
    update = [name for name in source.columns if name not in TAXPAYER_KEY]
    defaults = {"notice_status": F.lit("NOT_ISSUED"), "first_detected_at": now, "created_at": now}
    return upsert(target, source, TAXPAYER_KEY, update, defaults)


def merge_office_totals(target: DataFrame, totals: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Totals replace the stored ones; growth columns stay as they are."""
    now = F.lit(run_at)
    source = with_audit(totals, now)
    return upsert(target, source, OFFICE_KEY, [*office.TOTAL_COLUMNS, "updated_at"], {"created_at": now})


def update_office_growth(target: DataFrame, growth_rows: DataFrame, run_at: dt.datetime) -> DataFrame:
    """The growth columns of the stored rows named in ``growth_rows``."""
    source = with_audit(growth_rows, F.lit(run_at))
    return update_columns(target, source, OFFICE_KEY, [*office.GROWTH_COLUMNS, "updated_at"])


def merge_offices(target: DataFrame, offices: DataFrame, run_at: dt.datetime) -> DataFrame:
    """Stored office rows of the produced periods after merge, removal of stale offices and growth update."""
    now = F.lit(run_at)
    source = with_audit(offices, now)
    update = [*office.TOTAL_COLUMNS, *office.GROWTH_COLUMNS, "updated_at"]
    return upsert(target, source, OFFICE_KEY, update, {"created_at": now}, drop_unmatched=True)
