"""Filing status, delay, default score and record checks of one taxpayer and period."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from returns_analytics.functions.amounts import clamp_score, is_number
from returns_analytics.functions.bands import growth_label
from returns_analytics.functions.keys import is_valid_gstin, normalise
from returns_analytics.functions.periods import is_valid_period

# Reject codes in order of precedence with their texts, and the score points.
REJECTS = {
    "INVALID_GSTIN": "Invalid GSTIN format",
    "INVALID_RET_PERIOD": "RET_PERIOD must be MMYYYY",
    "DUE_DATE_MISSING": "Due date is required",
    "FILING_DATE_MISSING": "Filed return requires FILING_DATE",
    "CALCULATION_ERROR": "Risk score is not a number",
}
STATUS_POINTS = {"NOT_FILED": 40, "FILED_LATE": 10}
DELAY_POINTS = ((90, 20), (60, 15), (30, 10), (1, 5))
HISTORY_POINTS, HISTORY_CAP = 4, 16
RISK_SHARE = "0.10"
GROWTH_POINTS = {"STRONG_DECLINE": 8, "DECLINING": 4}


def reject_code(
    gstin: Column, period: Column, due: Column, filed: Column, filing_date: Column, risk_score: Column
) -> Column:
    """First failing check of a candidate, NULL if the record is sound."""
    return (
        F.when(~is_valid_gstin(normalise(gstin)), "INVALID_GSTIN")
        .when(~is_valid_period(period), "INVALID_RET_PERIOD")
        .when(due.isNull(), "DUE_DATE_MISSING")
        .when(filed & filing_date.isNull(), "FILING_DATE_MISSING")
        .when(~is_number(risk_score), "CALCULATION_ERROR")
    )


def reject_message(code: Column) -> Column:
    names = list(REJECTS)
    chain = F.when(code == names[0], REJECTS[names[0]])
    for name in names[1:]:
        chain = chain.when(code == name, REJECTS[name])
    return chain


def delay_days(filed: Column, filing_date: Column, due: Column, as_of: Column) -> Column:
    """Days after the due date: to the filing date if filed, else to the evaluation date.

    NULL where a date is missing, and for a filed return without a filing date.
    """
    days = F.datediff(F.when(filed, filing_date).otherwise(as_of), due)
    # greatest() passes over NULL
    return F.when(days.isNotNull(), F.greatest(days, F.lit(0)))


def filing_status(filed: Column, filing_date: Column, due: Column, as_of: Column) -> Column:
    """NULL where the delay is."""
    late = delay_days(filed, filing_date, due, as_of) > 0
    return (
        F.when(late.isNull(), F.lit(None))
        .when(filed & late, "FILED_LATE")
        .when(filed, "FILED_ON_TIME")
        .when(late, "NOT_FILED")
        .otherwise("NOT_DUE")
    )


def default_score(status: Column, delay: Column, past_defaults: Column, risk_score: Column, growth: Column) -> Column:
    """0..100 points; the risk score counts with a tenth of its value as stored. NULL without a status."""
    by_status = F.lit(0)
    for name, points in STATUS_POINTS.items():
        by_status = F.when(status == name, points).otherwise(by_status)
    by_delay = F.lit(0)
    for days, points in reversed(DELAY_POINTS):
        by_delay = F.when(delay >= days, points).otherwise(by_delay)
    label = growth_label(growth)
    by_growth = F.lit(0)
    for name, points in GROWTH_POINTS.items():
        by_growth = F.when(label == name, points).otherwise(by_growth)
    # the count is capped before it is multiplied, so a huge count cannot overflow
    enough = HISTORY_CAP // HISTORY_POINTS
    by_history = F.least(F.greatest(F.coalesce(past_defaults, F.lit(0)), F.lit(0)), F.lit(enough)) * HISTORY_POINTS
    points = (by_status + by_delay + by_growth + by_history).cast("decimal(10,0)")
    total = clamp_score(points + clamp_score(risk_score) * F.lit(RISK_SHARE).cast("decimal(3,2)"))
    return F.when(status.isNotNull() & is_number(risk_score), total)


def notice_eligible(status: Column, due: Column, as_of: Column) -> Column:
    return (status == "NOT_FILED") & (as_of > due)
