"""Who did not file, or filed late, for one period.

Every input is reduced to one row per taxpayer (or per taxpayer and period) before it is joined,
so the joins are one-to-one and the largest shuffled side is the population of the period. The
latest-row picks are ``row_number() = 1`` filters: Spark cuts them to one row per taxpayer on
the map side (WindowGroupLimit) before it shuffles.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.errors import DueDateError
from returns_analytics.functions.amounts import clamp_score, money, output_tax, zero_if_null
from returns_analytics.functions.bands import default_level, existing_level_or_derived, growth_label
from returns_analytics.functions.filing import (
    default_score,
    delay_days,
    filing_status,
    notice_eligible,
    reject_code,
    reject_message,
)
from returns_analytics.functions.keys import normalise, trim_to_null
from returns_analytics.functions.periods import (
    HISTORY_PERIOD_PATTERN,
    ends_quarter,
    first_day,
    is_valid_period,
    parse_period,
)
from returns_analytics.schemas import AVERAGE
from returns_analytics.sources.tables import period_slice, registration_slice

# Fixed values.
RETURN_TYPE = "GSTR3B"
HISTORY_MONTHS_DEFAULT, HISTORY_MONTHS_MIN, HISTORY_MONTHS_MAX = 36, 12, 120


# --- due date ------------------------------------------------------------------------------

def due_dates(due: DataFrame) -> DataFrame:
    """Per period of the return type: how many active due dates there are, and the date if it is one."""
    active = due.filter(
        (F.col("return_type") == RETURN_TYPE)
        & (F.col("active_flag") == "Y")
        & F.col("effective_due_date").isNotNull()
    )
    return active.groupBy("ret_period").agg(
        F.count(F.lit(1)).alias("active_dates"),
        F.when(F.count(F.lit(1)) == 1, F.max("effective_due_date")).alias("due_date"),
    )


def required_due_date(due: DataFrame, period: str) -> dt.date:
    """The one active due date of a period, or an error. Eager; one row reaches the driver."""
    row = due_dates(period_slice(due, period)).first()
    if row is None:
        raise DueDateError(f"no active due date for {period}")
    if row.active_dates > 1:
        raise DueDateError(f"{row.active_dates} active due dates for {period}")
    return row.due_date


# --- population ----------------------------------------------------------------------------

def eligible(registration: DataFrame, period: str) -> DataFrame:
    """Active taxpayers who must file for the period: everybody at a quarter end, else monthly filers.

    The preference is compared in upper case but not trimmed.
    """
    rows = registration_slice(registration, period).filter(
        (F.col("auth_status") == "A") & F.col("gstin_id").isNotNull()
    )
    if not ends_quarter(period):
        rows = rows.filter(F.upper("pref") == "M")
    return rows.groupBy(F.upper("gstin_id").alias("gstin")).agg(F.max("state_jursd_cd").alias("st_juri"))


def eligible_count(registration: DataFrame, period: str) -> DataFrame:
    """Size of the population as a one-row table."""
    return eligible(registration, period).agg(F.count(F.lit(1)).alias("eligible"))


# --- the six inputs of a candidate ---------------------------------------------------------

OUTPUT_TAX_COLUMNS = ("total_output_tax", "output_igst", "output_cgst", "output_sgst", "output_cess")
_RETURN_COLUMNS = ("filing_date", "total_output_tax", "taxable_value", *OUTPUT_TAX_COLUMNS[1:])


def latest_return(summary: DataFrame, period: str) -> DataFrame:
    """The return of a period with the latest filing date, per taxpayer.

    Equal dates are decided by the larger amounts, so the pick is the same on every run.
    """
    order = Window.partitionBy("gstin").orderBy(*[F.col(name).desc_nulls_last() for name in _RETURN_COLUMNS])
    return (
        period_slice(summary, period)
        .filter(F.col("gstin").isNotNull())
        .select("gstin", *_RETURN_COLUMNS)
        .withColumn("rank", F.row_number().over(order))
        .filter("rank = 1")
        .drop("rank")
    )


def current_return(summary: DataFrame, population: DataFrame, period: str) -> DataFrame:
    """Latest return of the period for the taxpayers of the population."""
    return latest_return(summary, period).join(population.select("gstin"), "gstin", "left_semi")


def history_months(requested: int = HISTORY_MONTHS_DEFAULT) -> int:
    """The lookback as given; a length outside the allowed range raises."""
    if not HISTORY_MONTHS_MIN <= requested <= HISTORY_MONTHS_MAX:
        raise ValueError(f"the lookback must be {HISTORY_MONTHS_MIN} to {HISTORY_MONTHS_MAX} months, not {requested}")
    return requested


def last_filed(
    growth: DataFrame,
    summary: DataFrame,
    period: str,
    months: int = HISTORY_MONTHS_DEFAULT,
    risk: DataFrame | None = None,
    population: DataFrame | None = None,
) -> DataFrame:
    """Latest earlier growth row, within the lookback, whose return has a filing date.

    It comes with its averages, its trend and, where the table is given, its risk. Growth rows, filings and risk rows
    are stacked and dealt by taxpayer once; they meet per month and the newest month with a filing is then the
    greatest of a struct, both as aggregates within that one partitioning, so nothing is joined on two keys. Only
    taxpayers of the population are looked at.
    """
    start = F.lit(parse_period(period))
    recent = growth.filter(
        (F.col("period_date") < start) & (F.col("period_date") >= F.add_months(start, -history_months(months)))
    )
    # The periods of the lookback prune the other tables' partitions at run time. They are distinct
    # valid periods, a few dozen and at most 120,000 short texts, so they are always small.
    periods = F.broadcast(recent.select("ret_period").filter(is_valid_period(F.col("ret_period"))).distinct())
    averages = [F.col(f"avg_{n}m_output_tax").alias(f"avg_output_tax_{n}m") for n in (3, 6, 12)]
    month = F.struct("period_date", *averages, F.col("growth_trend").alias("last_growth_trend"))
    stack = recent.select("gstin", "ret_period", month.alias("month"))
    filings = summary.join(periods, "ret_period", "left_semi").filter(F.col("filing_date").isNotNull())
    stack = stack.unionByName(filings.select("gstin", "ret_period", "filing_date"), allowMissingColumns=True)
    if risk is not None:
        at_risk = F.struct(F.col("risk_level").alias("last_risk_level"), F.col("risk_score").alias("last_risk_score"))
        risks = risk.join(periods, "ret_period", "left_semi").select("gstin", "ret_period", at_risk.alias("risk"))
        stack = stack.unionByName(risks, allowMissingColumns=True)
    if population is None:
        stack = stack.filter(F.col("gstin").isNotNull()).repartition("gstin")
    else:
        stack = stack.join(population.select("gstin"), "gstin", "left_semi")
    # a period with several returns counts once, with its latest date
    found = [F.max("month").alias("month"), F.max("filing_date").alias("last_filing_date")]
    if risk is not None:
        found.append(F.max("risk").alias("risk"))
    months_filed = (
        stack.groupBy("gstin", "ret_period").agg(*found).filter("month is not null and last_filing_date is not null")
    )
    order = F.struct("month.period_date", "last_filing_date", "ret_period")
    picked = months_filed.groupBy("gstin").agg(
        F.max_by(F.struct(*[c for c in months_filed.columns if c != "gstin"]), order).alias("pick"))
    carried = ["pick.last_filing_date", *[f"pick.month.avg_output_tax_{n}m" for n in (3, 6, 12)], "pick.month.last_growth_trend"]
    if risk is not None:
        carried += ["pick.risk.last_risk_level", "pick.risk.last_risk_score"]
    return picked.select("gstin", F.col("pick.ret_period").alias("last_filed_period"), *carried)


def historical_defaults(history: DataFrame, period: str) -> DataFrame:
    """Number of active not-filed results of earlier periods, per taxpayer.

    Stored text that is not a period never counts.
    """
    before = first_day(F.col("ret_period"), HISTORY_PERIOD_PATTERN) < F.lit(parse_period(period))
    return (
        history.filter((F.col("filing_status") == "NOT_FILED") & (F.col("active_flag") == "Y") & before)
        .groupBy("gstin")
        .agg(F.count(F.lit(1)).alias("default_count"))
    )


def with_effective_period(
    population: DataFrame,
    current: DataFrame,
    filed_before: DataFrame,
    growth: DataFrame,
    risk: DataFrame,
    period: str,
) -> DataFrame:
    """Population with its return, its last filed period, and growth and risk at the effective period.

    That is the period itself for filers, and the last filed period for everybody else. Both
    candidates are at hand per taxpayer (one partition of the growth and risk tables, and the
    columns that last_filed carries), so every join is on gstin alone and keeps one partitioning.
    """
    returns = current.withColumn("filed", F.lit(True))
    trends = period_slice(growth, period).select("gstin", F.col("growth_trend").alias("now_growth_trend"))
    risks = period_slice(risk, period).select(
        "gstin", F.col("risk_level").alias("now_risk_level"), F.col("risk_score").alias("now_risk_score"))
    rows = population
    for side in (returns, filed_before, trends, risks):
        rows = rows.join(side, "gstin", "left")
    rows = rows.withColumn("filed", F.coalesce("filed", F.lit(False)))
    filed = F.col("filed")
    return rows.withColumns({
        "effective_period": F.when(filed, F.lit(period)).otherwise(F.col("last_filed_period")),
        **{
            name: F.when(filed, F.col(f"now_{name}")).otherwise(F.col(f"last_{name}"))
            for name in ("growth_trend", "risk_level", "risk_score")
        },
    })


def defaulter_candidates(
    registration: DataFrame,
    summary: DataFrame,
    growth: DataFrame,
    risk: DataFrame,
    history: DataFrame,
    juri: DataFrame,
    period: str,
    due_date: dt.date,
    months: int = HISTORY_MONTHS_DEFAULT,
    name_column: str = "jurisdiction_name",
) -> DataFrame:
    """The population of a period with everything its evaluation needs.

    growth and risk of the period must be unique by gstin and the jurisdiction master by code;
    otherwise taxpayers come out twice, which operators.quality.bad_taxpayer_keys finds.
    """
    population = eligible(registration, period)
    rows = with_effective_period(
        population,
        latest_return(summary, period),
        last_filed(growth, summary, period, months, risk, population),
        growth,
        risk,
        period,
    ).join(historical_defaults(history, period), "gstin", "left")
    names = juri.select(F.col("jurisdiction_code").alias("st_juri"), F.col(name_column).alias("office_name"))
    averages = [
        F.coalesce(F.col(f"avg_output_tax_{n}m"), F.lit(0)).cast(AVERAGE).alias(f"avg_output_tax_{n}m")
        for n in (3, 6, 12)
    ]
    return (
        rows.join(names, "st_juri", "left")
        .select(
            normalise(F.col("gstin")).alias("gstin"),
            F.lit(period).alias("ret_period"),
            F.lit(due_date).cast("date").alias("due_date"),
            "filed",
            "filing_date",
            zero_if_null(F.col("taxable_value")).alias("taxable_value"),
            output_tax(*[F.col(name) for name in OUTPUT_TAX_COLUMNS]).alias("output_tax"),
            trim_to_null(F.col("last_filed_period")).alias("last_filed_period"),
            "last_filing_date",
            *averages,
            trim_to_null(F.col("growth_trend")).alias("growth_status"),
            trim_to_null(F.col("risk_level")).alias("risk_level"),
            F.coalesce(F.col("risk_score"), F.lit(0.0)).alias("risk_score"),
            F.coalesce(F.col("default_count"), F.lit(0)).alias("historical_default_count"),
            trim_to_null(F.col("st_juri")).alias("st_juri"),
            trim_to_null(F.col("office_name")).alias("office_name"),
        )
    )


# --- evaluation ----------------------------------------------------------------------------

RESULT_COLUMNS = (
    "gstin", "ret_period", "due_date", "filing_status", "filing_date", "delay_days", "taxable_value", "output_tax",
    "last_filed_period", "last_filing_date", "avg_output_tax_3m", "avg_output_tax_6m", "avg_output_tax_12m",
    "growth_status", "risk_level", "risk_score", "default_score", "default_level", "historical_default_count",
    "notice_eligible", "st_juri", "office_name",
)
REJECT_COLUMNS = ("gstin", "ret_period", "error_code", "error_message")


def checked_candidates(candidates: DataFrame) -> DataFrame:
    """Candidates with the code of the first failing check (NULL if sound)."""
    code = reject_code(*[F.col(c) for c in ("gstin", "ret_period", "due_date", "filed", "filing_date", "risk_score")])
    return candidates.withColumn("error_code", code)


def results_of(checked: DataFrame, as_of: dt.date) -> DataFrame:
    """Status, delay, score, level and notice flag of the sound records."""
    today = F.lit(as_of).cast("date")
    filed, filing_date, due = F.col("filed"), F.col("filing_date"), F.col("due_date")
    evaluated = (
        checked.filter(F.col("error_code").isNull())
        .withColumns({
            "filing_status": filing_status(filed, filing_date, due, today),
            "delay_days": delay_days(filed, filing_date, due, today),
        })
        .withColumns({
            "default_score": default_score(
                F.col("filing_status"),
                F.col("delay_days"),
                F.col("historical_default_count"),
                F.col("risk_score"),
                F.col("growth_status"),
            ),
            "notice_eligible": F.when(notice_eligible(F.col("filing_status"), due, today), "Y").otherwise("N"),
        })
    )
    score = clamp_score(F.col("risk_score"))
    return evaluated.withColumns({
        "taxable_value": money(F.col("taxable_value")),
        "output_tax": money(F.col("output_tax")),
        **{f"avg_output_tax_{n}m": money(F.col(f"avg_output_tax_{n}m")) for n in (3, 6, 12)},
        "growth_status": growth_label(F.col("growth_status")),
        "risk_level": existing_level_or_derived(F.col("risk_level"), score),
        "risk_score": score,
        "default_level": default_level(F.col("default_score")),
        "historical_default_count": F.greatest(F.col("historical_default_count"), F.lit(0)),
    }).select(*RESULT_COLUMNS)


def rejects_of(checked: DataFrame) -> DataFrame:
    """The records set aside, with code and text."""
    return checked.filter(F.col("error_code").isNotNull()).withColumn(
        "error_message", reject_message(F.col("error_code"))
    ).select(*REJECT_COLUMNS)


def evaluate_defaulters(candidates: DataFrame, as_of: dt.date) -> tuple[DataFrame, DataFrame]:
    """(results, rejects) of the candidates at an evaluation date; together they hold every candidate once."""
    checked = checked_candidates(candidates)
    return results_of(checked, as_of), rejects_of(checked)
