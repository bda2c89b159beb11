"""Return periods (``MMYYYY`` text) as Column expressions and as run parameters."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from returns_analytics.errors import InvalidPeriod

# Text format of a period, and the quarter names of the registration tables.
PERIOD_PATTERN = r"^(0[1-9]|1[0-2])[0-9]{4}\z"
HISTORY_PERIOD_PATTERN = r"^(0[1-9]|1[0-2])(19|20)[0-9]{2}\z"
QUARTER_NAMES = {1: "jan_mar", 2: "apr_jun", 3: "jul_sep", 4: "oct_dec"}


# --- run parameters (plain values on the driver) -------------------------------------------

def parse_period(text: str | None) -> dt.date:
    """First day of an ``MMYYYY`` period; raises InvalidPeriod."""
    if text is None or not re.fullmatch(r"(0[1-9]|1[0-2])[0-9]{4}", text) or text.endswith("0000"):
        raise InvalidPeriod(f"return period must be MMYYYY, got {text!r}")
    return dt.date(int(text[2:]), int(text[:2]), 1)


def shift_period(text: str, months: int) -> str:
    """The period ``months`` later (earlier if negative)."""
    day = parse_period(text)
    index = day.year * 12 + day.month - 1 + months
    return f"{index % 12 + 1:02d}{index // 12:04d}"


def quarter_of(text: str) -> tuple[str, str]:
    """(yy, quarter name) of a period parameter."""
    day = parse_period(text)
    return text[4:], QUARTER_NAMES[(day.month - 1) // 3 + 1]


def ends_quarter(text: str) -> bool:
    return parse_period(text).month % 3 == 0


# --- columns -------------------------------------------------------------------------------

def is_valid_period(period: Column) -> Column:
    return F.coalesce(period.rlike(PERIOD_PATTERN), F.lit(False))


def first_day(period: Column, pattern: str = PERIOD_PATTERN) -> Column:
    """First day of the period; NULL for text that is not a period.

    The pattern is tested first because date parsing throws on bad text in ANSI mode.
    """
    return F.when(
        period.rlike(pattern),
        F.make_date(period.substr(3, 4).cast("int"), period.substr(1, 2).cast("int"), F.lit(1)),
    )


def format_period(day: Column) -> Column:
    return F.date_format(day, "MMyyyy")


def previous_period(period: Column) -> Column:
    return format_period(F.add_months(first_day(period), -1))


def effective_date(period_date: Column, period: Column) -> Column:
    """The stored date of a row, or day 1 of its period where the date is missing."""
    return F.coalesce(period_date, first_day(period))


def month_index(day: Column) -> Column:
    """Months since year 0; consecutive months differ by one."""
    return F.year(day) * 12 + F.month(day) - 1


def quarter_name(period: Column) -> Column:
    quarter = F.quarter(first_day(period))
    chain = F.when(quarter == 1, QUARTER_NAMES[1])
    for number in (2, 3, 4):
        chain = chain.when(quarter == number, QUARTER_NAMES[number])
    return chain


def short_year(period: Column) -> Column:
    return F.when(is_valid_period(period), period.substr(5, 2))


def is_quarter_end(period: Column) -> Column:
    return F.month(first_day(period)) % 3 == 0
