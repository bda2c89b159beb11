"""Threshold bands and labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from returns_analytics.functions.keys import normalise

# Labels and thresholds.
#   yearly taxable growth (ratio): NA if none, >= .20, >= .05, > -.05, > -.20, else
#   office growth (percent): one percent separates a move from stability
#   risk score 0..1, default score 0..100
RISK_THRESHOLDS = (0.80, 0.60, 0.35)
RISK_BANDS = ("CRITICAL", "HIGH", "MEDIUM", "LOW")
DEFAULT_THRESHOLDS = (75, 50, 25)
DEFAULT_LEVELS = ("CRITICAL", "HIGH", "WARNING", "NORMAL")
OFFICE_MOVE = 1


def _decimal(text: str) -> Column:
    return F.lit(text).cast("decimal(4,2)")


def growth_trend(yearly_growth: Column) -> Column:
    return (
        F.when(yearly_growth.isNull(), "NA")
        .when(yearly_growth >= _decimal("0.20"), "STRONG_GROWTH")
        .when(yearly_growth >= _decimal("0.05"), "GROWTH")
        .when(yearly_growth > _decimal("-0.05"), "STABLE")
        .when(yearly_growth > _decimal("-0.20"), "DECLINE")
        .otherwise("STRONG_DECLINE")
    )


def office_trend(monthly: Column, yearly: Column) -> Column:
    """Direction of an office: both growths must agree where both exist."""
    up, down = F.lit(OFFICE_MOVE), F.lit(-OFFICE_MOVE)
    either = F.coalesce(monthly, yearly)
    one_sided = F.when(either >= up, "UPWARD").when(either <= down, "DOWNWARD").otherwise("STABLE")
    return (
        F.when(either.isNull(), "NO_BASE")
        .when(monthly.isNull() | yearly.isNull(), one_sided)
        .when((monthly >= up) & (yearly >= up), "UPWARD")
        .when((monthly <= down) & (yearly <= down), "DOWNWARD")
        .when((F.abs(monthly) < up) & (F.abs(yearly) < up), "STABLE")
        .otherwise("MIXED")
    )


def office_status(monthly: Column, yearly: Column) -> Column:
    growth = F.coalesce(monthly, yearly)
    return (
        F.when(growth.isNull(), "NO_BASE")
        .when(growth >= 15, "HIGH")
        .when(growth >= 5, "MEDIUM")
        .when(growth > 0, "LOW")
        .when(growth <= -OFFICE_MOVE, "DECLINING")
        .otherwise("STABLE")
    )


def _band(value: Column, thresholds: Sequence, labels: Sequence[str]) -> Column:
    """Label of the first threshold (highest first) the value reaches, else the last label."""
    chain = F.when(value >= F.lit(thresholds[0]), labels[0])
    for threshold, label in zip(thresholds[1:], labels[1:]):
        chain = chain.when(value >= F.lit(threshold), label)
    return chain.otherwise(labels[-1])


def risk_band(score: Column, thresholds: Sequence[float] = RISK_THRESHOLDS) -> Column:
    return _band(score, thresholds, RISK_BANDS)


def default_level(score: Column) -> Column:
    """NULL without a score."""
    return F.when(score.isNotNull(), _band(score, DEFAULT_THRESHOLDS, DEFAULT_LEVELS))


def _label(text: Column) -> Column:
    return F.translate(normalise(text), "- ", "__")


def growth_label(text: Column) -> Column:
    """Upper case with underscores; the older name of a strong decline is mapped to the current one."""
    label = _label(text)
    return F.when(label == "SHARP_DECLINE", "STRONG_DECLINE").otherwise(label)


def existing_level_or_derived(level: Column, score: Column) -> Column:
    """A known level is kept; any other text (or none) is replaced by the level of the score."""
    label = _label(level)
    return F.when(label.isin(*DEFAULT_LEVELS), label).otherwise(default_level(score))
