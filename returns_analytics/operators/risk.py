"""Risk features, validity, scores and bands per return. All of it is narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from returns_analytics.functions.amounts import clipped_ratio
from returns_analytics.functions.bands import RISK_THRESHOLDS, risk_band
from returns_analytics.functions.periods import is_valid_period
from returns_analytics.operators.trees import TreeModel, score
from returns_analytics.sources.tables import period_slices

# The features of the model in training order. Ten amounts, then eight ratios.
AMOUNTS = (
    "taxable_value", "total_output_tax", "eligible_itc", "utilized_itc", "reversed_itc", "ineligible_itc",
    "excess_itc", "rcm_total_tax", "cash_tax_paid", "itc_payment_total",
)
RATIOS = (
    "itc_utilization_ratio", "cash_payment_ratio", "itc_payment_ratio", "itc_to_tax_ratio", "nil_supply_ratio",
    "rcm_to_tax_ratio", "rcm_itc_ratio", "rcm_cash_ratio",
)
FEATURES = AMOUNTS + RATIOS

#: numerator and denominator of the derived ratios
_DERIVED = {
    "itc_utilization_ratio": ("utilized_itc", "eligible_itc"),
    "cash_payment_ratio": ("cash_tax_paid", "total_output_tax"),
    "itc_payment_ratio": ("itc_payment_total", "total_output_tax"),
    "itc_to_tax_ratio": ("eligible_itc", "total_output_tax"),
    "rcm_to_tax_ratio": ("rcm_total_tax", "total_output_tax"),
    "rcm_itc_ratio": ("rcm_total_tax", "eligible_itc"),
    "rcm_cash_ratio": ("rcm_total_tax", "cash_tax_paid"),
}


def risk_features(summary: DataFrame, periods: Iterable[str] | None = None) -> DataFrame:
    """The 18 features of every return as doubles, NULL amounts as 0."""
    given = [F.coalesce(F.col(name).cast("double"), F.lit(0.0)).alias(name) for name in (*AMOUNTS, "nil_supply_ratio")]
    rows = (
        period_slices(summary, periods)
        .filter(is_valid_period(F.col("ret_period")))
        .select("gstin", "ret_period", *given)
    )
    ratios = {name: clipped_ratio(F.col(over), F.col(under)) for name, (over, under) in _DERIVED.items()}
    return rows.withColumns(ratios).select("gstin", "ret_period", *FEATURES)


def infinite_feature() -> Column:
    """Number (from 1) of the first feature that is infinite as a 32-bit float; NULL if none. NaN is allowed.

    Only features that are given can be infinite: the derived ratios are clipped.
    """
    infinite = F.lit(float("inf"))
    return F.coalesce(*[
        F.when(F.abs(F.col(name).cast("float")) == infinite, F.lit(number))
        for number, name in enumerate(FEATURES, start=1)
        if name not in _DERIVED
    ])


def reject_reason() -> Column:
    """Why a return cannot be scored; NULL if it can.

    It does not look at the score, so a filter on it never evaluates the model. A model that could
    give no finite score is refused before it is used (operators.trees.check_model).
    """
    number = infinite_feature().cast("string")
    return F.concat(F.lit("Feature "), number, F.lit(" contains infinite value"))


def scored_returns(
    summary: DataFrame,
    model: TreeModel,
    periods: Iterable[str] | None = None,
    arrow: bool = False,
) -> DataFrame:
    """Every return with its score or the reason it has none."""
    reason = F.col("reject_reason")
    return risk_features(summary, periods).withColumn("reject_reason", reject_reason()).withColumn(
        "risk_score", F.when(reason.isNull(), score(model, arrow))
    )


def risk_profile_of(
    scored: DataFrame, model: TreeModel, thresholds: Sequence[float] = RISK_THRESHOLDS
) -> tuple[DataFrame, DataFrame]:
    """(profile, rejects) of scored returns."""
    profile = scored.filter(F.col("reject_reason").isNull()).select(
        "gstin",
        "ret_period",
        "risk_score",
        risk_band(F.col("risk_score"), thresholds).alias("risk_level"),
        F.lit(model.name).alias("model_name"),
        F.lit(model.version).alias("model_version"),
        F.lit(model.feature_version).alias("feature_version"),
    )
    rejects = scored.filter(F.col("reject_reason").isNotNull()).select(
        "gstin", "ret_period", F.col("reject_reason").alias("error_message")
    )
    return profile, rejects
