"""Money, scores, growth and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from returns_analytics.schemas import AMOUNT, PERCENT, SCORE

# Fixed value: bound of every derived ratio.
RATIO_BOUND = 9.9999

#: totals of up to 18 integer digits are divided with 17 digits after the point, longer ones (up to
#: the 24 of an office total) with 12
_DIVIDEND, _LONG_DIVIDEND, _SHORT = "decimal(20,2)", "decimal(26,2)", 10**18


def zero_if_null(amount: Column) -> Column:
    return F.coalesce(amount, F.lit(0).cast(AMOUNT))


def money(amount: Column) -> Column:
    """Two digits, half-up; NULL becomes 0.00."""
    return F.round(F.coalesce(amount, F.lit(0)), 2).cast(AMOUNT)


def clamp_score(score: Column) -> Column:
    """0..100 with two digits half-up; NULL and negative become 0.00, NaN and infinity NULL.

    It is clamped before it becomes a decimal, so no size of a number fails. A double is cast to
    decimal through its shortest text, so it rounds half-up as printed.
    """
    within = F.least(F.greatest(F.coalesce(score, F.lit(0)), F.lit(0)), F.lit(100)).cast("decimal(38,18)")
    return F.when(is_number(score), F.round(within, 2).cast(SCORE))


def is_number(score: Column) -> Column:
    """Neither NaN nor infinite; true for NULL."""
    value = F.coalesce(score, F.lit(0)).cast("double")
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def output_tax(total: Column, igst: Column, cgst: Column, sgst: Column, cess: Column) -> Column:
    """The stored total, or the sum of the four heads where it is missing."""
    heads = zero_if_null(igst) + zero_if_null(cgst) + zero_if_null(sgst) + zero_if_null(cess)
    return F.coalesce(total, heads.cast(AMOUNT))


def growth_ratio(current: Column, base: Column) -> Column:
    """(current - base) / |base| unrounded; NULL where the base is NULL or 0."""
    base = base.cast(AMOUNT)
    return F.when(base != 0, (zero_if_null(current).cast(AMOUNT) - base) / F.abs(base))


def growth_percent(current: Column, base: Column) -> Column:
    """Percent growth, rounded to 8 digits as a ratio and then to 2 as a percent, half-up."""

    def ratio(kind: str) -> Column:
        now, before = current.cast(kind), base.cast(kind)
        return F.round((now - before) / F.abs(before), 8)

    short = (F.abs(current) < _SHORT) & (F.abs(base) < _SHORT)
    value = F.when(short, ratio(_DIVIDEND)).otherwise(ratio(_LONG_DIVIDEND))
    return F.when(base != 0, F.round(value * 100, 2).cast(PERCENT))


def clipped_ratio(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator as double within +-9.9999; 0 unless the denominator is positive."""
    value = F.when(denominator <= 0.0, F.lit(0.0)).otherwise(numerator / denominator)
    # NaN sorts above every number in Spark, so it is passed on before the comparisons
    return (
        F.when(F.isnan(value), value)
        .when(value > RATIO_BOUND, F.lit(RATIO_BOUND))
        .when(value < -RATIO_BOUND, F.lit(-RATIO_BOUND))
        .otherwise(value)
    )
