"""Every band at, just below and just above its threshold; texts and dates at their edges."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from returns_analytics.errors import InvalidPeriod
from returns_analytics.functions import amounts, bands, filing, keys, periods


def column(spark, values, kind, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [row.y for row in frame.select("i", expression(F.col("x")).alias("y")).orderBy("i").collect()]


def decimals(*texts):
    return [None if text is None else Decimal(text) for text in texts]


def test_growth_trend(spark):
    values = decimals(None, "0.20", "0.199999", "0.05", "0.049999", "0", "-0.049999", "-0.05", "-0.199999", "-0.20")
    assert column(spark, values, "decimal(38,19)", bands.growth_trend) == [
        "NA", "STRONG_GROWTH", "GROWTH", "GROWTH", "STABLE", "STABLE", "STABLE", "DECLINE", "DECLINE",
        "STRONG_DECLINE"]


@pytest.mark.parametrize(("monthly", "yearly", "trend", "status"), [
    (None, None, "NO_BASE", "NO_BASE"),
    ("1.00", "1.00", "UPWARD", "LOW"),
    ("0.99", "1.00", "MIXED", "LOW"),
    ("-1.00", "-1.00", "DOWNWARD", "DECLINING"),
    ("-0.99", "-1.00", "MIXED", "STABLE"),
    ("0.99", "-0.99", "STABLE", "LOW"),
    ("5.00", "-5.00", "MIXED", "MEDIUM"),
    ("4.99", None, "UPWARD", "LOW"),
    (None, "-1.00", "DOWNWARD", "DECLINING"),
    (None, "0.99", "STABLE", "LOW"),
    ("0.00", None, "STABLE", "STABLE"),
    ("15.00", "0.00", "MIXED", "HIGH"),
    ("14.99", "2.00", "UPWARD", "MEDIUM"),
    (None, "15.00", "UPWARD", "HIGH"),
])
def test_office_bands(spark, monthly, yearly, trend, status):
    row = spark.createDataFrame([decimals(monthly, yearly)], "m decimal(28,2), y decimal(28,2)")
    got = row.select(bands.office_trend(F.col("m"), F.col("y")), bands.office_status(F.col("m"), F.col("y"))).first()
    assert tuple(got) == (trend, status)


def test_risk_band_and_thresholds(spark):
    values = [0.8, 0.7999, 0.6, 0.5999, 0.35, 0.3499, 0.0]
    assert column(spark, values, "double", bands.risk_band) == [
        "CRITICAL", "HIGH", "HIGH", "MEDIUM", "MEDIUM", "LOW", "LOW"]
    assert column(spark, [0.5], "double", lambda x: bands.risk_band(x, (0.5, 0.4, 0.3))) == ["CRITICAL"]


def test_default_level(spark):
    values = decimals("75.00", "74.99", "50.00", "49.99", "25.00", "24.99", "0.00")
    assert column(spark, values, "decimal(5,2)", bands.default_level) == [
        "CRITICAL", "HIGH", "HIGH", "WARNING", "WARNING", "NORMAL", "NORMAL"]


def test_growth_label(spark):
    values = [None, " ", "sharp-decline", "Strong Decline", "DECLINE", "declining\t"]
    assert column(spark, values, "string", bands.growth_label) == [
        None, None, "STRONG_DECLINE", "STRONG_DECLINE", "DECLINE", "DECLINING"]


def test_existing_level(spark):
    def level(text):
        return bands.existing_level_or_derived(text, F.lit(60))

    # bands of the risk profile are not levels of the defaulter step, except where the words agree
    assert column(spark, ["LOW", "MEDIUM", "high", "normal", None], "string", level) == [
        "HIGH", "HIGH", "HIGH", "NORMAL", "HIGH"]


def test_periods(spark):
    texts = ["012000", "122024", "132000", "002000", "12000", "0120001", None, "012000\n", "ab2000"]
    assert column(spark, texts, "string", periods.is_valid_period) == [True, True] + [False] * 7
    assert column(spark, texts[:3], "string", periods.first_day) == [dt.date(2000, 1, 1), dt.date(2024, 12, 1), None]
    assert column(spark, texts[:2], "string", periods.previous_period) == ["121999", "112024"]
    assert column(spark, ["032000", "042000", "092000", "102000"], "string", periods.quarter_name) == [
        "jan_mar", "apr_jun", "jul_sep", "oct_dec"]
    assert column(spark, ["032000", "042007", "xx"], "string", periods.short_year) == ["00", "07", None]
    assert column(spark, ["032000", "042000", "122000"], "string", periods.is_quarter_end) == [True, False, True]


def test_period_parameters():
    assert periods.parse_period("062000") == dt.date(2000, 6, 1)
    assert periods.shift_period("012000", -1) == "121999"
    assert periods.shift_period("122000", 13) == "012002"
    assert periods.quarter_of("062000") == ("00", "apr_jun")
    assert periods.ends_quarter("062000") and not periods.ends_quarter("052000")
    for bad in (None, "", "132000", "62000", "06200", "062000 ", "010000"):
        with pytest.raises(InvalidPeriod):
            periods.parse_period(bad)


GOOD, RELAXED = "19ABCDE1234F1Z5", "19ABCDE1234F1A5"


def test_keys(spark):
    texts = [GOOD, RELAXED, "19ABCDE1234F0Z5", GOOD.lower(), f" {GOOD}", GOOD + "\n", None]
    assert column(spark, texts, "string", lambda x: keys.is_valid_gstin(x, strict=True)) == [True] + [False] * 6
    assert column(spark, texts, "string", keys.is_valid_gstin) == [True, True] + [False] * 5
    assert column(spark, ["\t x y \n", "  ", "", None], "string", keys.normalise) == ["X Y", None, None, None]
    assert column(spark, [GOOD, "1234567", "123456", "", None], "string", keys.mask) == [
        "19*****F1Z5".replace("F1Z5", GOOD[-4:]), "12*****4567", "***", "***", "***"]


def test_money_and_scores(spark):
    values = decimals("1.005", "-1.005", "2.344999", None)
    assert column(spark, values, "decimal(22,6)", amounts.money) == decimals("1.01", "-1.01", "2.34", "0.00")
    scores = [None, -0.5, 0.125, 0.285, 99.995, 250.0, 1e-7]
    assert column(spark, scores, "double", amounts.clamp_score) == decimals(
        "0.00", "0.00", "0.13", "0.29", "100.00", "100.00", "0.00")


def test_growth_of_amounts(spark):
    frame = spark.createDataFrame(
        [decimals(*row) for row in [
            ("120", "100"), ("80", "-100"), (None, "50"), ("5", "0"), ("5", None), ("1", "3"),
            ("9999999999999999.99", "0.01")]],
        "c decimal(18,2), b decimal(18,2)")
    ratio = [row[0] for row in frame.select(amounts.growth_ratio(F.col("c"), F.col("b")).cast("decimal(28,6)")).collect()]
    assert ratio == decimals("0.2", "1.8", "-1", None, None, "-0.666667", "999999999999999998")
    percent = [row[0] for row in frame.select(amounts.growth_percent(F.col("c"), F.col("b"))).collect()]
    assert percent == decimals("20", "180", None, None, None, "-66.67", "99999999999999999800")


def test_clipped_ratio(spark):
    rows = [(1.0, 0.0), (1.0, -2.0), (100.0, 1.0), (-100.0, 1.0), (1.0, 4.0), (float("nan"), 1.0),
            (1.0, float("nan")), (0.0, 1.0)]
    frame = spark.createDataFrame(rows, "n double, d double")
    got = [row[0] for row in frame.select(amounts.clipped_ratio(F.col("n"), F.col("d"))).collect()]
    assert got[:5] == [0.0, 0.0, 9.9999, -9.9999, 0.25] and got[7] == 0.0
    assert all(value != value for value in got[5:7])


def test_output_tax_falls_back_to_the_heads(spark):
    frame = spark.createDataFrame(
        [decimals("7", "1", "2", "3", "4"), decimals(None, "1", None, "3", "4"), decimals(None, None, None, None, None)],
        "t decimal(18,2), i decimal(18,2), c decimal(18,2), s decimal(18,2), e decimal(18,2)")
    got = [row[0] for row in frame.select(amounts.output_tax(*[F.col(c) for c in "tices"])).collect()]
    assert got == decimals("7", "8", "0")


DUE = dt.date(2000, 7, 20)


def test_filing_status(spark):
    cases = [  # filed, filing date, evaluation date -> status, days, notice
        (True, DUE, DUE, "FILED_ON_TIME", 0, False),
        (True, DUE + dt.timedelta(1), DUE, "FILED_LATE", 1, False),
        (True, DUE - dt.timedelta(9), DUE, "FILED_ON_TIME", 0, False),
        (False, None, DUE, "NOT_DUE", 0, False),
        (False, None, DUE + dt.timedelta(1), "NOT_FILED", 1, True),
    ]
    frame = spark.createDataFrame([(*case[:3], DUE) for case in cases], "f boolean, d date, today date, due date")
    args = (F.col("f"), F.col("d"), F.col("due"), F.col("today"))
    status = filing.filing_status(*args)
    got = frame.select(status, filing.delay_days(*args), filing.notice_eligible(status, F.col("due"), F.col("today")))
    assert [tuple(row) for row in got.collect()] == [case[3:] for case in cases]


@pytest.mark.parametrize(("status", "delay", "past", "risk", "growth", "points"), [
    ("NOT_FILED", 90, 4, 100.0, "STRONG_DECLINE", "94.00"),
    ("NOT_FILED", 89, 0, None, None, "55.00"),
    ("NOT_FILED", 60, 0, 0.0, None, "55.00"),
    ("NOT_FILED", 59, 0, 0.0, None, "50.00"),
    ("NOT_FILED", 30, 0, 0.0, None, "50.00"),
    ("NOT_FILED", 29, 0, 0.0, None, "45.00"),
    ("FILED_LATE", 1, 0, 0.0, "DECLINING", "19.00"),
    ("FILED_LATE", 1, 0, 0.0, "DECLINE", "15.00"),
    ("FILED_ON_TIME", 0, 3, 0.0, None, "12.00"),
    ("FILED_ON_TIME", 0, 9, 0.0, None, "16.00"),
    ("FILED_ON_TIME", 0, -9, -5.0, None, "0.00"),
    ("NOT_DUE", 0, 0, 0.93, "sharp decline", "8.09"),
])
def test_default_score(spark, status, delay, past, risk, growth, points):
    frame = spark.createDataFrame(
        [(status, delay, past, risk, growth)], "s string, d int, p bigint, r double, g string")
    assert frame.select(filing.default_score(*[F.col(c) for c in "sdprg"])).first()[0] == Decimal(points)


def test_reject_codes_by_precedence(spark):
    rows = [
        ("bad", "13", None, True, None, 0.0),
        (GOOD, "13", None, True, None, 0.0),
        (GOOD, "062000", None, True, None, 0.0),
        (GOOD, "062000", DUE, True, None, float("nan")),
        (GOOD, "062000", DUE, False, None, None),
        (f" {RELAXED.lower()} ", "062000", DUE, True, DUE, 1e25),
        (None, "062000", DUE, True, DUE, 0.0),
        (GOOD, "062000", DUE, False, None, float("nan")),
        (GOOD, "062000", DUE, False, None, float("-inf")),
    ]
    frame = spark.createDataFrame(rows, "g string, p string, due date, f boolean, d date, r double")
    code = filing.reject_code(*[F.col(c) for c in ("g", "p", "due", "f", "d", "r")])
    got = [tuple(row) for row in frame.select(code, filing.reject_message(code)).collect()]
    assert [row[0] for row in got] == [
        "INVALID_GSTIN", "INVALID_RET_PERIOD", "DUE_DATE_MISSING", "FILING_DATE_MISSING", None, None, "INVALID_GSTIN",
        "CALCULATION_ERROR", "CALCULATION_ERROR"]
    assert got[4] == (None, None) and all(message for code, message in got if code)


def test_scores_of_any_size(spark):
    from returns_analytics.functions import amounts

    frame = spark.createDataFrame(
        [(x,) for x in (1e25, -1e25, float("nan"), float("inf"), None, 12.345)], "x double")
    got = [r[0] for r in frame.select(amounts.clamp_score(F.col("x"))).collect()]
    assert [None if g is None else float(g) for g in got] == [100, 0, None, None, 0, 12.35]


def test_a_filed_return_without_a_date_has_no_status(spark):
    frame = spark.createDataFrame([(True, None), (True, DUE), (False, None)], "f boolean, d date")
    case = (F.col("f"), F.col("d"), F.lit(DUE), F.lit(DUE))
    status, delay = filing.filing_status(*case), filing.delay_days(*case)
    score = filing.default_score(status, delay, F.lit(1), F.lit(5.0), F.lit("STABLE"))
    got = [tuple(r) for r in frame.select(status, delay, score.isNull()).collect()]
    assert got == [(None, None, True), ("FILED_ON_TIME", 0, False), ("NOT_DUE", 0, False)]


def test_percent_of_long_totals(spark):
    from returns_analytics.functions import amounts

    frame = spark.sql("select cast(150000000000000000000000 as decimal(26,2)) a, cast(100000000000000000000000 as decimal(26,2)) b")
    assert float(frame.select(amounts.growth_percent(F.col("a"), F.col("b"))).first()[0]) == 50.0
