"""Selection of the population, picks, joins and evaluation."""

import datetime as dt
from decimal import Decimal

import pytest
from helpers import collect, month, row, summary

from returns_analytics.errors import DueDateError
from returns_analytics.operators import defaulters
from returns_analytics.plans import pipelines

PERIOD, DUE, AS_OF = "062000", dt.date(2000, 7, 20), dt.date(2000, 8, 15)
G = [f"19ABCDE123{i}F1Z5" for i in range(8)]


def registration(spark, rows):
    return spark.createDataFrame(rows, "gstin_id string, state_jursd_cd string, auth_status string, pref string")


def test_population(spark):
    table = registration(spark, [
        (G[0].lower(), "001", "A", "m"), (G[0], "002", "A", "Q"), (G[1], "001", "A", "Q"), (G[2], "001", "C", "M"),
        (None, "001", "A", "M"), (G[3], None, "A", " M"), (G[4], "001", "A", None)])
    assert collect(defaulters.eligible(table, "062000"), "gstin", "st_juri") == [
        (G[0], "002"), (G[1], "001"), (G[3], None), (G[4], "001")]
    # between quarter ends only monthly filers; the preference is not trimmed
    assert collect(defaulters.eligible(table, "052000"), "gstin", "st_juri") == [(G[0], "001")]
    assert defaulters.eligible_count(table, "062000").first().eligible == 4


def test_due_date(spark):
    due = spark.createDataFrame(
        [("GSTR3B", "062000", DUE, "Y"), ("GSTR3B", "062000", AS_OF, "N"), ("GSTR1", "062000", AS_OF, "Y"),
         ("GSTR3B", "062000", None, "Y"), ("GSTR3B", "072000", DUE, "Y"), ("GSTR3B", "072000", AS_OF, "Y")],
        "return_type string, ret_period string, effective_due_date date, active_flag string")
    assert defaulters.required_due_date(due, "062000") == DUE
    for period in ("072000", "082000"):
        with pytest.raises(DueDateError):
            defaulters.required_due_date(due, period)


def test_latest_return(spark):
    table = summary(spark, [
        row("A", PERIOD, filing_date=None, taxable_value=9), row("A", PERIOD, filing_date=DUE, taxable_value=1),
        row("A", PERIOD, filing_date=DUE, taxable_value=2), row("A", "052000", filing_date=AS_OF, taxable_value=3),
        row("B", PERIOD, filing_date=None, taxable_value=4), row(None, PERIOD, filing_date=DUE)])
    assert collect(defaulters.latest_return(table, PERIOD), "gstin", "filing_date", "taxable_value") == [
        ("A", DUE, Decimal("2.00")), ("B", None, Decimal("4.00"))]


def world(spark):
    """Filer, late filer, non-filers with and without history, and records to set aside."""
    filed = DUE - dt.timedelta(5)
    table = summary(spark, [
        row(G[0], PERIOD, filing_date=filed, taxable_value=100, total_output_tax=None, output_igst=5, output_cess=2),
        row(G[0], "052000", filing_date=filed, taxable_value=100, total_output_tax=10),
        row(G[1], PERIOD, filing_date=DUE + dt.timedelta(31), taxable_value=50, total_output_tax=8),
        row(G[2], "042000", filing_date=filed, taxable_value=50, total_output_tax=30),
        row(G[2], "052000", filing_date=None, taxable_value=90, total_output_tax=90),
        row(G[2], "041999", filing_date=filed, taxable_value=200, total_output_tax=70),
        row(G[4], PERIOD, filing_date=None, taxable_value=1, total_output_tax=1),
        row(G[5], "051997", filing_date=filed, taxable_value=1, total_output_tax=1),
        row(G[6].lower(), PERIOD, filing_date=filed, taxable_value=1, total_output_tax=1),
    ])
    people = registration(spark, [(g, "001", "A", "M") for g in G[:7]] + [("bad key", "002", "A", "M")])
    growth = pipelines.growth_analytics(table)
    risk = spark.createDataFrame(
        [(G[0], PERIOD, "CRITICAL", 0.9), (G[0], "052000", "LOW", 0.1), (G[2], "042000", "MEDIUM", 0.5),
         (G[2], "052000", "HIGH", 0.7)],
        "gstin string, ret_period string, risk_level string, risk_score double")
    history = spark.createDataFrame(
        [(G[2], "012000", "NOT_FILED", "Y"), (G[2], "022000", "NOT_FILED", "Y"), (G[2], "032000", "NOT_FILED", "N"),
         (G[2], "042000", "FILED_LATE", "Y"), (G[2], PERIOD, "NOT_FILED", "Y"), (G[2], "991999", "NOT_FILED", "Y"),
         (G[2], "012100", "NOT_FILED", "Y"), (G[2], "011800", "NOT_FILED", "Y")],
        "gstin string, ret_period string, filing_status string, active_flag string")
    juri = spark.createDataFrame([("001", "WEST")], "jurisdiction_code string, jurisdiction_name string")
    return people, table, growth, risk, history, juri


def test_evaluation(spark):
    results, rejects = pipelines.return_defaulters(*world(spark), PERIOD, DUE, AS_OF)
    got = {r.gstin: r for r in results.collect()}
    assert set(got) == {G[i] for i in (0, 1, 2, 3, 5, 6)}
    assert results.columns == list(defaulters.RESULT_COLUMNS)

    on_time = got[G[0]]
    assert (on_time.filing_status, on_time.delay_days, on_time.output_tax) == ("FILED_ON_TIME", 0, Decimal("7.00"))
    assert (on_time.last_filed_period, on_time.risk_level, on_time.risk_score) == ("052000", "CRITICAL", Decimal("0.90"))
    assert on_time.default_score == Decimal("0.09")  # a risk score of 0..1 counts for a tenth of itself

    late = got[G[1]]
    assert (late.filing_status, late.delay_days, late.default_score) == ("FILED_LATE", 31, Decimal("20.00"))
    assert (late.last_filed_period, late.growth_status, late.risk_level) == (None, "NA", "NORMAL")

    absent = got[G[2]]
    assert (absent.filing_status, absent.delay_days, absent.notice_eligible) == ("NOT_FILED", 26, "Y")
    # 052000 has no filing date, so 042000 is the last filed period and gives growth and risk
    assert (absent.last_filed_period, absent.growth_status) == ("042000", "STRONG_DECLINE")
    assert (absent.risk_level, absent.risk_score) == ("NORMAL", Decimal("0.50"))  # MEDIUM is no level here
    assert absent.historical_default_count == 2
    assert absent.avg_output_tax_3m == Decimal("30.00")
    assert absent.default_score == Decimal("40") + 5 + 8 + 8 + Decimal("0.05")
    assert absent.office_name == "WEST"

    # nothing known, a return beyond the lookback, and a lower-case key that does not match
    for g in (G[3], G[5], G[6]):
        assert (got[g].filing_status, got[g].last_filed_period, got[g].default_score) == ("NOT_FILED", None, Decimal("45.00"))

    assert collect(rejects, "gstin", "error_code") == [(G[4], "FILING_DATE_MISSING"), ("BAD KEY", "INVALID_GSTIN")]


def test_not_due_on_the_due_date(spark):
    results, rejects = pipelines.return_defaulters(*world(spark), PERIOD, DUE, DUE)
    got = {r.gstin: r for r in results.collect()}
    assert (got[G[2]].filing_status, got[G[2]].notice_eligible, got[G[2]].delay_days) == ("NOT_DUE", "N", 0)
    assert rejects.count() == 2


def test_lookback(spark):
    people, table, growth, risk, history, juri = world(spark)
    assert collect(defaulters.last_filed(growth, table, PERIOD), "gstin", "last_filed_period") == [
        (G[0], "052000"), (G[2], "042000")]
    # 37 months back is outside by default and inside with a longer lookback; short ones are raised to a year
    far = defaulters.last_filed(growth, table, PERIOD, months=37)
    assert (G[5], "051997") in collect(far, "gstin", "last_filed_period")
    assert [defaulters.history_months(n) for n in (12, 36, 120)] == [12, 36, 120]
    for months in (6, 240):
        with pytest.raises(ValueError):
            defaulters.history_months(months)
    assert month("051997") == dt.date(1997, 5, 1)
