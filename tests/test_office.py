"""Office totals and growth."""

import datetime as dt
from decimal import Decimal

from helpers import exchanged, month, row, summary

from returns_analytics.operators.office import office_growth, office_totals
from returns_analytics.plans.pipelines import office_revenue


def masters(spark):
    dealer = spark.createDataFrame(
        [("A", "001"), ("A", "002"), ("A", None), ("B", "001"), ("C", None), ("D", "009"), (None, "001")],
        "gstin string, st_juri string")
    juri = spark.createDataFrame(
        [("001", "WEST"), ("001", "EAST"), ("002", "NORTH"), (None, "X")], "jurisdiction_code string, jurisdiction_name string")
    return dealer, juri


def test_totals(spark):
    table = summary(spark, [
        row("A", "012000", taxable_value=10, total_output_tax=None, output_igst=4),
        row("A", "012000", taxable_value=5, total_output_tax=2),
        row("B", "012000", taxable_value=None, total_output_tax=3),
        row("C", "012000", taxable_value=100), row("D", "012000", taxable_value=100),
        row("E", "012000", taxable_value=100), row(None, "012000", taxable_value=100),
        row("B", "022000", taxable_value=7)])
    got = {(r.ret_period, r.st_juri): r for r in office_totals(table, *masters(spark)).collect()}
    assert set(got) == {("012000", "002"), ("012000", "001"), ("022000", "001")}
    north = got["012000", "002"]  # the largest office code of A
    assert (north.filed_gstins, north.taxable_value, north.output_tax, north.igst) == (1, 15, 2, 4)
    assert north.period_date == dt.date(2000, 1, 1)
    west = got["012000", "001"]
    assert (west.office_name, west.filed_gstins, west.taxable_value, west.output_tax) == ("WEST", 1, 0, 3)


def stored(spark, rows):
    return spark.createDataFrame(
        [(p, j, month(p), None if t is None else Decimal(t), Decimal(1)) for p, j, t in rows],
        "ret_period string, st_juri string, period_date date, output_tax decimal(28,2), cash_tax_paid decimal(28,2)")


def test_growth_replaces_produced_periods(spark):
    table = summary(spark, [row("B", "032000", total_output_tax=110, cash_tax_paid=1)])
    totals = office_totals(table, *masters(spark))
    history = stored(spark, [
        ("022000", "001", "100"), ("032000", "001", "999"), ("032000", "007", "5"), ("031999", "001", "55"),
        ("012000", "001", None), ("122000", "001", "77")])
    for periods in (None, ["032000"]):
        (got,) = office_growth(totals, history, periods).collect()
        assert got.mom_output_growth == Decimal("10") and got.yoy_output_growth == Decimal("100")
        # three months are present and the stored NULL counts as 0: (110 + 100 + 0) / 3
        assert got.avg_output_tax_3m == Decimal("70")
        assert got.avg_output_tax_12m == Decimal("70")
        assert (got.growth_trend, got.growth_status) == ("UPWARD", "MEDIUM")


def test_periods_at_once_equal_one_after_the_other(spark):
    rows = [row("B", f"{m:02d}2000", total_output_tax=100 + 7 * m, cash_tax_paid=m) for m in range(1, 9)]
    table, (dealer, juri) = summary(spark, rows), masters(spark)
    whole = {r.ret_period: r for r in office_revenue(table, dealer, juri).collect()}
    kept = office_revenue(table, dealer, juri, None, ["012000"])
    for m in range(2, 9):
        period = f"{m:02d}2000"
        fresh = office_revenue(table, dealer, juri, kept, [period])
        assert fresh.collect() == [whole[period]]
        kept = spark.createDataFrame(kept.collect() + fresh.collect(), kept.schema)


def test_totals_move_no_row_per_taxpayer(spark):
    """What leaves a task grows with periods, offices and blocks of taxpayers, not with the returns."""
    few, many = [
        [row(f"{n:05d}", f"{m:02d}2000", taxable_value=n, total_output_tax=1) for n in range(size) for m in (1, 2, 2)]
        for size in (40, 400)]
    juri = spark.createDataFrame([(f"{j:03d}", f"OFFICE {j}") for j in range(4)], "jurisdiction_code string, jurisdiction_name string")
    moved = []
    for rows in (few, many):
        size = len(rows) // 3
        dealer = spark.createDataFrame([(f"{n:05d}", f"{n % 4:03d}") for n in range(size)], "gstin string, st_juri string")
        # without the registrations, whose exchange is one row per taxpayer
        frame = office_totals(summary(spark, rows).coalesce(2), dealer, juri)
        got = {(r.ret_period, r.st_juri): (r.filed_gstins, r.output_tax, r.taxable_value) for r in frame.collect()}
        assert got == {
            (f"{m:02d}2000", f"{j:03d}"): (size // 4, m * size // 4, m * sum(range(j, size, 4)))
            for m in (1, 2) for j in range(4)}
        moved.append(exchanged(frame, "ret_period"))
    assert moved[0] == moved[1]
