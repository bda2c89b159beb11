"""Windows against a brute-force self-join, with repeated rows, missing dates and other edges."""

import random
from decimal import ROUND_HALF_UP, Decimal

import pytest
from helpers import collect, exchanged, month, row, summary

from returns_analytics.operators.growth import (
    MOST_ROWS,
    average_columns,
    dated_rows,
    farther_rows,
    growth_columns,
    growth_history,
    taxpayers_above,
)
from returns_analytics.parity.fixtures import BY_ROW
from returns_analytics.parity.queries import CATALOG
from returns_analytics.plans.pipelines import growth_analytics

COLUMNS = {"taxable": "taxable_value", "output_tax": "total_output_tax", "itc": "eligible_itc", "cash": "cash_tax_paid"}


def random_rows(repeats, seed=7):
    rng = random.Random(seed)
    rows = []
    for gstin in ("A", "B", "C"):
        for index in range(12 * 1999, 12 * 1999 + 30):
            for _ in range(rng.choice([0, 1, 1, 1, 2] if repeats else [0, 1, 1, 1])):
                period = f"{index % 12 + 1:02d}{index // 12}"
                values = {c: rng.choice([None, 0, rng.randint(-500, 5000) / 4]) for c in COLUMNS.values()}
                rows.append(row(gstin, period, dated=rng.random() > 0.15, filing_delay_days=rng.randint(0, 9), **values))
    return rows


def rounded(value, places):
    return None if value is None else value.quantize(Decimal(1).scaleb(-places), rounding=ROUND_HALF_UP)


def brute(rows):
    """Growth and averages of every row from all rows of the taxpayer."""
    result = []
    for r in rows:
        day = r["period_date"] or month(r["ret_period"])
        seen = [x for x in rows if x["gstin"] == r["gstin"] and x["period_date"] is not None]

        def back(x):
            return (day.year - x["period_date"].year) * 12 + day.month - x["period_date"].month

        out = [r["gstin"], r["ret_period"]]
        for months in (1, 12):
            for column in COLUMNS.values():
                base = [x[column] for x in seen if back(x) == months and x[column] is not None]
                base = Decimal(str(max(base))) if base else None
                current = Decimal(str(r[column] or 0))
                out.append(rounded((current - base) / abs(base), 6) if base else None)
        for name in ("taxable", "output_tax", "itc"):
            for span in (3, 6, 12):
                values = [Decimal(str(x[COLUMNS[name]])) for x in seen if 0 <= back(x) < span and x[COLUMNS[name]] is not None]
                out.append(rounded(sum(values) / len(values), 6) if values else None)
        result.append(tuple(out))
    return sorted(result, key=str)


NAMES = ["gstin", "ret_period", *growth_columns(), *average_columns()]


@pytest.mark.parametrize("repeats", [False, True])
def test_windows_equal_self_join(spark, repeats):
    rows = random_rows(repeats)
    assert collect(growth_analytics(summary(spark, rows)), *NAMES) == brute(rows)


def test_one_shuffle_plan_gives_the_same(spark):
    rows = random_rows(False)
    assert collect(growth_analytics(summary(spark, rows), unique_rows=True), *NAMES) == brute(rows)


@pytest.mark.parametrize("unique", [False, True])
def test_period_by_period_equals_all_at_once(spark, unique):
    table = summary(spark, random_rows(False, seed=3))
    whole = collect(growth_analytics(table), *NAMES)
    periods = ["051999", "012000", "062001"]
    assert collect(growth_analytics(table, periods, unique), *NAMES) == [r for r in whole if r[1] in periods]
    assert collect(growth_analytics(table, ["032000"], unique), *NAMES) == [r for r in whole if r[1] == "032000"]


def test_row_without_date_sees_history_but_is_never_seen(spark):
    table = summary(spark, [
        row("A", "012000", taxable_value=100), row("A", "022000", dated=False, taxable_value=150),
        row("A", "032000", taxable_value=300)])
    got = {r.ret_period: r for r in growth_analytics(table).collect()}
    assert got["022000"].mom_taxable_growth == Decimal("0.5")
    assert got["022000"].period_date == month("022000")
    assert got["022000"].avg_3m_taxable == Decimal("100")  # its own amount is not in its average
    assert got["032000"].mom_taxable_growth is None
    assert got["032000"].avg_3m_taxable == Decimal("200")


def test_rows_without_taxpayer_or_period_are_not_produced(spark):
    table = summary(spark, [
        row(None, "012000", taxable_value=1), row("A", "022000", taxable_value=2),
        {"gstin": "A", "ret_period": "bad", "period_date": month("012000"), "taxable_value": 1},
        {"gstin": "A", "ret_period": "bad", "taxable_value": 9}])
    got = growth_analytics(table).collect()
    assert [(r.gstin, r.ret_period) for r in got] == [("A", "022000")]
    assert got[0].mom_taxable_growth == Decimal("1")  # a dated row is history whatever its period says


def test_empty_period(spark):
    table = summary(spark, [row("A", "012000", taxable_value=1)])
    assert growth_analytics(table, ["022000"]).count() == 0


def test_dates_off_the_first_day_must_match_exactly(spark):
    table = summary(spark, [
        {"gstin": "A", "ret_period": "012000", "period_date": month("012000").replace(day=15), "taxable_value": 10},
        row("A", "022000", taxable_value=20)])
    got = {r.ret_period: r for r in growth_history(table).collect()}
    assert got["022000"].mom_taxable_value is None
    assert got["022000"].avg_3m_taxable == Decimal("15")


@pytest.mark.parametrize("unique", [False, True])
def test_rows_dated_elsewhere_bring_their_own_history(spark, unique):
    """A return of 062000 dated in 2000-03 of another year sees what its date sees."""
    table = summary(spark, [
        row("A", "031999", taxable_value=100), {**row("A", "062000", taxable_value=200), "period_date": month("032000")},
        row("B", "062000", taxable_value=5), row("B", "061900", taxable_value=4),
        {**row("C", "062000", taxable_value=7), "period_date": month("011900")},
        row("C", "011899", taxable_value=70), row("D", "011899", taxable_value=1)])
    want = [r for r in collect(growth_analytics(table, None, unique), *NAMES, "growth_trend") if r[1] == "062000"]
    assert collect(growth_analytics(table, ["062000"], unique), *NAMES, "growth_trend") == want
    got = {r.gstin: r for r in growth_analytics(table, ["062000"], unique).collect()}
    assert got["A"].growth_trend == "STRONG_GROWTH" and got["C"].yoy_taxable_growth == Decimal("-0.9")
    assert collect(farther_rows(table, ["062000"]), "gstin", "ret_period") == [("A", "031999"), ("C", "011899")]


def test_random_rows_dated_elsewhere(spark):
    rng = random.Random(11)
    rows = random_rows(True, seed=4)
    for r in rows:
        if rng.random() < 0.3 and r["period_date"]:
            r["period_date"] = month(f"{rng.randint(1, 12):02d}{rng.randint(1998, 2001)}")
    table = summary(spark, rows)
    whole = collect(growth_analytics(table), *NAMES)
    assert whole == brute(rows)
    for periods in (["062000"], ["032000", "011999"]):
        assert collect(growth_analytics(table, periods), *NAMES) == [r for r in whole if r[1] in periods]


@pytest.mark.parametrize("most", [0, 40, 4096])
@pytest.mark.parametrize("wanted", [None, ["062000", "012001"]])
def test_large_taxpayers_apart_equal_the_default_plan(spark, most, wanted):
    """Repeated and undated rows; with 40 some taxpayers are above the bound, with 0 all, with 4096 none."""
    rows = random_rows(True) + [r for r in random_rows(True, 8) if r["gstin"] == "A"]
    rows += [row(None, "062000", taxable_value=1), {"gstin": "A", "ret_period": "bad", "period_date": None}]
    table = summary(spark, rows)
    sizes = taxpayers_above(dated_rows(table), 40).count()
    assert 0 < sizes < 3
    want, got = growth_analytics(table, wanted), growth_analytics(table, wanted, most_rows=most)
    assert set(got.columns) == set(want.columns)
    assert collect(got, *want.columns) == collect(want, *want.columns)


def test_small_taxpayers_are_dealt_once(spark, small):
    """Of the stored growth table's plan, each return is moved by taxpayer once, beside a count per task and taxpayer."""
    rows = small.table("summary")
    size, taxpayers = rows.count(), rows.select("gstin").distinct().count()
    frame = growth_analytics(rows, most_rows=MOST_ROWS)
    assert len(frame.collect()) == size
    counts = taxpayers * rows.rdd.getNumPartitions()
    assert size <= exchanged(frame, "gstin") <= size + counts
    plain = growth_analytics(rows)
    plain.collect()
    assert exchanged(plain, "gstin") >= 2 * size > size + counts


@pytest.mark.parametrize("name", BY_ROW)
def test_tables_by_row_are_not_dealt_again(small, name):
    """What is derived row by row from a table stored by period lies in about as many files as that has."""
    if name == "risk":
        CATALOG["run_summary"].plan(small)
    table, source = small.keep(name, lambda: small._derive(name)), small.table("summary")
    assert table.select("ret_period").distinct().count() == source.select("ret_period").distinct().count()
    assert len(table.inputFiles()) <= 3 * len(source.inputFiles())
