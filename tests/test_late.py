"""Late returns against a full recomputation."""

import random

import pytest
from helpers import collect, month, row, summary
from test_growth import COLUMNS, NAMES

from returns_analytics.operators import late
from returns_analytics.plans.pipelines import growth_analytics

SHOWN = [*NAMES, "period_date", "taxable_value", "growth_trend"]


def two_states(seed):
    """Rows before and after random arrivals, withdrawals, corrections and moves of some taxpayers."""
    rng = random.Random(seed)
    before, after = [], []
    for gstin in "ABCDEFGH":
        for index in range(12 * 1999, 12 * 1999 + 40):
            values = {c: rng.choice([None, 0, rng.randint(-500, 5000) / 4]) for c in COLUMNS.values()}
            r = row(gstin, f"{index % 12 + 1:02d}{index // 12}", dated=rng.random() > 0.1, filing_delay_days=1, **values)
            kind = rng.random() if gstin in "ABC" else 1
            if kind > 0.04:
                before.append(dict(r))
            if kind < 0.02 or kind > 0.06:
                if 0.06 < kind < 0.08:
                    r["taxable_value"] = 77
                elif 0.08 < kind < 0.1:
                    r["period_date"] = month(f"{rng.randint(1, 12):02d}{rng.randint(1998, 2003)}")
                after.append(r)
    return before, after


@pytest.mark.parametrize("seed", range(3))
def test_equals_full_recomputation(spark, seed):
    before, after = (summary(spark, rows) for rows in two_states(seed))
    changes = late.changed_dates(before, after)
    rows = late.late_growth(after, changes)
    merged = late.merge_late_growth(growth_analytics(before), rows, changes, None)
    assert collect(merged, *SHOWN) == collect(growth_analytics(after), *SHOWN)
    assert {r.gstin for r in changes.collect()} <= set("ABC")
    history = late.affected_history(after, changes)
    assert {r.gstin for r in history.select("gstin").distinct().collect()} <= set("ABC")


def test_only_the_reach_is_computed(spark):
    rows = [row(g, f"{i % 12 + 1:02d}{i // 12}", taxable_value=i) for g in "AB" for i in range(12 * 1995, 12 * 2005)]
    table = summary(spark, rows)
    changes = late.late_dates(summary(spark, [row("A", "062000")]))
    got = [(r.gstin, r.ret_period) for r in late.late_growth(table, changes).collect()]
    reach = [i for i in range(12 * 2000 + 5, 12 * 2001 + 6)]
    assert sorted(got) == sorted(("A", f"{i % 12 + 1:02d}{i // 12}") for i in reach)
    # the windows see two years of one taxpayer
    assert late.affected_history(table, changes).count() == 25


def test_unchanged_tables_and_other_columns(spark):
    table = summary(spark, [row("A", "012000", taxable_value=1), row("A", "012000", taxable_value=1)])
    assert late.changed_dates(table, table).count() == 0
    once = summary(spark, [row("A", "012000", taxable_value=1)])
    assert collect(late.changed_dates(once, table), "gstin", "changed_date") == [("A", month("012000"))]
    other = summary(spark, [row("A", "012000", taxable_value=1, reversed_itc=5)])
    assert late.changed_dates(once, other).count() == 0
    assert late.late_growth(table, late.changed_dates(table, table)).count() == 0


def test_month_ends(spark):
    """The reach is the windows' own: 29 February looks back to 28 February."""
    rows = [{**row("A", "021999", taxable_value=10), "period_date": month("021999").replace(day=28)},
            {**row("A", "022000", taxable_value=30), "period_date": month("022000").replace(day=29)}]
    after = summary(spark, rows)
    changes = late.changed_dates(summary(spark, rows[1:]), after)
    merged = late.merge_late_growth(growth_analytics(summary(spark, rows[1:])), late.late_growth(after, changes), changes, None)
    assert collect(merged, *SHOWN) == collect(growth_analytics(after), *SHOWN)
