"""Distinct taxpayers from bitmaps."""

import random
import re

from helpers import collect, row, summary

from returns_analytics.operators import bitmaps


def tables(spark, seed=5):
    rng = random.Random(seed)
    rows = [row(f"{k:05d}", f"{rng.randint(1, 12):02d}{rng.choice([1999, 2000])}") for k in range(300) for _ in range(rng.randint(0, 6))]
    rows += [row(None, "012000"), row("00001", "bad", dated=False), row("99999", "012000")]
    dealer = [(f"{k:05d}", f"{k % 7:03d}") for k in range(300)] + [("00002", "006"), (None, "001"), ("00003", None)]
    juri = [(f"{k:03d}", f"office {k}") for k in range(6)] + [(None, "nowhere"), ("000", "office 0 again")]
    return (rows, summary(spark, rows), spark.createDataFrame(dealer, "gstin string, st_juri string"),
            spark.createDataFrame(juri, "jurisdiction_code string, jurisdiction_name string"))


def brute(rows):
    office = {f"{k:05d}": k % 7 for k in range(300)} | {"00002": 6}
    seen = {}
    for r in rows:
        code, period = office.get(r["gstin"]), r["ret_period"]
        if code is None or code == 6 or period == "bad":
            continue
        seen.setdefault((period[2:], (int(period[:2]) + 2) // 3, f"{code:03d}"), set()).add(r["gstin"])
    return seen


def test_quarters_and_years(spark):
    rows, table, dealer, juri = tables(spark)
    ids = bitmaps.taxpayer_ids(table)
    bits = bitmaps.with_calendar(bitmaps.filer_bitmaps(table, ids, dealer, juri))
    seen = brute(rows)
    got = collect(bitmaps.distinct_filers(bits, "year", "quarter", "st_juri"), "year", "quarter", "st_juri", "filed_gstins")
    assert got == sorted(((*k, len(v)) for k, v in seen.items()), key=str)
    for year in ("1999", "2000"):
        want = len(set().union(*[v for k, v in seen.items() if k[0] == year]))
        assert bitmaps.distinct_filers(bits, "year").filter(f"year = '{year}'").first().filed_gstins == want
    some = bitmaps.filer_bitmaps(table, ids, dealer, juri, ["012000"])
    assert {r.ret_period for r in some.collect()} == {"012000"}


def test_ids_are_dense_and_stay(spark):
    first = bitmaps.taxpayer_ids(summary(spark, [row(f"{k:03d}", "012000") for k in range(0, 100, 2)] + [row("004", "022000"), row(None, "012000")]))
    ids = {r.gstin: r.id for r in first.collect()}
    assert [ids[k] for k in sorted(ids)] == list(range(50))
    more = bitmaps.taxpayer_ids(summary(spark, [row(f"{k:03d}", "012000") for k in range(120)]), known=first)
    after = {r.gstin: r.id for r in more.collect()}
    assert ids.items() <= after.items() and sorted(after.values()) == list(range(120))
    assert bitmaps.taxpayer_ids(summary(spark, [row("000", "012000")]), known=first).count() == 50
    assert bitmaps.taxpayer_ids(summary(spark, [])).count() == 0


def test_counts_read_the_stored_bits_only(spark, small):
    from returns_analytics.parity.queries import CATALOG

    plan = CATALOG["filed_gstins_by_quarter"].plan(small)._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", re.sub(r"#\d+L?", "", plan))
    assert scans == ["ret_period,st_juri,bucket,bits"] and "partial_bitmap_or_agg" in plan
