"""Equal-depth ranges against a numbered list, and pages."""

import random

import pytest
from helpers import collect

from returns_analytics.operators import ranges


def brute(keys, n):
    ordered = sorted((k for k in keys if k is not None)) + [k for k in keys if k is None]
    small, larger = divmod(len(ordered), n)
    out, start = [], 0
    for bucket in range(1, n + 1):
        part = ordered[start:start + small + (bucket <= larger)]
        start += len(part)
        known = [k for k in part if k is not None]
        if part:
            out.append((bucket, known[0] if known else None, known[-1] if known else None, len(part)))
    return sorted(out, key=str)


@pytest.mark.parametrize("n", [1, 3, 7, 250])
@pytest.mark.parametrize("hot", [0, 90])
def test_equal_depth(spark, n, hot):
    rng = random.Random(n + hot)
    keys = [f"{rng.randint(0, 60):03d}" for _ in range(100)] + ["031"] * hot + [None] * 3
    frame = spark.createDataFrame([(k,) for k in keys], "gstin string").repartition(5)
    got = ranges.equi_depth_ranges(frame, "gstin", n, partitions=6)
    assert collect(got, "bucket", "lo", "hi", "rows") == brute(keys, n)


def test_range_count():
    assert [ranges.range_count(*case) for case in ((0, 50_000), (50_000, 50_000), (50_001, 50_000), (2_500, 1))] == [
        1, 1, 2, 2_500]
    with pytest.raises(ValueError):
        ranges.range_count(10, 0)


def test_pages(spark):
    frame = spark.createDataFrame([(f"K{i:04d}",) for i in range(30)], "gstin string").repartition(4)
    assert [r.gstin for r in ranges.page_after(frame, "gstin", 2).collect()] == ["K0000", "K0001"]
    assert [r.gstin for r in ranges.page_after(frame, "gstin", 2, " k0007").collect()] == ["K0008", "K0009"]
    assert ranges.page_after(frame, "gstin", 2, "  ").count() == 2
    many = spark.range(7_000).selectExpr("lpad(id, 5, '0') gstin")
    assert ranges.page_after(many, "gstin", 6_500).count() == 6_500
    for size in (0, -1):
        with pytest.raises(ValueError):
            ranges.page_after(frame, "gstin", size)
    assert ranges.key_slice(frame, "gstin", "K0003", "K0005").count() == 3
