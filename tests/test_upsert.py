"""Merges: what wins, what is kept, and that a second merge changes nothing."""

import pytest
from helpers import collect
from pyspark.sql import functions as F

from returns_analytics.errors import DuplicateKeys, GateFailed
from returns_analytics.operators import quality
from returns_analytics.operators.upsert import require_targets, rows_without_target, stale_keys, update_columns, upsert

SHAPE = "k string, p string, a int, note string"


def frames(spark):
    target = spark.createDataFrame([("x", "1", 1, "old"), ("y", "1", 2, "old"), (None, "1", 3, "old")], SHAPE)
    source = spark.createDataFrame([("x", "1", None), ("z", "1", 9), (None, "1", 7)], "k string, p string, a int")
    return target, source


def merge(target, source, **options):
    return upsert(target, source, ["k", "p"], ["a"], {"note": F.lit("new")}, **options)


def test_merge(spark):
    target, source = frames(spark)
    merged = merge(target, source)
    assert merged.schema == target.schema
    # NULL wins on a match, other columns are kept, and a NULL key matches nothing
    assert collect(merged, *merged.columns) == sorted([
        ("x", "1", None, "old"), ("y", "1", 2, "old"), ("z", "1", 9, "new"), (None, "1", 3, "old"),
        (None, "1", 7, "new")], key=str)


def test_twice_is_once(spark):
    target, source = frames(spark)
    target, source = target.filter("k is not null"), source.filter("k is not null")
    once = merge(target, source)
    twice = merge(once, source)
    assert collect(once, *once.columns) == collect(twice, *once.columns)


def test_stale_rows(spark):
    target, source = frames(spark)
    assert collect(merge(target, source, drop_unmatched=True), "k", "note") == sorted(
        [("x", "old"), ("z", "new"), (None, "new")], key=str)
    assert collect(stale_keys(target.filter("k is not null"), source, ["k", "p"]), "k") == [("y",)]


def test_column_group_update(spark):
    target, source = frames(spark)
    updated = update_columns(target, source, ["k", "p"], ["a"])
    assert collect(updated, "k", "a") == sorted([("x", None), ("y", 2), (None, 3)], key=str)
    assert collect(rows_without_target(target, source, ["k"]).filter("k is not null"), "k") == [("z",)]
    with pytest.raises(GateFailed):
        require_targets(target, source.filter("k = 'z'"), ["k", "p"])
    require_targets(target, source.filter("k = 'x'"), ["k", "p"])


def test_repeated_source_keys_stop_a_merge(spark):
    target, _ = frames(spark)
    quality.require_unique(target, ["k", "p"])
    with pytest.raises(DuplicateKeys):
        quality.require_unique(target.unionByName(target), ["k", "p"])
