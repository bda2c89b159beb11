import random

import numpy as np
import pytest
from helpers_llm import jaccard_components

from returns_analytics.llm import jaccard

SCHEMA = "doc_id long, text string, n long, key string"


def corpus(seed):
    """Chains of near copies, common passages, short and empty texts."""
    rng = random.Random(seed)
    text = lambda n: [f"w{rng.randint(0, 400)}" for _ in range(n)]
    common = text(30)
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one"), (4, "ONE\n"), (5, "one two"), (6, "a b c d"), (7, "A  b c d")]
    base = text(80)
    for i in range(10, 110):
        kind = rng.random()
        if kind < 0.4:  # a chain: each differs a little from the one before
            base = list(base)
            base[rng.randint(0, 79)] = f"n{i}"
            body = base
        elif kind < 0.6:
            body = common + text(rng.randint(0, 12))
        elif kind < 0.7:
            body = rng.choice(rows)[1] or "x"
            body = body.split(" ")
        else:
            body = text(rng.randint(1, 60))
        rows.append((i, " ".join(body)))
    return rows


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 4, 85), (2, 5, 80), (3, 2, 60)])
def test_equals_brute_force(spark, seed, size, percent):
    rows = corpus(seed)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame, size, percent).collect()}
    assert got == jaccard_components(rows, size, percent)
    assert len({c for _, c in got.values()}) < len(rows) - 10


def test_large_group_of_near_copies_equals_brute_force(spark):
    """One cell of more points than a leaf holds, with pairs on both sides of the threshold."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(90)]
    rows = []
    for i in range(jaccard.LEAF + 170):
        body = list(base)
        for k in range(rng.randint(0, 4)):
            body[rng.randint(0, 89)] = f"n{i}_{k}"
        rows.append((i, " ".join(body)))
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.classes(frame).collect()}
    assert got == jaccard_components(rows, 4, 85)
    assert 1 < len({c for _, c in got.values()}) < len(rows)


def test_parities_bound_the_difference_of_sets():
    rng = np.random.default_rng(4)
    for n in (3, 60, 4000):
        pool = rng.integers(0, 1 << 63, 2 * n, dtype=np.uint64)
        x, y = pool[:n], pool[n // 3 : n // 3 + n]
        bits = jaccard.parities(np.concatenate((x, y)), np.repeat([0, 1], n), 2).view(np.uint64)
        differ = int(np.bitwise_count(bits[0] ^ bits[1]).sum())
        assert 0 < differ <= len(np.setxor1d(x, y))


def test_repeated_rows_null_ids_and_extra_columns(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f"), (3, "x y z q r s")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = sorted((r.doc_id, r.component_id) for r in jaccard.classes(frame).collect())
    assert got == [(1, 1), (2, 1), (3, 3)]
    kept = jaccard.keep_first(frame)
    assert kept.columns == frame.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "3", "None"]


def test_empty_table(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert jaccard.classes(frame).count() == 0 and jaccard.keep_first(frame).count() == 0


@pytest.mark.parametrize("k", [5, 200])
def test_tree_finds_all_pairs_within_the_bound(k):
    rng = np.random.default_rng(k)
    points = rng.poisson(2, (k, jaccard.GROUPS))
    points[k // 2 :] = points[: k - k // 2] + rng.integers(0, 2, (k - k // 2, jaccard.GROUPS))
    n = points.sum(axis=1)
    both = np.minimum(points[:, None], points[None]).sum(axis=2)
    want = {(i, j) for i, j in zip(*np.nonzero(both >= jaccard.required(n[:, None], n[None], 85))) }
    sized = {(i, j) for i, j in want if 100 * min(n[i], n[j]) >= 85 * max(n[i], n[j])}
    found = {(int(a), int(b)) for i, j, _ in jaccard.CountTree(points, n).partners(np.arange(k), 85) for a, b in zip(i, j)}
    assert sized <= found <= want


def test_only_sets_of_pairs_that_may_link_are_moved(spark, monkeypatch):
    """Large sets that share half of their shingles: fixed parities let the pair pass, those of the set's size do not."""
    rng = random.Random(12)
    text = lambda n: [f"w{rng.randint(0, 10**9)}" for _ in range(n)]
    common, own, other = (" ".join(text(4000)) for _ in range(3))
    # what is not common is the more frequent part, so that the pair meets in cells of common shingles
    rows = [(0, f"{common} {own}"), (1, f"{common} {other}"), (9, f"{common} {own} and more")]
    rows += [(k, own) for k in range(20, 26)] + [(k, other) for k in range(30, 36)]
    real = jaccard._verify

    def bounded(percent):
        verify = real(percent)

        def run(batches):
            held = list(batches)
            for batch in held:
                assert set(zip(batch["a"].to_pylist(), batch["b"].to_pylist())) <= {(0, 9)}
            yield from verify(iter(held))

        return run

    monkeypatch.setattr(jaccard, "_verify", bounded)
    got = {r.doc_id: r.component_id for r in jaccard.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 1, 9: 0} | dict.fromkeys(range(20, 26), 20) | dict.fromkeys(range(30, 36), 30)


def test_wide_parities_never_differ_in_more_than_the_sets_do():
    rng = np.random.default_rng(3)
    for n, m, both in [(0, 0, 0), (1, 1, 1), (1, 900, 1), (300, 340, 290), (5000, 5600, 4900), (4000, 4000, 0)]:
        values = np.unique(rng.integers(0, 1 << 62, n + m, dtype=np.uint64))
        assert len(values) == n + m
        x, y = values[:n], np.concatenate((values[:both], values[n : n + m - both]))
        sketches = (np.frombuffer(jaccard.wide_parities(v), np.uint8) for v in (x, y))
        differ = jaccard.differing(*sketches)
        assert differ <= n + m - 2 * both
        if m <= 2 * n:  # sizes of which some pair may link
            assert differ >= (n + m - 2 * both) // 3


def test_overlaps_of_few_pairs_equal_those_of_many(monkeypatch):
    rng = np.random.default_rng(5)
    x, y = (rng.integers(0, 40, (n, jaccard.GROUPS)).astype(np.uint16) for n in (7, 9))
    want = np.minimum(x[:, None].astype(int), y[None]).sum(axis=2)
    for few in (0, 256):
        monkeypatch.setattr(jaccard, "FEW", few, raising=False)
        got = jaccard._overlaps(x, y)
        assert got.dtype == x.dtype and (got == want).all()
