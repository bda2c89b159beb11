import numpy as np
import pytest
from helpers_llm import Union

from returns_analytics.llm import neighbours

SCHEMA = "vec_id long, embedding array<float>, id string, data int"


def vectors(seed, groups=(40, 7, 2, 2)):
    rng = np.random.default_rng(seed)
    rows = []
    for size in groups:
        centre = rng.standard_normal(32)
        rows += [centre + 0.05 * rng.standard_normal(32) for _ in range(size)]
    rows += list(rng.standard_normal((80, 32)))
    rows += [rows[0], rows[0] * 2, rows[90]]  # equal, scaled, equal
    order = rng.permutation(len(rows))
    out = [(int(k), [float(x) for x in np.float32(rows[i])]) for k, i in enumerate(order)]
    n = len(out)
    return out + [(n, None), (n + 1, []), (n + 2, [0.0] * 32), (n + 3, [None] + [1.0] * 31), (n + 4, [float("nan")] * 32),
                  (n + 5, [float("inf")] * 32), (n + 6, [1.0, 2.0]), (n + 7, [2.0, 4.0])]


def brute(rows, threshold=0.95):
    unit = {}
    for i, v in rows:
        if v and None not in v and np.isfinite(v).all() and np.any(v):
            unit[i] = np.array(v, float) / np.sqrt(np.sum(np.array(v, float) ** 2))
    union, links = Union(i for i, _ in rows), dict.fromkeys((i for i, _ in rows), 0)
    for a, x in unit.items():
        for b, y in unit.items():
            if a != b and len(x) == len(y) and x @ y >= threshold:
                links[a] += 1
                union.join(a, b)
    return {i: (links[i], union.find(i), union.find(i) == i) for i, _ in rows}


@pytest.mark.parametrize("block", [2048, 8])
def test_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "COUNT_BLOCK", block)
    rows = vectors(1)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.link(frame).collect()}
    assert got == brute(rows)


def test_empty_table_and_nothing_valid(spark):
    assert neighbours.link(spark.createDataFrame([], SCHEMA)).count() == 0
    frame = spark.createDataFrame([(1, None, "x", 1), (2, [0.0], "x", 1), (None, [1.0], "x", 1)], SCHEMA)
    assert sorted(map(tuple, neighbours.link(frame).collect())) == [(1, 0, 1, True), (2, 0, 2, True)]


def two_tight_groups(size, seed=3):
    """Two groups, inside far more alike than across, where all cosines are still over the threshold."""
    rng = np.random.default_rng(seed)
    centre = rng.standard_normal(64)
    centre /= np.linalg.norm(centre)
    aside = rng.standard_normal(64)
    aside -= (aside @ centre) * centre
    aside /= np.linalg.norm(aside)
    rows = []
    for angle in (-0.135, 0.135):
        middle = np.cos(angle) * centre + np.sin(angle) * aside
        rows += [middle + 0.004 * rng.standard_normal(64) for _ in range(size)]
    return [(k, [float(x) for x in np.float32(v)]) for k, v in enumerate(rows)]


def test_links_across_tight_groups_outlive_full_lists(spark):
    rows = two_tight_groups(150)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA).repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in neighbours.link(frame).collect()}
    assert got == brute(rows)


def test_full_groups_that_no_comparison_met_are_joined(spark):
    rows = two_tight_groups(150)
    unit = [(i, (np.array(v) / np.linalg.norm(v)).astype("<f8").tobytes()) for i, v in rows]
    nodes = spark.createDataFrame(unit, "id long, data binary")
    found = spark.createDataFrame([(i, i // 150 * 150) for i, _ in rows], "node long, component long")
    listed = [(a, a // 150 * 150 + (a + k) % 150, 0.999, False) for a, _ in rows for k in range(1, 20)]
    edges = spark.createDataFrame(listed, "a long, b long, cosine double, tie boolean")
    across = neighbours._between(nodes, found, edges, 64, 0.95, neighbours.Scratch(spark, "test")).collect()
    assert across and all(row.a // 150 != row.b // 150 for row in across)


def test_links_that_stay_lost_fail_the_run(spark, monkeypatch):
    none = spark.createDataFrame([], "a long, b long, cosine double, tie boolean")
    monkeypatch.setattr(neighbours, "_descend", lambda *rest: none)
    monkeypatch.setattr(neighbours, "TRIES", 1)
    frame = spark.createDataFrame([(*r, "x", 1) for r in vectors(1)], SCHEMA)
    with pytest.raises(RuntimeError, match="recall"):
        neighbours.link(frame)


def test_recall_is_a_mean_over_nodes_and_trees_grow_with_the_table(spark):
    true = spark.createDataFrame([(1, 999), (2, 1), (3, 0)], "id long, links long")
    counts = spark.createDataFrame([(1, 999)], "id long, n long")
    assert neighbours.audit(true, counts) == 0.5
    assert neighbours.trees_for(2_000, 0.95) == 8 < neighbours.trees_for(10_000_000, 0.95)
