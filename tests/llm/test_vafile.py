import hashlib

import numpy as np
import pytest

from returns_analytics.llm import vafile


def brute(rows, clusters, rounds):
    """vec_id, cluster, distance of each kept row, and the centroids, in Python's own integers."""
    kept = []
    for vec_id, v in rows:
        if v is None or len(v) != 64 or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [int(np.floor(np.float64(256) * np.float64(np.float32(x)))) for x in v]))
    text = lambda i: "2:" + ("" if i is None else str(i))
    key = lambda r: (hashlib.sha256(text(r[0]).encode()).hexdigest(), -1 if r[0] is None else r[0], r[1])
    centroids = [v for _, v in sorted(kept, key=key)[:clusters]]

    def assign():
        out = []
        for _, v in kept:
            d = [sum((a - b) ** 2 for a, b in zip(v, c)) for c in centroids]
            out.append((d.index(min(d)), min(d)))
        return out

    for _ in range(rounds):
        found = assign()
        for c in range(len(centroids)):
            mine = [v for (_, v), (k, _) in zip(kept, found) if k == c]
            if mine:
                centroids[c] = [sum(x) // len(mine) for x in zip(*mine)]
    return [(i, c, d) for (i, _), (c, d) in zip(kept, assign())], centroids


def table(spark, rows):
    frame = spark.createDataFrame([(i, v, 0, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster int, v string")
    return frame.repartition(5)


def vectors(n, seed, spread=0.05):
    rng = np.random.default_rng(seed)
    centres = rng.normal(0, 0.2, (6, 64))
    return [(i, (centres[i % 6] + rng.normal(0, spread, 64)).astype(np.float32).tolist()) for i in range(n)]


def key(row):
    return tuple((x is not None, x) for x in row)


@pytest.mark.parametrize("bits", [1, 4, 6, 8])
def test_equals_brute_force(spark, bits):
    rows = vectors(300, bits)
    rows += [(1000, None), (1001, [0.1] * 63), (1002, [float("nan")] * 64), (1003, [None] + [0.0] * 63), (1004, []),
             (1005, [float("inf")] * 64), (1006, [0.0] * 64), (1007, [0.0] * 64), (1008, [-3.0] * 64), (1009, [900.0] * 64),
             rows[3], rows[3], (None, rows[5][1])]
    found = vafile.cluster(table(spark, rows), clusters=7, rounds=3, bits=bits, block=64)
    want, centroids = brute(rows, 7, 3)
    assert sorted(map(tuple, found.assigned.collect()), key=key) == sorted(want, key=key)
    assert found.centroids.tolist() == centroids
    result = {(r.vec_id, r.cluster): r for r in vafile.digest(table(spark, rows), clusters=7, rounds=3, bits=bits, block=64).collect()}
    for vec_id, c, d in want:
        r = result[vec_id, c]
        assert (r.distance, r.inertia) == (d, sum(x[2] for x in want))
        assert r.cluster_inertia == sum(x[2] for x in want if x[1] == c)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()


def test_far_groups_are_not_fetched(spark):
    """Where intervals do not overlap, only vectors that change their cluster are read in full."""
    rng = np.random.default_rng(1)
    centres = rng.normal(0, 4, (4, 64))
    rows = [(i, (centres[i % 4] + rng.normal(0, 0.02, 64)).astype(np.float32).tolist()) for i in range(400)]
    found = vafile.cluster(table(spark, rows), clusters=4, rounds=4, block=50)
    assert found.fetched[0] == 1.0 and found.fetched[-1] == 0.0
    assert sorted(map(tuple, found.assigned.collect())) == sorted(brute(rows, 4, 4)[0])


def test_bounds_hold():
    rng = np.random.default_rng(2)
    data, centroids = rng.integers(-300, 300, (200, 8)), rng.integers(-300, 300, (5, 8))
    edges = vafile.cell_edges(data[:20], 3)  # the rest lies outside of the sample's range as well
    low, high = data.min(axis=0), data.max(axis=0)
    cells = np.stack([np.searchsorted(edges[d], data[:, d], "right") for d in range(8)], axis=1)
    begin, end = vafile.cell_ranges(edges, low, high)
    exact = ((data[:, None, :] - centroids[None]) ** 2).sum(axis=2)
    least, greatest = vafile.distance_bounds(cells, begin, end, centroids)
    assert (least <= exact).all() and (exact <= greatest).all()
    for leader in range(5):
        lead = vafile.least_lead(cells, begin, end, centroids, leader)
        assert (lead <= exact - exact[:, [leader]]).all() and (lead[:, leader] == 0).all()
    assert (vafile._unpacked(vafile._packed(cells, 3), 200, 8, 3) == cells).all()


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = vectors(3, 5)
    assert sorted(map(tuple, vafile.cluster(table(spark, rows)).assigned.collect())) == sorted(brute(rows, 40, 5)[0])
    for empty in (table(spark, [(1, None)]), spark.createDataFrame([], "vec_id long, embedding array<double>")):
        result = vafile.digest(empty)
        assert result.count() == 0 and result.columns[:3] == ["vec_id", "cluster", "distance"]


def test_a_third_of_all_rows_under_one_id(spark):
    rows = vectors(120, 9) + [(7, vectors(1, 9)[0][1])] * 60
    found = vafile.cluster(table(spark, rows), clusters=5, rounds=2, block=32)
    assert sorted(map(tuple, found.assigned.collect())) == sorted(brute(rows, 5, 2)[0])
