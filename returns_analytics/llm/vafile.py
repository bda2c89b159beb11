"""Centroid clustering over a vector-approximation file.

Every vector is kept twice: as a few bits per dimension (its *cells*) in blocks Spark scans each round,
and in full in files that are opened only where needed. A round broadcasts k centroids in its closure; for each
block, lookup tables give the least and the greatest squared distance of a centroid to every cell of a dimension,
and their sums bound the distance of every vector to every centroid. Where intervals overlap, a second set of tables
bounds by how much a centroid is farther than the leading one: the squares of the vector cancel out in that, so its
interval is much narrower. Only vectors still open then are fetched in full, by position, and decided exactly. Centroids
are updated from the vectors that changed their cluster, so a vector that stays is not fetched for that either. The
first update and the final distances need every vector once.

Edges of the cells are quantiles of a bounded sample (``SAMPLE`` vectors of smallest hash); every vector is
indexed, and the outermost cells of a block end at the block's own least and greatest values, so the bounds hold
whatever the sample missed. All arithmetic is on integers, so results don't depend on order or partitioning.

Tables of a round hold one row per block: a lost executor costs its blocks' work of that round. What reaches
the driver is the sample once, then one row per cluster and round.

Defined results: vectors that are null, have another length, or hold a null or non-finite component are left out,
and so are those with a component beyond 2**26 after scaling (squared distances would leave 64 bits); a null vec_id
is kept and counts as an empty number in the hash; repeated rows count once each; with fewer vectors than centroids
each vector starts one; equal centroids: the smaller number takes all; an empty table gives an empty table; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm.storage import Scratch

#: Components of a vector, and what they are multiplied with.
DIMENSIONS, SCALE = 64, 256
CLUSTERS, ROUNDS = 40, 5
#: Bits of a cell, vectors in the sample the edges come from, vectors of a block, greatest integer.
CELL_BITS, SAMPLE, BLOCK, GREATEST = 6, 4096, 4096, 1 << 26
#: Vectors closer together than this are fetched by one read, and none longer than that.
_GAP, _LONGEST = 16, 1 << 14

BLOCKS = "file string, first long, n int, width int, ids array<long>, cells binary, low binary, high binary"
_BLOCKS = pa.schema(
    [("file", pa.string()), ("first", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("ids", pa.list_(pa.int64())),
     ("cells", pa.binary()), ("low", pa.binary()), ("high", pa.binary())]
)
#: A round's rows: a block with its clusters now; the last block of a task carries what its task changed, by cluster.
STATE = (
    "file string, first long, n int, width int, cells binary, low binary, high binary, clusters binary, "
    "touched array<int>, counts array<long>, sums array<array<long>>, fetched long"
)
ASSIGNED = "vec_id long, cluster int, distance long"
_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])
RESULT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def _kept(embeddings: DataFrame, dimensions: int, scale: int) -> DataFrame:
    """vec_id and components as integers of the vectors that take part."""
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double") * scale) <= GREATEST))
    valid = F.col("embedding").isNotNull() & (F.size("embedding") == dimensions) & finite
    return embeddings.select("vec_id", "embedding").filter(valid).select("vec_id", scaled.cast("array<int>").alias("v"))


def first_vectors(kept: DataFrame, n: int, salt: str = "2:") -> np.ndarray:
    """The n vectors of smallest hash of their id, in that order; ties by id and components."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "vec_id", "v").orderBy("key", "vec_id", "v").limit(n).collect()
    return np.array([row["v"] for row in rows], np.int64)


def cell_edges(sample: np.ndarray, bits: int) -> np.ndarray:
    """Per dimension, the 2**bits - 1 first integers of all cells but the lowest."""
    at = np.linspace(0, len(sample), (1 << bits) + 1)[1:-1].astype(int)
    return np.sort(sample, axis=0)[np.minimum(at, len(sample) - 1)].T.copy()


def _packed(cells: np.ndarray, bits: int) -> bytes:
    """Cells of ``bits`` bits, one row of whole bytes per vector."""
    lanes = np.unpackbits(cells[:, :, None].astype(np.uint8), axis=2, bitorder="little")[:, :, :bits]
    return np.packbits(lanes.reshape(len(cells), -1), axis=1, bitorder="little").tobytes()


def _unpacked(data: bytes, n: int, dimensions: int, bits: int) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(n, -1)
    lanes = np.unpackbits(rows, axis=1, bitorder="little")[:, : dimensions * bits].reshape(n, dimensions, bits)
    return np.packbits(lanes, axis=2, bitorder="little")[:, :, 0]


def _indexer(folder: str, edges: np.ndarray, bits: int, block: int):
    """Writes full vectors to one file per task attempt; yields the rows of its blocks."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/vectors", recursive=True)
        name = f"{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        sink, first, rest_ids, rest = None, 0, [], np.zeros((0, len(edges)), np.int32)

        def row(ids: list, vectors: np.ndarray) -> pa.RecordBatch:
            nonlocal first
            sink.write(vectors.astype("<i4").tobytes())
            cells = np.stack([np.searchsorted(edges[d], vectors[:, d], "right") for d in range(len(edges))], axis=1)
            low, high = vectors.min(axis=0), vectors.max(axis=0)
            values = (name, first, len(ids), bits, ids, _packed(cells, bits), low.astype("<i4").tobytes(), high.astype("<i4").tobytes())
            first += len(ids)
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(values, _BLOCKS.types, strict=True)], schema=_BLOCKS)

        for batch in batches:
            if not batch.num_rows:
                continue
            if sink is None:
                sink = store.open_output_stream(f"{root}/vectors/{name}", compression=None)
            vectors = batch["v"].flatten().to_numpy(zero_copy_only=False).astype(np.int32).reshape(batch.num_rows, -1)
            rest_ids, rest = rest_ids + batch["vec_id"].to_pylist(), np.concatenate((rest, vectors))
            at = 0
            while len(rest_ids) - at >= block:
                yield row(rest_ids[at : at + block], rest[at : at + block])
                at += block
            rest_ids, rest = rest_ids[at:], rest[at:]
        if rest_ids:
            yield row(rest_ids, rest)
        if sink is not None:
            sink.close()

    return index


def cell_ranges(edges: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest integer of every cell (dimensions, cells), cut to the range of a block."""
    lowest, highest = np.full((len(edges), 1), np.iinfo(np.int64).min), np.full((len(edges), 1), np.iinfo(np.int64).max)
    begin, end = np.concatenate((lowest, edges), axis=1), np.concatenate((edges - 1, highest), axis=1)
    return tuple(np.clip(x, low[:, None], high[:, None]) for x in (begin, end))


def _sums(tables: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Per vector and centroid, the sum over dimensions of the table entry of its cell."""
    total = np.zeros((len(cells), tables.shape[2]), np.int64)
    for d in range(cells.shape[1]):
        total += tables[d][cells[:, d]]
    return total


def distance_bounds(cells: np.ndarray, begin: np.ndarray, end: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest squared distance of every vector to every centroid."""
    below, above = begin[:, :, None] - centroids.T[:, None, :], centroids.T[:, None, :] - end[:, :, None]
    gap = np.maximum(np.maximum(below, above), 0)
    reach = np.maximum(np.abs(below), np.abs(above))
    return _sums(gap * gap, cells), _sums(reach * reach, cells)


def least_lead(cells: np.ndarray, begin: np.ndarray, end: np.ndarray, centroids: np.ndarray, leader: int) -> np.ndarray:
    """By how much every centroid is farther from every vector than the leader, at least (squared distances)."""
    lead = centroids[leader]
    constant = (centroids**2 - lead**2).T[:, None, :]
    slope = -2 * (centroids - lead).T[:, None, :]
    return _sums(constant + np.minimum(slope * begin[:, :, None], slope * end[:, :, None]), cells)


def _fetch(source, first: int, rows: np.ndarray, dimensions: int) -> np.ndarray:
    """Full vectors of ascending rows of a block, by as few reads as gaps allow."""
    if not len(rows):
        return np.zeros((0, dimensions), np.int64)
    starts = [0, *(np.flatnonzero(np.diff(rows) > _GAP) + 1), len(rows)]
    out = []
    for a, b in zip(starts, starts[1:], strict=False):
        for at in range(a, b, _LONGEST):
            part = rows[at : min(b, at + _LONGEST)]
            source.seek((first + int(part[0])) * dimensions * 4)
            data = source.read(int(part[-1] - part[0] + 1) * dimensions * 4)
            out.append(np.frombuffer(data, "<i4").reshape(-1, dimensions)[part - part[0]])
    return np.concatenate(out).astype(np.int64)


class _Files:
    """The vector file opened last."""

    def __init__(self, folder: str) -> None:
        self._store, self._root = fs.FileSystem.from_uri(folder)
        self._name, self._source = None, None

    def __getitem__(self, name: str):
        if name != self._name:
            self.close()
            self._name, self._source = name, self._store.open_input_file(f"{self._root}/vectors/{name}")
        return self._source

    def close(self) -> None:
        if self._source is not None:
            self._source.close()


def nearest(
    cells: np.ndarray, edges: np.ndarray, low: np.ndarray, high: np.ndarray, centroids: np.ndarray, fetch
) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid of every vector (ties: the smaller number) and which rows were fetched for it.

    ``fetch`` returns the full vectors of ascending rows.
    """
    begin, end = cell_ranges(edges, low, high)
    least, greatest = distance_bounds(cells, begin, end, centroids)
    within = least <= greatest.min(axis=1)[:, None]
    clusters = within.argmax(axis=1)
    open_rows = np.flatnonzero(within.sum(axis=1) > 1)
    leaders = (least + greatest)[open_rows].argmin(axis=1)
    for leader in np.unique(leaders):
        rows = open_rows[leaders == leader]
        within[rows] &= least_lead(cells[rows], begin, end, centroids, leader) <= 0
    clusters[open_rows] = within[open_rows].argmax(axis=1)
    open_rows = open_rows[within[open_rows].sum(axis=1) > 1]
    if len(open_rows):
        vectors = fetch(open_rows)
        row, c = np.nonzero(within[open_rows])
        exact = np.full((len(open_rows), len(centroids)), np.iinfo(np.int64).max)
        for at in range(0, len(row), 1 << 16):
            r, k = row[at : at + (1 << 16)], c[at : at + (1 << 16)]
            exact[r, k] = ((vectors[r] - centroids[k]) ** 2).sum(axis=1)
        clusters[open_rows] = exact.argmin(axis=1)
    return clusters, open_rows


def _assigner(folder: str, edges: np.ndarray, centroids: np.ndarray):
    dimensions = centroids.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, last = _Files(folder), None
        counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
        for batch in batches:
            for block in batch.to_pylist():
                if last is not None:
                    yield pa.RecordBatch.from_pylist([last], _STATE)
                n = block["n"]
                low, high = (np.frombuffer(block[k], "<i4").astype(np.int64) for k in ("low", "high"))
                cells = _unpacked(block["cells"], n, dimensions, block["width"])
                before = np.frombuffer(block["clusters"], "<i4") if block["clusters"] is not None else np.full(n, -1)
                fetch = lambda rows: _fetch(files[block["file"]], block["first"], rows, dimensions)  # noqa: B023, E731
                clusters, seen = nearest(cells, edges, low, high, centroids, fetch)
                changed = np.flatnonzero(clusters != before)
                _add_changes(counts, sums, fetch(changed), clusters[changed], before[changed])
                last = block | {
                    "clusters": clusters.astype("<i4").tobytes(), "fetched": len(np.union1d(seen, changed)),
                    "touched": [], "counts": [], "sums": [],
                }
        files.close()
        if last is not None:
            touched = np.flatnonzero((counts != 0) | (sums != 0).any(axis=1))
            last |= {"touched": touched.tolist(), "counts": counts[touched].tolist(), "sums": sums[touched].tolist()}
            yield pa.RecordBatch.from_pylist([last], _STATE)

    return assign


_STATE = pa.schema(
    [("file", pa.string()), ("first", pa.int64()), ("n", pa.int32()), ("width", pa.int32()), ("cells", pa.binary()),
     ("low", pa.binary()), ("high", pa.binary()), ("clusters", pa.binary()), ("touched", pa.list_(pa.int32())),
     ("counts", pa.list_(pa.int64())), ("sums", pa.list_(pa.list_(pa.int64()))), ("fetched", pa.int64())]
)


def _add_changes(counts: np.ndarray, sums: np.ndarray, vectors: np.ndarray, now: np.ndarray, before: np.ndarray) -> None:
    """Add vectors to the clusters they joined and take them from those they left (-1: none)."""
    for labels, sign in ((now, 1), (before, -1)):
        known = labels >= 0
        np.add.at(counts, labels[known], sign)
        order = np.argsort(labels[known], kind="stable")
        ordered = labels[known][order]
        if len(ordered):
            starts = np.flatnonzero(np.r_[True, np.diff(ordered) > 0])
            sums[ordered[starts]] += sign * np.add.reduceat(vectors[known][order], starts, axis=0)


def _measurer(folder: str, edges: np.ndarray, centroids: np.ndarray):
    dimensions = centroids.shape[1]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder)
        for batch in batches:
            for block in batch.to_pylist():
                n = block["n"]
                low, high = (np.frombuffer(block[k], "<i4").astype(np.int64) for k in ("low", "high"))
                cells = _unpacked(block["cells"], n, dimensions, block["width"])
                # the distances need every vector, so one read of the block serves the open rows as well
                vectors = _fetch(files[block["file"]], block["first"], np.arange(n), dimensions)
                clusters, _ = nearest(cells, edges, low, high, centroids, vectors.__getitem__)
                distance = ((vectors - centroids[clusters]) ** 2).sum(axis=1)
                columns = [pa.array(block["ids"], pa.int64()), pa.array(clusters.astype(np.int32)), pa.array(distance)]
                yield pa.RecordBatch.from_arrays(columns, schema=_ASSIGNED)
        files.close()

    return measure


def _moved(state: DataFrame, k: int, dimensions: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Changes of counts and sums by cluster, and how many vectors were fetched.

    One row per cluster and dimension at most comes to the driver; counts and fetches travel as dimensions -1 and -2.
    """
    changes = state.select(F.explode(F.arrays_zip("touched", "counts", "sums")).alias("c")).select("c.*")
    parts = changes.select("touched", F.posexplode("sums").alias("d", "x"))
    parts = parts.unionAll(changes.select("touched", F.lit(-1), "counts"))
    parts = parts.unionAll(state.select(F.lit(0), F.lit(-2), "fetched"))
    counts, sums, fetched = np.zeros(k, np.int64), np.zeros((k, dimensions), np.int64), 0
    for c, d, x in parts.groupBy("touched", "d").agg(F.sum("x")).collect():
        if d >= 0:
            sums[c, d] = x
        elif d == -1:
            counts[c] = x
        else:
            fetched = x
    return counts, sums, fetched


def centroid_sha256(centroid: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


@dataclass(frozen=True)
class Clustering:
    """Assigned vectors (stored), final centroids, and the share of vectors each round fetched in full."""

    assigned: DataFrame
    centroids: np.ndarray
    fetched: list[float]


def cluster(
    embeddings: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS,
    scale: int = SCALE, bits: int = CELL_BITS, block: int = BLOCK,
) -> Clustering:
    """Runs the rounds and assigns every vector once more. Eager; ``assigned`` has vec_id, cluster, distance."""
    if not 1 <= bits <= 8:
        raise ValueError("a cell takes 1 to 8 bits")
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "vafile")
    kept = _kept(embeddings, dimensions, scale)
    sample = first_vectors(kept, max(SAMPLE, clusters))
    if not len(sample):
        return Clustering(spark.createDataFrame([], ASSIGNED), np.zeros((0, dimensions), np.int64), [])
    centroids, edges = sample[:clusters], cell_edges(sample, bits)
    blocks = scratch.store(kept.mapInArrow(_indexer(scratch.folder, edges, bits, block), BLOCKS))
    counts, sums = np.zeros(len(centroids), np.int64), np.zeros(centroids.shape, np.int64)
    state = blocks.drop("ids").withColumn("clusters", F.lit(None).cast("binary"))
    fetched = []
    for _ in range(rounds):
        before = state
        columns = [f.name for f in _STATE][:8]
        state = scratch.store(before.select(*columns).mapInArrow(_assigner(scratch.folder, edges, centroids), STATE))
        scratch.drop(before)
        count_change, sum_change, seen = _moved(state, len(centroids), dimensions)
        counts, sums = counts + count_change, sums + sum_change
        fetched.append(seen / int(counts.sum()))
        full = counts > 0
        centroids = centroids.copy()
        centroids[full] = sums[full] // counts[full][:, None]  # numpy rounds down
    assigned = scratch.store(blocks.mapInArrow(_measurer(scratch.folder, edges, centroids), ASSIGNED))
    return Clustering(assigned, centroids, fetched)


def digest(embeddings: DataFrame, **options: int) -> DataFrame:
    """One row per vector with its cluster, distances summed over cluster and table, and its centroid's digest."""
    spark = embeddings.sparkSession
    found = cluster(embeddings, **options)
    # at most one row per cluster
    sums = {r["cluster"]: int(r["s"]) for r in found.assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    rows = [(c, s, sum(sums.values()), centroid_sha256(found.centroids[c])) for c, s in sums.items()]
    about = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(about), "cluster").select(*(part.split()[0] for part in RESULT.split(", ")))
