"""Near-duplicate vectors by NN-descent.

Equal vectors are one node. Neighbour lists start from random-projection trees: nodes sorted by the signs of
random projections are compared within blocks of neighbours in that order, so that a group of any size
is many blocks. Lists are then refined through neighbours-of-neighbours joins: around each node the nodes
of its list and those that list it are compared with each other. A list that is full of links is
doubled. The lists are bounded, the links are not: all links that a comparison sees go on as ties, which
tie the nodes they connect to one of them. A link can only stay unseen for the bounds where both ends have
many links, so such nodes of different components are compared exactly: centres of components with their
radii first, then the nodes of the components that come close enough. Links and ties give components; within a
component every link is then counted exactly, block against block, or without comparing any pair where its
radius shows that all of it is linked. What remains to be lost is what no comparison meets: the trees grow in
number with the nodes, so that a pair at the threshold seldom misses all of them, and the recall, a mean over
nodes that hold links, is audited on a hash-chosen sample of nodes against all others. If it is too low more
trees are added; if they do not help either, the run fails. Where no node of the largest sample holds a
link there is nothing to measure it by.

Cosines are computed in double precision. Defined results: vectors that are null, empty, zero or hold
null or non-finite components link with nothing, nor do vectors of different length; equal vectors
link; rows that agree in vec_id are one vector, the smallest in bytes; rows without vec_id are dropped;
an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.llm.components import components
from returns_analytics.llm.storage import Scratch

THRESHOLD = 0.95
#: Neighbours of a list, least trees (and trees at once), nodes of a block, rounds, and the least cosine of an edge
#: that is followed whatever its place in a list; the first WALK of a list always are.
NEIGHBOURS, TREES, BLOCK, ROUNDS, FOLLOWED, WALK = 16, 8, 128, 3, 0.8, 4
#: Share of pairs at the threshold that may miss each other in all trees.
MISSED = 0.01
#: Nodes of a component compared at once, least recall, and tries with more trees.
COUNT_BLOCK, LEAST_RECALL, TRIES = 2048, 0.98, 4
#: Nodes of the audit at first and at most, and how many of them have to hold links.
AUDITED, MOST_AUDITED, HOLDERS = 1024, 16384, 64
_BITS = 24


def _rows(column: pa.Array) -> np.ndarray:
    """Packed vectors as rows of length one."""
    x = np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(len(column), -1)
    return x


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, dim and the vector scaled to length one; null if it links with nothing."""
    for batch in batches:
        packed, dims = [], []
        for vector in batch["embedding"]:
            values = vector.as_py()
            data, dim = None, 0
            if values and None not in values:
                x = np.array(values, float)
                if np.isfinite(x).all() and x.any():
                    x = x / np.abs(x).max()
                    data, dim = (x / np.sqrt(x @ x)).astype("<f8").tobytes(), len(x)
            packed.append(data)
            dims.append(dim)
        yield pa.RecordBatch.from_arrays(
            [batch["vec_id"], pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], ["vec_id", "dim", "data"]
        )


def _codes(dim: int, first_tree: int, trees: int):
    planes = np.random.default_rng(1000 + first_tree).standard_normal((trees, dim, _BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch["data"])
            for tree in range(trees):
                code = ((x @ planes[tree] > 0) << np.arange(_BITS)[::-1]).sum(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(x), tree, np.int32)), pa.array(code.astype(np.int64)), batch["id"], batch["data"]],
                    ["tree", "code", "id", "data"],
                )

    return run


def _ties(ids: np.ndarray, linked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes that links connect, each with the first of those it is connected with."""
    some = np.flatnonzero(linked.any(axis=1))
    linked, label = linked[np.ix_(some, some)], np.arange(len(some))
    while True:
        new = np.minimum(np.where(linked, label, len(some)).min(axis=1, initial=len(some)), label)
        new = new[new]
        if (new == label).all():
            break
        label = new
    tied = np.flatnonzero(label != np.arange(len(some)))
    return ids[some[tied]], ids[some[label[tied]]]


def _best(ids: np.ndarray, cosines: np.ndarray, keep: int, least: float, threshold: float) -> pa.RecordBatch:
    """For each row its most similar others; and the ties of all links."""
    np.fill_diagonal(cosines, -2)
    tied, to = _ties(ids, cosines >= threshold)
    take = min(keep, len(ids) - 1)
    part = np.argpartition(-cosines, take - 1, axis=1)[:, :take] if take > 0 else np.zeros((len(ids), 0), int)
    part = np.take_along_axis(part, np.argsort(-np.take_along_axis(cosines, part, 1), axis=1), 1)
    a, value = np.repeat(ids, take), np.take_along_axis(cosines, part, 1).ravel()
    good = (value >= least) | (np.tile(np.arange(take), len(ids)) < WALK)
    columns = (a[good], tied), (ids[part].ravel()[good], to), (value[good], np.ones(len(tied))), (np.zeros(good.sum(), bool), np.ones(len(tied), bool))
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["a", "b", "cosine", "tie"])


def _block_edges(keep: int, least: float, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            ids, x, tree = table["id"].to_numpy(), _rows(table["data"]), table["tree"].to_numpy()
            for at in range(0, len(ids), BLOCK):
                for own in np.unique(tree[at : at + BLOCK]):
                    some = at + np.flatnonzero(tree[at : at + BLOCK] == own)
                    yield _best(ids[some], x[some] @ x[some].T, keep, least, threshold)

        for batch in batches:
            held.append(batch)
            n += batch.num_rows
            if n >= 32 * BLOCK:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    return run


def _pivot_edges(keep: int, least: float, threshold: float):
    """All nodes around a pivot compared with each other; rows come sorted by pivot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def around(table: pa.Table) -> Iterator[pa.RecordBatch]:
            pivot, ids, x = table["pivot"].to_numpy(), table["id"].to_numpy(), _rows(table["data"])
            edges = np.concatenate(([0], np.flatnonzero(pivot[1:] != pivot[:-1]) + 1, [len(pivot)]))
            out = [_best(ids[a:b], x[a:b] @ x[a:b].T, keep, least, threshold) for a, b in zip(edges, edges[1:]) if b > a + 1]
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            pivot = table["pivot"].to_numpy()
            cut = int(np.searchsorted(pivot, pivot[-1]))
            if cut:
                yield from around(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from around(rest)

    return run


def _pair_counts(threshold: float):
    """Links of each member of a block with the other block; rows come sorted by component and blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None

        def count(table: pa.Table) -> Iterator[pa.RecordBatch]:
            group = table["group"].to_numpy()
            ids, weight, side, x = table["id"].to_numpy(), table["copies"].to_numpy(), table["side"].to_numpy(), _rows(table["data"])
            edges = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]))
            out = []
            for a, b in zip(edges, edges[1:]):
                here, there = a + np.flatnonzero(side[a:b] != 1), a + np.flatnonzero(side[a:b] != 0)
                linked = x[here] @ x[there].T >= threshold
                linked &= ids[here][:, None] != ids[there][None]
                out.append((ids[here], linked @ weight[there]))
                if (side[a:b] != 2).any():  # two different blocks
                    out.append((ids[there], weight[here] @ linked))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([o[0] for o in out])), pa.array(np.concatenate([o[1] for o in out]).astype(np.int64))],
                ["id", "n"],
            )

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            group = table["group"].to_numpy()
            cut = int(np.flatnonzero(group != group[-1])[-1]) + 1 if (group != group[-1]).any() else 0
            if cut:
                yield from count(table.slice(0, cut))
            rest = table.slice(cut)
        if rest is not None and rest.num_rows:
            yield from count(rest)

    return run


def _descend(
    nodes: DataFrame, dim: int, scratch: Scratch, first_tree: int, trees: int, known: DataFrame | None, threshold: float
) -> DataFrame:
    """Neighbour lists (a, b, cosine) of the nodes (id, data) and, with tie, all ties: trees, then rounds of joins."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    edge = "a long, b long, cosine double, tie boolean"

    def lists(edges: DataFrame, keep: int) -> DataFrame:
        """The best of each list, and every tie. A list full of links is let grow to twice its size."""
        order = Window.partitionBy("a", "tie").orderBy(F.col("cosine").desc(), "b")
        numbered = edges.groupBy("a", "b", "tie").agg(F.max("cosine").alias("cosine")).withColumn("k", F.row_number().over(order))
        roomy = F.when(F.col("cosine") >= threshold, 2 * keep).otherwise(keep)
        listed = ((F.col("cosine") >= FOLLOWED) & (F.col("k") <= roomy)) | (F.col("k") <= WALK)
        return scratch.store(numbered.filter(F.col("tie") | listed).select("a", "b", "cosine", "tie"))

    keep, now = NEIGHBOURS, known
    for first in range(first_tree, first_tree + trees, TREES):
        some = min(TREES, first_tree + trees - first)
        dealt = nodes.mapInArrow(_codes(dim, first, some), "tree int, code long, id long, data binary")
        dealt = dealt.repartitionByRange(tasks, "tree", "code").sortWithinPartitions("tree", "code", "id")
        start = dealt.mapInArrow(_block_edges(NEIGHBOURS, FOLLOWED, threshold), edge)
        now = lists(start if now is None else start.unionByName(now), NEIGHBOURS)
    for _ in range(ROUNDS):
        listed = now.filter(~F.col("tie"))
        back = listed.select(F.col("b").alias("pivot"), F.col("a").alias("id"), "cosine")
        # those that list a node: as many as its own list holds, others meet it around their own neighbours
        order = Window.partitionBy("pivot").orderBy(F.col("cosine").desc(), F.xxhash64("id"))
        back = back.withColumn("k", F.row_number().over(order)).filter(F.col("k") <= keep).drop("k", "cosine")
        around = listed.select(F.col("a").alias("pivot"), F.col("b").alias("id")).unionByName(back)
        around = around.unionByName(listed.select(F.col("a").alias("pivot"), F.col("a").alias("id"))).distinct()
        gathered = around.join(nodes, "id").repartition(tasks, "pivot").sortWithinPartitions("pivot", "id")
        found = gathered.select("pivot", "id", "data").mapInArrow(_pivot_edges(keep, FOLLOWED, threshold), edge)
        new = lists(now.unionByName(found), keep)
        before, after = (t.agg(F.count(F.lit(1)), F.sum("cosine")).first() for t in (now, new))
        scratch.drop(now)
        now, keep = new, 2 * keep
        if after[0] <= before[0] * 1.001 and (after[1] or 0) <= (before[1] or 0) * 1.001:
            break
    return now


def _radii(members: DataFrame, dim: int) -> DataFrame:
    """component, centre (of length one) and r, the widest angle of its members (component, data) with it."""
    tasks = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if batch.num_rows:
                own, at = np.unique(batch["component"].to_numpy(), return_inverse=True)
                sums = np.zeros((len(own), dim))
                np.add.at(sums, at, _rows(batch["data"]))
                for k, component in enumerate(own.tolist()):
                    total[component] = total.get(component, 0) + sums[k]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(total), pa.int64()), pa.array([v.astype("<f8").tobytes() for v in total.values()], pa.binary())],
            ["component", "data"],
        )

    def scale(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                centre = _rows(batch["data"])
                centre = centre / np.maximum(np.sqrt((centre**2).sum(axis=1, keepdims=True)), 1e-300)
                yield pa.RecordBatch.from_arrays(
                    [batch["component"], pa.array([v.astype("<f8").tobytes() for v in centre], pa.binary())], ["component", "centre"]
                )

    sums = "component long, data binary"
    # sums of each task first, then one row per task and component
    centres = members.select("component", "data").mapInArrow(add, sums).repartition(tasks, "component").mapInArrow(add, sums)
    centres = centres.mapInArrow(scale, "component long, centre binary")
    angles = members.join(centres, "component").select("component", "data", "centre").mapInArrow(_angles, "component long, angle double")
    return centres.join(angles.groupBy("component").agg(F.max("angle").alias("r")), "component")


def _angles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The angle of data with centre, in place of both."""
    for batch in batches:
        if batch.num_rows:
            cosine = (_rows(batch["centre"]) * _rows(batch["data"])).sum(axis=1)
            rest = batch.drop_columns(["data", "centre"])
            yield pa.RecordBatch.from_arrays([*rest.columns, pa.array(np.arccos(np.clip(cosine, -1, 1)))], [*rest.schema.names, "angle"])


def _all_linked(members: DataFrame, dim: int, threshold: float) -> DataFrame:
    """Components of more than one block of which every pair is linked, seen from their radius alone."""
    limit = float(np.arccos(threshold)) - 1e-6
    return _radii(members.filter(F.col("size") > COUNT_BLOCK), dim).filter(F.col("r") * 2 <= limit).select("component")


def _block_pairs(rows: DataFrame, size: Column, group: str, node: str) -> DataFrame:
    """The rows of each group in blocks, once for each block that theirs meets: side 2 for itself, else 0 or 1."""
    return (
        rows.withColumn("blocks", F.ceil(size / COUNT_BLOCK))
        .withColumn("own", F.pmod(F.xxhash64(node), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumn("low", F.least("own", "other"))
        .withColumn("high", F.greatest("own", "other"))
        .withColumn("side", F.when(F.col("low") == F.col("high"), 2).when(F.col("own") == F.col("low"), 0).otherwise(1))
        .withColumn("group", F.xxhash64(group, "low", "high"))
    )


def _complete(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole groups and where these begin and end; rows come with a group side by side."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        rest = table if rest is None else pa.concat_tables([rest, table])
        group = rest["group"].to_numpy()
        new = np.flatnonzero(group[1:] != group[:-1]) + 1
        if len(new):
            yield rest.slice(0, new[-1]), np.concatenate(([0], new))
            rest = rest.slice(new[-1])
    if rest is not None and rest.num_rows:
        yield rest, np.array([0, rest.num_rows])


def _near_centres(limit: float):
    """Pairs of components whose members may come as close as an angle of limit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _complete(batches):
            component, r, side, x = table["component"].to_numpy(), table["r"].to_numpy(), table["side"].to_numpy(), _rows(table["centre"])
            for a, b in zip(edges, edges[1:]):
                here, there = a + np.flatnonzero(side[a:b] != 1), a + np.flatnonzero(side[a:b] != 0)
                near = np.arccos(np.clip(x[here] @ x[there].T, -1, 1)) <= r[here][:, None] + r[there][None] + limit
                if (side[a:b] == 2).any():
                    near &= component[here][:, None] < component[there][None]
                one, two = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([pa.array(component[here[one]]), pa.array(component[there[two]])], ["a", "b"])

    return run


def _any_link(threshold: float):
    """One link of each group between its sides, if there is one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, edges in _complete(batches):
            ids, side, x = table["id"].to_numpy(), table["side"].to_numpy(), _rows(table["data"])
            for a, b in zip(edges, edges[1:]):
                here, there = a + np.flatnonzero(side[a:b] == 0), a + np.flatnonzero(side[a:b] == 1)
                linked = x[here] @ x[there].T >= threshold
                if linked.any():
                    one, two = np.unravel_index(linked.argmax(), linked.shape)
                    yield pa.RecordBatch.from_arrays([pa.array(ids[here[one : one + 1]]), pa.array(ids[there[two : two + 1]])], ["a", "b"])

    return run


def _between(nodes: DataFrame, found: DataFrame, edges: DataFrame, dim: int, threshold: float, scratch: Scratch) -> DataFrame | None:
    """Links (a, b) that join components whose nodes have so many links that a bounded list may hold none of these."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    limit = float(np.arccos(threshold)) + 1e-6
    crowded = edges.filter(~F.col("tie") & (F.col("cosine") >= threshold)).groupBy(F.col("a").alias("id")).agg(F.count(F.lit(1)).alias("k"))
    crowded = crowded.filter(F.col("k") >= NEIGHBOURS).select("id")
    members = nodes.join(crowded, "id").join(found.withColumnRenamed("node", "id"), "id")
    members = scratch.store(members.select("component", "id", "data"))
    groups = scratch.store(_radii(members, dim))
    many = groups.count()
    if many < 2:
        return None
    spread = _block_pairs(groups.withColumn("all", F.lit(0)), F.lit(many), "all", "component")
    spread = spread.repartition(tasks, "low", "high").sortWithinPartitions("group", "component")
    pairs = spread.select("group", "component", "r", "side", "centre").mapInArrow(_near_centres(limit), "a long, b long")
    pairs = scratch.store(pairs)
    if pairs.isEmpty():
        return None
    # of each pair the nodes that come near enough to the other component
    ways = pairs.select("a", "b", F.col("a").alias("component"), F.col("b").alias("to"), F.lit(0).alias("side")).unionByName(
        pairs.select("a", "b", F.col("b").alias("component"), F.col("a").alias("to"), F.lit(1).alias("side"))
    )
    ways = ways.join(groups.select(F.col("component").alias("to"), "centre", "r"), "to")
    meet = members.join(ways, "component").select("a", "b", "side", "id", "r", "data", "centre")
    meet = meet.mapInArrow(_angles, "a long, b long, side int, id long, r double, angle double").filter(F.col("angle") <= F.col("r") + limit)
    meet = scratch.store(meet.select("a", "b", "side", "id"))
    sizes = meet.groupBy("a", "b").agg(
        *(F.ceil(F.count(F.when(F.col("side") == k, 1)) / COUNT_BLOCK).alias(f"blocks{k}") for k in (0, 1))
    )
    first = F.col("side") == 0
    dealt = (
        meet.join(sizes.filter("blocks0 > 0 and blocks1 > 0"), ["a", "b"])
        .withColumn("own", F.pmod(F.xxhash64("id"), F.when(first, F.col("blocks0")).otherwise(F.col("blocks1"))))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(first, F.col("blocks1")).otherwise(F.col("blocks0")) - 1)))
        .withColumn("group", F.xxhash64("a", "b", F.when(first, F.col("own")).otherwise(F.col("other")), F.when(first, F.col("other")).otherwise(F.col("own"))))
    )
    spread = dealt.select("group", "id", "side").join(members.select("id", "data"), "id")
    spread = spread.repartition(tasks, "group").sortWithinPartitions("group", "side", "id")
    links = scratch.store(spread.select("group", "id", "side", "data").mapInArrow(_any_link(threshold), "a long, b long"))
    return None if links.isEmpty() else links


def _count_links(nodes: DataFrame, found: DataFrame, dim: int, threshold: float, scratch: Scratch) -> DataFrame:
    """id, n: the links of each node within its component, copies counted."""
    tasks = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = found.groupBy("component").agg(F.count(F.lit(1)).alias("size"))
    members = nodes.join(found.withColumnRenamed("node", "id"), "id").join(sizes, "component")
    members = scratch.store(members.select("component", "size", "id", "copies", "data"))
    whole = scratch.store(_all_linked(members, dim, threshold))
    total = members.join(whole, "component", "left_semi").groupBy("component").agg(F.sum("copies").alias("all"))
    tight = members.join(total, "component").select("id", (F.col("all") - F.col("copies")).alias("n"))
    dealt = _block_pairs(members.join(whole, "component", "left_anti"), F.col("size"), "component", "id")
    spread = dealt.repartition(tasks, "component", "low", "high").sortWithinPartitions("group", "component", "low", "high")
    counted = spread.select("group", "id", "copies", "side", "data").mapInArrow(_pair_counts(threshold), "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n")).unionByName(tight)


def trees_for(n: int, threshold: float) -> int:
    """Trees in which all but MISSED of the pairs at the threshold meet: a block of n nodes is so many signs deep."""
    depth = np.log2(max(n / BLOCK, 1)) + 1
    meet = (1 - np.arccos(threshold) / np.pi) ** depth
    return max(TREES, int(np.ceil(np.log(MISSED) / np.log1p(-meet))))


def true_links(nodes: DataFrame, threshold: float, scratch: Scratch) -> DataFrame:
    """id, links of the audited nodes, from a comparison with all; more are audited while few hold links."""
    total, wanted = nodes.count(), AUDITED
    while True:
        share = max(1, min(1 << 30, (wanted << 30) // max(total, 1)))
        chosen = nodes.filter(F.pmod(F.xxhash64("id", F.lit(3)), F.lit(1 << 30)) < share).select("id", "data").collect()
        ids = np.array([row["id"] for row in chosen], np.int64)
        queries = np.frombuffer(b"".join(bytes(row["data"]) for row in chosen), "<f8").reshape(len(ids), -1) if chosen else None
        true = scratch.store(
            nodes.select("id", "data", "copies").mapInArrow(_compare(ids, queries, threshold), "id long, n long")
            .groupBy("id").agg(F.sum("n").alias("links"))
        )
        if wanted >= min(total, MOST_AUDITED) or true.filter("links > 0").count() >= HOLDERS:
            return true
        wanted *= 4


def _compare(ids: np.ndarray, queries: np.ndarray | None, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ids), np.int64)
        for batch in batches:
            if batch.num_rows and len(ids):
                x, own, copies = _rows(batch["data"]), batch["id"].to_numpy(), batch["copies"].to_numpy()
                for at in range(0, len(ids), 256):
                    linked = queries[at : at + 256] @ x.T >= threshold
                    linked &= ids[at : at + 256, None] != own[None]
                    total[at : at + 256] += linked @ copies
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(total)], ["id", "n"])

    return run


def audit(true: DataFrame, counts: DataFrame) -> float:
    """Mean share of the true links that were counted, over the audited nodes that hold links; 1 if none does."""
    share = F.least("links", F.coalesce("n", F.lit(0))) / F.col("links")
    recall = true.filter("links > 0").join(counts, "id", "left").agg(F.avg(share)).first()[0]
    return 1.0 if recall is None else recall


def link(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector. Eager, in steps."""
    spark = embeddings.sparkSession
    scratch = Scratch(spark, "neighbours")
    packed = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").filter("vec_id is not null")
    packed = packed.mapInArrow(_pack, "vec_id long, dim int, data binary")
    vectors = scratch.store(packed.groupBy("vec_id").agg(F.max(F.struct("data", "dim")).alias("v")).select("vec_id", "v.*"))
    keyed = vectors.filter("data is not null").withColumn("key", F.sha1("data"))
    groups = keyed.groupBy("dim", "key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("copies"))
    groups = scratch.store(groups)
    nodes = scratch.store(
        keyed.withColumnRenamed("vec_id", "id").join(groups, ["dim", "key", "id"]).select("id", "dim", "copies", "data")
    )
    dims = [row[0] for row in nodes.select("dim").distinct().collect()]
    counts, labels = [], []
    for dim in sorted(dims):
        own = nodes.filter(F.col("dim") == dim).select("id", "copies", "data")
        plain, edges, trees = own.select("id", "data"), None, 0
        wanted, true = trees_for(own.count(), threshold), true_links(own, threshold, scratch)
        for attempt in range(TRIES):
            more = wanted << attempt
            edges = _descend(plain, dim, scratch, trees, more, edges, threshold)
            trees += more
            links = edges.filter(F.col("tie") | (F.col("cosine") >= threshold)).select("a", "b")
            found = scratch.store(components(links, scratch))
            across = _between(plain, found, edges, dim, threshold, scratch)
            if across is not None:
                found = scratch.store(components(links.unionByName(across), scratch))
            counted = scratch.store(_count_links(own, found, dim, threshold, scratch))
            recall = audit(true, counted)
            if recall >= LEAST_RECALL:
                break
        else:
            raise RuntimeError(f"recall {recall:.3f} of the links of audited vectors after {trees} trees, below {LEAST_RECALL}")
        counts.append(counted)
        labels.append(found)
    per_class = groups.select("dim", "key", "id", "copies")
    for name, parts in (("n", counts), ("component", labels)):
        whole = None
        for part in parts:
            part = part if name == "n" else part.withColumnRenamed("node", "id")
            whole = part if whole is None else whole.unionByName(part)
        per_class = per_class.join(whole, "id", "left") if whole is not None else per_class.withColumn(name, F.lit(None).cast("long"))
    per_vector = keyed.join(per_class, ["dim", "key"]).select(
        "vec_id",
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
    )
    return vectors.select("vec_id").join(per_vector, "vec_id", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
        (F.coalesce("component_id", "vec_id") == F.col("vec_id")).alias("kept"),
    )
