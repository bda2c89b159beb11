"""Exact Jaccard join of word shingle sets over count-vector R-trees.

Shingles are hashed into groups; the counts of its groups make a set a point. The overlap of two sets is at
most the sum of the smaller coordinates, and of a set with any member of a tree node at most that sum with
the node's largest coordinates; nodes and pairs whose bound is below the required overlap are left out, the
rest is verified on the sets.

One R-tree over all points prunes next to nothing at these dimensions: with as many points as any corpus
has, a node is narrow in a dozen coordinates only. So the points are first dealt into cells in which
every linked pair meets: two sets this similar share one of the ``prefix`` shingles that come first in any
common order, here the rarest first by a count of all shingles in hashed counters. Within a cell the
trees prune. Equal sets are one point from the start.

Each point carries parities besides: bit k tells whether an odd number of its shingles hash to k. Two sets differ
in at least as many shingles as their parities differ in bits, a second bound that is held against a pair
within its cell, before the pair is a row of any table. A fixed number of bits says little of large sets, so
pairs are held once more against parities whose number grows with the set, and only the sets of pairs that
pass are moved to be verified.

A cell of many near copies is not expanded into pairs: first each point is verified with that partner of a smaller
id whose bound is largest, a likely link (with one of a larger id where no smaller may link), and after that only cells
whose members are still in different components are searched for all pairs between these. No link between
components is lost, so components are exact.

Defined results: words are in lower case (A-Z) and separated by ASCII white space; a set is that of the runs of
``size`` words, of a shorter text its whole sequence; null and empty texts and such without words have
an empty set and link with nothing; equal sets link; rows that agree in doc_id are one document, linked by any of
its texts; a null doc_id is dropped; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.llm.arrays import LOWER, SPACES, list_array, mix, shingles, slices, span_hashes, word_bounds
from returns_analytics.llm.components import components
from returns_analytics.llm.storage import Scratch

SIZE, PERCENT = 4, 85
#: Coordinates of a point, hashed counters of shingles, points of a tree leaf.
GROUPS, COUNTERS, LEAF = 32, 1 << 20, 128
#: Parities of a set, and bits of the filter of ids.
PARITIES, FILTER_BITS = 1024, 1 << 23
#: Pairs whose bounds are computed at once.
COMPARED = 100_000
#: Pairs whose coordinates are compared in one array; most cells have no more.
FEW = 256
#: Pairs a task holds before it passes them on.
PAIRS = 100_000
_KEY = np.uint64((1 << 40) - 1)
_PIECE = 1 << 16


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row of a slice, distinct shingles sorted by row, and where each row of the slice begins."""
    for first, last, data, offsets in slices(column):
        starts, ends, rows = word_bounds(data, offsets, SPACES)
        values, owner = shingles(span_hashes(LOWER[data], starts, ends), rows, last - first, size)
        order = np.lexsort((values, owner))
        values, owner = values[order], owner[order]
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
        yield first, values, np.searchsorted(owner, np.arange(last - first + 1))


def _count(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for _, values, _ in _sets(batch["text"], size):
                total += np.bincount((values >> np.uint64(40)).astype(np.int64) % COUNTERS, minlength=COUNTERS)
        some = [k for k in range(0, COUNTERS, _PIECE) if total[k : k + _PIECE].any()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([total[k : k + _PIECE].astype("<i8").tobytes() for k in some], pa.binary())],
            ["piece", "counts"],
        )

    return run


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for piece, counts in zip(batch["piece"].to_pylist(), batch["counts"], strict=True):
            add = np.frombuffer(counts.as_py(), "<i8")
            total[piece] = total[piece] + add if piece in total else add
    # the place in the order is all that counts: sixteenths of powers of two
    level = {k: np.round(16 * np.log2(1 + v)).astype(np.uint16) for k, v in total.items()}
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(level), pa.int32()), pa.array([v.tobytes() for v in level.values()], pa.binary())],
        ["piece", "levels"],
    )


def frequency_levels(documents: DataFrame, size: int) -> np.ndarray:
    """How frequent the shingles of each hashed counter are, over all documents: a table of fixed size."""
    counted = documents.select("text").mapInArrow(_count(size), "piece int, counts binary")
    pieces = COUNTERS // _PIECE
    summed = counted.repartition(pieces, "piece").mapInArrow(_add, "piece int, levels binary").collect()
    levels = np.zeros(COUNTERS, np.uint16)
    for row in summed:
        levels[row["piece"] : row["piece"] + _PIECE] = np.frombuffer(row["levels"], np.uint16)
    return levels


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    """Shingles of a set of n of which any linked set has one among its own first ones."""
    return n - -(-n * percent // 100) + 1


def required(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Least overlap of linked sets of a and b shingles: 100 * overlap >= percent * union."""
    return -(-percent * (a + b) // (100 + percent))


def _narrow(point: np.ndarray) -> bytes:
    """Counts in one byte each, or in four if one is too large: the length tells which."""
    return (point.astype(np.uint8) if point.max() < 256 else point.astype("<u4")).tobytes()


def _wide(points: list[bytes]) -> np.ndarray:
    if all(len(p) == GROUPS for p in points):
        return np.frombuffer(b"".join(points), np.uint8).reshape(-1, GROUPS)
    return np.stack([np.frombuffer(p, np.uint8 if len(p) == GROUPS else "<u4").astype(np.uint32) for p in points])


def parities(values: np.ndarray, owner: np.ndarray, rows: int) -> np.ndarray:
    """For each row a bit per number of a hash, set where an odd count of its values has that number."""
    number = (values >> np.uint64(24)).astype(np.int64) % PARITIES
    odd = np.bincount(owner * PARITIES + number, minlength=rows * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8).reshape(rows, PARITIES), axis=1)


def wide_parities(values: np.ndarray) -> bytes:
    """Parities of one set, a power of two of them and four a value at least; halves added up are those of half as many."""
    many = max(64, 1 << (4 * len(values) - 1).bit_length())
    odd = np.bincount(mix(values).astype(np.int64) & (many - 1), minlength=many) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def differing(x: np.ndarray, y: np.ndarray) -> int:
    """Bits in which the wide parities of two sets differ, at the smaller number of them."""
    while len(x) != len(y):
        x, y = (x, y) if len(x) > len(y) else (y, x)
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum(dtype=np.int64))


def _overlaps(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums of coordinate minima of all rows of x with all rows of y, of more than FEW pairs coordinate by coordinate.

    The type of the coordinates has to hold the sum of a row, and so holds every overlap.
    """
    if len(x) * len(y) <= FEW:
        return np.minimum(x[:, None], y[None]).sum(axis=2, dtype=x.dtype)
    total = np.zeros((len(x), len(y)), x.dtype)
    least = np.empty(total.shape, x.dtype)
    for a, b in zip(np.ascontiguousarray(x.T), np.ascontiguousarray(y.T), strict=True):
        np.minimum(a[:, None], b[None], out=least)
        total += least
    return total


def _points(size: int, percent: int, levels: np.ndarray):
    """doc_id, n, two digests of the set, its group counts, its parities, and the keys of its prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, values, begin in _sets(batch["text"], size):
                n = np.diff(begin)
                rows = len(n)
                owner = np.repeat(np.arange(rows), n)
                group = (values >> np.uint64(8)).astype(np.int64) % GROUPS
                points = np.bincount(owner * GROUPS + group, minlength=rows * GROUPS).reshape(rows, GROUPS)
                odd = parities(values, owner, rows)
                full = n > 0
                one, two = np.zeros(rows, np.uint64), np.zeros(rows, np.uint64)
                if len(values):
                    one[full] = np.add.reduceat(mix(values), begin[:-1][full])
                    two[full] = np.add.reduceat(mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), begin[:-1][full])
                order = np.lexsort((values, levels[(values >> np.uint64(40)).astype(np.int64) % COUNTERS], owner))
                take = np.arange(len(values)) - begin[:-1][owner] < prefix_length(n, percent)[owner]
                length = np.where(full, prefix_length(n, percent), 0)
                keys = (values[order][take] & _KEY).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, rows),
                        pa.array(n),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.array([_narrow(p) for p in points], pa.binary()),
                        pa.array([p.tobytes() for p in odd], pa.binary()),
                        list_array(pa.array(keys), length),
                    ],
                    ["doc_id", "n", "one", "two", "point", "odd", "keys"],
                )

    return run


class CountTree:
    """R-tree over points of one cell, bulk-loaded along the coordinates with the largest spread."""

    def __init__(self, points: np.ndarray, n: np.ndarray, odd: np.ndarray | None = None) -> None:
        self.points, self.n, self.odd = points, n, odd
        parts = [np.arange(len(n))]
        while max(map(len, parts), default=0) > LEAF:
            cut = []
            for part in parts:
                if len(part) <= LEAF:
                    cut.append(part)
                    continue
                axis = points[part].std(axis=0).argmax()
                order = part[np.argsort(points[part, axis], kind="stable")]
                cut += [order[: len(order) // 2], order[len(order) // 2 :]]
            parts = cut
        self.leaves = parts
        self.largest = np.array([points[p].max(axis=0) for p in parts])
        self.least_n = np.array([n[p].min() for p in parts])
        self.most_n = np.array([n[p].max() for p in parts])

    def partners(self, at: np.ndarray, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For the points ``at``: pairs of numbers whose overlap may reach what is required, and its bound."""
        for leaf, largest, least, most in zip(self.leaves, self.largest, self.least_n, self.most_n, strict=True):
            # smallest requirement of any member against the sum of coordinate minima with the node
            bound = np.minimum(self.points[at], largest).sum(axis=1, dtype=np.int64)
            near = (bound >= required(self.n[at], least, percent)) & (100 * least <= 100 * self.n[at] * 100 // percent)
            near &= 100 * most >= percent * self.n[at]
            if not near.any():
                continue
            for some in np.array_split(at[near], max(1, near.sum() * len(leaf) // COMPARED)):
                both = _overlaps(self.points[some], self.points[leaf]).astype(np.int64)
                need = required(self.n[some][:, None], self.n[leaf][None], percent)
                i, j = np.nonzero(both >= need)
                both, need, i, j = both[i, j], need[i, j], some[i], leaf[j]
                if self.odd is not None:
                    differ = np.bitwise_count(self.odd[i] ^ self.odd[j]).sum(axis=1, dtype=np.int64)
                    both = np.minimum(both, (self.n[i] + self.n[j] - differ) // 2)
                    near_pair = both >= need
                    both, i, j = both[near_pair], i[near_pair], j[near_pair]
                yield i, j, both


def _cells(percent: int, best: bool):
    """Pairs (a, b) of points of each cell in different components that the bounds let pass, and a rank.

    Rows come sorted by key. ``best``: for each point a only its first partner b, which is one of a smaller id
    if any passes, with the largest share the bound allows; otherwise all pairs.
    """

    def pairs(rows: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        label, ids, n = rows["component"], rows["id"], rows["n"]
        # the coordinates of a point add up to n
        points = _wide(rows["point"]).astype(np.uint16 if n.max() < 1 << 16 else np.uint32)
        odd = np.frombuffer(b"".join(rows["odd"]), np.uint64).reshape(len(n), -1)
        rank = np.full(len(n), -1)
        partner = np.full(len(n), -1)
        out = []
        search = np.arange(len(n))
        if not best:
            # a component that all but a few members belong to is searched from those few
            names, common = np.unique(label, return_counts=True)
            search = np.flatnonzero(label != names[common.argmax()]) if len(names) > 1 else search
        for i, j, bound in CountTree(points, n, odd).partners(search, percent):
            other = (label[i] != label[j]) & (ids[i] != ids[j])
            i, j, bound = i[other], j[other], bound[other]
            if not len(i):
                continue
            if not best:
                out.append((ids[i], ids[j], bound))
                continue
            value = (bound * (1 << 20)) // (n[i] + n[j] - bound) + (ids[j] < ids[i]) * (1 << 21)
            # smallest partner of those with the largest share
            order = np.lexsort((ids[j], -value, i))
            i, j, value = i[order], j[order], value[order]
            lead = np.ones(len(i), bool)
            lead[1:] = i[1:] != i[:-1]
            i, j, value = i[lead], j[lead], value[lead]
            more = (value > rank[i]) | ((value == rank[i]) & (ids[j] < ids[partner[i]]))
            rank[i[more]], partner[i[more]] = value[more], j[more]
        if best:
            has = np.flatnonzero(partner >= 0)
            return ids[has], ids[partner[has]], rank[has]
        if not out:
            return (np.zeros(0, np.int64),) * 3
        x, y, bound = (np.concatenate(o) for o in zip(*out, strict=True))
        return np.minimum(x, y), np.maximum(x, y), bound

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def flush() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            rows = {
                name: table[name].to_pylist() if name in ("point", "odd") else table[name].to_numpy()
                for name in table.column_names
            }
            key = rows["key"]
            edges = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
            out, size = [], 0
            for a, b in zip(edges, edges[1:]):
                out.append(pairs({name: values[a:b] for name, values in rows.items()}))
                size += len(out[-1][0])
                if size > PAIRS or b == len(key):
                    columns = [pa.array(np.concatenate([o[k] for o in out]).astype(np.int64)) for k in range(3)]
                    yield pa.RecordBatch.from_arrays(columns, ["a", "b", "rank"])
                    out, size = [], 0

        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch["key"].to_numpy()
            # everything before the last key of the batch is complete
            cut = int(np.searchsorted(key, key[-1]))
            if cut or (held and held[-1]["key"][0].as_py() != key[-1]):
                held.append(batch.slice(0, cut))
                yield from flush()
                held = [batch.slice(cut)]
            else:
                held.append(batch)
        if held:
            yield from flush()

    return run


def _id_filter(ids: DataFrame) -> np.ndarray:
    """Bits of a table of fixed size, set for the hashes of the ids in column ``a``.

    It spares a shuffle of all texts to meet few ids: rows whose bit is not set are none of them.
    """
    at = F.pmod(F.xxhash64("a"), F.lit(FILTER_BITS))
    words = ids.select((at % 64).cast("int").alias("bit"), F.floor(at / 64).alias("word")).groupBy("word").agg(
        F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    for row in words.collect():
        table[row["word"]] = row["bits"]
    return table


def _hold_sets(size: int, bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch["at"].to_numpy()
            batch = batch.filter(pa.array((bits[at // 64] >> (at % 64)) & 1 == 1))
            for first, values, begin in _sets(batch["text"], size):
                packed = values.astype("<u8").tobytes()
                edges = list(zip(begin, begin[1:]))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["doc_id"].slice(first, len(begin) - 1),
                        pa.array([packed[8 * a : 8 * b] for a, b in edges], pa.binary()),
                        pa.array([wide_parities(values[a:b]) for a, b in edges], pa.binary()),
                        pa.array(np.diff(begin)),
                    ],
                    ["id", "held", "odd", "n"],
                )

    return run


def _may_link(percent: int):
    """Pairs whose wide parities leave the overlap that linked sets need."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch["n"].to_numpy(), batch["m"].to_numpy()
            differ = np.array(
                [
                    differing(np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8))
                    for x, y in zip(batch["x"], batch["y"], strict=True)
                ],
                np.int64,
            )
            yield batch.select(["a", "b"]).filter(pa.array((n + m - differ) // 2 >= required(n, m, percent)))

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(batch.num_rows, bool)
            for k, (x, y) in enumerate(zip(batch["x"], batch["y"], strict=True)):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = np.concatenate((x, y))
                both.sort(kind="stable")
                good[k] = np.count_nonzero(both[1:] == both[:-1]) >= required(len(x), len(y), percent)
            yield batch.select(["a", "b"]).filter(pa.array(good))

    return run


def classes(documents: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest linked doc_id, itself included). Eager, in steps."""
    spark = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    scratch = Scratch(spark, "jaccard")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").filter("doc_id is not null")
    levels = frequency_levels(texts, size)
    points = scratch.store(
        texts.mapInArrow(
            _points(size, percent, levels), "doc_id long, n long, one long, two long, point binary, odd binary, keys array<long>"
        )
    )
    digest = ["n", "one", "two"]
    firsts = scratch.store(points.filter("n > 0").groupBy(*digest).agg(F.min("doc_id").alias("id")))
    # one row per distinct set; of equal rows under one id any serves
    distinct = points.join(firsts.withColumnRenamed("id", "doc_id"), ["doc_id", *digest]).dropDuplicates(["doc_id", *digest])
    unique = scratch.store(
        distinct.select(F.col("doc_id").alias("id"), "n", "one", "two", "point", "odd", "keys")
    )
    by_key = Window.partitionBy("key").orderBy("id")
    # cells of one point are done; neighbours in the order show which these are
    cells = scratch.store(
        unique.select("id", F.explode("keys").alias("key"))
        .select("key", "id", F.lag("id").over(by_key).alias("last"), F.lead("id").over(by_key).alias("next"))
        .filter("last is not null or next is not null")
        .select("key", "id")
    )
    ids = unique.select("id", "n", "point", "odd")
    digests = scratch.store(points.select("doc_id", *digest))
    scratch.drop(points)

    def search(rows: DataFrame, best: bool) -> DataFrame:
        members = rows.join(ids, "id").repartition(tasks, "key").sortWithinPartitions("key", "id")
        members = members.select("key", "id", "component", "n", "point", "odd")
        pairs = members.mapInArrow(_cells(percent, best), "a long, b long, rank long")
        if best:
            chosen = pairs.groupBy("a").agg(F.max(F.struct("rank", F.negative("b").alias("b"))).alias("p"))
            pairs = chosen.select(F.least("a", F.negative("p.b")).alias("a"), F.greatest("a", F.negative("p.b")).alias("b"))
        return pairs.select("a", "b").distinct()  # a pair shares many cells: combined before the shuffle

    pairs = scratch.store(search(cells.withColumn("component", F.col("id")), True))
    # every point with any partner has a first one: no other text is needed from here on
    involved = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a")))
    bits = _id_filter(involved)
    held = texts.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(FILTER_BITS)).alias("at"), "text")
    sets = scratch.store(held.mapInArrow(_hold_sets(size, bits), "id long, held binary, odd binary, n long"))
    live = scratch.store(cells.join(involved.select(F.col("a").alias("id")).distinct(), "id").select("key", "id"))

    def beside(pairs: DataFrame, rows: DataFrame, *columns: tuple[str, str, str]) -> DataFrame:
        """The pairs with columns of the rows of both ids; only rows that a pair asks for move."""
        for side, *names in columns:
            asked = rows.join(pairs.select(F.col(side).alias("id")).distinct(), "id", "left_semi")
            named = [F.col(old).alias(new) for old, new in names]
            pairs = pairs.join(asked.select(F.col("id").alias(side), *named), side)
        return pairs

    def verify(pairs: DataFrame) -> DataFrame:
        sketched = beside(
            pairs, sets.select("id", "odd", "n"), ("b", ("odd", "y"), ("n", "m")), ("a", ("odd", "x"), ("n", "n"))
        )
        near = scratch.store(
            sketched.select("a", "b", "n", "m", "x", "y").mapInArrow(_may_link(percent), "a long, b long").distinct()
        )
        both = beside(near, sets.select("id", "held"), ("b", ("held", "y")), ("a", ("held", "x")))
        compared = both.select("a", "b", "x", "y").mapInArrow(_verify(percent), "a long, b long")
        return scratch.store(compared.distinct())

    links = verify(pairs)
    found = scratch.store(components(links, scratch))
    labelled = live.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")
    )
    labelled = scratch.store(labelled)
    mixed = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    mixed = mixed.filter("low <> high").select("key")
    rest = search(labelled.join(mixed, "key"), False)
    links = links.unionByName(verify(scratch.store(rest)))
    equal = digests.filter("n > 0").join(firsts, digest).select(F.col("id").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.unionByName(equal), scratch)
    sizes = digests.groupBy("doc_id").agg(F.max("n").alias("n_shingles"))
    return sizes.join(final.withColumnRenamed("node", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def keep_first(documents: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, that with the smallest doc_id; rows without a doc_id stay. All columns."""
    found = classes(documents, size, percent)
    dropped = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_dropped"))
    return documents.join(dropped, documents["doc_id"] == dropped["_dropped"], "left_anti")
