"""Removal of repeated byte strings by suffix arrays.

Two equal strings of ``length`` bytes hold the same anchor: of their runs of ``GRAM`` bytes the one with the
smallest hash. So every window of that length is dealt to its anchor's hash, neighbouring windows
with one anchor together (a stretch), and only stretches whose anchor occurs again can hold a repeated
window. Equal stretches are counted, combined before the shuffle, and need no text. The other ones, one of
each content, are brought together by anchor; there their suffixes are sorted to the depth of a window,
by prefix doubling of ranks, and the previous and next smaller positions in suffix order give each
window's longest earlier match, cut at the depth. An earlier match of full depth makes a window a later
copy; ``keep_first`` removes later copies only, otherwise every copy goes.

An anchor with very many different stretches is not sorted, so that no task has to hold all its stretches. They
are dealt in parts of ``SPLIT`` windows by the bytes these share; equal parts are counted like equal stretches,
and where parts that share these bytes still differ, their windows are counted one by one. Parts and windows are
told apart by 128 bits of a hash.

Defined results: a null text is empty; texts shorter than a window stay; matches never cross documents but
may overlap, within one document as well; rows that agree in doc_id and text count as two documents with
the same outcome; the first copy is that with the smallest doc_id (null first), then hash of the text, then
position; an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm import arrays
from returns_analytics.llm.arrays import mix, powers, ragged, sliding_min, slices
from returns_analytics.llm.storage import Scratch

LENGTH, GRAM = 200, 40
#: Different stretches of an anchor from which they are dealt further, and the windows dealt as one then.
MANY, SPLIT = 4096, 16
#: Bytes of stretches sorted at once; more if an anchor has more, which has MANY stretches at most.
SORT_BYTES = 1 << 21
_NO_ID = -(1 << 63)
_HASH_BITS, _AT_BITS = np.uint64(36), np.uint64(28)
_AT = ["doc", "text_hash"]


def _hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers from which hashes of any span follow."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(arrays._BYTE_CODE[data] * powers(arrays._MULTIPLIER, n)[:n], out=sums[1:])
    return sums, powers(arrays._INVERSE, n)


def stretches(data: np.ndarray, offsets: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """Row, first and last window, anchor (positions in the row), anchor hash and content hash."""
    gram = min(GRAM, length)
    none = (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    n = len(data)
    if n < length:
        return none
    if n >> int(_AT_BITS):
        raise ValueError("a text of more than 268 million bytes cannot be anchored")
    sums, inverse = _hashes(data)
    grams = mix((sums[gram:] - sums[:-gram]) * inverse[: n - gram + 1])
    packed = (grams >> (np.uint64(64) - _HASH_BITS)) << _AT_BITS
    packed |= np.arange(len(grams), dtype=np.uint64)
    anchor = (sliding_min(packed, length - gram + 1) & np.uint64((1 << int(_AT_BITS)) - 1)).astype(np.int64)
    # windows that stay within their row
    begin, count = offsets[:-1], np.maximum(np.diff(offsets) - length + 1, 0)
    windows = ragged(begin, count)
    if not len(windows):
        return none
    row = np.repeat(np.arange(len(begin)), count)
    anchor = anchor[windows]
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(new)
    first, last = windows[at], windows[np.append(at[1:], len(windows)) - 1]
    anchor, row = anchor[at], row[at]
    content = mix((sums[last + length] - sums[first]) * inverse[first] + (last - first).astype(np.uint64))
    content = mix(content + (anchor - first).astype(np.uint64))
    return row, first - begin[row], last - begin[row], anchor - begin[row], grams[anchor], content


def _find(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, text_hash = (batch[c].to_numpy() for c in _AT)
            for begin, _, data, offsets in slices(batch["text"]):
                row, first, last, anchor, key, content = stretches(data, offsets, length)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc[begin + row]), pa.array(text_hash[begin + row]), pa.array(first.astype(np.int32)),
                        pa.array(last.astype(np.int32)), pa.array(anchor.astype(np.int32)),
                        pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                    ],
                    [*_AT, "first", "last", "anchor", "key", "content"],
                )

    return run


def suffix_ranks(data: np.ndarray, end: np.ndarray, depth: int) -> np.ndarray:
    """Ranks of the suffixes of every position by their first ``depth`` bytes; -1 where fewer are left.

    end: where the text of each position ends. The ranks double their depth, from eight bytes on, and the
    last step lets two overlapping ranks cover the depth. Equal ranks are equal strings.
    """
    n, known = len(data), 1
    rank = data.astype(np.int64)
    at = np.arange(n)
    while known < depth:
        step = min(known, depth - known)
        good = at + known + step <= end
        new = np.full(n, -1, np.int64)
        if good.any():
            where = at[good]
            pair = rank[where] * (rank.max() + 1) + rank[where + step]
            if known < 4:  # up to four bytes a pair is a rank by itself
                new[where] = pair
            else:
                new[where] = np.unique(pair, return_inverse=True)[1]
        rank, known = new, known + step
    return rank


def earlier_matches(rank: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For suffixes with their ranks and places: whether an earlier place has a full match, and whether any has.

    In suffix order, equal ranks by place, the previous smaller position of all but the first suffix of
    a rank is the one before it, and matches to the full depth: its longest previous factor. The next smaller
    position has a higher rank and a shorter match.
    """
    order = np.lexsort((place, rank))
    same = rank[order][1:] == rank[order][:-1]
    later, shared = np.zeros(len(rank), bool), np.zeros(len(rank), bool)
    later[order[1:]] = same
    shared[order[1:]] = same
    shared[order[:-1]] |= same
    return later, shared


def _cut(length: int):
    """The bytes of the stretches asked for of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for doc, text_hash, text, wanted in zip(*(batch[c].to_pylist() for c in (*_AT, "text", "wanted")), strict=True):
                data = text.encode()
                for w in wanted:
                    part = data[w["first"] : w["last"] + length]
                    out.append((w["key"], w["content"], doc, text_hash, w["first"], part, w["anchor"], w["many"]))
            names = ["key", "content", *_AT, "first", "bytes", "anchor", "many"]
            yield _batch(out, names, (*(pa.int64(),) * 4, pa.int32(), pa.binary(), pa.int32(), pa.bool_()))

    return run


def _batch(rows: list[tuple], names: list[str], kinds: tuple) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)


def _digest(data: bytes) -> tuple[int, int]:
    whole = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(whole[:8], "little", signed=True), int.from_bytes(whole[8:], "little", signed=True)


def _parts(length: int, single: bool):
    """Stretches, from their bytes, in parts of SPLIT windows or, if ``single``, window by window: place and hashes.

    low, high: the windows of the stretch to cut up, counted from its first one. skip: windows of the stretch
    before the part. dealt: hash of the bytes all windows of a part share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            columns = (batch[c].to_pylist() for c in ("key", "content", *_AT, "first", "bytes", "anchor", "low", "high"))
            for key, content, doc, text_hash, begin, data, anchor, low, high in zip(*columns, strict=True):
                first, last = begin + low, begin + high
                at = (key, content, doc, text_hash)
                if single:
                    for k in range(low, high + 1):
                        one, two = _digest(data[k : k + length])
                        out.append((one, one, two, *at, begin + k, begin + k, anchor, k))
                    continue
                # windows by their distance to the anchor: parts begin at fixed distances
                for part in range((anchor - last) // SPLIT, (anchor - first) // SPLIT + 1):
                    least, most = anchor - part * SPLIT - SPLIT + 1, anchor - part * SPLIT
                    a, b = max(first, least), min(last, most)
                    dealt = _digest(data[max(most - begin, 0) : max(least + length - begin, 0)])[0]
                    out.append((dealt, *_digest(data[a - begin : b + length - begin]), *at, a, b, anchor, a - begin))
            names = ["dealt", "one", "two", "key", "content", *_AT, "first", "last", "anchor", "skip"]
            yield _batch(out, names, (*(pa.int64(),) * 7, *(pa.int32(),) * 4))

    return run


_PARTS = "dealt long, one long, two long, key long, content long, doc long, text_hash long, first int, last int, anchor int, skip int"
_CUT = "key long, content long, doc long, text_hash long, first int, bytes binary, anchor int, many boolean"


def _match(length: int, keep_first: bool):
    """key, content, low, high: windows to remove of each stretch, counted from its first one."""

    def sort(table: pa.Table) -> Iterator[pa.RecordBatch]:
        parts = table["bytes"].to_pylist()
        size = np.array([len(p) for p in parts])
        data = np.frombuffer(b"".join(parts), np.uint8)
        begin = np.cumsum(size) - size
        rank = suffix_ranks(data, np.repeat(begin + size, size), length)
        count = size - length + 1
        windows = ragged(begin, count)
        owner = np.repeat(np.arange(len(parts)), count)
        doc, text_hash, first = (table[c].to_numpy() for c in (*_AT, "first"))
        text = np.zeros(len(parts), np.int64)
        order = np.lexsort((text_hash, doc))
        changed = (doc[order][1:] != doc[order][:-1]) | (text_hash[order][1:] != text_hash[order][:-1])
        text[order[1:]] = np.cumsum(changed)
        place = (text[owner] << 32) + first[owner] + windows - begin[owner]
        later, shared = earlier_matches(rank[windows], place)
        hit = np.flatnonzero(later if keep_first else shared)
        if not len(hit):
            return
        new = np.ones(len(hit), bool)
        new[1:] = (np.diff(hit) != 1) | (owner[hit[1:]] != owner[hit[:-1]])
        low = hit[new]
        high = hit[np.append(np.flatnonzero(new)[1:], len(hit)) - 1]
        own = owner[low]
        offset = -begin[own]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(table["key"].to_numpy()[own]), pa.array(table["content"].to_numpy()[own]),
                pa.array((windows[low] + offset).astype(np.int32)), pa.array((windows[high] + offset).astype(np.int32)),
            ],
            ["key", "content", "low", "high"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while batch.num_rows:
                # complete anchors up to the wanted size; rows come sorted
                key = batch["key"].to_numpy()
                ends = np.append(np.flatnonzero(key[1:] != key[:-1]) + 1, len(key))
                if held and held[-1]["key"][-1].as_py() != key[0] and size >= SORT_BYTES:
                    yield from sort(pa.Table.from_batches(held))
                    held, size = [], 0
                lengths = np.frombuffer(batch["bytes"].buffers()[1], np.int32, len(key) + 1, batch["bytes"].offset * 4)
                taken = (lengths[ends] - lengths[0]).astype(np.int64)
                k = int(np.searchsorted(taken, SORT_BYTES - size))
                cut = int(ends[min(k, len(ends) - 1)])
                held.append(batch.slice(0, cut))
                size += int(lengths[cut] - lengths[0])
                batch = batch.slice(cut)
        if held:
            yield from sort(pa.Table.from_batches(held))

    return run


def _crowded(pieces: DataFrame, length: int, keep_first: bool, scratch: Scratch) -> DataFrame:
    """key, content, low, high as ``_match`` gives them, for stretches of anchors with very many, by counting.

    pieces: the stretches with their bytes, one of each content; no text is read again.
    """
    here, kept = F.struct(*_AT, "first"), F.struct("kept.doc", "kept.text_hash", "kept.first")

    def read(some: DataFrame, single: bool) -> DataFrame:
        asked = some.select("key", "content", *_AT, "first", "bytes", "anchor", "low", "high")
        return scratch.store(asked.mapInArrow(_parts(length, single), _PARTS))

    def again(some: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Each part once, and the rows of those that occur again and go."""
        place = F.struct(*_AT, "first", "last", "anchor", "skip", "key", "content")
        once = scratch.store(some.groupBy("dealt", "one", "two").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("kept")))
        rows = some.join(once.filter("n > 1").select("dealt", "one", "two", "kept"), ["dealt", "one", "two"])
        rows = rows.filter(here > kept) if keep_first else rows
        return once, rows.select(
            "key", "content", F.col("skip").alias("low"), (F.col("skip") + F.col("last") - F.col("first")).alias("high")
        )

    whole = pieces.withColumns({"low": F.lit(0), "high": F.octet_length("bytes") - length})
    once, equal = again(read(whole, False))
    differ = scratch.store(once.groupBy("dealt").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1").select("dealt"))
    parts = once.join(differ, "dealt").select(
        "kept.key", "kept.content", F.col("kept.skip").alias("low"),
        (F.col("kept.skip") + F.col("kept.last") - F.col("kept.first")).alias("high"),
    )
    _, single = again(read(pieces.join(parts, ["key", "content"]), True))
    return equal.unionByName(single)


def removed_spans(documents: DataFrame, scratch: Scratch, length: int = LENGTH, keep_first: bool = False) -> DataFrame:
    """doc, text_hash, windows: first and last of the windows to remove, for each document that has any."""
    spark = documents.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = documents.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.xxhash64("text").alias("text_hash"), "text"
    ).filter(F.octet_length("text") >= length)
    found = scratch.store(
        texts.mapInArrow(
            _find(length), "doc long, text_hash long, first int, last int, anchor int, key long, content long"
        )
    )
    by_key = found.groupBy("key").agg(F.count(F.lit(1)).alias("all"))
    again = by_key.filter("all > 1").drop("all")
    repeated = scratch.store(found.join(again, "key"))
    scratch.drop(found)
    by_content = repeated.groupBy("key", "content").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(*_AT, "first", "last", "anchor")).alias("kept")
    )
    by_content = scratch.store(by_content)
    kinds = by_content.groupBy("key").agg(F.count(F.lit(1)).alias("kinds")).filter("kinds > 1")
    # one stretch of each content, where an anchor has several
    wanted = by_content.join(kinds, "key").select(
        "kept.doc", "kept.text_hash",
        F.struct("key", "content", "kept.first", "kept.last", "kept.anchor", (F.col("kinds") > MANY).alias("many")).alias("w"),
    )
    wanted = scratch.store(wanted)
    # whole texts move once for all of them; what follows works on the bytes of stretches
    per_text = wanted.groupBy(*_AT).agg(F.collect_list("w").alias("wanted"))
    cut_up = texts.join(per_text, _AT).select(*_AT, "text", "wanted").mapInArrow(_cut(length), _CUT)
    pieces = scratch.store(cut_up)
    scratch.drop(wanted)
    few = pieces.filter("not many").select("key", "content", *_AT, "first", "bytes")
    sorted_ones = few.repartition(tasks, "key").sortWithinPartitions("key", *_AT, "first")
    matched = scratch.store(sorted_ones.mapInArrow(_match(length, keep_first), "key long, content long, low int, high int"))
    many = pieces.filter("many")
    if not many.isEmpty():
        matched = matched.unionByName(scratch.store(_crowded(many, length, keep_first, scratch)))
    scratch.drop(pieces)
    if keep_first:
        # copies of a stretch go whole; its first one loses the windows that match an earlier place
        here = F.struct(*_AT, "first")
        first_of = F.struct("kept.doc", "kept.text_hash", "kept.first")
        copies = repeated.join(by_content.filter("n > 1").select("key", "content", "kept"), ["key", "content"])
        whole = copies.filter(here > first_of).select(*_AT, "first", "last")
        some = matched.join(by_content.select("key", "content", "kept"), ["key", "content"]).select(
            F.col("kept.doc").alias("doc"), F.col("kept.text_hash").alias("text_hash"),
            (F.col("kept.first") + F.col("low")).alias("first"), (F.col("kept.first") + F.col("high")).alias("last"),
        )
    else:
        once = by_content.filter("n = 1")
        whole = repeated.join(by_content.filter("n > 1").select("key", "content"), ["key", "content"]).select(*_AT, "first", "last")
        some = matched.join(once.select("key", "content", "kept"), ["key", "content"]).select(
            F.col("kept.doc").alias("doc"), F.col("kept.text_hash").alias("text_hash"),
            (F.col("kept.first") + F.col("low")).alias("first"), (F.col("kept.first") + F.col("high")).alias("last"),
        )
    windows = whole.unionByName(some)
    return windows.groupBy(*_AT).agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("windows"))


def cut(data: bytes, windows: list[dict], length: int) -> tuple[bytes, int]:
    """The bytes that stay, and how many maximal runs go. windows: sorted first and last windows."""
    kept, at, spans, end = [], 0, 0, -1
    for window in windows:
        if window["first"] > end:  # runs that touch are one
            kept.append(data[at : window["first"]])
            spans += 1
        at = end = max(end, window["last"] + length)
    kept.append(data[at:])
    return b"".join(kept), spans


def remove_repeats(documents: DataFrame, length: int = LENGTH, keep_first: bool = False, digest: bool = False) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed and n_spans of every row; with ``digest`` the SHA-256 of the kept bytes."""
    windows = removed_spans(documents, Scratch(documents.sparkSession, "repeats"), length, keep_first)
    doc, text_hash = F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)), F.xxhash64("text")
    rows = documents.select("doc_id", "text")
    joined = rows.join(windows, (doc == windows["doc"]) & (text_hash == windows["text_hash"]), "left")
    name, kind = ("kept_sha256", pa.string()) if digest else ("kept", pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, result = [], [], [], []
            for text, found in zip(batch["text"], batch["windows"], strict=True):
                data = (text.as_py() or "").encode()
                kept, n = cut(data, found.as_py() or [], length)
                size.append(len(data))
                removed.append(len(data) - len(kept))
                spans.append(n)
                result.append(hashlib.sha256(kept).hexdigest() if digest else kept)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(result, kind)],
                ["doc_id", "n_bytes", "n_removed", "n_spans", name],
            )

    schema = f"doc_id long, n_bytes long, n_removed long, n_spans long, {name} {'string' if digest else 'binary'}"
    return joined.select("doc_id", "text", "windows").mapInArrow(run, schema)
