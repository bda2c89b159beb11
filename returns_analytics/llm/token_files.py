"""Token ids in files of fixed-width bit packing.

Every id takes the minimum of bits the vocabulary needs. A file is

    magic (8 bytes)
    blocks of ``BLOCK`` ids, the last one shorter, each padded to a byte
    document table: doc_id (int64), start (uint64, one more than documents), known (uint8; 0: doc_id is null)
    block table: offset (uint64), crc32 (uint32)
    tail: ids, documents, blocks, start of the tables (uint64); bits, ids per block, crc32 of the tables (uint32); magic

all little-endian. Eight ids fill exactly ``bits`` bytes, so packing and unpacking are a few numpy operations
over columns of bytes, and the block table leads from any id to the bytes that hold it: ``PackedFile.ids`` reads
only the blocks it needs.

Documents are tokenised where they are scanned, dealt to shards by doc_id (bounds from one quantile sketch;
an id that spans several bounds is dealt further by content) and sorted within each; a task writes its
shard to files of bounded size under names of its attempt. The manifest, stored by Spark's own commit, names
the files of one attempt per task, and only these are read: an attempt that is lost or repeated
leaves files nobody reads.

Defined results: a null or empty text is the final id alone; a null doc_id comes first; repeated ids are
ordered by content, and equal rows are written once each; a text that holds the name of a special token gives
its id, as the tokenizer does; an empty table gives an empty manifest; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from returns_analytics.llm.arrays import list_array, ragged, slices, span_hashes, table_of
from returns_analytics.llm.storage import Scratch

#: The id after every document.
FINAL_ID = 2
#: Ids of a block; bytes of blocks and documents after which a file is closed.
BLOCK, ROLL_BYTES, ROLL_DOCUMENTS = 4096, 64 << 20, 1 << 20
#: Parts of texts whose ids a worker keeps in each of two generations.
PARTS_KEPT = 800_000
#: Ids unpacked at once.
_RUN = 1 << 19
_MAGIC = b"TOKBITS1"
_TAIL = struct.Struct("<QQQQIII4x8s")
_ENCODED = pa.schema([("shard", pa.int32()), ("doc_id", pa.int64()), ("n", pa.int64()), ("packed", pa.binary())])
ENCODED = "shard int, doc_id long, n long, packed binary"
_MANIFEST = pa.schema(
    [("shard", pa.int32()), ("part", pa.int32()), ("name", pa.string()), ("documents", pa.int64()), ("ids", pa.int64()), ("bytes", pa.int64())]
)
MANIFEST = "shard int, part int, name string, documents long, ids long, bytes long"
_DIGEST = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"
IDS = "doc_id long, start long, ids array<long>"


def width_of(vocabulary: int) -> int:
    """Bits that hold every id below the size of the vocabulary."""
    return max(1, (vocabulary - 1).bit_length())


#: Widths for which the packed form is an array of whole numbers.
_WHOLE_BYTES = {8: "u1", 16: "<u2", 32: "<u4"}


def pack_bits(ids: np.ndarray, bits: int) -> bytes:
    """Ids at ``bits`` bits each, lowest bit first."""
    n = len(ids)
    if n and int(ids.max()) >> bits:
        raise ValueError(f"an id needs more than {bits} bits")
    if bits in _WHOLE_BYTES:
        return ids.astype(_WHOLE_BYTES[bits]).tobytes()
    lanes = np.zeros(-(-n // 8) * 8, np.uint64)
    lanes[:n] = ids
    lanes = lanes.reshape(-1, 8)
    out = np.zeros((len(lanes), bits), np.uint8)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = lanes[:, lane] << np.uint64(shift)
        for k in range((shift + bits + 7) // 8):
            out[:, byte + k] |= (value >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: (n * bits + 7) // 8]


def unpack_bits(data: bytes, n: int, bits: int) -> np.ndarray:
    """The first ``n`` ids of packed bytes."""
    if bits in _WHOLE_BYTES:
        return np.frombuffer(data, _WHOLE_BYTES[bits], n).astype(np.uint32)
    groups = -(-n // 8)
    padded = np.zeros(groups * bits, np.uint8)
    taken = np.frombuffer(data, np.uint8, (n * bits + 7) // 8)
    padded[: len(taken)] = taken
    padded = padded.reshape(groups, bits)
    out = np.empty((groups, 8), np.uint32)
    mask = np.uint64((1 << bits) - 1)
    for lane in range(8):
        byte, shift = divmod(lane * bits, 8)
        value = np.zeros(groups, np.uint64)
        for k in range((shift + bits + 7) // 8):
            value |= padded[:, byte + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, lane] = (value >> np.uint64(shift)) & mask
    return out.reshape(-1)[:n]


class _Kept(dict):
    """Values computed once; when full, the generation before is forgotten, so that frequent keys stay."""

    def __init__(self, compute, size: int) -> None:
        super().__init__()
        self._compute, self._size, self._old = compute, size, {}

    def __missing__(self, key: bytes) -> bytes:
        value = self._old.get(key)
        if value is None:
            value = self._compute(key)
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


#: How byte-level files of this family split a text, for texts of Latin-1 characters; fixed values.
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff"
_DIGIT = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_WHITE = r"\t-\r \x85\xa0"
_SPLIT = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_WHITE}{_LETTER}{_DIGIT}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
_IN_LATIN = re.compile("[\x00-\xff]*").fullmatch
#: Byte-level characters: bytes that print stand for themselves, the others follow from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}
_SPACE = chr(_BYTE_LEVEL[32])

_ASCII_LETTERS = table_of(bytes(b for b in range(128) if chr(b).isalpha()))
#: What ends a word without being able to join what follows it, unlike an apostrophe.
_MARKS = table_of(bytes(b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"))
#: Bytes a space may be cut off from: what prints in ASCII, and all others but the last bytes of white space.
_SOLID = table_of(bytes(b for b in range(33, 256) if b != 127 and b not in {*range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF}))


def part_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where the parts of all rows begin; no token of a byte-level split reaches over these places.

    A part begins with its row, with a space that follows something else than white space, and with a
    punctuation mark that follows a letter.
    """
    cut = np.zeros(len(data), bool)
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    before, here = data[:-1], data[1:]
    space = here == 32
    cut[1:] |= (space & _SOLID[before]) | (_MARKS[here] & _ASCII_LETTERS[before])
    # last bytes that letters share with white space: decided by the bytes before
    for at in (np.flatnonzero(space & ~_SOLID[before] & (before >= 0x80)) + 1,):
        two = (data[at - 2] == 0xC2) & ((data[at - 1] == 0x85) | (data[at - 1] == 0xA0))
        three = (data[at - 2] >= 0x80) & (data[at - 2] < 0xC0) & (data[at - 3] >= 0xE1) & (data[at - 3] <= 0xE3)
        cut[at[~two & ~three]] = True
    return np.flatnonzero(cut)


class ByteTokenizer:
    """Ids of whole texts by a byte-level tokenizer file, many rows at once.

    The ids of a text are those of its parts (part_starts) one after another. The parts of a slice of rows are found and
    made distinct by arrays; each distinct part is then looked up, and the tokenizer is asked for new ones only.
    Parts with characters beyond Latin-1, rows that name a special token and files of another kind go
    through the tokenizer whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self._whole = Tokenizer.from_file(path)
        self.vocabulary = self._whole.get_vocab_size()
        split = self._whole.pre_tokenizer
        self.by_parts = isinstance(split, ByteLevel) and split.use_regex and not split.add_prefix_space
        self.by_parts = self.by_parts and self._whole.normalizer is None and self._whole.post_processor is None
        added = [token.content for token in self._whole.get_added_tokens_decoder().values()]
        self._added = re.compile(b"|".join(re.escape(name.encode()) for name in added) or b"(?!)")
        model = self._whole.model
        # parts are looked up here; the model's own small table would cost more than it finds
        getattr(model, "_resize_cache", lambda size: None)(0)
        self._model = model.tokenize
        self._parts = _Kept(self._part, PARTS_KEPT)

    def _part(self, part: bytes) -> bytes:
        text = part.decode()
        if not (text.isascii() or _IN_LATIN(text)):
            return self._whole_ids(text)
        ids = []
        for piece in _SPLIT.findall(text):
            if piece.isascii() and piece.isprintable():
                level = piece.replace(" ", _SPACE)
            else:
                level = piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
            ids += [token.id for token in self._model(level)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def _whole_ids(self, text: str) -> bytes:
        return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def encode(self, text: str) -> np.ndarray:
        """Ids of one text."""
        return next(self.encode_rows(pa.array([text], pa.string())))[0]

    def encode_rows(self, column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of all rows of a slice, one after another, and how many each row has; null counts as empty."""
        for _, _, data, offsets in slices(column):
            blob = data.tobytes()
            special = {int(np.searchsorted(offsets, m.start(), "right")) - 1 for m in self._added.finditer(blob)}
            if not self.by_parts:
                special = set(range(len(offsets) - 1))
            ids, counts = self._slice(data, blob, offsets) if len(special) < len(offsets) - 1 else (None, None)
            if special:
                ends = np.cumsum(counts) if counts is not None else None
                rows = []
                for row in range(len(offsets) - 1):
                    if row in special:
                        whole = self._whole_ids(blob[offsets[row] : offsets[row + 1]].decode())
                        rows.append(np.frombuffer(whole, "<u4"))
                    else:
                        rows.append(ids[ends[row] - counts[row] : ends[row]])
                ids, counts = np.concatenate(rows), np.array([len(r) for r in rows], np.int64)
            yield ids, counts

    def _slice(self, data: np.ndarray, blob: bytes, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = part_starts(data, offsets)
        if not len(starts):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        ends = np.append(starts[1:], len(data))
        _, first, which = np.unique(span_hashes(data, starts, ends), return_index=True, return_inverse=True)
        # parts lie one after another, so all of them are compared with their first likeness at once
        lengths = ends - starts
        like = first[which]
        if not (lengths == lengths[like]).all() or not (data == data[ragged(starts[like], lengths)]).all():
            first, which = np.arange(len(starts)), np.arange(len(starts))
        keys = [blob[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)]
        found = list(map(self._parts.__getitem__, keys))
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        flat = np.frombuffer(b"".join(found), "<u4")
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        ids = flat[ragged(begin[which], sizes[which])]
        rows = np.searchsorted(offsets, starts, "right") - 1
        counts = np.bincount(rows, weights=sizes[which], minlength=len(offsets) - 1).astype(np.int64)
        return ids, counts


_TOKENIZERS: dict[str, ByteTokenizer] = {}


def _tokenizer(path: str) -> ByteTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = ByteTokenizer(path)
    return _TOKENIZERS[path]


def shard_bounds(documents: DataFrame, shards: int) -> np.ndarray:
    """doc_ids that cut the table into shards of about equal rows; a frequent id stands there repeatedly.

    One pass over the id column by a mergeable sketch; ``shards - 1`` numbers at most.
    """
    if shards < 2:
        return np.zeros(0, np.int64)
    cuts = F.percentile_approx("doc_id", [k / shards for k in range(1, shards)], max(10_000, 20 * shards))
    return np.array(documents.agg(cuts.alias("cuts")).first()["cuts"] or [], np.int64)


def _shards(doc_ids: pa.Array, bounds: np.ndarray, packed: list[bytes]) -> np.ndarray:
    """Shard of every row: by doc_id, and by content where an id spans several bounds; null comes first.

    Within such an id the shard ascends with the check sum, the next part of the order rows are written in.
    """
    ids = doc_ids.fill_null(0).to_numpy(zero_copy_only=False)
    shard, end = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    for row in np.flatnonzero(end - shard > 1):
        shard[row] += zlib.crc32(packed[row]) * int(end[row] - shard[row]) >> 32
    shard[doc_ids.is_null().to_numpy(zero_copy_only=False)] = 0
    return shard


def _encoder(path: str, bits: int, final_id: int, bounds: np.ndarray):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _tokenizer(path)
        for batch in batches:
            row = 0
            for ids, counts in tokenizer.encode_rows(batch["text"]):
                ends = np.cumsum(counts)
                ids, counts = np.insert(ids, ends, final_id), counts + 1
                ends = np.cumsum(counts)
                packed = [pack_bits(ids[b - n : b], bits) for b, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                doc_ids = batch["doc_id"].slice(row, len(counts))
                row += len(counts)
                shards = pa.array(_shards(doc_ids, bounds, packed), pa.int32())
                columns = [shards, doc_ids.cast(pa.int64()), pa.array(counts), pa.array(packed, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=_ENCODED)

    return encode


class _File:
    """One file while it is written: whole blocks go out, at most one stays behind."""

    def __init__(self, sink, bits: int, block: int) -> None:
        self.sink, self.bits, self.block = sink, bits, block
        self.sink.write(_MAGIC)
        self.size, self.ids = len(_MAGIC), 0
        self._rest: list[np.ndarray] = []
        self._held = 0
        self.doc_ids: list[int | None] = []
        self._starts, self._offsets, self._crcs = [0], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.doc_ids.append(doc_id)
        self.ids += len(ids)
        self._starts.append(self.ids)
        self._rest.append(ids)
        self._held += len(ids)
        if self._held >= self.block:
            held = np.concatenate(self._rest)
            whole = len(held) // self.block * self.block
            for at in range(0, whole, self.block):
                self._write(held[at : at + self.block])
            self._rest, self._held = [held[whole:]], len(held) - whole

    def _write(self, ids: np.ndarray) -> None:
        data = pack_bits(ids, self.bits)
        self._offsets.append(self.size)
        self._crcs.append(zlib.crc32(data))
        self.sink.write(data)
        self.size += len(data)

    def close(self) -> int:
        """Write what is left and the tables; returns the bytes of the file."""
        if self._held:
            self._write(np.concatenate(self._rest))
        tables = b"".join(
            np.array(values, kind).tobytes()
            for values, kind in (
                ([0 if d is None else d for d in self.doc_ids], "<i8"), (self._starts, "<u8"),
                ([d is not None for d in self.doc_ids], "u1"), (self._offsets, "<u8"), (self._crcs, "<u4"),
            )
        )
        tail = _TAIL.pack(self.ids, len(self.doc_ids), len(self._offsets), self.size, self.bits, self.block, zlib.crc32(tables), _MAGIC)
        self.sink.write(tables + tail)
        self.sink.close()
        return self.size + len(tables) + len(tail)


class PackedFile:
    """Random access to one file through its tables. Damage is found by the check sums."""

    def __init__(self, source) -> None:
        self._source = source
        self._source.seek(self._source.size() - _TAIL.size)
        fields = _TAIL.unpack(self._source.read(_TAIL.size))
        self.n_ids, documents, blocks, tables_at, self.bits, self.block, crc, magic = fields
        if magic != _MAGIC:
            raise ValueError("no file of packed token ids")
        size = self._source.size() - _TAIL.size - tables_at
        self._source.seek(tables_at)
        tables = self._source.read(size)
        if zlib.crc32(tables) != crc:
            raise ValueError("the tables of a file of packed token ids are damaged")
        at = 0
        columns = []
        for kind, n in (("<i8", documents), ("<u8", documents + 1), ("u1", documents), ("<u8", blocks), ("<u4", blocks)):
            columns.append(np.frombuffer(tables, kind, n, at))
            at += columns[-1].nbytes
        self.doc_ids, starts, self.known, offsets, self._crcs = columns
        self.starts = starts.astype(np.int64)
        self._offsets = np.append(offsets, np.uint64(tables_at)).astype(np.int64)

    def _blocks(self, first: int, last: int) -> np.ndarray:
        """All ids of blocks first .. last - 1, by one read."""
        self._source.seek(int(self._offsets[first]))
        data = self._source.read(int(self._offsets[last] - self._offsets[first]))
        out = []
        for k in range(first, last):
            block = data[self._offsets[k] - self._offsets[first] : self._offsets[k + 1] - self._offsets[first]]
            if zlib.crc32(block) != self._crcs[k]:
                raise ValueError(f"block {k} of a file of packed token ids is damaged")
            out.append(unpack_bits(block, min(self.block, self.n_ids - k * self.block), self.bits))
        return np.concatenate(out) if out else np.zeros(0, np.uint32)

    def ids(self, start: int, stop: int) -> np.ndarray:
        """Ids start .. stop - 1 of the file."""
        start, stop = max(start, 0), min(stop, self.n_ids)
        if start >= stop:
            return np.zeros(0, np.uint32)
        first = start // self.block
        return self._blocks(first, -(-stop // self.block))[start - first * self.block : stop - first * self.block]

    def document(self, k: int) -> np.ndarray:
        """Ids of document k of the file."""
        return self.ids(int(self.starts[k]), int(self.starts[k + 1]))

    def runs(self, size: int = _RUN) -> Iterator[tuple[int, np.ndarray]]:
        """Start and ids of consecutive runs of whole blocks."""
        step = max(1, size // self.block)
        for first in range(0, len(self._crcs), step):
            yield first * self.block, self._blocks(first, min(first + step, len(self._crcs)))


def _writer(folder: str, bits: int, block: int, roll_bytes: int, roll_documents: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        attempt = TaskContext.get().taskAttemptId()
        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(f"{root}/files", recursive=True)
        done, file, current, part = [], None, None, 0

        def close() -> None:
            size = file.close()
            done.append({"shard": current, "part": part, "name": name, "documents": len(file.doc_ids), "ids": file.ids, "bytes": size})

        for batch in batches:
            packed = batch["packed"]
            rows = zip(batch["shard"].to_pylist(), batch["doc_id"].to_pylist(), batch["n"].to_pylist(), strict=True)
            for row, (shard, doc_id, n) in enumerate(rows):
                if file is not None and (shard != current or file.size >= roll_bytes or len(file.doc_ids) >= roll_documents):
                    close()
                    part = part + 1 if shard == current else 0
                    file = None
                if file is None:
                    current = shard
                    name = f"ids-{shard:06d}-{part:05d}-{attempt}.bin"
                    file = _File(store.open_output_stream(f"{root}/files/{name}", compression=None), bits, block)
                file.add(doc_id, unpack_bits(packed[row].as_buffer(), n, bits))
        if file is not None:
            close()
        yield pa.RecordBatch.from_pylist(done, _MANIFEST)

    return write


def write(
    documents: DataFrame, folder: str, tokenizer_path: str, final_id: int = FINAL_ID, shards: int | None = None,
    block: int = BLOCK, roll_bytes: int = ROLL_BYTES, roll_documents: int = ROLL_DOCUMENTS,
) -> DataFrame:
    """Writes the ids of all documents in the order of doc_id to a new folder; returns the manifest. Eager."""
    from tokenizers import Tokenizer

    spark = documents.sparkSession
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = width_of(max(Tokenizer.from_file(tokenizer_path).get_vocab_size(), final_id + 1))
    bounds = shard_bounds(documents, shards)
    (
        documents.select("doc_id", "text")
        .mapInArrow(_encoder(tokenizer_path, bits, final_id, bounds), ENCODED)
        .repartitionById(shards, "shard")
        .sortWithinPartitions("shard", "doc_id", F.crc32("packed"), "packed")
        .mapInArrow(_writer(folder, bits, block, roll_bytes, roll_documents), MANIFEST)
        .write.parquet(f"{folder}/manifest")
    )
    return manifest(spark, folder)


def manifest(spark: SparkSession, folder: str) -> DataFrame:
    """One row per file, with the ids in all files before it (``first``).

    Sums run over one row per shard, then over the files of each shard.
    """
    files = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    per_shard = files.groupBy("shard").agg(F.sum("ids").alias("all_ids"))
    earlier = F.sum("all_ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    shards = per_shard.select("shard", F.coalesce(earlier, F.lit(0)).alias("before"))
    within = F.sum("ids").over(Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    numbered = files.withColumn("within", F.coalesce(within, F.lit(0)))
    return numbered.join(shards, "shard").withColumn("first", F.col("before") + F.col("within")).drop("before", "within")


def _files(folder: str, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, PackedFile]]:
    store, root = fs.FileSystem.from_uri(folder)
    for batch in batches:
        for name, first in zip(batch["name"].to_pylist(), batch["first"].to_pylist(), strict=True):
            with store.open_input_file(f"{root}/files/{name}") as source:
                yield first, PackedFile(source)


def _id_columns(file: PackedFile, first: int, a: int, b: int) -> list[pa.Array]:
    doc_ids = pa.array(file.doc_ids[a:b], mask=file.known[a:b] == 0)
    return [doc_ids, pa.array(file.starts[a:b] + first)]


def _digester(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, file in _files(folder, batches):
            crcs = np.zeros(len(file.doc_ids), np.int64)
            at, crc = 0, 0
            for start, ids in file.runs():
                data = memoryview(ids.astype("<u4").tobytes())
                stop = start + len(ids)
                # a document may go on in the next run: its sum is carried over
                while at < len(crcs) and file.starts[at] < stop:
                    begin, end = max(int(file.starts[at]), start), min(int(file.starts[at + 1]), stop)
                    crc = zlib.crc32(data[4 * (begin - start) : 4 * (end - start)], crc)
                    if file.starts[at + 1] > stop:
                        break
                    crcs[at] = crc
                    at, crc = at + 1, 0
            for a in range(0, len(crcs), 50_000):
                b = min(a + 50_000, len(crcs))
                lengths = pa.array(np.diff(file.starts[a : b + 1]))
                yield pa.RecordBatch.from_arrays([*_id_columns(file, first, a, b), lengths, pa.array(crcs[a:b])], schema=_DIGEST)

    return run


def _lister(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for first, file in _files(folder, batches):
            a = 0
            while a < len(file.doc_ids):
                b = max(a + 1, int(np.searchsorted(file.starts, file.starts[a] + _RUN, "right")) - 1)
                values = file.ids(int(file.starts[a]), int(file.starts[b])).astype(np.int64)
                lists = list_array(pa.array(values), np.diff(file.starts[a : b + 1]))
                yield pa.RecordBatch.from_arrays([*_id_columns(file, first, a, b), lists], ["doc_id", "start", "ids"])
                a = b

    return run


def _read(spark: SparkSession, folder: str, reader, columns: str) -> DataFrame:
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest(spark, folder).select("name", "first").repartition(tasks, "name").mapInArrow(reader(folder), columns)


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start and the list of ids of every document of the files the manifest names."""
    return _read(spark, folder, _lister, IDS)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document; memory is bounded by a run of blocks and the tables."""
    return _read(spark, folder, _digester, DIGEST)


def digest(documents: DataFrame, tokenizer_path: str, final_id: int = FINAL_ID, **options: int) -> DataFrame:
    """Writes the files of all documents to the shared folder and reads them back; one row per document."""
    folder = Scratch(documents.sparkSession, "token-files").folder
    write(documents, folder, tokenizer_path, final_id, **options)
    return read_digests(documents.sparkSession, folder)
