"""Best-fit packing of tokenised documents by minimum bin slack.

Pieces are counted by length, so that the table the combinations are searched in has one row per
length at most (the sequence length bounds it, whatever the corpus holds). For each sequence the largest
length left is fixed and a bitset subset sum over the lengths left finds the fullest feasible
combination; the combination is taken out as often as the counts allow, which makes the number of
searches independent of the number of documents. Equal lengths are interchangeable: every piece learns
its number among the pieces of its length and from it its sequence and its place.

Defined results: null and empty texts are the final id alone; repeated rows are packed once each (they
need not differ in doc_id); an empty table gives an empty table; extra columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from returns_analytics.llm.storage import Scratch

#: Tokens of a sequence, and the id after every document.
SEQUENCE, FINAL_ID = 4096, 1
#: Words whose ids a worker keeps; the table starts anew when full.
WORDS_KEPT = 300_000

_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
)
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


#: The pattern by which the tokenizer file splits, a fixed value, and what it matches in Latin-1 text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LATIN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff]+|[0-9\xb2\xb3\xb9\xbc-\xbe]|"
                    r"[^a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff0-9\xb2\xb3\xb9\xbc-\xbe]+")
_IN_LATIN = re.compile(r"[!-~\xa1-\xff]+").fullmatch
#: White space in the tokenizer's sense; str.split() takes four control characters for it as well.
_WHITE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_CONTROL = re.compile("[\x1c-\x1f]")
#: Byte-level characters: bytes that print stand for themselves, the others follow from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PRINTED))}


class WordTokenizer(dict):
    """Packed token ids (little-endian, 32 bits) of words, by a tokenizer that drops white space.

    Such a tokenizer never merges over white space, so the ids of a text are those of its words one
    after another. Words already seen are looked up, and so are the pieces that new words fall into;
    both tables are bounded and start anew when full.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        described = json.loads(self._whole.to_str())
        self._added = re.compile("|".join(re.escape(t["content"]) for t in described["added_tokens"]) or "(?!)").search
        splits = [p["pattern"].get("Regex") for p in described["pre_tokenizer"]["pretokenizers"] if "pattern" in p]
        self._own_split = splits == [_PATTERN]
        self._model = self._whole.model.tokenize
        self._pieces: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        if self._own_split and _IN_LATIN(word) and not self._added(word):
            lower = word.lower()
            packed = self._piece(lower) if lower.isalpha() else b"".join(map(self._piece, _LATIN.findall(lower)))
        else:
            packed = np.array(self._whole.encode(word, add_special_tokens=False).ids, "<u4").tobytes()
        self[word] = packed
        return packed

    def _piece(self, piece: str) -> bytes:
        packed = self._pieces.get(piece)
        if packed is None:
            if len(self._pieces) >= WORDS_KEPT:
                self._pieces.clear()
            level = piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)
            tokens = self._model(level)
            packed = self._pieces[piece] = b"".join([token.id.to_bytes(4, "little") for token in tokens])
        return packed

    def encode(self, text: str) -> bytes:
        if len(self) >= WORDS_KEPT:
            self.clear()
        words = text.split() if not _CONTROL.search(text) else [w for w in _WHITE.split(text) if w]
        return b"".join(map(self.__getitem__, words))


_TOKENIZERS: dict[str, WordTokenizer] = {}


def _tokenizer(path: str) -> WordTokenizer:
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = WordTokenizer(path)
    return _TOKENIZERS[path]


def _cutter(path: str, size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(path).encode
        final = FINAL_ID.to_bytes(4, "little")
        for batch in batches:
            doc_ids, piece, start, length, crc = [], [], [], [], []
            texts = batch["text"]
            for row, doc_id in enumerate(batch["doc_id"].to_pylist()):
                ids = encode(texts[row].as_py() or "") + final
                for k, at in enumerate(range(0, len(ids) // 4, size)):
                    doc_ids.append(doc_id)
                    piece.append(k)
                    start.append(at)
                    length.append(min(size, len(ids) // 4 - at))
                    crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip((doc_ids, piece, start, length, crc), _PIECES.types, strict=True)],
                schema=_PIECES,
            )

    return cut


@dataclass(frozen=True)
class Plan:
    """For each length, by the number of a piece: combination, first sequence, repeats and place.

    Row r serves the pieces first[r] .. first[r] + repeats[r] * count[r] - 1 of its length.
    """

    length: np.ndarray
    first: np.ndarray
    count: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int


def _fullest(room: int, lengths: list[int], left: dict[int, int]) -> list[int]:
    """Lengths, descending, whose sum is the largest that fits into the room.

    Bit s of ``reach`` says that the lengths so far can sum to s; the sets after each step are kept to
    walk back. Counts are added in powers of two.
    """
    mask, reach = (1 << (room + 1)) - 1, 1
    steps = []
    for size in lengths:
        if size > room:
            continue
        n, take = min(left[size], room // size), 1
        while n > 0:
            take = min(take, n)
            steps.append((size, take, reach))
            reach |= (reach << (size * take)) & mask
            n -= take
            take *= 2
        if reach >> room:
            break
    total, chosen = reach.bit_length() - 1, []
    for size, take, before in reversed(steps):
        if not before >> total & 1:
            chosen += [size] * take
            total -= size * take
    return chosen


def minimum_bin_slack(counts: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Combinations for all pieces of the given counts by length (1 .. size)."""
    left = {length: n for length, n in sorted(counts.items(), reverse=True) if n > 0}
    used = dict.fromkeys(left, 0)
    rows, sequence = [], 0
    while left:
        largest = next(iter(left))
        left[largest] -= 1
        chosen = [largest, *_fullest(size - largest, [n for n in left if left[n]], left)]
        left[largest] += 1
        times: dict[int, int] = {}
        for length in chosen:
            times[length] = times.get(length, 0) + 1
        repeats = min(left[length] // n for length, n in times.items())
        offset = 0
        for length, n in times.items():
            rows.append((length, used[length], n, sequence, offset))
            used[length] += n * repeats
            left[length] -= n * repeats
            offset += n * length
            if not left[length]:
                del left[length]
        sequence += repeats
    rows.sort()
    columns = [np.array(c, np.int64) for c in zip(*rows, strict=True)] if rows else [np.zeros(0, np.int64)] * 5
    return Plan(*columns, sequences=sequence)


def _places(plan: Plan):
    """Sequence and offset of piece number k of its length, by binary search in the plan."""
    # one ascending key per row: numbers stay below the count of pieces, so lengths never mix
    step = int(plan.first.max() + 1) if len(plan.first) else 1

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys = plan.length.astype(object) * step + plan.first if step > 1 << 50 else plan.length * step + plan.first
        for rows in batches:
            length, number = rows["length"].to_numpy(np.int64), rows["number"].to_numpy(np.int64)
            row = np.searchsorted(keys, length * step + np.minimum(number, step - 1), "right") - 1
            within = number - plan.first[row]
            rows["sequence_id"] = plan.sequence[row] + within // plan.count[row]
            rows["offset"] = plan.offset[row] + within % plan.count[row] * length
            yield rows.drop(columns=["number"])

    return place


def pack(documents: DataFrame, tokenizer_path: str, size: int = SEQUENCE) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "packing")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pieces = documents.select("doc_id", "text").mapInArrow(_cutter(tokenizer_path, size), PIECES)
    # a bucket splits a length that very many documents have
    bucket = F.pmod(F.xxhash64("doc_id", "piece"), F.lit(max(tasks, 16))).cast("int")
    pieces = scratch.store(pieces.withColumn("bucket", bucket))
    per_bucket = pieces.groupBy("length", "bucket").agg(F.count(F.lit(1)).alias("n"))
    # one row per length: at most ``size`` of them
    counts = {row["length"]: row["n"] for row in per_bucket.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = minimum_bin_slack(counts, size)
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_bucket.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "bucket").orderBy("doc_id", "piece", "ids_crc32")
    numbered = (
        pieces.withColumn("k", F.row_number().over(within) - 1)
        .join(offsets, ["length", "bucket"])
        .withColumn("number", F.col("k") + F.col("before"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "number")
    )
    return numbered.mapInPandas(_places(plan), PIECES + ", sequence_id long, offset long")
