"""Fill-in-the-middle: documents cut into prefix, middle and suffix and written in another order.

Secondary-sort assembly. Every document leaves its task as pieces of at most ``unit`` code points, keyed by
the document and the place of the piece in the *output*. One exchange deals the pieces by document and sorts
them by place, so that an output is a stream of pieces and no task ever builds one. Restoration reads that
stream: a marker says which section the next pieces belong to, each piece gets its place in the original, and
a second sort within the same partitions (no further exchange) puts the sections back into their order.

Defined results: a null text is an empty one; an empty text, and one that holds a marker, stays plain; a null
doc_id counts as an empty number in the hash; repeated rows are transformed once each (a row carries its
number within its task, and pieces are dealt by doc_id and content, so that rows under one doc_id spread);
an empty table gives an empty table; other columns are ignored. Texts are code points throughout, and a
long one is never more than a piece at a time after the first step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Markers of prefix, suffix and middle, fixed values.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of 100 documents so many are transformed, and of 100 transformed ones so many start with the suffix.
TRANSFORMED, SUFFIX_FIRST = 90, 20
#: Code points of a piece.
UNIT = 4096

#: A document's key: id, content and row; the first piece of a document carries what is known of the whole.
_KEY = [("doc_id", pa.int64()), ("content", pa.binary()), ("row", pa.int64())]
_WHOLE = [("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64())]
_PIECES = pa.schema([*_KEY, ("place", pa.int64()), ("piece", pa.binary()), *_WHOLE])
_SECTIONS = pa.schema([*_KEY, ("section", pa.int32()), ("place", pa.int64()), ("piece", pa.binary()), *_WHOLE, ("output_sha256", pa.string())])
_DIGEST = pa.schema([("doc_id", pa.int64()), *_WHOLE, ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
_OUTPUT = pa.schema([("doc_id", pa.int64()), *_WHOLE, ("output", pa.string())])
_NAMES = {pa.int64(): "long", pa.int32(): "int", pa.string(): "string", pa.binary(): "binary"}
_DOCUMENT = [name for name, _ in _KEY]
#: Bytes of pieces a task hands on at once.
_BATCH = 4 << 20


def _ddl(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_NAMES[f.type]}" for f in schema)


def cut_points(doc_id: int | None, n: int, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST) -> tuple[str, int, int]:
    """Form and the ends of prefix and middle of a text of ``n`` code points without markers."""
    digest = hashlib.sha256(b"1:" + (b"" if doc_id is None else str(doc_id).encode())).hexdigest()
    one, two, three, four = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
    if n == 0 or three % 100 >= transformed:
        return "plain", 0, 0
    first, last = sorted((one % (n + 1), two % (n + 1)))
    return ("spm" if four % 100 < suffix_first else "psm"), first, last


class _Rows:
    """Columns of a schema, handed on as batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema = schema
        self._columns: list[list] = [[] for _ in schema]
        self.bytes = 0

    def add(self, *values: object, size: int = 64) -> None:
        for column, value in zip(self._columns, values, strict=True):
            column.append(value)
        self.bytes += size

    def take(self) -> pa.RecordBatch:
        arrays = [pa.array(c, t) for c, t in zip(self._columns, self.schema.types, strict=True)]
        self._columns, self.bytes = [[] for _ in self.schema], 0
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)


def _cutter(unit: int, transformed: int, suffix_first: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        row = TaskContext.get().partitionId() << 40
        out = _Rows(_PIECES)
        for batch in batches:
            texts = batch["text"]
            for at, doc_id in enumerate(batch["doc_id"].to_pylist()):
                text = texts[at].as_py() or ""
                n = len(text)
                form, first, last = cut_points(doc_id, n, transformed, suffix_first)
                if any(marker in text for marker in (PREFIX, SUFFIX, MIDDLE)):
                    form = "plain"
                sections = {
                    "plain": ((0, n),),
                    "psm": (PREFIX, (0, first), SUFFIX, (last, n), MIDDLE, (first, last)),
                    "spm": (SUFFIX, (last, n), PREFIX, (0, first), MIDDLE, (first, last)),
                }[form]
                content = hashlib.blake2b(text.encode(), digest_size=8).digest()
                lengths = (None, None) if form == "plain" else (first, last - first)
                whole, place = (n, form, *lengths), 0
                for section in sections:
                    if isinstance(section, str):
                        pieces = [section]
                    else:
                        pieces = (text[k : min(k + unit, section[1])] for k in range(section[0], section[1], unit))
                    for piece in pieces:
                        data = piece.encode()
                        out.add(doc_id, content, row, place, data, *whole, size=len(data) + 64)
                        whole, place = (None,) * 4, place + 1
                        if out.bytes >= _BATCH:
                            yield out.take()
                if not place:  # the empty text
                    out.add(doc_id, content, row, 0, b"", *whole)
                row += 1
        yield out.take()

    return cut


def pieces(
    documents: DataFrame, unit: int = UNIT, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """The outputs as pieces: all of a document in one partition, ordered by ``place``.

    doc_id, content and row together are one document; n, form and lengths stand at its first piece.
    """
    cut = documents.select("doc_id", "text").mapInArrow(_cutter(unit, transformed, suffix_first), _ddl(_PIECES))
    return cut.repartition("doc_id", "content").sortWithinPartitions(*_DOCUMENT, "place")


def _columns(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per document with its output as text."""
    out, key, whole, parts = _Rows(_OUTPUT), None, None, []
    for batch in batches:
        for doc_id, content, row, _, piece, *head in _columns(batch):
            if (doc_id, content, row) != key:
                if key is not None:
                    text = b"".join(parts)
                    out.add(key[0], *whole, text.decode(), size=len(text))
                    if out.bytes >= _BATCH:
                        yield out.take()
                key, whole, parts = (doc_id, content, row), head, []
            parts.append(piece)
    if key is not None:
        out.add(key[0], *whole, b"".join(parts).decode())
    yield out.take()


def transform(
    documents: DataFrame, unit: int = UNIT, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars and the output text."""
    return pieces(documents, unit, transformed, suffix_first).mapInArrow(_assemble, _ddl(_OUTPUT))


#: Places of the sections in the original.
_ORDER = {PREFIX.encode(): 0, MIDDLE.encode(): 1, SUFFIX.encode(): 2}


def _sections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests of the outputs as they stream by, and each piece with its section as the markers say.

    The row that follows a document's last piece carries the digest (and what is known of the whole); its
    section sorts behind all others.
    """
    out, key, whole, section, total = _Rows(_SECTIONS), None, None, 0, None
    for batch in batches:
        for doc_id, content, row, place, piece, *head in _columns(batch):
            if (doc_id, content, row) != key:
                if key is not None:
                    out.add(*key, 3, 0, b"", *whole, total.hexdigest())
                key, whole, section, total = (doc_id, content, row), head, 0, hashlib.sha256()
            total.update(piece)
            # only plain texts can hold a marker, and these are one section
            if whole[1] != "plain" and piece in _ORDER:
                section = _ORDER[piece]
            else:
                out.add(*key, section, place, piece, None, None, None, None, None, size=len(piece) + 64)
            if out.bytes >= _BATCH:
                yield out.take()
    if key is not None:
        out.add(*key, 3, 0, b"", *whole, total.hexdigest())
    yield out.take()


def _restored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out, total = _Rows(_DIGEST), hashlib.sha256()
    for batch in batches:
        for doc_id, _, _, section, _, piece, n, form, prefix, middle, output in _columns(batch):
            total.update(piece)
            if section == 3:
                out.add(doc_id, n, form, prefix, middle, output, total.hexdigest())
                total = hashlib.sha256()
        if out.bytes >= _BATCH:
            yield out.take()
    yield out.take()


def digest(
    documents: DataFrame, unit: int = UNIT, transformed: int = TRANSFORMED, suffix_first: int = SUFFIX_FIRST
) -> DataFrame:
    """One row per document with the digests of its output and of the text restored from that output."""
    return (
        pieces(documents, unit, transformed, suffix_first)
        .mapInArrow(_sections, _ddl(_SECTIONS))
        .sortWithinPartitions(*_DOCUMENT, "section", "place")
        .mapInArrow(_restored, _ddl(_DIGEST))
    )


def restore_text(output: str, form: str) -> str:
    """The text an output of the given form was made from."""
    if form == "plain":
        return output
    parts, at = {}, sorted((output.index(marker), marker) for marker in (PREFIX, SUFFIX, MIDDLE))
    for (start, marker), (end, _) in zip(at, [*at[1:], (len(output), "")], strict=True):
        parts[marker] = output[start + len(marker) : end]
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]
