"""Benchmark decontamination: every passage of every document is a query against the test items.

The items form a BM25 inverted index in blocks; for each term a block stores the largest weight of its
items. As in block-max WAND, a block is skipped for a passage if the largest weights of the passage's
terms there add up to less than the lowest threshold in the block; the items of the other blocks are scored
exactly. All cursors of a batch of passages move block by block, so that the bounds are sums over
arrays. Every item at or above its threshold is then verified by its text.

An item is a question and, from its last line if it has several, an answer. It is found in a passage that
holds at least ``overlap`` of the question's distinct five-word shingles and of the answer's distinct
words. A passage is twice the longest item and begins at every multiple of it, so any stretch as long as
an item lies whole in one. The threshold of an item is the score that a verified passage cannot stay
below: all weights of its terms less the largest of as many as may be missing. So nothing is lost
before the verification.

The items are read in shards of a checked size; more shards mean more passes over the documents.

Defined results: words are runs of letters and digits in lower case; null and empty texts hold nothing;
items with fewer than five words carry no shingle and match nothing; equal items are found each; a row
per document row and item (the best passage, the first of equal ones); empty tables give no row; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm.arrays import PUNCTUATION, ragged, shingles, slices, span_hashes, word_bounds
from returns_analytics.llm.storage import free_name

SHINGLE, OVERLAP = 5, 0.8
K1, B = 1.2, 0.75
#: Items per block, and bytes of benchmark text in one index (a shard).
BLOCK, SHARD_BYTES = 8, 4 << 20
HITS = "doc_id long, item_id long, passage int, score double, question_overlap double, answer_overlap double"


@dataclass(frozen=True)
class Item:
    item_id: int
    terms: np.ndarray  # distinct words, ascending
    tf: np.ndarray
    words: int
    question: np.ndarray  # distinct shingles
    question_terms: np.ndarray
    answer: np.ndarray  # distinct words


def _words(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    starts, ends, _ = word_bounds(data, np.array([0, len(data)]), PUNCTUATION)
    return span_hashes(data, starts, ends)


def _shingles(words: np.ndarray) -> np.ndarray:
    return np.unique(shingles(words, np.zeros(len(words), np.int64), 1, SHINGLE)[0])


def read_item(item_id: int, text: str | None) -> Item | None:
    """An item, or None if it has too few words for a shingle."""
    lines = [line for line in (text or "").split("\n") if line.strip()]
    question, answer = _words("\n".join(lines[:-1])), _words(lines[-1] if lines else "")
    if len(question) < SHINGLE:
        question, answer = np.concatenate((question, answer)), answer[:0]
    if len(question) < SHINGLE:
        return None
    every = np.concatenate((question, answer))
    terms, tf = np.unique(every, return_counts=True)
    return Item(item_id, terms, tf, len(every), _shingles(question), np.unique(question), np.unique(answer))


class Index:
    """Inverted index over items in blocks, with block maxima and thresholds."""

    def __init__(self, items: list[Item], frequency: dict[int, int], n_items: int, mean_words: float, overlap: float):
        self.items = items
        self.longest = max((item.words for item in items), default=1)
        self.terms = np.unique(np.concatenate([item.terms for item in items])) if items else np.zeros(0, np.uint64)
        df = np.array([frequency[int(t)] for t in self.terms], float)
        self.idf = np.log(1 + (n_items - df + 0.5) / (df + 0.5))
        self.n_blocks = -(-len(items) // BLOCK)
        numbers, owners, weights, self.threshold = [], [], [], np.zeros(len(items))
        for k, item in enumerate(items):
            at = np.searchsorted(self.terms, item.terms)
            w = self.idf[at] * item.tf * (K1 + 1) / (item.tf + K1 * (1 - B + B * item.words / mean_words))
            numbers.append(at)
            owners.append(np.full(len(at), k))
            weights.append(w)
            # a term may miss without its shingles' count showing it at the first four words
            missing = int((1 - overlap) * len(item.question) + 1e-9) + SHINGLE - 1
            lost = np.sort(w[np.isin(item.terms, item.question_terms)])[::-1][:missing].sum()
            if len(item.answer):
                missing = int((1 - overlap) * len(item.answer) + 1e-9)
                lost += np.sort(w[np.isin(item.terms, item.answer)])[::-1][:missing].sum()
            self.threshold[k] = max(w.sum() - lost - 1e-6, 1e-9)
        term, owner, weight = (np.concatenate(x) if items else np.zeros(0, int) for x in (numbers, owners, weights))
        order = np.lexsort((owner, term))
        self.post_item, self.post_weight = owner[order], weight[order].astype(float)
        self.post_start = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        # per term and block the largest weight
        key = term[order] * max(self.n_blocks, 1) + owner[order] // BLOCK
        pair, first = np.unique(key, return_index=True)
        self.max_block = pair % max(self.n_blocks, 1)
        self.max_weight = np.maximum.reduceat(self.post_weight, first) if len(first) else np.zeros(0)
        self.max_start = np.searchsorted(pair // max(self.n_blocks, 1), np.arange(len(self.terms) + 1))
        self.block_threshold = np.array(
            [self.threshold[b * BLOCK : (b + 1) * BLOCK].min() for b in range(self.n_blocks)]
        )

    def candidates(self, passage: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Passages, items and scores at or above the items' thresholds.

        passage, term: the distinct terms of each passage, sorted by passage.
        """
        starts, lengths = self.max_start[term], np.diff(self.max_start)[term]
        at = ragged(starts, lengths)
        bound = np.bincount(
            np.repeat(passage, lengths) * self.n_blocks + self.max_block[at], self.max_weight[at], n * self.n_blocks
        ).reshape(n, self.n_blocks)
        open_blocks = bound >= self.block_threshold
        hit = np.flatnonzero(open_blocks.any(axis=1))
        if not len(hit):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),)
        row = np.full(n, -1)
        row[hit] = np.arange(len(hit))
        some = row[passage] >= 0
        passage, term = row[passage[some]], term[some]
        starts, lengths = self.post_start[term], np.diff(self.post_start)[term]
        at = ragged(starts, lengths)
        owner, item = np.repeat(passage, lengths), self.post_item[at]
        inside = open_blocks[hit][owner, item // BLOCK]
        key, number = np.unique(owner[inside] * len(self.items) + item[inside], return_inverse=True)
        scores = np.bincount(number, self.post_weight[at][inside], len(key))
        owner, item = key // len(self.items), key % len(self.items)
        good = scores >= self.threshold[item]
        return hit[owner[good]], item[good], scores[good]


def search(index: Index, data: np.ndarray, offsets: np.ndarray, overlap: float) -> list[tuple]:
    """(row, item, passage, score, question overlap, answer overlap) of the verified items of each row."""
    if not index.items:
        return []
    starts, ends, rows = word_bounds(data, offsets, PUNCTUATION)
    if not len(starts):
        return []
    hashes = span_hashes(data, starts, ends)
    n_rows = len(offsets) - 1
    counts = np.bincount(rows, minlength=n_rows)
    begin = np.concatenate(([0], np.cumsum(counts)))
    step = index.longest
    # passage k of a row holds its words k * step .. (k + 2) * step - 1
    passages = np.maximum(-(-counts // step) - 1, 1) * (counts > 0)
    base = np.concatenate(([0], np.cumsum(passages)))
    term = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[term] == hashes)
    row, at, term = rows[known], known - begin[rows[known]], term[known]
    k = at // step
    later = base[row] + np.minimum(k, passages[row] - 1)
    earlier = base[row] + np.clip(k - 1, 0, passages[row] - 1)
    pairs = np.unique(np.concatenate((later, earlier)) * len(index.terms) + np.concatenate((term, term)))
    passage, item, score = index.candidates(pairs // len(index.terms), pairs % len(index.terms), int(base[-1]))
    best: dict[tuple[int, int], tuple] = {}
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist(), strict=True):
        r = int(np.searchsorted(base, p, "right")) - 1
        first = begin[r] + (p - base[r]) * step
        words = hashes[first : min(first + 2 * step, begin[r + 1])]
        wanted = index.items[i]
        question = np.isin(wanted.question, _shingles(words)).mean()
        if question < overlap:
            continue
        answer = np.isin(wanted.answer, words).mean() if len(wanted.answer) else 1.0
        if answer < overlap:
            continue
        found = (r, i, int(p - base[r]), s, float(question), float(answer))
        if (r, i) not in best or (found[4], found[5]) > best[r, i][4:]:
            best[r, i] = found
    return list(best.values())


def indexes(benchmark: DataFrame, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> Iterator[Index]:
    """Indexes that together hold all items, each over at most about ``shard_bytes`` of text."""
    items = benchmark.select("item_id", "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = -(-size // shard_bytes)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [read_item(*row) for row in zip(batch["item_id"].to_pylist(), batch["text"].to_pylist(), strict=True)]
            found = [item for item in found if item]
            yield pa.RecordBatch.from_arrays(
                [pa.array([item.terms.view(np.int64).tolist() for item in found], pa.list_(pa.int64())),
                 pa.array([item.words for item in found], pa.int64())],
                ["terms", "words"],
            )

    terms = items.mapInArrow(read, "terms array<long>, words long")
    totals = terms.agg(F.count(F.lit(1)).alias("n"), F.avg("words").alias("mean")).first()
    if not totals["n"]:
        return
    frequencies = terms.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    for shard in range(shards):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(shards)) == shard) if shards > 1 else items
        rows = [(row["item_id"], row["text"] or "") for row in own.collect()]
        rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1]))
        found = [item for item in (read_item(*row) for row in rows) if item]
        if not found:
            continue
        mine = terms.sparkSession.createDataFrame(
            [(int(t),) for t in np.unique(np.concatenate([i.terms for i in found])).view(np.int64)], "term long"
        )
        df = frequencies if shards == 1 else frequencies.join(F.broadcast(mine), "term")
        counts = {int(np.int64(row["term"]).view(np.uint64)): row["df"] for row in df.collect()}
        yield Index(found, counts, totals["n"], totals["mean"], overlap)


def find(documents: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document and test item it holds."""

    def over(index: Index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doc_ids, out = batch["doc_id"].to_pylist(), []
                for first, _, data, offsets in slices(batch["text"]):
                    for row, item, *rest in search(index, data, offsets, overlap):
                        out.append((doc_ids[first + row], index.items[item].item_id, *rest))
                columns = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.float64(), pa.float64(), pa.float64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                    ["doc_id", "item_id", "passage", "score", "question_overlap", "answer_overlap"],
                )

        return run

    texts = documents.select("doc_id", F.lower("text").alias("text"))
    hits = [texts.mapInArrow(over(index), HITS) for index in indexes(benchmark, overlap, shard_bytes)]
    if not hits:
        return texts.filter("false").mapInArrow(over(Index([], {}, 0, 1.0, overlap)), HITS)
    whole = hits[0]
    for more in hits[1:]:
        whole = whole.unionByName(more)
    return whole


def keep_clean(
    documents: DataFrame, benchmark: DataFrame, overlap: float = OVERLAP, shard_bytes: int = SHARD_BYTES
) -> DataFrame:
    """The rows of documents that hold no test item, all columns as they are."""
    lowered = free_name("lower", documents.columns)
    for index in indexes(benchmark, overlap, shard_bytes):

        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                lower = batch.column(batch.schema.get_field_index(lowered))
                for first, _, data, offsets in slices(lower):
                    for row, *_ in search(index, data, offsets, overlap):
                        clean[first + row] = False
                yield batch.drop_columns([lowered]).filter(pa.array(clean))

        documents = documents.withColumn(lowered, F.lower("text")).mapInArrow(run, documents.schema)
    return documents
