"""Language identification by character n-grams.

Texts become TF-IDF vectors of hashed runs of one to three letters; a sparse multinomial logistic
regression is trained with follow-the-regularised-leader updates and an elastic-net penalty, and a
temperature fitted on rows kept aside turns its margins into calibrated probabilities.

Document frequencies are counted over all training rows; only the weights are fitted on a bounded
sample of them (``sample_rows``, and ``LEAST_ROWS`` at least of every language, so that a rare one is learned as
well; the calibration gives its rows the weight of their share). Texts are read whole.

Defined results: a text that is null or has no letter is ``und`` with score 1; without training rows every
other text is ``und`` with score 0; ties go to the alphabetically first language; repeated rows are
predicted once each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm.arrays import slices
from returns_analytics.llm.sampling import bounded_per_class, fold

#: Rows the weights are fitted on, hashed n-grams, bytes of text handled at once.
SAMPLE_ROWS, BUCKETS, SLICE = 4_000, 1 << 14, 1 << 18
#: Rows of the sample every language has, if there are as many.
LEAST_ROWS = 100
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"

_LETTER = np.array([chr(c).isalpha() for c in range(1 << 16)])
_FACTORS = (2654435761, 2246822519, 3266489917)


def _letters(codes: np.ndarray) -> np.ndarray:
    low = codes < 1 << 16
    letter = _LETTER[np.where(low, codes, 0)]
    if not low.all():
        letter[~low] = [chr(c).isalpha() for c in codes[~low]]
    return letter


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bucket and row of every n-gram, and the number of letters of each row.

    Every character but a letter counts as a blank, runs of blanks as one.
    """
    n = len(offsets) - 1
    text = data.tobytes()
    # code points of all rows at once; rows are whole characters, so that their starts are character starts
    codes = np.frombuffer(text.decode("utf-8", "replace").lower().encode("utf-32-le"), np.uint32).astype(np.int64)
    starts = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))[offsets]
    if len(codes) != starts[-1]:  # lower case of a few characters is longer: take these rows one by one
        parts = [text[a:b].decode("utf-8", "replace").lower() for a, b in zip(offsets, offsets[1:])]
        codes = np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32).astype(np.int64)
        starts = np.concatenate(([0], np.cumsum([len(p) for p in parts])))
    letter = _letters(codes)
    row = np.repeat(np.arange(n), np.diff(starts))
    letters = np.bincount(row[letter], minlength=n)
    first = np.zeros(len(codes), bool)
    first[starts[:-1][np.diff(starts) > 0]] = True
    keep = letter.copy()
    keep[1:] |= letter[:-1] & ~first[1:]  # one blank after a word
    codes = np.where(letter, codes, 32)[keep].astype(np.uint64)
    row = row[keep]
    one, two, three = np.uint64(_FACTORS[0]), np.uint64(_FACTORS[1]), np.uint64(_FACTORS[2])
    shift = np.uint64(64 - (BUCKETS.bit_length() - 1))
    golden = np.uint64(0x9E3779B97F4A7C15)
    found, rows = [(codes * one * golden) >> shift], [row]
    if len(codes) > 1:
        same = row[1:] == row[:-1]
        pair = codes[:-1] * two + codes[1:]
        found.append(((pair * three * golden) >> shift)[same])
        rows.append(row[1:][same])
        same = row[2:] == row[:-2]
        triple = pair[:-1] * three + codes[2:]
        found.append(((triple * one * golden) >> shift)[same])
        rows.append(row[2:][same])
    return np.concatenate(found).astype(np.int64), np.concatenate(rows), letters


def counts(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows by buckets, and the letters of each row."""
    n = len(offsets) - 1
    bucket, row, letters = ngrams(data, offsets)
    return np.bincount(row * BUCKETS + bucket, minlength=n * BUCKETS).reshape(n, BUCKETS), letters


def tf_idf(found: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log term frequencies times inverse document frequencies, rows of length one."""
    x = np.log1p(found.astype(np.float32)) * idf
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    return x / np.maximum(norm, 1e-12)[:, None]


class Ftrl:
    """Multinomial logistic regression, one update per row, with L1 and L2 penalties."""

    def __init__(self, features: int, classes: int, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z = np.zeros((features, classes))
        self.n = np.zeros((features, classes))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def update(self, at: np.ndarray, values: np.ndarray, label: int) -> None:
        w = self.weights(at)
        error = softmax((values @ w)[None])[0]
        error[label] -= 1
        gradient = np.outer(values, error)
        n = self.n[at]
        sigma = (np.sqrt(n + gradient**2) - np.sqrt(n)) / self.alpha
        self.z[at] += gradient - sigma * w
        self.n[at] = n + gradient**2


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def temperature(margins: np.ndarray, labels: np.ndarray, weights: np.ndarray | None = None) -> float:
    """The divisor of the margins with the least (weighted) log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0
    weights = np.ones(len(labels)) if weights is None else weights
    loss = lambda t: -(weights * np.log(softmax(margins / np.exp(t))[np.arange(len(labels)), labels] + 1e-12)).sum()
    low, high, ratio = -4.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    temperature: float

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray]:
        found, letters = counts(data, offsets)
        if not self.languages:
            return [UNKNOWN] * len(letters), (letters == 0).astype(float)
        chance = softmax(tf_idf(found, self.idf) @ self.weights / self.temperature)
        best = chance.argmax(axis=1)
        names = [self.languages[k] if n else UNKNOWN for k, n in zip(best, letters, strict=True)]
        return names, np.where(letters > 0, chance.max(axis=1), 1.0)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a partition that hold each n-gram."""
    total = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for first, last, data, offsets in slices(batch["text"], SLICE):
            bucket, row, _ = ngrams(data, offsets)
            held = np.zeros((last - first, BUCKETS), bool)
            held[row, bucket] = True
            total += held.sum(axis=0)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Language, n-grams and their counts of each row."""
    for batch in batches:
        for first, last, data, offsets in slices(batch["text"], SLICE):
            found, _ = counts(data, offsets)
            row, bucket = np.nonzero(found)
            ends = np.searchsorted(row, np.arange(last - first + 1))
            values = np.minimum(found[row, bucket], 65535)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["lang"].slice(first, last - first),
                    batch["weight"].slice(first, last - first),
                    pa.array([bucket[a:b].astype("<u2").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                    pa.array([values[a:b].astype("<u2").tobytes() for a, b in zip(ends, ends[1:])], pa.binary()),
                ],
                ["lang", "weight", "buckets", "counts"],
            )


def fit(documents: DataFrame, sample_rows: int = SAMPLE_ROWS, held_out: int | None = HELD_OUT, epochs: int = 3) -> Model:
    """Learns from text and lang of the rows with a language outside the held-out fold."""
    rows = documents.select("doc_id", "text", "lang").filter("lang is not null")
    if held_out is not None:
        rows = rows.filter(fold(F.col("doc_id"), FOLDS) != held_out)
    df = rows.select("text").mapInArrow(_frequencies, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    # one row per bucket: at most BUCKETS
    total, frequency = rows.count(), np.zeros(BUCKETS)
    for row in df.collect():
        frequency[row["bucket"]] = row["n"]
    idf = np.log((1 + total) / (1 + frequency)).astype(np.float32) + np.float32(1)
    sample = bounded_per_class(rows, "lang", ["doc_id", "text"], sample_rows, LEAST_ROWS).select("text", "lang", "weight").mapInArrow(
        _features, "lang string, weight double, buckets binary, counts binary"
    ).toArrow()
    languages = tuple(sorted(set(sample["lang"].to_pylist())))
    if not languages:
        return Model((), idf, np.zeros((BUCKETS, 0)), 1.0)
    number = {name: k for k, name in enumerate(languages)}
    # the order of the rows decides the online updates: sort by content, then shuffle with a fixed seed
    found = sorted(zip(*[sample[c].to_pylist() for c in ("lang", "buckets", "counts", "weight")], strict=True))
    order = np.random.default_rng(5).permutation(len(found))
    vectors = []
    for k in order:
        lang, buckets, values, weight = found[k]
        at = np.frombuffer(buckets, "<u2").astype(np.int64)
        x = np.log1p(np.frombuffer(values, "<u2").astype(float)) * idf[at]
        vectors.append((at, x / max(np.sqrt((x**2).sum()), 1e-12), number[lang], weight))
    aside = len(vectors) // 5
    learner = Ftrl(BUCKETS, len(languages))
    for _ in range(epochs):
        for at, x, label, _ in vectors[aside:]:
            learner.update(at, x, label)
    weights = learner.weights()
    margins = np.array([x @ weights[at] for at, x, *_ in vectors[:aside]]).reshape(-1, len(languages))
    labels, shares = np.array([v[2] for v in vectors[:aside]], int), np.array([v[3] for v in vectors[:aside]])
    return Model(languages, idf, weights.astype(np.float32), temperature(margins, labels, shares))


def identify(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    model = fit(documents, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for _, _, data, offsets in slices(batch["text"], SLICE):
                name, value = model.predict(data, offsets)
                names += name
                scores.append(value)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(names, pa.string()), pa.array(np.concatenate(scores or [np.zeros(0)]).astype(float))],
                ["doc_id", "lang_pred", "score"],
            )

    predicted = documents.select("doc_id", "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
    return predicted.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "lang_pred", "score")
