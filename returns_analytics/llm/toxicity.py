"""Toxicity by weak supervision.

Many voters look at a text: lexicons of words mined from labelled rows, patterns of its characters, the
absence of any lexicon word, and the annotator where there is a label. A generative model estimates
how often each voter votes in either class by expectation maximisation, and the correlation of voters
within the classes; correlated voters share their weight. Its posteriors are the labels a linear
classifier is trained on, which then scores every text.

All of it is fitted on a bounded sample of the labelled rows of the training folds (``sample_rows``), whose ids
and labels are small enough to be sent to every task, so that no text is shuffled to meet its label.
Every text is scored.

Defined results: null and empty texts are scored by the intercept; without labelled rows of both classes
nothing is known to be toxic and every score is 0; repeated rows are scored once each; a document with
several labels counts with each; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from returns_analytics.llm.arrays import LOWER, PUNCTUATION, slices, span_hashes, word_bounds
from returns_analytics.llm.sampling import bounded, fold

#: Labelled rows the voters and the classifier are fitted on, words of the classifier, words per lexicon, lexicons.
SAMPLE_ROWS, VOCABULARY, LEXICON_WORDS, LEXICONS = 20_000, 256, 4, 16
#: Labelled rows of a class that a word has to occur in, and by how many standard errors it has to favour one.
LEAST_ROWS, LEAST_Z = 5, 3.5
FOLDS, HELD_OUT = 5, 0

PATTERNS = ("exclamations", "capitals", "digits", "long_runs", "very_short")


def _patterns(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Shares and counts of characters per row, each in 0..1."""
    size = np.diff(offsets)
    sums = lambda flags: np.diff(np.concatenate(([0], np.cumsum(flags)))[offsets])
    share = lambda flags: sums(flags) / np.maximum(size, 1)
    same = np.zeros(len(data), bool)
    if len(data) > 3:
        same[3:] = (data[3:] == data[2:-1]) & (data[2:-1] == data[1:-2]) & (data[1:-2] == data[:-3])
    return np.column_stack([
        np.minimum(share(data == ord("!")) * 10, 1),
        share((data >= 65) & (data <= 90)),
        share((data >= 48) & (data <= 57)),
        np.minimum(share(same) * 10, 1),
        (words < 20).astype(float),
    ])


@dataclass(frozen=True)
class Vocabulary:
    """Hashes of words, ascending, and what to do with them."""

    hashes: np.ndarray

    def present(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows by words, true where a word occurs, and the patterns of the rows."""
        n = len(offsets) - 1
        starts, ends, rows = word_bounds(data, offsets, PUNCTUATION)
        hashes = span_hashes(LOWER[data], starts, ends)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes if len(self.hashes) else np.zeros(len(hashes), bool)
        found = np.zeros((n, len(self.hashes)), bool)
        found[rows[hit], at[hit]] = True
        return found, _patterns(data, offsets, np.bincount(rows, minlength=n))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words of a slice with the labelled rows of either class they occur in."""
    for batch in batches:
        toxic = np.asarray(batch["toxic"]).astype(bool)
        for first, last, data, offsets in slices(batch["text"]):
            starts, ends, rows = word_bounds(data, offsets, PUNCTUATION)
            if not len(starts):
                continue
            lower = LOWER[data]
            hashes = span_hashes(lower, starts, ends)
            _, index, number = np.unique(hashes, return_index=True, return_inverse=True)
            pairs = np.unique(number * (last - first) + rows)
            word, label = pairs // (last - first), toxic[first:last][pairs % (last - first)]
            text = lower.tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hashes[index].view(np.int64)),
                    pa.array([text[starts[i] : ends[i]].decode("utf-8", "replace") for i in index]),
                    pa.array(np.bincount(word, label, len(index)).astype(np.int64)),
                    pa.array(np.bincount(word, ~label, len(index)).astype(np.int64)),
                ],
                ["hash", "word", "toxic", "clean"],
            )


@dataclass(frozen=True)
class LabelModel:
    """Votes 1 and 0 per class and voter, the class prior, and the weight left to each voter."""

    prior: float
    votes: np.ndarray  # class, voter, vote (0 clean, 1 toxic, 2 abstains)
    weight: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        column = np.arange(votes.shape[1])
        log = [
            np.log(p) + (np.log(self.votes[y][column, votes]) * self.weight).sum(axis=1)
            for y, p in ((0, 1 - self.prior), (1, self.prior))
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -50, 50)))


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 400) -> LabelModel:
    """Expectation maximisation from initial posteriors; voters that repeat others weigh less.

    votes: rows by voters, 0 clean, 1 toxic, 2 abstains.
    """
    shown = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    signed = np.where(votes == 2, 0.0, votes * 2.0 - 1)
    posterior, weight = start.astype(float), np.ones(votes.shape[1])
    for _ in range(rounds):
        prior = float(np.clip(posterior.mean(), 1e-3, 1 - 1e-3))
        by_class = np.stack([
            (np.tensordot(p, shown, 1) + 0.5) / (p.sum() + 1.5) for p in (1 - posterior, posterior)
        ])
        # what voters share beyond their class: correlation of the residuals around the class means
        mean = np.stack([p @ signed / max(p.sum(), 1e-9) for p in (1 - posterior, posterior)])
        rest = signed - (np.outer(1 - posterior, mean[0]) + np.outer(posterior, mean[1]))
        scale = np.sqrt((rest**2).mean(axis=0)) + 1e-6
        correlation = (rest / scale).T @ (rest / scale) / len(rest)
        np.fill_diagonal(correlation, 0)
        weight = 1 / (1 + np.where(correlation > 0.2, correlation, 0).sum(axis=1))
        model = LabelModel(prior, by_class, weight)
        new = model.posterior(votes)
        if np.abs(new - posterior).max() < 1e-4:
            break
        posterior = new
    return model


def fit_linear(features: np.ndarray, target: np.ndarray, ridge: float = 2e-4, rounds: int = 40) -> np.ndarray:
    """Weights and, last, intercept of a logistic regression on soft labels (Newton steps)."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge * len(x))
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + penalty * w
        hessian = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    """Words with their weights, weights of the patterns, intercept. Without words every score is 0."""

    vocabulary: Vocabulary
    weights: np.ndarray
    words: tuple[str, ...] = ()
    label_model: LabelModel | None = None

    def score(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        n = len(offsets) - 1
        if not len(self.weights):
            return np.zeros(n)
        found, patterns = self.vocabulary.present(data, offsets)
        v = len(self.vocabulary.hashes)
        margin = found @ self.weights[:v] + patterns @ self.weights[v:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(margin, -50, 50)))


def _lexicon_votes(found: np.ndarray, patterns: np.ndarray, toxic_order: np.ndarray) -> np.ndarray:
    """Votes of the lexicons, of the absence of all their words, and of the patterns."""
    columns = []
    leading = toxic_order[: LEXICONS * LEXICON_WORDS]
    for k in range(0, len(leading), LEXICON_WORDS):
        columns.append(np.where(found[:, leading[k : k + LEXICON_WORDS]].any(axis=1), 1, 2))
    if len(leading):
        columns.append(np.where(found[:, leading].any(axis=1), 2, 0))
    columns += [np.where(patterns[:, k] > 0.5, 1, 2) for k in range(patterns.shape[1])]
    return np.column_stack(columns)


def fit(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, held_out: int | None = HELD_OUT) -> Model:
    """Learns from the labelled rows outside the held-out fold."""
    known = labels.filter("toxic is not null").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    if held_out is not None:
        known = known.filter(fold(F.col("doc_id"), FOLDS) != held_out)
    known = bounded(known, "doc_id", sample_rows)
    # at most about sample_rows ids and labels
    rows = documents.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    counts = (
        rows.select("text", "toxic")
        .mapInArrow(_count_words, "hash long, word string, toxic long, clean long")
        .groupBy("hash")
        .agg(F.min("word").alias("word"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    totals = known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    n = {int(row["toxic"] > 0): row["n"] for row in totals}
    if not n.get(0) or not n.get(1):
        return Model(Vocabulary(np.zeros(0, np.uint64)), np.zeros(0))
    # signed root of the log-likelihood ratio: unlike a standard error of odds it does not saturate for words
    # that one class never holds
    part = lambda x: F.when(x > 0, x * F.log(x)).otherwise(0.0)
    toxic, clean = F.col("toxic").cast("double"), F.col("clean").cast("double")
    rest_toxic, rest_clean = F.greatest(n[1] - toxic, F.lit(0.0)), F.greatest(n[0] - clean, F.lit(0.0))
    ratio = part(toxic) + part(clean) + part(rest_toxic) + part(rest_clean) - part(toxic + clean)
    ratio += part(rest_toxic + rest_clean) * -1 + part(toxic + clean + rest_toxic + rest_clean)
    ratio += part(toxic + rest_toxic) * -1 - part(clean + rest_clean)
    sign = F.when(toxic * n[0] > clean * n[1], 1.0).otherwise(-1.0)
    z = sign * F.sqrt(2 * F.greatest(ratio, F.lit(0.0)))
    ranked = counts.filter(F.greatest("toxic", "clean") >= LEAST_ROWS).withColumn("z", z)
    # a bounded vocabulary is the feature: the words that tell the classes apart best
    best = ranked.filter(F.abs("z") >= LEAST_Z).orderBy(F.abs("z").desc(), "word").limit(VOCABULARY).collect()
    best = sorted(((np.int64(r["hash"]).view(np.uint64), r["word"], r["z"]) for r in best), key=lambda r: int(r[0]))
    vocabulary = Vocabulary(np.array([r[0] for r in best], np.uint64))
    z = np.array([r[2] for r in best])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = batch["toxic"].to_pylist()
            for first, last, data, offsets in slices(batch["text"]):
                found, patterns = vocabulary.present(data, offsets)
                packed = np.packbits(found, axis=1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(toxic[first:last], pa.int32()),
                        pa.array([row.tobytes() for row in packed], pa.binary()),
                        pa.array(patterns.tolist(), pa.list_(pa.float64())),
                    ],
                    ["toxic", "found", "patterns"],
                )

    sample = rows.select("toxic", "text").mapInArrow(
        look, "toxic int, found binary, patterns array<double>"
    ).collect()
    gold = np.array([row["toxic"] > 0 for row in sample], float)
    width = len(vocabulary.hashes)
    found = np.stack([
        np.unpackbits(np.frombuffer(row["found"], np.uint8))[:width].astype(bool) for row in sample
    ])
    patterns = np.array([row["patterns"] for row in sample])
    toxic_order = np.array([i for i in np.argsort(-z, kind="stable") if z[i] > 0], int)
    votes = np.column_stack([_lexicon_votes(found, patterns, toxic_order), gold.astype(int)])
    label_model = fit_label_model(votes, gold)
    weights = fit_linear(np.column_stack([found, patterns]).astype(float), label_model.posterior(votes))
    return Model(vocabulary, weights, tuple(r[1] for r in best), label_model)


def score(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (0..1) and predicted (1 from 0.5 on) of every row; whole texts are read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [model.score(data, offsets) for _, _, data, offsets in slices(batch["text"])]
            values = np.concatenate(scores) if scores else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(values), pa.array((values >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, predicted int")


def classify(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """Scores of all documents by a model of the labels outside the held-out fold."""
    scored = score(documents, fit(documents, labels, sample_rows))
    return scored.select("doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score", "predicted")


def keep_clean(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """The rows of documents that are not predicted to be toxic, all columns as they are."""
    model = fit(documents, labels, sample_rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("text")
            scores = [model.score(data, offsets) for _, _, data, offsets in slices(batch.column(at))]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < 0.5))

    return documents.mapInArrow(run, documents.schema)
