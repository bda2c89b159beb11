import random

import numpy as np
import pytest
from helpers_llm import later_bytes, repeated_bytes

from returns_analytics.llm import suffix_dedup

LENGTH = 60


def corpus(seed):
    """Texts with copies of whole texts, of passages at odd places, and of themselves."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdéß") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = [text(25) for _ in range(4)]
    rows = [(0, None), (1, ""), (2, "x" * LENGTH), (3, "ab" * 200), (4, "short")]
    for i in range(5, 60):
        body = text(rng.randint(0, 60))
        if rng.random() < 0.5:
            at = rng.randint(0, len(body))
            body = body[:at] + rng.choice(passage)[rng.randint(0, 9) :] + body[at:]
        if rng.random() < 0.2:
            body = rng.choice([t for _, t in rows if t])
        if rng.random() < 0.2 and body:
            at = rng.randint(0, len(body) - 1)
            body = body[:at] + "!" + body[at + 1 :]
        rows.append((i, body))
    return rows + [rows[7], rows[8]]  # repeated rows


@pytest.mark.parametrize(("seed", "many"), [(1, 4096), (2, 4096), (3, 1)])
def test_equals_brute_force(spark, monkeypatch, seed, many):
    monkeypatch.setattr(suffix_dedup, "MANY", many)
    monkeypatch.setattr(suffix_dedup, "GRAM", 12)
    rows = corpus(seed)
    frame = spark.createDataFrame([(*r, "extra") for r in rows], "doc_id long, text string, windows string")
    got = suffix_dedup.remove_repeats(frame, LENGTH).collect()
    want = [(i, *x) for (i, _), x in zip(rows, repeated_bytes(rows, LENGTH))]
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got) == sorted(want)
    assert sum(x[2] for x in want)


def test_keeps_the_first_copy(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "GRAM", 12)
    rows = corpus(4)[:-2]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame, LENGTH, keep_first=True).collect()}
    assert got == {i: kept for (i, _), kept in zip(rows, later_bytes(rows, LENGTH))}


def test_digest_and_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    out = suffix_dedup.remove_repeats(frame, digest=True)
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert out.count() == 0


@pytest.mark.parametrize("keep_first", [False, True])
def test_no_task_holds_an_anchor_with_many_stretches(spark, monkeypatch, keep_first):
    """One passage behind different text in every document: its edge has a different stretch in each."""
    rng = np.random.default_rng(8)
    word = lambda n: "".join(chr(c) for c in rng.integers(97, 123, n))
    passage = word(150)
    rows = [(k, word(90) + passage + word(90)) for k in range(40)]
    monkeypatch.setattr(suffix_dedup, "MANY", 8)
    real = suffix_dedup._match

    def bounded(length, first):
        match = real(length, first)

        def run(batches):
            held = list(batches)
            names = [c for c in ("dealt", "key") if held and c in held[0].schema.names]
            at = [k for batch in held for k in batch[names[0]].to_pylist()]
            assert max((at.count(k) for k in set(at)), default=0) <= 8
            yield from match(iter(held))

        return run

    monkeypatch.setattr(suffix_dedup, "_match", bounded)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame, 60, keep_first).collect()}
    wanted = later_bytes(rows, 60) if keep_first else [r[3] for r in repeated_bytes(rows, 60)]
    assert got == {k: kept for (k, _), kept in zip(rows, wanted)}


def test_a_crowded_anchor_moves_stretches_and_no_texts(spark, monkeypatch):
    """Parts and windows are cut from the bytes of stretches, so that whole texts move only once before the last join."""
    rng = np.random.default_rng(9)
    word = lambda n: "".join(chr(c) for c in rng.integers(97, 123, n))
    passage = word(150)
    rows = [(k, word(3000) + passage + word(3000)) for k in range(20)]
    monkeypatch.setattr(suffix_dedup, "MANY", 8)
    real = suffix_dedup._parts

    def bounded(length, single):
        parts = real(length, single)

        def run(batches):
            held = list(batches)
            assert all("text" not in batch.schema.names for batch in held)
            assert all(len(data) < 500 for batch in held for data in batch["bytes"].to_pylist())
            yield from parts(iter(held))

        return run

    monkeypatch.setattr(suffix_dedup, "_parts", bounded)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: bytes(r.kept) for r in suffix_dedup.remove_repeats(frame, 60).collect()}
    assert got == {k: r[3] for (k, _), r in zip(rows, repeated_bytes(rows, 60))}
    assert all(len(kept) < 6010 for kept in got.values())
