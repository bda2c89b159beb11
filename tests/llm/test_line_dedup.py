import random

import pytest
from helpers_llm import line_runs, sha256

from returns_analytics.llm import line_dedup

SCHEMA = "doc_id long, text string, at int, runs string"


def corpus(seed):
    rng = random.Random(seed)
    line = lambda: " ".join(rng.choice("abcdefgh") for _ in range(rng.choice([1, 1, 2, 3, 6])))
    pool = [line() for _ in range(12)] + ["", " \t"]
    rows = [(0, None), (1, ""), (2, "\n\n"), (3, "same\n" * 20)]
    for i in range(4, 40):
        body = [rng.choice(pool) if rng.random() < 0.6 else f"{i} {line()}" for _ in range(rng.randint(0, 14))]
        if rng.random() < 0.4:
            other = (rng.choice(rows)[1] or "").split("\n")
            at = rng.randint(0, len(other))
            body[rng.randint(0, len(body)) :] = other[at : at + rng.randint(0, 9)]
        rows.append((i, "\n".join(body)))
    return rows


@pytest.mark.parametrize(("seed", "least"), [(1, 5), (2, 8), (3, 1), (4, 12)])
def test_equals_brute_force(spark, seed, least):
    rows = corpus(seed)
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(5)
    want = line_runs(rows, least)
    got = line_dedup.dedup_lines(frame, least, drop_empty=False)
    assert got.columns == frame.columns
    assert {r.doc_id: r.text for r in got.collect()} == want
    kept = {r.doc_id for r in line_dedup.dedup_lines(frame, least).collect()}
    assert kept == {i for i, text in rows if want[i] == text or want[i].strip()}
    digest = {r.doc_id: (r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.digest(frame, least).collect()}
    lines = lambda t: 0 if t is None else len(t.split("\n"))
    for i, text in rows:
        n, removed, kept_hash = digest[i]
        assert (n, kept_hash) == (lines(text), sha256((want[i] or "").encode()))
        # an empty text may be no line or one blank line
        assert removed == n - lines(want[i]) or (not want[i] and removed == n)


def test_repeated_rows_null_ids_and_empty_table(spark):
    text = "one two three four\nfive six seven"
    rows = [(5, text), (5, text), (None, text), (7, text + "\nlast line")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = sorted((str(r.doc_id), r.text) for r in line_dedup.dedup_lines(frame, 4).collect())
    assert got == [("7", "last line"), ("None", text)]
    assert line_dedup.dedup_lines(spark.createDataFrame([], SCHEMA)).count() == 0
