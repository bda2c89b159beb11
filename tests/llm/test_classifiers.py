import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from returns_analytics.llm import langid, sampling, toxicity

FOLDER = "/root/testdata/sf0.01"


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_toxicity_on_held_out_rows(spark, documents):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    got = toxicity.classify(documents, labels).collect()
    assert len(got) == documents.count()
    known = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) and r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got)
    held = [(r.predicted, known[r.doc_id]) for r in got if r.held_out and r.doc_id in known]
    # some labels are wrong on purpose
    assert np.mean([a == b for a, b in held]) > 0.93
    kept = toxicity.keep_clean(documents, labels)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in got if not r.predicted}


def test_toxicity_ignores_held_out_labels(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(30)) + (" vile" if i % 3 == 0 else "")) for i in range(300)]
    rows += [(900, None), (901, ""), (902, "vile " * 3000), (903, "VILE!"), (5, rows[5][1])]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, toxic string")
    label = lambda flip: spark.createDataFrame(
        [(i, int((i % 3 == 0) != (flip and fold(i, 5) == 0)), None) for i in range(300)] + [(1, None, None), (7777, 1, None)],
        "doc_id long, toxic int, text string",
    )
    first, second = ([(r.doc_id, r.score, r.predicted) for r in toxicity.classify(frame, label(f)).collect()] for f in (False, True))
    assert sorted(first) == sorted(second) and len(first) == len(rows)
    found = {d: p for d, _, p in first}
    assert all(found[i] == (i % 3 == 0) for i in range(300)) and found[902] == found[903] == 1 and found[900] == found[901] == 0


def test_toxicity_without_labels(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    for labels in (none, one):
        assert [(r.score, r.predicted) for r in toxicity.classify(frame, labels).collect()] == [(0.0, 0)] * 2
        assert toxicity.keep_clean(frame, labels).count() == 2
    assert toxicity.classify(frame.filter("false"), one).count() == 0


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(0)
    truth = rng.random(20_000) < 0.3
    voter = lambda accuracy: np.where(rng.random(len(truth)) < accuracy, truth, ~truth).astype(int)
    good, fair, poor = voter(0.95), voter(0.8), voter(0.55)
    votes = np.column_stack([good, fair, fair, poor])  # the second one twice
    model = toxicity.fit_label_model(votes, voter(0.7).astype(float))
    right = lambda j: 0.7 * model.votes[0, j, 0] + 0.3 * model.votes[1, j, 1]
    assert abs(right(0) - 0.95) < 0.03 and abs(right(1) - 0.8) < 0.03 and abs(right(3) - 0.55) < 0.03
    assert model.weight[1] < 0.6 < model.weight[0]
    assert ((model.posterior(votes) > 0.5) == truth).mean() > 0.94


def test_languages_of_held_out_rows(documents):
    got = langid.identify(documents).collect()
    true = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    assert len(got) == len(true) and all(0 <= r.score <= 1 and r.held_out == (fold(r.doc_id, 4) == 2) for r in got)
    assert np.mean([r.lang_pred == true[r.doc_id] for r in got if r.held_out]) > 0.98


def test_languages_of_odd_texts(spark):
    rows = [(i, "the cat and the dog " * 3, "en") for i in range(40)] + [(i, "der hund und die katze " * 3, "de") for i in range(40, 80)]
    odd = [(100, None, "en"), (101, "", None), (102, "12 34 !? \n", "de"), (103, "İ" * 50 + " the cat", None), (104, "🙂", "en"),
           (105, "UND DER HUND " * 5000, None), (106, "und der hund", None), rows[0]]
    frame = spark.createDataFrame([(*r, "x") for r in rows + odd], "doc_id long, text string, lang string, score string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in langid.identify(frame.repartition(3)).collect()]
    found = {d: (p, s) for d, p, s in got}
    assert len(got) == len(rows) + len(odd)
    assert all(found[i] == ("und", 1.0) for i in (100, 101, 102, 104))
    assert found[105][0] == found[106][0] == "de" and found[0][0] == "en"
    nothing = langid.identify(frame.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 1.0), ("und", 0.0)}
    assert langid.identify(frame.filter("false")).count() == 0


def test_a_rare_language_is_learned(spark):
    """12 rows among 6,000, of which a sample of 300 in the languages' shares would hold none or one."""
    rng = np.random.default_rng(8)
    words = {"en": "the cat and dog house with very old trees near that river", "de": "der hund und die katze im haus mit sehr alten bäumen",
             "fr": "le chien et la maison avec des arbres très vieux près du fleuve"}
    langs = ["fr"] * 12 + ["en"] * 3000 + ["de"] * 2988
    rows = [(i, " ".join(rng.choice(words[lang].split(), 12)), lang) for i, lang in enumerate(langs)]
    rows += [(10_000 + k, " ".join(rng.choice(words["fr"].split(), 12)), None) for k in range(20)]
    rows += [(5, f"the very old house {k}", "en") for k in range(3000)]  # one id with a third of all rows
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(8)
    got = {r.doc_id: r.lang_pred for r in langid.identify(frame, sample_rows=300).collect() if r.doc_id != 5}
    assert [got[10_000 + k] for k in range(20)] == ["fr"] * 20
    assert np.mean([got[i] == lang for i, lang in enumerate(langs) if i != 5]) > 0.99


def test_classes_of_a_sample(spark):
    rows = spark.range(10_000).selectExpr("id", "case when id < 7 then 'a' when id < 500 then 'b' else 'c' end as lang")
    sample = sampling.bounded_per_class(rows, "lang", ["id"], 1000, 50)
    found = {r.lang: (r.n, r.w) for r in sample.groupBy("lang").agg(F.count("id").alias("n"), F.sum("weight").alias("w")).collect()}
    assert found["a"][0] == 7 and 35 <= found["b"][0] <= 70 and 850 < found["c"][0] < 1050
    assert abs(found["a"][1] - 0.7) < 1e-9 and abs(sum(w for _, w in found.values()) - 1000) < 60
    assert sampling.bounded_per_class(rows, "lang", ["id"], 20_000, 50).filter("weight = 1").count() == 10_000


def test_ngrams_do_not_cross_rows():
    data = "ab|éz|x".encode()
    split = np.frombuffer("abézx".encode(), np.uint8)
    bucket, row, letters = langid.ngrams(split, np.array([0, 2, 5, 5, 6]))
    assert letters.tolist() == [2, 2, 0, 1] and len(data) == 8
    for r, text in enumerate(("ab", "éz", "", "x")):
        own, *_ = langid.ngrams(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
        assert sorted(bucket[row == r].tolist()) == sorted(own.tolist())


def test_temperature_lowers_the_loss():
    rng = np.random.default_rng(2)
    margins = rng.standard_normal((500, 3)) * 8
    labels = np.array([rng.choice(3, p=p) for p in langid.softmax(margins / 4)])
    assert 2.5 < langid.temperature(margins, labels) < 6
    assert langid.temperature(np.zeros((0, 3)), np.zeros(0, int)) == 1.0
