"""Registered queries against their SQL on the smallest folder; the pipeline against its stages' brute-force versions."""

import sys
from pathlib import Path

import duckdb
import pytest
from helpers_llm import jaccard_components, line_runs
from test_decontaminate import brute

import corpus_pipeline
from returns_analytics.llm import queries, toxicity

sys.path.insert(0, str(Path(__file__).resolve().parents[2] / "tools"))
from check import rows  # noqa: E402

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    database = duckdb.connect()
    for path in Path(FOLDER).glob("*.parquet"):
        database.execute(f"create view {path.stem} as select * from '{path}'")
    frame = queries.QUERIES[name](spark, FOLDER)
    names = sorted(frame.columns)
    result = database.execute(queries.ORACLES[name])
    assert rows(frame.collect(), frame.columns, names) == rows(result.fetchall(), [c[0] for c in result.description], names)


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    columns, before = docs.columns, docs
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, FOLDER).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        texts = sorted((r.doc_id, r.text) for r in before.select("doc_id", "text").collect())
        if number < 4:
            assert after.columns == columns
            found = {r.doc_id: r.text for r in after.collect()}
        if number == 0:
            scored = toxicity.score(before, toxicity.fit(before, labels)).collect()
            assert set(found) == {r.doc_id for r in scored if not r.predicted}
        elif number == 1:
            want = line_runs(texts, 50)
            assert found == {i: want[i] for i, t in texts if want[i] == t or want[i].strip()}
            assert all(r.n_chars == len(r.text) for r in after.collect())
        elif number == 2:
            assert set(found) == {i for i, (_, c) in jaccard_components(texts, 5, 80).items() if i == c}
        elif number == 3:
            items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
            assert set(found) == {i for i, _ in texts} - {d for d, _ in brute(texts, items)}
        before = after
    assert {r.doc_id for r in before.collect()} == set(found)
    whole = corpus_pipeline.run(spark, FOLDER)
    assert sorted(map(tuple, whole.select("doc_id", "piece", "length", "ids_crc32").collect())) == sorted(
        map(tuple, before.select("doc_id", "piece", "length", "ids_crc32").collect()))
