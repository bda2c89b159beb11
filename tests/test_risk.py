"""Features, validity, both forms of the model, and model checks."""

import json
import math
import random

import pytest
from helpers import row, summary
from pyspark.sql import functions as F

from returns_analytics.errors import GateFailed
from returns_analytics.operators import quality, risk, runs, trees
from returns_analytics.parity import oracle
from returns_analytics.plans.pipelines import risk_profile


@pytest.fixture(scope="module")
def model():
    return trees.load_model(oracle.MODEL_PATH, risk.FEATURES)


def brute_score(model, values):
    """Walk the trees in plain Python."""
    import numpy as np

    margin = np.float32(model.base_margin)
    for tree in model.trees:
        node = tree
        while "leaf" not in node:
            split = node["split"]
            position = model.features.index(split) if split in model.features else int(split[1:])
            value = np.float32(values[position])
            branch = "missing" if math.isnan(value) else "yes" if value < np.float32(node["split_condition"]) else "no"
            node = next(child for child in node["children"] if child["nodeid"] == node[branch])
        margin = np.float32(margin + np.float32(node["leaf"]))
    return float(np.float32(1 / (1 + math.exp(-float(margin)))))


def test_both_forms_equal_the_tree_walk(spark, model):
    rng = random.Random(1)
    edges = [0.1, 0.21, 0.3, 0.33, 1.35, 9.5, 250000.5, 15000.25, 4200.0, float("nan"), -1.0, 0.0, 1e9]
    rows = [tuple(rng.choice(edges) for _ in risk.FEATURES) for _ in range(300)]
    frame = spark.createDataFrame(rows, ", ".join(f"{name} double" for name in risk.FEATURES)).repartition(3)
    scored = frame.select("*", trees.score(model, arrow=False).alias("a"), trees.score(model, arrow=True).alias("b"))
    for r in scored.collect():
        assert r.a == r.b == brute_score(model, r[:18])


def test_features(spark):
    table = summary(spark, [row("A", "012000", taxable_value=10, total_output_tax=-4, eligible_itc=2, utilized_itc=1,
                                rcm_total_tax=100, cash_tax_paid=5, nil_supply_ratio=0.25)])
    got = risk.risk_features(table).first()
    assert (got.itc_utilization_ratio, got.cash_payment_ratio, got.rcm_itc_ratio, got.rcm_cash_ratio) == (
        0.5, 0.0, 9.9999, 9.9999)
    assert (got.reversed_itc, got.nil_supply_ratio) == (0.0, 0.25)
    assert risk.risk_features(table).columns[2:] == list(risk.FEATURES)


def test_infinite_features_are_set_aside(spark, model):
    inf, nan = float("inf"), float("nan")
    table = summary(spark, [row(g, "012000", taxable_value=1) for g in "ABCD"]).withColumns({
        "utilized_itc": F.expr("case gstin when 'A' then double('-infinity') when 'B' then double('nan') else 1e0 end"),
        "nil_supply_ratio": F.expr("case gstin when 'C' then 1e39 else 0e0 end")})
    profile, rejects = risk_profile(table, model)
    assert {(r.gstin, r.error_message) for r in rejects.collect()} == {
        ("A", "Feature 4 contains infinite value"), ("C", "Feature 15 contains infinite value")}
    assert {r.gstin for r in profile.collect()} == {"B", "D"}
    counters = runs.risk_counters(risk.scored_returns(table, model)).first()
    assert (counters.rows_read, counters.scored, counters.failed, counters.failed_percent) == (4, 2, 2, 50.0)
    assert inf > 0 and nan != nan


def test_failure_limit_is_strict():
    quality.enforce_failure_limit(200, 2)
    quality.enforce_failure_limit(0, 0)
    with pytest.raises(GateFailed):
        quality.enforce_failure_limit(199, 2)


def test_the_form_is_the_callers_choice(model):
    big = trees.TreeModel("big", "1", "18", model.features, model.trees * 100)
    assert "score(" in str(trees.score(big, arrow=True)) and "score(" not in str(trees.score(model))


@pytest.mark.parametrize("change", [
    lambda spec: spec.update(trees=[]),
    lambda spec: spec["trees"][0].update(split="unknown"),
    lambda spec: spec["trees"][0].update(split="f18"),
    lambda spec: spec["trees"][0].update(yes=7),
    lambda spec: spec["trees"][0]["children"][1].update(leaf=float("nan")),
])
def test_bad_models_are_refused(tmp_path, change):
    with open(oracle.MODEL_PATH, encoding="utf-8") as source:
        spec = json.load(source)
    change(spec)
    path = tmp_path / "model.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(GateFailed):
        trees.load_model(str(path), risk.FEATURES)


def test_wrong_number_of_features(model):
    with pytest.raises(GateFailed):
        trees.check_model(trees.TreeModel("m", "1", "17", model.features[:17], model.trees))
