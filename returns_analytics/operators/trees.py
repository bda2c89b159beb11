"""Boosted-tree models as Spark expressions.

A model is given in the public JSON dump format of gradient-boosted trees: a list of trees whose
inner nodes hold ``split``, ``split_condition``, ``yes``, ``no``, ``missing`` and ``children``,
and whose leaves hold ``leaf``. Features and thresholds are compared as 32-bit floats, a value
below the threshold goes to ``yes``, NaN goes to ``missing``, and the sum of the leaves passes
through the logistic function.

Small models become one Column, evaluated inside generated code. Large ones are walked level by
level over Arrow batches, since an expression with very many nodes would no longer be compiled.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from returns_analytics.errors import GateFailed


@dataclass(frozen=True)
class TreeModel:
    name: str
    version: str
    feature_version: str
    features: tuple[str, ...]
    trees: tuple[dict, ...]
    base_margin: float = 0.0

    @property
    def node_count(self) -> int:
        return sum(1 for tree in self.trees for _ in _nodes(tree))


def load_model(path: str, features: Sequence[str]) -> TreeModel:
    """Read a model from a JSON file and check it before it is used."""
    with open(path, encoding="utf-8") as source:
        spec = json.load(source)
    model = TreeModel(
        name=spec["name"],
        version=spec["version"],
        feature_version=spec["feature_version"],
        features=tuple(features),
        trees=tuple(spec["trees"]),
        base_margin=float(spec.get("base_margin", 0.0)),
    )
    check_model(model)
    return model


def _nodes(tree: dict) -> Iterator[dict]:
    yield tree
    for child in tree.get("children", ()):
        yield from _nodes(child)


def _feature_index(model: TreeModel, split: str) -> int:
    """Position of a split feature, given by name or as f0, f1, ..."""
    if split in model.features:
        return model.features.index(split)
    if split[:1] == "f" and split[1:].isdigit() and int(split[1:]) < len(model.features):
        return int(split[1:])
    raise GateFailed(f"model {model.name} splits on {split!r}, which is not one of its features")


def check_model(model: TreeModel, feature_count: int = 18) -> None:
    """Refuse a model that is empty, has another number of features, or could give no finite score.

    Finite leaves are enough: the logistic function maps every sum of them into 0..1.
    """
    if not model.trees:
        raise GateFailed(f"model {model.name} holds no tree")
    if len(model.features) != feature_count:
        raise GateFailed(f"model {model.name} has {len(model.features)} features, {feature_count} expected")
    for tree in model.trees:
        for node in _nodes(tree):
            if "leaf" in node:
                if not math.isfinite(node["leaf"]):
                    raise GateFailed(f"model {model.name}: leaf {node['nodeid']} is not a number")
                continue
            _feature_index(model, node["split"])
            if {node["yes"], node["no"]} != {child["nodeid"] for child in node["children"]}:
                raise GateFailed(f"model {model.name}: children of node {node['nodeid']} do not match")
    score = _score_batch(_flatten(model), [pd.Series([0.0])] * feature_count)
    if not math.isfinite(score.iloc[0]):
        raise GateFailed(f"model {model.name} gives {score.iloc[0]} for a zero row")


# --- as one expression ---------------------------------------------------------------------

def _tree_column(model: TreeModel, node: dict) -> Column:
    if "leaf" in node:
        return F.lit(float(node["leaf"])).cast("float")
    children = {child["nodeid"]: _tree_column(model, child) for child in node["children"]}
    value = F.col(model.features[_feature_index(model, node["split"])]).cast("float")
    threshold = F.lit(float(node["split_condition"])).cast("float")
    return (
        F.when(F.isnan(value), children[node.get("missing", node["yes"])])
        .when(value < threshold, children[node["yes"]])
        .otherwise(children[node["no"]])
    )


def _score_expression(model: TreeModel) -> Column:
    margin = F.lit(model.base_margin).cast("float")
    for tree in model.trees:
        margin = margin + _tree_column(model, tree)
    chance = (F.lit(1.0) / (F.lit(1.0) + F.exp(-margin.cast("double")))).cast("float").cast("double")
    return F.greatest(F.least(chance, F.lit(1.0)), F.lit(0.0))


# --- over Arrow batches --------------------------------------------------------------------

@dataclass(frozen=True)
class _FlatTree:
    feature: np.ndarray
    threshold: np.ndarray
    yes: np.ndarray
    no: np.ndarray
    missing: np.ndarray
    leaf: np.ndarray
    depth: int


@dataclass(frozen=True)
class _FlatModel:
    trees: tuple[_FlatTree, ...]
    base_margin: float


def _depth(node: dict) -> int:
    return 1 + max((_depth(child) for child in node.get("children", ())), default=0)


def _flatten(model: TreeModel) -> _FlatModel:
    """Node arrays per tree; a leaf points at itself, so walking past it changes nothing."""
    flat = []
    for tree in model.trees:
        nodes = list(_nodes(tree))
        place = {node["nodeid"]: index for index, node in enumerate(nodes)}

        def target(node: dict, branch: str) -> int:
            return place[node["nodeid"]] if "leaf" in node else place[node.get(branch, node["yes"])]

        flat.append(_FlatTree(
            feature=np.array([0 if "leaf" in n else _feature_index(model, n["split"]) for n in nodes]),
            threshold=np.array([n.get("split_condition", 0.0) for n in nodes], dtype=np.float32),
            yes=np.array([target(n, "yes") for n in nodes]),
            no=np.array([target(n, "no") for n in nodes]),
            missing=np.array([target(n, "missing") for n in nodes]),
            leaf=np.array([n.get("leaf", 0.0) for n in nodes], dtype=np.float32),
            depth=_depth(tree),
        ))
    return _FlatModel(tuple(flat), model.base_margin)


def _score_batch(model: _FlatModel, features: Sequence[pd.Series]) -> pd.Series:
    with np.errstate(over="ignore"):
        values = np.column_stack([f.to_numpy(dtype=np.float64) for f in features]).astype(np.float32)
    rows = np.arange(len(values))
    margin = np.full(len(values), model.base_margin, dtype=np.float32)
    for tree in model.trees:
        node = np.zeros(len(values), dtype=np.int64)
        for _ in range(tree.depth):
            value = values[rows, tree.feature[node]]
            below = np.where(value < tree.threshold[node], tree.yes[node], tree.no[node])
            node = np.where(np.isnan(value), tree.missing[node], below)
        margin = margin + tree.leaf[node]
    with np.errstate(over="ignore"):
        chance = (1.0 / (1.0 + np.exp(-margin.astype(np.float64)))).astype(np.float32).astype(np.float64)
    return pd.Series(np.clip(chance, 0.0, 1.0))


def _score_udf(model: TreeModel) -> Column:
    flat = _flatten(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for features in batches:
            yield _score_batch(flat, features)

    return score(*[F.col(name).cast("double") for name in model.features])


def score(model: TreeModel, arrow: bool = False) -> Column:
    """Score 0..1 of the feature columns named by the model.

    By default the model is one Column, which suits models of some hundred nodes; ``arrow=True`` walks
    the trees over Arrow batches and suits models of any size. Both give the same scores.
    """
    return _score_udf(model) if arrow else _score_expression(model)
