"""The entry works without the corpus operators, with or without the pipeline file."""

import sys

import pytest

import __spark_entry__ as entry
from returns_analytics.parity.queries import CATALOG


class Blocked:
    """Finds nothing for the corpus subpackage, as if its folder were deleted."""

    def find_spec(self, name, path=None, target=None):
        if name == "returns_analytics.llm" or name.startswith("returns_analytics.llm."):
            raise ModuleNotFoundError(name)


@pytest.mark.parametrize("blocked", [False, True])
def test_without_the_corpus_operators(monkeypatch, blocked):
    for name in [n for n in sys.modules if n.startswith("returns_analytics.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    if blocked:  # an import by any way fails
        monkeypatch.setattr(sys, "meta_path", [Blocked(), *sys.meta_path])
    monkeypatch.setattr(entry, "find_spec", lambda name: None if name.startswith("returns_analytics.llm") else object())
    assert set(entry.queries()) == set(CATALOG)
    assert set(entry.oracle_sql()) <= set(CATALOG)
    assert not [n for n in sys.modules if n.startswith("returns_analytics.llm")]
