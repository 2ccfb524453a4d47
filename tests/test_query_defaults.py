"""The queries that tune models or fit clusters ask for the operators' defaults and search spaces."""

import inspect

import pytest

from lapsewise.operators import models as M
from lapsewise.operators import segment as S
from lapsewise.plans import stages
from lapsewise.queries import modelling, segments
from lapsewise.sources.workspace import materialise


class Asked(Exception):
    """Ends a query where the long part would begin."""


def asked(monkeypatch, module, name, query, *args):
    """What the query calls the function with, defaults included."""
    signature, calls = inspect.signature(getattr(module, name)), []

    def call(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        calls.append(bound.arguments)
        raise Asked

    monkeypatch.setattr(module, name, call)
    with pytest.raises(Asked):
        query(*args)
    return calls[0]


@pytest.fixture(scope="module")
def matrices(spark, sf_dir):
    return modelling.matrices(spark, sf_dir)


@pytest.fixture(scope="module")
def featured(spark, sf_dir):
    return materialise(segments.featured(spark, sf_dir), "featured")


@pytest.mark.parametrize("query", ["model_comparison", "model_comparison_without_proxies", "tree_contributions", "tree_risk_table"])
def test_models_are_searched(spark, sf_dir, monkeypatch, matrices, query):
    monkeypatch.setattr(modelling, "matrices", lambda *_: matrices)
    monkeypatch.setattr(stages, "smote", lambda rows, names: rows)
    call = asked(monkeypatch, stages, "train_models", getattr(modelling, query), spark, sf_dir)
    assert (call["trials"], call["folds"], call["spaces"], call["fixed"]) == (30, 5, None, None)


def test_search_is_whole(spark, sf_dir, monkeypatch, matrices):
    monkeypatch.setattr(modelling, "matrices", lambda *_: matrices)
    call = asked(monkeypatch, M, "random_search", modelling.random_search, spark, sf_dir)
    assert (call["trials"], call["folds"], call["space"]) == (30, 5, None)
    assert call["train"].select("fold").distinct().count() == 5


@pytest.mark.parametrize(
    "query, restarts",
    [("kmeans_segment_profile", 20), ("segmenter_round_trip", 20), ("kmeans_scan", 10), ("kmeans_silhouette", 20), ("kmeans_embeddings_quality", 20)],
)
def test_clusters_have_all_restarts(spark, sf_dir, monkeypatch, featured, query, restarts):
    monkeypatch.setattr(segments, "featured", lambda *_: featured)
    call = asked(monkeypatch, S, "fit_starts", getattr(segments, query), spark, sf_dir)
    assert (call["restarts"], call["max_iter"]) == (restarts, 500)
