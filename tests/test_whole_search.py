"""The searches draw from the reference's whole spaces; the registered ones with a stated number of draws."""

import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from veld.plans import boost, catalog_models, flow
from veld.plans import evaluate as ev

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.mark.parametrize("name", ["listing_train", "listing_score", None])
def test_listing_search_draws(spark, monkeypatch, name):
    """Ten draws of each kind by default; the registered queries draw fewer trees, as ``LISTING_DRAWS`` says."""
    drawn = {}

    def search(data, kind, features, target, candidates):
        drawn[kind] = candidates
        return spark.createDataFrame([(kind, 0, {}, 0.0, 0.0)], "model string, candidate int, params map<string,string>, mean_r2 double, std_r2 double")

    data = spark.range(60).select("id", F.col("id").cast("double").alias("x"), F.col("id").cast("double").alias("Price"), (F.col("id") % 5 == 0).alias("is_test"))
    monkeypatch.setattr(flow, "prepare_listings", lambda *a: SimpleNamespace(data=data))
    monkeypatch.setattr(ev, "random_search", search)
    if name:
        getattr(catalog_models, f"q_{name}")(spark, SF).count()
    else:
        flow.train_models(data, "Price")
    draws = catalog_models.LISTING_DRAWS if name else dict.fromkeys(flow.MODEL_SPACES, 10)
    assert drawn == {k: ev.sample_params(s, draws[k], 42) for k, s in flow.MODEL_SPACES.items()}


def test_boosted_workflow_is_whole_by_default(spark, monkeypatch):
    drawn = []

    def search(data, features, label, key, candidates, fold, seed):
        drawn.extend(candidates)
        return spark.createDataFrame([(0, {}, 0.0, 0.0)], "candidate int, params map<string,string>, trees double, mean_r2 double")

    monkeypatch.setattr(boost, "boosted_search", search)
    monkeypatch.setattr(boost, "fit_boosted", lambda *a, **k: [["model"]])
    out = boost.boosted_workflow(None, ["x"], "y", ["id"])
    assert out["model"] == "model" and len(drawn) == 100
    assert all(c["n_estimators"] == 100 and c["early_stopping_rounds"] == 20 for c in drawn)
    assert {c["max_depth"] for c in drawn} == set(range(3, 10)) and {c["min_child_weight"] for c in drawn} == set(range(1, 8))
    assert all(set(boost.SPACE) < set(c) for c in drawn)


def test_registered_workflow_is_the_whole_search(spark, monkeypatch):
    """The registered query runs the reference's 100 trials of 100 rounds (F1)."""
    asked = {}

    def workflow(train, features, label, key, fold="fold", n_trials=100, num_boost_round=100, early_stopping_rounds=20, seed=42, batch=None):
        asked.update(trials=n_trials, rounds=num_boost_round, early=early_stopping_rounds)
        raise StopIteration

    monkeypatch.setattr(boost, "boosted_workflow", workflow)
    with pytest.raises(StopIteration):
        catalog_models.q_boosted_workflow(spark, SF)
    assert asked == {"trials": 100, "rounds": 100, "early": 20}


def test_registered_listing_searches_draw_ten_of_each_kind():
    """As the reference's random search does, tree models included."""
    assert catalog_models.LISTING_DRAWS == dict.fromkeys(flow.MODEL_SPACES, 10)
