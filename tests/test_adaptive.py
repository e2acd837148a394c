"""The adaptive search: better than random draws on equal budgets, stopped trials, odd scores."""

import math

import pytest
from pyspark.sql import functions as F

from veld.plans import adaptive
from veld.plans import evaluate as ev

SPACE = {"a": ("uniform", -5.0, 5.0), "b": ("log", 1e-6, 1.0), "c": ("int", 1, 9)}


def _bowl(p):
    return -((p["a"] - 1.3) ** 2) - (math.log10(p["b"]) + 2.5) ** 2 - 0.3 * (p["c"] - 6) ** 2


@pytest.mark.parametrize("seed", [42, 43])
def test_better_than_random_draws(seed):
    found = adaptive.adaptive_search(lambda cs, folds: [[_bowl(c)] * len(folds) for c in cs], SPACE, [0], 80, seed=seed)
    drawn = ev.sample_continuous(SPACE, 80, seed)
    assert adaptive.best_trial(found)["mean_r2"] > max(map(_bowl, drawn))
    for t in found:
        p = t["params"]
        assert -5 <= p["a"] <= 5 and 1e-6 <= p["b"] <= 1 and p["c"] in range(1, 10)
    again = adaptive.adaptive_search(lambda cs, folds: [[_bowl(c)] * len(folds) for c in cs], SPACE, [0], 80, seed=seed)
    assert found == again


def test_stopped_trials_see_fewer_folds_and_are_never_best():
    seen = []

    def score(cs, folds):
        seen.append((len(cs), tuple(folds)))
        return [[_bowl(c) + (50.0 if f < 2 else 0.0) for f in folds] for c in cs]

    found = adaptive.adaptive_search(score, SPACE, [0, 1, 2, 3], 60, startup=10)
    stopped = [t for t in found if t["stopped"]]
    assert stopped and all(t["folds"] == 2 for t in stopped) and not any(t["stopped"] for t in found[:10])
    best = adaptive.best_trial(found)
    assert not best["stopped"] and best["mean_r2"] < max(t["mean_r2"] for t in stopped)      # their folds are easier
    assert sum(n * len(f) for n, f in seen) == sum(t["folds"] for t in found) < 60 * 4


def test_missing_scores_fixed_ranges_and_bad_spaces():
    fixed = {"a": ("uniform", 2.0, 2.0), "b": ("uniform", 0.0, 1.0)}
    found = adaptive.adaptive_search(lambda cs, folds: [[None if c["b"] < 0.5 else c["b"]] for c in cs], fixed, [0], 40)
    assert {t["params"]["a"] for t in found} == {2.0}
    assert adaptive.best_trial(found)["mean_r2"] >= 0.5 and len(found) == 40
    with pytest.raises(ValueError):
        adaptive.best_trial(adaptive.adaptive_search(lambda cs, folds: [[None] for _ in cs], fixed, [0], 12))
    for bad in (("log", 0.0, 1.0), ("uniform", 2.0, 1.0), ("other", 0.0, 1.0)):
        with pytest.raises(ValueError):
            adaptive.ParzenSampler({"x": bad})


def test_linear_search_scores_as_the_random_search(spark):
    df = spark.range(400).select(
        "id", (F.col("id") % 6).cast("int").alias("fold"), F.sin(F.col("id")).alias("x"), F.cos(F.col("id") * 1.7).alias("z"),
        (3 * F.sin(F.col("id")) + F.cos(F.col("id") * 1.7) + F.sin(F.col("id") * 12.9898) * 2).alias("y"))
    space = {"alpha": ("uniform", 0.01, 10.01), "l1_ratio": ("uniform", 0.0, 1.0)}
    rows = adaptive.adaptive_linear_search(df, "elastic_net", ["x", "z"], "y", space, n_trials=30).collect()
    whole = [r for r in rows if not r["stopped"]]
    cands = [{k: float(v) for k, v in r["params"].items()} for r in whole]
    plain = ev.random_search(df, "elastic_net", ["x", "z"], "y", cands).orderBy("candidate").collect()
    assert [r["mean_r2"] for r in whole] == pytest.approx([r["mean_r2"] for r in plain])
    drawn = ev.random_search(df, "elastic_net", ["x", "z"], "y", ev.sample_continuous(space, 30)).agg(F.max("mean_r2")).first()[0]
    assert max(r["mean_r2"] for r in whole) >= drawn


def test_boosted_workflow_in_batches(spark):
    from veld.plans.boost import SPACE as RANGES, boosted_workflow
    df = spark.range(240).select("id", (F.col("id") % 3).cast("int").alias("fold"), F.sin(F.col("id")).alias("x"),
                                 (3 * F.sin(F.col("id")) + F.cos(F.col("id") * 7.1)).alias("y"))
    out = boosted_workflow(df, ["x"], "y", ["id"], n_trials=3, num_boost_round=2, batch=2)
    rows = out["search"].orderBy("candidate").collect()
    assert [r["candidate"] for r in rows] == [0, 1, 2] and all(set(RANGES) <= set(r["params"]) for r in rows)
    best = max(rows, key=lambda r: r["mean_r2"])
    assert out["best"]["candidate"] == best["candidate"]
    assert out["model"].params["max_depth"] == int(best["params"]["max_depth"])
