"""Adaptive parameter search (V5): a tree-structured Parzen estimator with early stopped trials.

The driver keeps one row a trial.  After ``startup`` random trials the finished ones are cut
into the best and the rest; each parameter gets two densities, mixtures of normals around the
values of either part (cut to the range, one wide component over the whole range in each), and
of ``draws`` values drawn from the first the one with the largest ratio of both is proposed.
Proposals come in batches, so the trials of a batch are fitted together.

A trial is scored on groups of folds, one group after the other; after each but the last, a trial whose mean so far
is below the median that finished trials had there is stopped and keeps that mean.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from statistics import NormalDist, median

from pyspark.sql import DataFrame

from veld.plans.linear_cv import fold_statistics, r2_of, solve_kind, _minus, _sum

_UNIT = NormalDist()


class ParzenSampler:
    """Proposals for ``{"name": ("uniform"|"log"|"int", low, high)}``; higher scores are better."""

    def __init__(self, space: Mapping[str, tuple], seed: int = 42, startup: int = 10, draws: int = 24):
        for name, (kind, low, high) in space.items():
            if kind not in ("uniform", "log", "int") or low > high or (kind == "log" and low <= 0):
                raise ValueError(f"{name}: {(kind, low, high)}")
        self.space, self.startup, self.draws = dict(space), startup, draws
        self.random = random.Random(seed)
        self.trials: list[tuple[dict, tuple[int, float]]] = []

    def _inner(self, name: str, value: float) -> float:
        return math.log(value) if self.space[name][0] == "log" else float(value)

    def _range(self, name: str) -> tuple[float, float]:
        kind, low, high = self.space[name]
        half = 0.5 if kind == "int" else 0.0
        return self._inner(name, low) - half, self._inner(name, high) + half

    def _outer(self, name: str, x: float):
        kind, low, high = self.space[name]
        if kind == "int":
            return min(max(round(x), low), high)
        return min(max(math.exp(x) if kind == "log" else x, low), high)

    def _mixture(self, name: str, values: Sequence[float]) -> list[tuple[float, float]]:
        """(centre, width) of the components; a width is the larger gap to a neighbour, within bounds."""
        low, high = self._range(name)
        at = sorted([*values, (low + high) / 2])
        widest, least = high - low, (high - low) / min(100, 1 + len(at))
        found = [(0.5 * (low + high), widest)]
        for v in values:
            i = at.index(v)
            gaps = [abs(v - other) for other in (*at[max(0, i - 1):i], *at[i + 1:i + 2])]
            found.append((v, min(max([*gaps, least]), widest)))
        return found

    def _draw(self, name: str, mixture: list) -> float:
        low, high = self._range(name)
        centre, width = self.random.choice(mixture)
        a, b = _UNIT.cdf((low - centre) / width), _UNIT.cdf((high - centre) / width)
        p = min(max(a + (b - a) * self.random.random(), 1e-12), 1 - 1e-12)
        return min(max(centre + width * _UNIT.inv_cdf(p), low), high)

    def _density(self, name: str, mixture: list, x: float) -> float:
        low, high = self._range(name)
        total = 0.0
        for centre, width in mixture:
            inside = _UNIT.cdf((high - centre) / width) - _UNIT.cdf((low - centre) / width)
            total += _UNIT.pdf((x - centre) / width) / (width * inside)
        return total / len(mixture)

    def ask(self, n: int) -> list[dict]:
        """``n`` proposals from the trials told so far."""
        if len(self.trials) < self.startup:
            return [{k: self._outer(k, self.random.uniform(*self._range(k))) for k in self.space} for _ in range(n)]
        ranked = sorted(self.trials, key=lambda t: t[1], reverse=True)
        cut = min(25, max(1, math.ceil(0.1 * len(ranked))))
        out = []
        mixtures = {k: tuple(self._mixture(k, [self._inner(k, p[k]) for p, _ in part]) for part in (ranked[:cut], ranked[cut:]))
                    for k, (_, low, high) in self.space.items() if low < high}
        for _ in range(n):
            params = {k: low for k, (_, low, high) in self.space.items() if low == high}
            for k, (good, rest) in mixtures.items():
                drawn = [self._draw(k, good) for _ in range(self.draws)]
                params[k] = self._outer(k, max(drawn, key=lambda x: self._density(k, good, x) / self._density(k, rest, x)))
            out.append(params)
        return out

    def tell(self, params: dict, score: float | None, folds: int = 1) -> None:
        """A trial stopped on fewer folds ranks below all that saw more (folds differ in level); one
        without a score, or with NaN, counts as the worst of its number of folds."""
        self.trials.append((params, (folds, -math.inf if score is None or math.isnan(score) else score)))


def adaptive_search(score: Callable[[list, list], list], space: Mapping[str, tuple], folds: Sequence, n_trials: int = 100,
                    batch: int = 5, group: int = 2, seed: int = 42, startup: int = 10) -> list[dict]:
    """Rows ``params``, ``mean_r2``, ``std_r2``, ``folds`` (scored), ``stopped``, in order of trial.

    ``score(candidates, folds)`` gives for each candidate its scores on those folds.  ``group`` folds
    are scored at a time; no trial is stopped before ``startup`` of them have finished."""
    sampler = ParzenSampler(space, seed, startup)
    steps = [list(folds[i:i + group]) for i in range(0, len(folds), group)]
    finished: list[list[float]] = []                     # means after each step, of whole trials
    out = []
    mean = lambda xs: None if not xs or None in xs else sum(xs) / len(xs)
    while len(out) < n_trials:
        proposed = sampler.ask(min(batch, n_trials - len(out)))
        scores = [[] for _ in proposed]
        means = [[] for _ in proposed]
        alive = list(range(len(proposed)))
        for s, step in enumerate(steps):
            for i, got in zip(alive, score([proposed[i] for i in alive], step)):
                scores[i] += got
                means[i].append(mean(scores[i]))
            if s + 1 < len(steps) and len(finished) >= startup:
                bar = median(m[s] for m in finished)
                alive = [i for i in alive if means[i][-1] is not None and means[i][-1] >= bar]
            if not alive:
                break
        for i, params in enumerate(proposed):
            m = means[i][-1]
            whole = len(scores[i]) == len(folds)
            std = None if m is None else math.sqrt(sum((x - m) ** 2 for x in scores[i]) / len(scores[i]))
            sampler.tell(params, m, len(scores[i]))
            if whole and None not in means[i]:
                finished.append(means[i])
            out.append({"params": params, "mean_r2": m, "std_r2": std, "folds": len(scores[i]), "stopped": not whole})
    return out


def best_trial(trials: Sequence[dict]) -> dict:
    """The best of the whole trials, the earliest of equals; a stopped one is never chosen."""
    whole = [t for t in trials if not t["stopped"] and t["mean_r2"] is not None]
    if not whole:
        raise ValueError("no trial has a score on every fold")
    return max(whole, key=lambda t: t["mean_r2"])


def linear_scorer(data: DataFrame, kind: str, features: Sequence[str], label: str, fold: str = "fold"
                  ) -> tuple[Callable[[list, list], list], list]:
    """A scorer of linear models and its folds, from one scan of the rows however many trials follow."""
    stats = fold_statistics(data, features, label, fold)
    if len(stats) < 2:
        raise ValueError("a search needs two folds with rows")
    total = _sum(list(stats.values()))
    train = {k: _minus(total, s) for k, s in stats.items()}

    def score(candidates: list, folds: list) -> list:
        return [[r2_of(stats[k], *solve_kind(kind, train[k], c)) for k in folds] for c in candidates]

    return score, sorted(stats)


def adaptive_linear_search(data: DataFrame, kind: str, features: Sequence[str], label: str, space: Mapping[str, tuple],
                           fold: str = "fold", n_trials: int = 100, seed: int = 42) -> DataFrame:
    """``(model, candidate, params, mean_r2, std_r2, folds, stopped)`` of an adaptive search of a linear kind."""
    score, folds = linear_scorer(data, kind, features, label, fold)
    rows = [(kind, j, {k: str(v) for k, v in t["params"].items()}, t["mean_r2"], t["std_r2"], t["folds"], t["stopped"])
            for j, t in enumerate(adaptive_search(score, space, folds, n_trials, seed=seed))]
    return data.sparkSession.createDataFrame(
        rows, "model string, candidate int, params map<string,string>, mean_r2 double, std_r2 double, folds int, stopped boolean")
