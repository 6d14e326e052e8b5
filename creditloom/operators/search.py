"""Model-based parameter search: a Parzen density ratio over the trials so far, with successive halving.

The first trials are random. After that the finished trials are parted into the best share and the rest; for each parameter both parts are
smoothed to a density, values are drawn from that of the best, and the one with the highest ratio of the two densities is tried next.
A trial is measured at growing budgets (`rungs`) and stopped at a rung where it isn't among the best 1 / `reduction` so far. Trials
live in a table, from which a search can go on: the next proposal depends on the seed and the trials alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession

TABLE = "trial int, params map<string,double>, state string, value double, history array<double>"


def _unit(spec, x: float) -> float:
    """A value of a parameter (kind, low, high) as a number in [0, 1]."""
    kind, low, high = spec
    if kind == "log":
        return math.log(x / low) / math.log(high / low)
    return (x - low + 0.5) / (high - low + 1) if kind == "int" else (x - low) / (high - low)


def _value(spec, u: float) -> float:
    kind, low, high = spec
    if kind == "log":
        return low * (high / low) ** u
    return float(min(high, low + math.floor(u * (high - low + 1)))) if kind == "int" else low + (high - low) * u


_erf = np.vectorize(math.erf)


class Parzen:
    """A density on [0, 1]: a normal kernel at every point, as wide as the gap to its neighbours, and one broad kernel for the prior."""

    def __init__(self, points: Sequence[float]) -> None:
        order = np.sort(np.array(points, float))
        gaps = np.diff(np.r_[0.0, order, 1.0])
        self.at = np.r_[order, 0.5]
        self.width = np.r_[np.clip(np.maximum(gaps[:-1], gaps[1:]), 1 / min(100, len(order) + 2), 1.0), 1.0]
        self.inside = 0.5 * (_erf((1 - self.at) / self.width / math.sqrt(2)) + _erf(self.at / self.width / math.sqrt(2)))

    def draw(self, rng: np.random.Generator, n: int) -> np.ndarray:
        out: list[float] = []
        while len(out) < n:
            i = rng.integers(len(self.at))
            x = rng.normal(self.at[i], self.width[i])
            if 0 <= x <= 1:
                out.append(float(x))
        return np.array(out)

    def log_density(self, x: np.ndarray) -> np.ndarray:
        z = (x[:, None] - self.at[None, :]) / self.width[None, :]
        return np.log((np.exp(-0.5 * z * z) / (math.sqrt(2 * math.pi) * self.width * self.inside)).mean(axis=1) + 1e-300)


@dataclass
class Study:
    """Trials of a search that maximises. A list in place of (kind, low, high) is a choice; its values must be numbers."""

    space: Mapping[str, tuple | list]
    seed: int = 42
    startup: int = 10
    best_share: float = 0.12
    candidates: int = 64
    trials: list[dict] = field(default_factory=list)

    def ask(self) -> dict[str, float]:
        rng = np.random.default_rng([self.seed, len(self.trials)])
        if len(self.trials) < self.startup:
            return {n: float(rng.choice(s)) if isinstance(s, list) else _value(s, rng.random()) for n, s in self.space.items()}
        # Stopped trials come after finished ones, those that got further first.
        order = sorted(self.trials, key=lambda t: (t["state"] != "complete", -len(t["history"]), -t["value"]))
        cut = max(2, math.ceil(self.best_share * len(order)))
        good, rest = order[:cut], order[cut:]
        return {n: self._propose(n, s, good, rest, rng) for n, s in self.space.items()}

    def _propose(self, name: str, spec, good: list[dict], rest: list[dict], rng: np.random.Generator) -> float:
        if isinstance(spec, list):
            weigh = [np.array([1 + sum(t["params"][name] == v for t in part) for v in spec], float) for part in (good, rest)]
            drawn = rng.choice(len(spec), self.candidates, p=weigh[0] / weigh[0].sum())
            ratio = weigh[0] / weigh[0].sum() / (weigh[1] / weigh[1].sum())
            return float(spec[drawn[np.argmax(ratio[drawn])]])
        high, low = (Parzen([_unit(spec, t["params"][name]) for t in part]) for part in (good, rest))
        drawn = high.draw(rng, self.candidates)
        return _value(spec, float(drawn[np.argmax(high.log_density(drawn) - low.log_density(drawn))]))

    def promising(self, history: Sequence[float], reduction: float) -> bool:
        """Whether a trial's latest value is among the best 1 / reduction of all that reached that rung."""
        met = sorted((t["history"][len(history) - 1] for t in self.trials if len(t["history"]) >= len(history)), reverse=True)
        return len(met) < reduction or history[-1] >= met[max(0, math.ceil(len(met) / reduction) - 1)]

    def tell(self, params: Mapping[str, float], history: Sequence[float], complete: bool = True) -> None:
        self.trials.append({"params": dict(params), "state": "complete" if complete else "pruned", "value": float(history[-1]), "history": [float(v) for v in history]})

    @property
    def best(self) -> dict | None:
        done = [t for t in self.trials if t["state"] == "complete"]
        return max(done, key=lambda t: t["value"]) if done else None

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([(i, t["params"], t["state"], t["value"], t["history"]) for i, t in enumerate(self.trials)], TABLE)

    def resumed(self, table: DataFrame) -> Study:
        """This study with the trials of a stored table."""
        self.trials = [{"params": dict(r["params"]), "state": r["state"], "value": r["value"], "history": list(r["history"])} for r in table.orderBy("trial").collect()]
        return self


def run(study: Study, measure: Callable[[Mapping[str, float], float], float], n: int, rungs: Sequence[float] = (1.0,), reduction: float = 3.0) -> Study:
    """Adds trials until the study has `n`. `measure(params, share)` gives the value at a share of the full budget."""
    while len(study.trials) < n:
        params, history, going = study.ask(), [], True
        for share in rungs:
            history.append(measure(params, share))
            going = share == rungs[-1] or study.promising(history, reduction)
            if not going:
                break
        study.tell(params, history, going)
    return study
