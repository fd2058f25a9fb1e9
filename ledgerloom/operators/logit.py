"""L2 logistic regression for many training parts at once, by Newton steps on sums that Spark adds up.

A model is fitted per part: one for all rows, or one per fold, trained on the rows of the other folds. A step is a single
aggregate however many models are fitted: tasks add up, for every model still moving, the gradient, the curvature and the
loss of the rows that it trains on, and Spark adds the tasks' sums. The driver sees (features + 1)^2 numbers per model.

Features are standardised with the mean and population deviation of a model's own training rows. These come from one
aggregate of moments per fold, merged over the other folds without cancellation. The penalty is |w|^2 / (2 C), not on the
intercept, as for the logistic regression of `classify`.

Defined cases: rows with a NULL label or feature take no part; a constant column has weight zero; separable classes
have finite weights because of the penalty; a training part with a single class always predicts that class; a part without
rows predicts 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Largest number of steps, largest gradient entry per row of a finished model, intercept of a single class.
MAX_STEPS, TOLERANCE, CERTAIN = 100, 1e-10, 40.0


@dataclass
class Logit:
    """`weights` and `intercept` belong to the standardised features; `steps` counts the Newton steps taken."""

    features: list[str]
    rows: int
    means: np.ndarray
    deviations: np.ndarray
    weights: np.ndarray
    intercept: float
    steps: int = 0

    def score(self, z: np.ndarray) -> np.ndarray:
        """Probability of class 1 of raw feature rows."""
        return sigmoid(((z - self.means) / self.deviations) @ self.weights + self.intercept)

    def column(self) -> Column:
        """The same as a column expression."""
        terms = [(F.col(f) - float(m)) / float(s) * float(w) for f, m, s, w in zip(self.features, self.means, self.deviations, self.weights)]
        return 1 / (1 + F.exp(-reduce(lambda a, b: a + b, terms, F.lit(self.intercept))))


def sigmoid(t: np.ndarray) -> np.ndarray:
    return np.exp(-np.logaddexp(0.0, -t))


def _matrix(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.column_stack([batch.column(n).to_numpy(zero_copy_only=False).astype(float) for n in names])


@dataclass
class _Moments:
    n: int
    ones: int
    mean: np.ndarray
    spread: np.ndarray  # summed squared distances from the mean

    def merged(self, other: _Moments) -> _Moments:
        n = self.n + other.n
        if not self.n or not other.n:
            return other if not self.n else self
        gap = other.mean - self.mean
        mean = self.mean + gap * (other.n / n)
        return _Moments(n, self.ones + other.ones, mean, self.spread + other.spread + gap**2 * (self.n * other.n / n))


def _moments(rows: DataFrame, features: Sequence[str], label: str, fold: str) -> dict[int, _Moments]:
    parts = [F.avg(f).alias(f"m{i}") for i, f in enumerate(features)] + [F.var_pop(f).alias(f"v{i}") for i, f in enumerate(features)]
    found = rows.groupBy(fold).agg(F.count("*").alias("n"), F.sum(label).alias("ones"), *parts).collect()  # a row per fold
    pick = lambda r, c: np.array([r[f"{c}{i}"] for i in range(len(features))], float)
    return {r[fold]: _Moments(r["n"], int(r["ones"]), pick(r, "m"), pick(r, "v") * r["n"]) for r in found}


def fit_parts(
    df: DataFrame, features: Sequence[str], label: str, fold: str | None = None, strength: float = 1.0, max_steps: int = MAX_STEPS
) -> dict[int | None, Logit]:
    """A model per fold, fitted on the rows of the other folds; without `fold` one model (key None) of all rows.

    `label` is 0 or 1, `fold` an integer. `df` is read once for the moments and once per step.
    """
    features = list(features)
    part = F.lit(0) if fold is None else F.col(fold)
    rows = df.select(*[F.col(f).cast("double").alias(f"x{i}") for i, f in enumerate(features)], F.col(label).cast("int").alias("y"), part.cast("int").alias("part"))
    rows = rows.dropna()
    names = [f"x{i}" for i in range(len(features))]
    moments = _moments(rows, names, "y", "part")
    nothing = _Moments(0, 0, np.zeros(len(features)), np.zeros(len(features)))
    keys = [None] if fold is None else sorted(moments)
    models: dict[int | None, Logit] = {}
    for key in keys or [None]:
        own = reduce(_Moments.merged, [m for p, m in moments.items() if fold is None or p != key], nothing)
        deviations = np.sqrt(own.spread / max(own.n, 1))
        deviations[deviations <= 1e-12 * np.abs(own.mean)] = 1.0
        deviations[deviations == 0] = 1.0
        share = own.ones / own.n if own.n else 0.5
        start = -CERTAIN if share == 0 else CERTAIN if share == 1 else float(np.log(share / (1 - share)))
        models[key] = Logit(features, own.n, own.mean, deviations, np.zeros(len(features)), start)
        models[key].steps = -1 if 0 < share < 1 and own.n else 0  # -1: to be fitted
    live = {k: _Descent(models[k], strength) for k in models if models[k].steps < 0}
    for _ in range(max_steps):
        if not live:
            break
        sums = _sums(rows, names, fold is not None, {k: d.tried for k, d in live.items()}, {k: models[k] for k in live})
        live = {k: d for k, d in live.items() if d.step(*sums[k])}
    for k, m in models.items():
        m.steps = max(m.steps, 0)
    return models


class _Descent:
    """Newton's method with halved steps, fed with sums at the point `tried` (intercept first)."""

    def __init__(self, model: Logit, strength: float):
        self.model, self.penalty = model, np.r_[0.0, np.full(len(model.features), 1.0 / strength)]
        self.tried = np.r_[model.intercept, model.weights]
        self.best, self.move, self.loss = self.tried, np.zeros_like(self.tried), np.inf
        model.steps = 0

    def step(self, gradient: np.ndarray, curvature: np.ndarray, loss: float) -> bool:
        """Whether the model needs another look at `tried`."""
        m = self.model
        m.steps += 1
        loss = loss + 0.5 * (self.penalty * self.tried**2).sum()
        if loss > self.loss * (1 + 1e-12) + 1e-12:  # too far: half of the way
            self.move = self.move / 2
            self.tried = self.best + self.move
            return bool(np.abs(self.move).max() > 1e-14)
        self.best, self.loss = self.tried, loss
        m.intercept, m.weights = float(self.best[0]), self.best[1:]
        gradient = gradient + self.penalty * self.best
        if np.abs(gradient).max() <= TOLERANCE * m.rows:
            return False
        curvature = curvature + np.diag(self.penalty)
        self.move = -np.linalg.lstsq(curvature, gradient, rcond=1e-14)[0]
        self.tried = self.best + self.move
        return True


def _sums(
    rows: DataFrame, names: Sequence[str], folded: bool, points: Mapping[int | None, np.ndarray], models: Mapping[int | None, Logit]
) -> dict[int | None, tuple[np.ndarray, np.ndarray, float]]:
    """Gradient, curvature and loss of every model at its point, in one aggregate."""
    order = list(points)
    scale = [(models[k].means, models[k].deviations) for k in order]
    at = [points[k] for k in order]
    d = len(names) + 1

    def scan(batches) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(order), d * d + d + 1))
        for batch in batches:
            x, y, part = _matrix(batch, names), batch.column("y").to_numpy().astype(float), batch.column("part").to_numpy()
            for i, key in enumerate(order):
                use = part != key if folded else slice(None)
                z = np.column_stack([np.ones(len(x[use])), (x[use] - scale[i][0]) / scale[i][1]])
                t = z @ at[i]
                p = sigmoid(t)
                total[i, : d * d] += (z.T @ (z * (p * (1 - p))[:, None])).ravel()
                total[i, d * d : -1] += z.T @ (p - y[use])
                total[i, -1] += (np.logaddexp(0.0, t) - y[use] * t).sum()
        model = np.repeat(np.arange(len(order)), total.shape[1])
        cell = np.tile(np.arange(total.shape[1]), len(order))
        yield pa.RecordBatch.from_arrays([pa.array(model, pa.int32()), pa.array(cell, pa.int32()), pa.array(total.ravel())], names=["model", "cell", "v"])

    found = rows.mapInArrow(scan, "model int, cell int, v double").groupBy("model", "cell").agg(F.sum("v").alias("v")).collect()
    out = np.zeros((len(order), d * d + d + 1))
    for r in found:  # models x cells numbers
        out[r["model"], r["cell"]] = r["v"]
    return {k: (o[d * d : -1], o[: d * d].reshape(d, d), float(o[-1])) for k, o in zip(order, out)}


def held_out_scores(df: DataFrame, models: Mapping[int | None, Logit], fold: str, name: str = "score") -> DataFrame:
    """Every row with the score of the model that has not seen its fold; NULL where a feature is missing."""
    out = F.lit(None).cast("double")
    for key, model in models.items():
        out = F.when(F.col(fold) == key, model.column()).otherwise(out)
    return df.withColumn(name, out)
