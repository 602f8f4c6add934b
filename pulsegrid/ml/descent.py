"""Linear models by gradient descent with a step size, a loss and an updater.

Round ``t`` moves against the mean gradient by ``step / sqrt(t)``. The updater then shrinks the
weights: not at all, towards zero by a fixed amount and never across it (L1), or in proportion (L2).
All models of a sweep are trained side by side: a round is one pass over the points and one sum of
their gradients, however many settings there are.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.ml.blocks import Block, sum_blocks
from pulsegrid.operators.aggregates import hard_label_metrics

LOSSES = ("squared", "logistic", "hinge")
UPDATERS = ("none", "l1", "l2")


@dataclass(frozen=True)
class Setting:
    """What one model of a sweep does differently."""

    loss: str = "logistic"
    updater: str = "none"
    step: float = 1.0
    reg: float = 0.0

    def __post_init__(self) -> None:
        if self.loss not in LOSSES or self.updater not in UPDATERS:
            raise ValueError(f"loss is one of {LOSSES}, updater one of {UPDATERS}")


@dataclass
class Descent:
    """Weights by model name, and per round the mean loss (with penalty) that each model had before it."""

    settings: dict[str, Setting]
    weights: dict[str, np.ndarray]
    losses: list[dict[str, float]] = field(default_factory=list)


def _factors(margins: np.ndarray, labels: np.ndarray, losses: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Per row and model: the factor of the row in the gradient, and its loss."""
    factor, loss = np.empty_like(margins), np.empty_like(margins)
    for m, name in enumerate(losses):
        z = margins[:, m]
        if name == "squared":
            factor[:, m], loss[:, m] = z - labels, (z - labels) ** 2 / 2
        elif name == "logistic":
            p = 1 / (1 + np.exp(-np.clip(z, -700, 700)))
            factor[:, m], loss[:, m] = p - labels, np.logaddexp(0, z) - labels * z
        else:
            side = 2 * labels - 1
            short = 1 - side * z
            factor[:, m], loss[:, m] = np.where(short > 0, -side, 0.0), np.maximum(short, 0.0)
    return factor, loss


def _penalty(setting: Setting, w: np.ndarray) -> float:
    return {"none": 0.0, "l1": setting.reg * np.abs(w).sum(), "l2": setting.reg * (w @ w) / 2}[setting.updater]


def _updated(setting: Setting, w: np.ndarray, gradient: np.ndarray, t: int) -> np.ndarray:
    rate = setting.step / t**0.5
    if setting.updater == "l1":
        moved = w - rate * gradient
        return np.sign(moved) * np.maximum(np.abs(moved) - rate * setting.reg, 0.0)
    kept = 1 - rate * setting.reg if setting.updater == "l2" else 1.0
    return kept * w - rate * gradient


def descend(
    points: DataFrame, settings: Mapping[str, Setting], width: int, rounds: int, fraction: float = 1.0,
    tolerance: float = 0.0, seed: int = 1, start: Mapping[str, np.ndarray] | None = None,
) -> Descent:
    """Train on ``label`` and ``features`` (see :mod:`pulsegrid.ml.blocks`).

    ``fraction`` of the points, another sample each round, make the gradient. Rounds end early when
    no weights move by more than ``tolerance`` of their length. Persist the points before.
    """
    names = list(settings)
    chosen = [settings[n] for n in names]
    weights = np.stack([np.zeros(width) if start is None else np.asarray(start[n], float) for n in names])
    losses: list[dict[str, float]] = []
    for t in range(1, rounds + 1):
        current = weights
        part = points if fraction >= 1 else points.sample(fraction, seed + t)

        def gradient(batch: pa.RecordBatch) -> np.ndarray:
            block = Block(batch.column("features"), width)
            labels = batch.column("label").to_numpy(zero_copy_only=False)
            factor, loss = _factors(block.times(current), labels, [s.loss for s in chosen])  # noqa: B023
            return np.concatenate((block.weighted(factor).ravel(), loss.sum(0), [len(labels)]))

        sums = sum_blocks(part.select("label", "features"), gradient)
        if sums is None:  # an empty sample moves nothing
            continue
        n = round(sums[-1])
        gradients = sums[: -1 - len(names)].reshape(len(names), width) / n
        losses.append({m: float(v / n + _penalty(s, w)) for m, v, s, w in zip(names, sums[-1 - len(names) : -1], chosen, weights)})
        weights = np.stack([_updated(s, w, g, t) for s, w, g in zip(chosen, weights, gradients)])
        moved = np.linalg.norm(weights - current, axis=1)
        if tolerance and (moved < tolerance * np.maximum(np.linalg.norm(weights, axis=1), 1)).all():
            break
    return Descent(dict(settings), dict(zip(names, weights)), losses)


def weight_rows(spark, found: Descent) -> DataFrame:
    """``model``, ``pos`` and ``weight``."""
    rows = [(m, i, float(x)) for m, w in found.weights.items() for i, x in enumerate(w)]
    return spark.createDataFrame(rows, "model string, pos int, weight double")


def scored(points: DataFrame, found: Descent) -> DataFrame:
    """A row per point and model: ``model``, ``label``, ``margin``, and ``prediction`` (the margin, or 0/1 for a classifier)."""
    names = list(found.weights)
    weights = np.stack([found.weights[m] for m in names])
    hard = np.array([found.settings[m].loss != "squared" for m in names])

    def run(batches):
        for batch in batches:
            margins = Block(batch.column("features"), weights.shape[1]).times(weights)
            said = np.where(hard, (margins > 0).astype(float), margins)
            yield pa.RecordBatch.from_pydict(
                {
                    "model": pa.array(np.tile(np.array(names, object), batch.num_rows), pa.string()),
                    "label": pa.array(np.repeat(batch.column("label").to_numpy(zero_copy_only=False), len(names))),
                    "margin": pa.array(margins.ravel()),
                    "prediction": pa.array(said.ravel()),
                }
            )

    return points.select("label", "features").mapInArrow(run, "model string, label double, margin double, prediction double")


def sweep_report(test: DataFrame, found: Descent) -> DataFrame:
    """Confusion counts, accuracy and areas of every classifier of a sweep: one pass over the test rows."""
    return hard_label_metrics(scored(test, found), "label", "prediction", ["model"])
