"""Many logistic regressions from the same passes over one table.

A search fits the same rows again and again: other folds, class weights, penalties and feature lists. Here all of them
are fitted together by Newton steps. One pass computes, for every model at once, the gradient and the matrix of second
derivatives: with K the products of pairs of columns, the matrices of all models are one product K' W, where W holds the
weight of each row in each model (zero in a held-out fold). Tasks add up their blocks, models are dealt to reduce tasks
that add up the tasks, and one small row a model reaches the driver. The data are neither copied nor reordered, and a
model that has converged takes no more part.

The loss is that of Spark ML without standardisation: the weighted mean of the log loss and ``penalty / 2`` times the
squared coefficients (not the intercept). A step that does not lower the loss is halved. Features left out of a model
keep a coefficient of zero.

Defined results: rows with a null label or feature take no part; a model whose rows all have one label, or that has no
row, gets null coefficients and a null score.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.small import any_null

LABEL = "is_fraud"
BLOCK_ROWS = 4096
MOST_STEPS = 60


@dataclass(frozen=True)
class Fit:
    """What one model is fitted on. ``penalty`` may instead be given as ``c``, its inverse times the sum of weights."""

    name: str
    features: tuple[str, ...]
    positive_weight: float = 1.0
    penalty: float | None = None
    c: float | None = None
    held_out: int | None = None


@dataclass
class _State:
    fit: Fit
    used: np.ndarray
    at: np.ndarray
    before: np.ndarray | None = None
    loss: float = np.inf
    steps: int = 0
    done: bool = False
    result: np.ndarray | None = field(default=None)


@dataclass(frozen=True)
class Fitted:
    fit: Fit
    intercept: float | None
    coefficients: dict[str, float] | None
    steps: int


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(columns with a leading one, labels, folds) of a block of rows."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            columns = [np.asarray(c, dtype=float) for c in batch.columns]
            yield np.column_stack([np.ones(batch.num_rows), *columns[2:]]), columns[0], columns[1]


def _slim(df: DataFrame, columns: list[str]) -> DataFrame:
    fold = F.col("fold") if "fold" in df.columns else F.lit(-1)
    known = df.where(~any_null([LABEL, *columns]))
    return known.select(F.col(LABEL).cast("double"), fold.cast("double").alias("fold"), *[F.col(c).cast("double") for c in columns])


def _weights(fits: list[Fit], labels: np.ndarray, folds: np.ndarray) -> np.ndarray:
    """Rows by models."""
    weight = np.array([f.positive_weight for f in fits])
    held = np.array([np.nan if f.held_out is None else f.held_out for f in fits])
    return np.where(labels[:, None] == 1, weight, 1.0) * (folds[:, None] != held)


def summed(
    rows: DataFrame, shape: tuple[int, int], work: Callable[[Iterator[pa.RecordBatch]], np.ndarray]
) -> np.ndarray:
    """The sum over all tasks of ``work``, an array of ``shape`` with a row for each model."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = work(batches)
        yield pa.RecordBatch.from_pydict({"model": np.arange(shape[0]), "sums": [r.tobytes() for r in found]})

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            for model, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held = np.frombuffer(sums)
                totals[model] = totals[model] + held if model in totals else held
        yield pa.RecordBatch.from_pydict(
            {"model": pa.array(list(totals), pa.int64()), "sums": pa.array([t.tobytes() for t in totals.values()], pa.binary())}
        )

    schema = "model long, sums binary"
    found = rows.mapInArrow(partial, schema).repartition("model").mapInArrow(added, schema).collect()
    out = np.zeros(shape)
    for row in found:
        out[row["model"]] = np.frombuffer(row["sums"])
    return out


def _step(state: _State, sums: np.ndarray, width: int, pairs: tuple[np.ndarray, np.ndarray], tolerance: float) -> None:
    """Move one model by what a pass has summed: weights, positives, loss, gradient, second derivatives."""
    total, positive, loss = sums[:3]
    gradient, second = sums[3 : 3 + width], np.zeros((width, width))
    second[pairs] = sums[3 + width :]
    second.T[pairs] = sums[3 + width :]
    if positive <= 0 or positive >= total:
        state.done = True
        return
    fit = state.fit
    penalty = fit.penalty if fit.c is None else 1 / (fit.c * total)
    ridge = np.full(width, penalty or 0.0)
    ridge[0] = 0.0
    loss = loss / total + (ridge * state.at**2).sum() / 2
    state.steps += 1
    if state.before is not None and not loss <= state.loss + 1e-15 and state.steps < MOST_STEPS:
        state.at = (state.at + state.before) / 2
        return
    slope = (gradient / total + ridge * state.at)[state.used]
    state.loss, state.before, state.result = loss, state.at, state.at
    if np.abs(slope).max() < tolerance or state.steps >= MOST_STEPS:
        state.done = True
        return
    curve = (second / total + np.diag(ridge))[np.ix_(state.used, state.used)]
    moved = np.zeros(width)
    moved[state.used] = np.linalg.lstsq(curve, slope, rcond=None)[0]
    state.at = state.at - moved


def fit_all(df: DataFrame, fits: list[Fit], tolerance: float = 1e-10) -> list[Fitted]:
    """All fits over one table, with a column ``fold`` where a fit holds one out. The table should be a written one."""
    columns = sorted({c for f in fits for c in f.features})
    width = len(columns) + 1
    pairs = np.triu_indices(width)
    states = []
    for fit in fits:
        used = np.array([0, *[1 + columns.index(c) for c in sorted(fit.features)]])
        states.append(_State(fit, used, np.zeros(width)))
    rows = _slim(df, columns)
    while active := [s for s in states if not s.done]:
        some, at = [s.fit for s in active], np.column_stack([s.at for s in active])
        shape = (len(active), 3 + width + len(pairs[0]))

        def work(batches, some=some, at=at, shape=shape):
            out = np.zeros(shape)
            for x, labels, folds in _blocks(batches):
                weight = _weights(some, labels, folds)
                margin = x @ at
                p = 1 / (1 + np.exp(-np.clip(margin, -500, 500)))
                out[:, 0] += weight.sum(axis=0)
                out[:, 1] += labels @ weight
                out[:, 2] += (weight * (np.logaddexp(0, margin) - labels[:, None] * margin)).sum(axis=0)
                out[:, 3 : 3 + width] += (weight * (p - labels[:, None])).T @ x
                out[:, 3 + width :] += (weight * p * (1 - p)).T @ (x[:, pairs[0]] * x[:, pairs[1]])
            return out

        for state, sums in zip(active, summed(rows, shape, work), strict=True):
            _step(state, sums, width, pairs, tolerance)
    out = []
    for state in states:
        if state.result is None:
            out.append(Fitted(state.fit, None, None, state.steps))
            continue
        named = {c: float(state.result[1 + columns.index(c)]) for c in state.fit.features}
        out.append(Fitted(state.fit, float(state.result[0]), named, state.steps))
    return out


def held_out_counts(df: DataFrame, fitted: list[Fitted], threshold: float = 0.5) -> list[dict]:
    """tp, fp, fn, tn of each model on its held-out fold (on all rows, if it holds none out), from one pass."""
    columns = sorted({c for f in fitted for c in f.fit.features})
    at = np.array([[f.intercept or 0.0, *[(f.coefficients or {}).get(c, 0.0) for c in columns]] for f in fitted]).T
    limit = np.log(threshold / (1 - threshold))

    def work(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((len(fitted), 4))
        for x, labels, folds in _blocks(batches):
            inside = np.column_stack([(folds == f.fit.held_out) if f.fit.held_out is not None else np.ones(len(x), bool) for f in fitted])
            above, positive = x @ at >= limit, labels[:, None] == 1
            for i, cell in enumerate((above & positive, above & ~positive, ~above & positive, ~above & ~positive)):
                out[:, i] += (cell & inside).sum(axis=0)
        return out

    return [dict(zip(("tp", "fp", "fn", "tn"), map(int, r), strict=True)) for r in summed(_slim(df, columns), (len(fitted), 4), work)]


def with_scores(df: DataFrame, fitted: Fitted, name: str = "score") -> DataFrame:
    """Add the probability of the positive class."""
    if fitted.coefficients is None:
        return df.withColumn(name, F.lit(None).cast("double"))
    margin = F.lit(fitted.intercept)
    for column, value in fitted.coefficients.items():
        margin = margin + F.lit(value) * F.col(column)
    return df.withColumn(name, 1 / (1 + F.exp(-margin)))


def grid_search(df: DataFrame, features: list[str], cs: list[float], weights: list[float], folds: int) -> tuple[list[dict], Fitted]:
    """Every (c, positive weight) with its recall on held-out folds, and the best one fitted on all rows.

    ``df`` has a column ``fold`` from 0. The first trial wins a tie. All fits, the final ones of every trial included,
    share their passes.
    """
    trials = [{"c": c, "positive_weight": w} for c in cs for w in weights]
    fits = [
        Fit(f"{i}", tuple(features), t["positive_weight"], c=t["c"], held_out=k)
        for i, t in enumerate(trials)
        for k in [*range(folds), None]
    ]
    fitted = fit_all(df, fits)
    counts = held_out_counts(df, [f for f in fitted if f.fit.held_out is not None])
    out = []
    for i, trial in enumerate(trials):
        found = counts[i * folds : (i + 1) * folds]
        recalls = [c["tp"] / (c["tp"] + c["fn"]) for c in found if c["tp"] + c["fn"]]
        precisions = [c["tp"] / (c["tp"] + c["fp"]) for c in found if c["tp"] + c["fp"]]
        means = [float(np.mean(x)) if x else None for x in (recalls, precisions)]
        out.append({"trial": i, **trial, "mean_recall": means[0], "mean_precision": means[1]})
    best = max(out, key=lambda r: (-1.0 if r["mean_recall"] is None else r["mean_recall"], -r["trial"]))
    final = [f for f in fitted if f.fit.held_out is None]
    return out, final[best["trial"]]
