"""Exact per-row attribution of tree models (path-dependent Shapley values).

A model is flattened to its paths, one for each leaf of each tree: for every feature on the path the interval of values
that stay on it, and the share of the training rows that stay on it. A row's attribution to a feature on a path is

    value * (o_i - z_i) * integral over t in [0, 1] of the product over the other features j of ((1 - t) * z_j + t * o_j)

where o_j tells whether the row's value lies in the interval and z_j is the share. That is the Shapley sum over all
subsets of the path's features: expanding the product gives each subset the weight |S|! (d - |S| - 1)! / d!. The integrand
is a polynomial, so a Gauss-Legendre rule with half as many points as there are features is exact.

A tree sees of a row only between which of its own cuts each value lies. So a batch of rows is worked on tree by tree, and
rows that a tree cannot tell apart are worked on once. A path sees even less, one bit for each of its features: what it
adds for all patterns of these bits is a small table, as long as the model's tables together stay small (``TABLE_CELLS``);
beyond that the integral is taken for each different row of each tree.

Contributions of a row and the base value add up to the model's raw score: the margin of boosted trees (its probability
is 1 / (1 + exp(-2 * margin))), the probability itself of a forest.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import ensure_checkpoint_dir

# Rows times paths that are worked on at once.
CELLS = 1 << 19
# Numbers in the tables of all paths together (32 MB); more than this, and the integrals are taken row by row.
TABLE_CELLS = 1 << 22


@dataclass(frozen=True)
class Paths:
    """All paths of a model, tree by tree: arrays of (paths, features on the longest path); what a path lacks has share 1,
    feature 0. ``first`` has the place of the first path of each tree."""

    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    first: np.ndarray

    @property
    def base(self) -> float:
        """The mean raw score over the training rows of each tree."""
        return float((self.value * self.share.prod(axis=1)).sum())


def saved_nodes(model: PipelineModel, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted tree model as a table, from its saved form: (tree, weight, nodeData)."""
    path = f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"
    model.stages[-1].write().save(path)
    weights = spark.read.parquet(f"{path}/treesMetadata").toDF("tree", "metadata", "weight").drop("metadata")
    return spark.read.parquet(f"{path}/data").withColumnRenamed("treeID", "tree").join(weights, "tree")


def paths_of(model: PipelineModel, spark: SparkSession) -> Paths:
    """The paths of a boosted or forest model. Its size is that of the model: trees times leaves."""
    forest = "RandomForest" in type(model.stages[-1]).__name__
    nodes = saved_nodes(model, spark).select("tree", "weight", "nodeData.*").collect()
    trees: dict[int, dict] = {}
    for node in nodes:
        trees.setdefault(node["tree"], {})[node["id"]] = node
    found, first = [], []
    for tree in trees.values():
        first.append(len(found))
        stack = [(0, {})]
        while stack:
            place, seen = stack.pop()
            node = tree[place]
            if node["leftChild"] < 0:
                stats = node["impurityStats"]
                value = stats[1] / sum(stats) / len(trees) if forest else node["prediction"] * node["weight"]
                found.append((value, seen))
                continue
            split = node["split"]
            if split["numCategories"] >= 0:
                raise ValueError("splits on categories are not attributed")
            cut, feature = split["leftCategoriesOrThreshold"][0], split["featureIndex"]
            for side, child in enumerate((node["leftChild"], node["rightChild"])):
                low, high, share = seen.get(feature, (-np.inf, np.inf, 1.0))
                low, high = (low, min(high, cut)) if side == 0 else (max(low, cut), high)
                share *= tree[child]["rawCount"] / node["rawCount"]
                stack.append((child, seen | {feature: (low, high, share)}))
    width = max([1, *[len(seen) for _, seen in found]])
    shape = (len(found), width)
    feature, low, high, share = np.zeros(shape, np.int64), np.full(shape, -np.inf), np.full(shape, np.inf), np.ones(shape)
    for i, (_, seen) in enumerate(found):
        for j, (name, span) in enumerate(seen.items()):
            feature[i, j], (low[i, j], high[i, j], share[i, j]) = name, span
    return Paths(np.array([v for v, _ in found]), feature, low, high, share, np.array(first))


def _integrals(inside: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """What each feature of each path adds: ``inside`` tells it of (cases, paths, features on the path)."""
    points, weights = np.polynomial.legendre.leggauss(share.shape[-1] // 2 + 1)
    total = np.zeros(inside.shape)
    for t, w in zip((points + 1) / 2, weights / 2, strict=True):
        away = (1 - t) * share
        factor = np.where(inside, away + t, away)
        total += w * factor.prod(axis=-1, keepdims=True) / factor
    return total * (inside - share) * value[:, None]


class _Tree:
    """The paths of one tree, what tells rows apart for them, and their table of patterns."""

    def __init__(self, paths: Paths, part: slice, tabled: bool):
        self.value, self.feature, self.low, self.high, self.share = (
            a[part] for a in (paths.value, paths.feature, paths.low, paths.high, paths.share)
        )
        self.named, places = np.unique(self.feature, return_inverse=True)
        # Adds up the parts of one feature.
        self.adds = np.eye(len(self.named))[places.ravel()]
        # The limits of each feature: two rows between the same ones are the same to the tree.
        self.cuts = {}
        for f in self.named:
            ends = np.unique(np.concatenate([a[self.feature == f] for a in (self.low, self.high)]))
            self.cuts[f] = ends[np.isfinite(ends)]
        self.table = None
        if tabled:
            width = self.feature.shape[1]
            bits = (np.arange(1 << width)[:, None] >> np.arange(width) & 1).astype(bool)
            self.table = _integrals(np.repeat(bits[:, None], len(self.value), axis=1), self.share, self.value).reshape(-1, width)
            self.weight = len(self.value) << np.arange(width)

    def alike(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A row of each kind that the tree can tell apart, and the kind of every row."""
        sizes = [len(c) + 2 for c in self.cuts.values()]
        if sum(np.log2(sizes)) > 62:
            return np.arange(len(x)), np.arange(len(x))
        code = np.zeros(len(x), np.int64)
        for (f, cuts), size in zip(self.cuts.items(), sizes, strict=True):
            place = np.searchsorted(cuts, x[:, f])
            place[np.isnan(x[:, f])] = size - 1
            code = code * size + place
        _, one, kind = np.unique(code, return_index=True, return_inverse=True)
        return one, kind

    def added(self, x: np.ndarray) -> np.ndarray:
        """Rows by the features of the tree."""
        at = x[:, self.feature]
        inside = (at > self.low) & (at <= self.high)
        if self.table is None:
            parts = _integrals(inside, self.share, self.value)
        else:
            parts = self.table[(inside * self.weight).sum(axis=2) + np.arange(len(self.value))]
        return parts.reshape(len(x), -1) @ self.adds


def trees_of(paths: Paths) -> list[_Tree]:
    """The trees of a model, ready to be asked for many rows."""
    tabled = paths.feature.size << paths.feature.shape[1] <= TABLE_CELLS
    ends = [*paths.first[1:], len(paths.value)]
    return [_Tree(paths, slice(a, b), tabled) for a, b in zip(paths.first, ends, strict=True)]


def contributions(trees: list[_Tree], x: np.ndarray) -> np.ndarray:
    """Rows by features: what each feature adds to the raw score of each row."""
    out = np.zeros_like(x)
    for tree in trees:
        one, kind = tree.alike(x)
        step = max(1, CELLS // len(tree.value))
        added = np.concatenate([tree.added(x[one[at : at + step]]) for at in range(0, len(one), step)] or [np.zeros((0, len(tree.named)))])
        out[:, tree.named] += added[kind]
    return out


def attributions(df: DataFrame, model: PipelineModel, columns: list[str], key: str = "transaction_id") -> DataFrame:
    """key, base_value, raw_score (their sum) and one column of contributions for each feature."""
    paths = df.sparkSession.sparkContext.broadcast(paths_of(model, df.sparkSession))
    rows = df.select(key, *[F.col(c).cast("double").alias(c) for c in columns])
    numbers = [T.StructField(c, T.DoubleType()) for c in ["base_value", "raw_score", *columns]]
    schema = T.StructType([df.schema[key], *numbers])

    def attributed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees = trees_of(paths.value)
        for batch in batches:
            x = np.column_stack([np.asarray(c, dtype=float) for c in batch.columns[1:]])
            found = contributions(trees, x)
            base = np.full(len(x), paths.value.base)
            columns = [batch.column(0), pa.array(base), pa.array(base + found.sum(axis=1))]
            yield pa.RecordBatch.from_arrays([*columns, *[pa.array(c) for c in found.T]], schema.names)

    return rows.mapInArrow(attributed, schema)


def mean_attribution(attributed: DataFrame, columns: list[str]) -> DataFrame:
    """feature, mean_abs, mean: the features by the size of what they add, largest first."""
    entries = [F.struct(F.lit(c).alias("feature"), F.col(c).alias("value")) for c in columns]
    long = attributed.select(F.inline(F.array(*entries)))
    means = long.groupBy("feature").agg(
        F.round(F.avg(F.abs("value")), 9).alias("mean_abs"), F.round(F.avg("value"), 9).alias("mean")
    )
    return means.orderBy(F.desc("mean_abs"), "feature")
