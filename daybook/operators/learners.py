"""Classifiers that MLlib lacks: ridge regression of classes, and gradient boosting of several classes at once."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol, HasLabelCol, HasMaxIter, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasRegParam, HasStepSize,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # tasks need not find this module

#: Rounds of boosting after which the scores of the training rows are kept anew.
KEPT_EACH = 5
#: Rows that a task takes at least while trees grow, as a round is a chain of short jobs.
ROWS = 1 << 15
#: Histograms of so many tasks are summed by the driver, of more by tasks first.
SUMMED = 64
#: Splits whose gains differ by less are equally good, and the first is taken, however the sums were rounded.
EVEN = 1e-9


class _Learner(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasRawPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    def _rows(self, dataset: DataFrame) -> DataFrame:
        """Features as an array and the class code."""
        return dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("int").alias("y"))

    def _counts(self, dataset: DataFrame) -> np.ndarray:
        """Rows per class code, from 0 to the greatest."""
        found = dataset.groupBy(F.col(self.getLabelCol()).cast("double").alias("y")).agg(F.count(F.lit(1)).alias("n")).collect()
        if not found or any(r["y"] is None or r["y"] < 0 or r["y"] != int(r["y"]) for r in found):
            raise ValueError(f"classes must be numbered 0, 1, 2, ...; found {sorted({str(r['y']) for r in found})[:10]}")
        counts = np.zeros(1 + int(max(r["y"] for r in found)))
        counts[[int(r["y"]) for r in found]] = [r["n"] for r in found]
        return counts


def _arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        if batch.num_rows:
            x, y = (batch.column(i) for i in range(2))
            yield x.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1), y.to_numpy(zero_copy_only=False)


def _largest(scores: Column) -> Column:
    """Position of the greatest entry from 0, the first on a tie."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("double")


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Rows, means and sums of products around the means of two sets of rows together."""
    if a is None:
        return b
    n, apart = a[0] + b[0], b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)


class RidgeClassifier(Estimator, _Learner, HasRegParam):
    """Least squares with a penalty on the squared coefficients: each class against the rest as 1 against -1, the greatest value wins.

    One pass adds up products of the centred columns; the equations of the columns are solved for all classes at once. The intercept has no penalty.
    """

    def __init__(self, regParam: float = 1.0):
        super().__init__()
        self._set(regParam=regParam)

    def _fit(self, dataset: DataFrame) -> RidgeModel:
        classes = len(self._counts(dataset))

        def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = None
            for x, y in _arrays(batches):
                z = np.hstack([x, 2.0 * (y[:, None] == np.arange(classes)) - 1])
                centred = z - z.mean(0)
                total = _merged(total, (len(z), z.mean(0), centred.T @ centred))
            if total:
                yield pa.RecordBatch.from_pylist([{"n": total[0], "mean": total[1].tolist(), "products": total[2].ravel().tolist()}])

        total = None
        for part in self._rows(dataset).mapInArrow(moments, "n long, mean array<double>, products array<double>").collect():
            mean = np.array(part["mean"])
            total = _merged(total, (part["n"], mean, np.array(part["products"]).reshape(len(mean), -1)))
        _, mean, products = total
        width = len(mean) - classes
        weights = np.linalg.solve(products[:width, :width] + self.getRegParam() * np.eye(width), products[:width, width:])
        model = RidgeModel()._set(coefficients=weights.T.tolist(), intercepts=(mean[width:] - mean[:width] @ weights).tolist())
        return self._copyValues(model)


class RidgeModel(Model, _Learner, HasRegParam):
    coefficients = Param(Params._dummy(), "coefficients", "coefficients of each class", TypeConverters.identity)
    intercepts = Param(Params._dummy(), "intercepts", "intercept of each class", TypeConverters.toListFloat)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        x = vector_to_array(F.col(self.getFeaturesCol()))

        def value(weights: list[float], intercept: float) -> Column:
            products = F.zip_with(x, F.array(*[F.lit(w) for w in weights]), lambda a, w: a * w)
            return F.aggregate(products, F.lit(intercept), lambda total, p: total + p)

        values = F.array(*[value(w, b) for w, b in zip(self.getOrDefault("coefficients"), self.getOrDefault("intercepts"))])
        raw = self.getRawPredictionCol()
        scored = dataset.withColumn(raw, array_to_vector(values))
        return scored.withColumn(self.getPredictionCol(), _largest(vector_to_array(F.col(raw))))


def _shares(scores: np.ndarray) -> np.ndarray:
    """Probabilities of the classes (rows) from their scores."""
    grown = np.exp(scores - scores.max(0))
    return grown / grown.sum(0)


def _leaves(columns: np.ndarray, features: np.ndarray, limits: np.ndarray, depth: int) -> np.ndarray:
    """Number of the node that each row reaches at ``depth`` of a tree: to the right where its value is above the node's limit."""
    node = np.zeros(columns.shape[1], dtype=np.min_scalar_type(2**depth))
    for level in range(depth):
        right = np.zeros(len(node), dtype=bool)
        for j in range(2**level):
            at = 2**level - 1 + j
            right |= (node == j) & (columns[features[at]] > limits[at])
        node = 2 * node + right
    return node


def _summed(parts: RDD) -> np.ndarray:
    return parts.treeReduce(lambda a, b: a + b) if parts.getNumPartitions() > SUMMED else sum(parts.collect())


class GradientBoostingClassifier(Estimator, _Learner, HasProbabilityCol, HasMaxIter, HasStepSize):
    """Boosted trees of all classes: in each round one regression tree per class on what its probability lacks, the probabilities adding up to 1.

    Splits bring the squared means of two sides farthest apart, at one of ``maxBins`` quantiles of all rows; a leaf takes one Newton step of the
    multinomial loss. The trees of a round grow together, a pass over the rows per level, and tasks return sums per bin only.
    """

    maxDepth = Param(Params._dummy(), "maxDepth", "depth of the trees", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)

    def __init__(self, maxIter: int = 100, maxDepth: int = 3, stepSize: float = 0.1, maxBins: int = 256):
        super().__init__()
        self._set(maxIter=maxIter, maxDepth=maxDepth, stepSize=stepSize, maxBins=maxBins)

    def _edges(self, rows: DataFrame) -> list[np.ndarray]:
        """Limits between the bins of each feature, halfway between neighbouring quantiles."""
        bins, width = min(256, self.getOrDefault("maxBins")), len(rows.first()["x"])
        at = F.array(*[F.lit(i / (bins - 1)) for i in range(bins)])
        found = rows.agg(*[F.percentile_approx(F.col("x")[i], at, 100 * bins).alias(f"q{i}") for i in range(width)]).first()
        quantiles = [np.unique(np.array(q)) for q in found]
        return [(q[:-1] + q[1:]) / 2 for q in quantiles]

    def _fit(self, dataset: DataFrame) -> GradientBoostingModel:
        counts = self._counts(dataset)
        present = np.flatnonzero(counts)
        start = np.log(counts[present] / counts.sum())
        rows = self._rows(dataset)
        edges = self._edges(rows)
        rate, depth = self.getStepSize(), self.getOrDefault("maxDepth")

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = [(np.array([np.searchsorted(e, v) for e, v in zip(edges, x.T)], dtype=np.uint8), np.searchsorted(present, y))
                     for x, y in _arrays(batches)]
            if parts:
                columns, labels = (np.concatenate(p, axis=-1) for p in zip(*parts))
                yield pa.RecordBatch.from_pylist([{"columns": columns.tobytes(), "labels": labels.astype(np.int32).tobytes()}])

        def begun(row) -> tuple:
            labels = np.frombuffer(row["labels"], dtype=np.int32)
            columns = np.frombuffer(row["columns"], dtype=np.uint8).reshape(len(edges), len(labels))
            return columns, labels, np.repeat(start[:, None], len(labels), axis=1)

        states = rows.mapInArrow(binned, "columns binary, labels binary").rdd.map(begun)
        kept = first = states.coalesce(int(np.ceil(counts.sum() / ROWS))).persist(StorageLevel.MEMORY_AND_DISK)
        trees = []
        try:
            for done in range(self.getMaxIter()):
                last = kept
                if done and done % KEPT_EACH == 0:  # from the first scores, so that no chain of tables grows
                    kept = first.map(_advancing(trees[:], rate, depth)).persist(StorageLevel.MEMORY_AND_DISK)
                trees.append(_grow(kept, trees[done // KEPT_EACH * KEPT_EACH:], rate, depth, [len(e) + 1 for e in edges], len(present)))
                if last is not kept and last is not first:
                    last.unpersist()
        finally:
            kept.unpersist()
            first.unpersist()
        # limits as values of the features; a node that does not split leaves all rows on its left
        limits = [[[float(edges[f][b]) if b < len(edges[f]) else float("inf") for f, b in zip(fs, bs)] for fs, bs in zip(features, splits)]
                  for features, splits, _ in trees]
        model = GradientBoostingModel()._set(
            classes=present.tolist(), start=start.tolist(), features=[t[0].tolist() for t in trees], limits=limits, values=[t[2].tolist() for t in trees],
        )
        return self._copyValues(model)


def _advancing(trees: list[tuple], rate: float, depth: int):
    def advanced(state: tuple) -> tuple:
        columns, labels, scores = state
        scores = scores.copy()
        for features, splits, values in trees:
            for k in range(len(scores)):
                scores[k] += rate * values[k][_leaves(columns, features[k], splits[k], depth)]
        return columns, labels, scores

    return advanced


def _grow(kept: RDD, before: list[tuple], rate: float, depth: int, bins: list[int], classes: int) -> tuple:
    """(features, splits, values) of a round's trees, one per class; ``before`` are the rounds that the kept scores lack."""
    first = np.concatenate([[0], np.cumsum(bins)])
    advanced = _advancing(before, rate, depth)
    features, splits = np.zeros((classes, 2**depth - 1), dtype=np.int64), np.full((classes, 2**depth - 1), 255)

    def histograms(states: Iterator[tuple], level: int, measures: int) -> Iterator[np.ndarray]:
        """Per class, node and bin: rows, sum of residuals and, if wanted, of the loss's second derivatives."""
        size = 2**level * first[-1]
        out = np.zeros((measures, classes, size))
        for columns, labels, scores in map(advanced, states):
            lacking = (labels == np.arange(classes)[:, None]) - _shares(scores)
            curved = np.abs(lacking) * (1 - np.abs(lacking))
            for k in range(classes):
                node = _leaves(columns, features[k], splits[k], level) * np.int64(first[-1])
                for f, column in enumerate(columns):
                    at = node + (column + first[f])
                    for m, weights in enumerate((None, lacking[k], curved[k])[:measures]):
                        out[m, k] += np.bincount(at, weights, size)
        yield out.reshape(measures, classes, 2**level, first[-1])

    for level in range(depth):
        measures = 3 if level == depth - 1 else 2
        sums = _summed(kept.mapPartitions(lambda states, level=level, measures=measures: histograms(states, level, measures)))
        best = np.full((classes, 2**level), 1e-15)
        left = sums[..., first[0]:first[1]].sum(-1)  # all rows, where nothing parts them
        whole, nodes = left.copy(), slice(2**level - 1, 2 ** (level + 1) - 1)
        for f in range(len(bins)):
            upto = sums[..., first[f]:first[f + 1]].cumsum(-1)
            rest = whole[..., None] - upto
            with np.errstate(divide="ignore", invalid="ignore"):
                gains = upto[0] * rest[0] / (upto[0] + rest[0]) * (upto[1] / upto[0] - rest[1] / rest[0]) ** 2
            gains = np.where((upto[0] > 0) & (rest[0] > 0), gains, 0.0)
            at = (gains >= gains.max(-1, keepdims=True) * (1 - EVEN)).argmax(-1)
            gain = np.take_along_axis(gains, at[..., None], -1)[..., 0]
            better = gain > best * (1 + EVEN)
            best = np.where(better, gain, best)
            features[:, nodes] = np.where(better, f, features[:, nodes])
            splits[:, nodes] = np.where(better, at, splits[:, nodes])
            left = np.where(better, np.take_along_axis(upto, at[None, ..., None], -1)[..., 0], left)
    sides = np.stack([left, whole - left], axis=-1).reshape(3, classes, -1)
    with np.errstate(divide="ignore", invalid="ignore"):
        steps = (classes - 1) / classes * sides[1] / sides[2]
    return features, splits, np.where(np.abs(sides[2]) < 1e-150, 0.0, steps)


class GradientBoostingModel(Model, _Learner, HasProbabilityCol, HasMaxIter, HasStepSize):
    maxDepth = Param(Params._dummy(), "maxDepth", "depth of the trees", TypeConverters.toInt)
    maxBins = Param(Params._dummy(), "maxBins", "bins of a feature, 256 at most", TypeConverters.toInt)
    classes = Param(Params._dummy(), "classes", "class codes that occur", TypeConverters.toListInt)
    start = Param(Params._dummy(), "start", "score of each of these classes without trees", TypeConverters.toListFloat)
    features = Param(Params._dummy(), "features", "feature of each node, by round and class", TypeConverters.identity)
    limits = Param(Params._dummy(), "limits", "value above which rows go right, by round and class", TypeConverters.identity)
    values = Param(Params._dummy(), "values", "value of each leaf, by round and class", TypeConverters.identity)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        start, classes, rate, depth = (self.getOrDefault(p) for p in ("start", "classes", "stepSize", "maxDepth"))
        trees = [tuple(np.array(part) for part in tree) for tree in zip(*(self.getOrDefault(p) for p in ("features", "limits", "values")))]

        @F.pandas_udf("array<double>")
        def scored(features: pd.Series) -> pd.Series:
            columns = np.stack(features.to_numpy()).T if len(features) else np.zeros((0, 0))
            scores = np.full((max(classes) + 1, columns.shape[1]), -np.inf)
            found = np.repeat(np.array(start)[:, None], columns.shape[1], axis=1)
            scores[classes] = _advancing(trees, rate, depth)((columns, None, found))[2]
            return pd.Series(list(scores.T))

        raw, probability = self.getRawPredictionCol(), self.getProbabilityCol()
        scores = dataset.withColumn(raw, array_to_vector(scored(vector_to_array(F.col(self.getFeaturesCol())))))
        apart = F.transform(vector_to_array(F.col(raw)), lambda v: F.exp(v - F.array_max(vector_to_array(F.col(raw)))))
        total = F.aggregate(apart, F.lit(0.0), lambda a, v: a + v)
        return scores.withColumns({
            probability: array_to_vector(F.transform(apart, lambda v: v / total)),
            self.getPredictionCol(): _largest(vector_to_array(F.col(raw))),
        })
