"""Multinomial regression over sparse vectors, by L-BFGS on scaled coefficients.

MLlib divides every feature by its deviation before it searches. With a penalty on the
coefficients as they are, that makes rare terms so stiff that a thousand passes don't reach
the minimum. Here each coefficient is scaled by the curvature of loss and penalty
together, first where all classes are as likely, then once more after some steps, where most rows
are no longer in doubt; some dozens of passes do. Each pass is one job over persisted blocks of
rows; coefficients and gradients are all that moves.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import DenseMatrix, SparseVector, Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# functions that run in tasks are sent by value: executors need no copy of this module
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Entries and rows of a block; rows of a task while there are few tasks, how many are few, and
# rows of a task beyond; steps remembered, and the sizes of the gradient, next to that at the start, at which
# coefficients are scaled anew and at which the search has arrived.
ENTRIES, ROWS = 1 << 19, 1 << 14
ROWS_PER_TASK, FEW_TASKS, MOST_ROWS_PER_TASK = 5_000, 24, 20_000
MEMORY, SCALED_ANEW, ARRIVED = 10, 0.1, 1e-5
# no curvature counts as less than this share of that at the start
FLAT = 1e-6


#: Rows after another, as (labels, weights, starts, slots, values): entry e is ``values[e]`` in column
#: ``slots[e]``, a row's entries begin at its start and end with a 1 for the intercept.
Block = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]


def blocks(rows: Iterable, width: int) -> Iterator[Block]:
    """``rows`` of (label, weight, vector) in blocks of bounded size."""
    labels, weights, sizes, slots, values, entries = [], [], [], [], [], 0

    def block() -> Block:
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        return np.array(labels, np.int64), np.array(weights), starts, np.concatenate(slots), np.concatenate(values)

    for label, weight, vector in rows:
        if isinstance(vector, SparseVector):
            at, found = vector.indices, vector.values
        else:
            at, found = np.arange(vector.size), vector.toArray()
        labels.append(int(label))
        weights.append(float(weight))
        sizes.append(len(at) + 1)
        slots.append(np.append(at, width).astype(np.int32))
        values.append(np.append(found, 1.0))
        entries += sizes[-1]
        if entries >= ENTRIES or len(sizes) >= ROWS:
            yield block()
            labels, weights, sizes, slots, values, entries = [], [], [], [], [], 0
    if labels:
        yield block()


def margins_of(block: Block, ahead: np.ndarray) -> np.ndarray:
    """Margins of the classes by rows, next to the largest one of each row."""
    labels, _, starts, slots, values = block
    slots, products = slots.astype(np.intp), np.empty(len(slots))
    margins = np.zeros((len(ahead) + 1, len(labels)))
    for own, margin in zip(ahead, margins):
        own.take(slots, out=products, mode="clip")  # other modes go through a buffer
        np.add.reduceat(np.multiply(products, values, out=products), starts, out=margin)
    return margins - margins.max(axis=0)


def column_sums(block: Block, factors: np.ndarray, width: int, squared: bool = False) -> np.ndarray:
    """Each row of ``factors``, a factor per row of the block, by the sums of values, or their squares, in columns."""
    _, _, starts, slots, values = block
    slots, sizes = slots.astype(np.intp), np.diff(np.append(starts, len(slots)))
    values, products = values ** 2 if squared else values, np.empty(len(slots))
    return np.stack([
        np.bincount(slots, np.multiply(np.repeat(own, sizes), values, out=products), width) for own in factors])


def loss(block: Block, ahead: np.ndarray) -> tuple[float, np.ndarray]:
    """Weighted log loss of a block and its gradient, classes by columns and the intercept.

    ``ahead`` is how far the coefficients of all classes but the last are above those of the last; its
    gradient is left out as well, as the gradients of all classes add up to 0.
    """
    labels, weights = block[:2]
    rows, margins = np.arange(len(labels)), margins_of(block, ahead)
    errors = np.exp(margins)
    sums = errors.sum(axis=0)
    value = float(np.dot(weights, np.log(sums) - margins[labels, rows]))
    errors /= sums
    errors[labels, rows] -= 1
    errors *= weights
    return value, column_sums(block, errors[:-1], ahead.shape[1])


def curvature(block: Block, ahead: np.ndarray) -> tuple[np.ndarray]:
    """Second derivatives of a block's loss, each coefficient by itself, of all classes."""
    guess = np.exp(margins_of(block, ahead))
    guess /= guess.sum(axis=0)
    return (column_sums(block, guess * (1 - guess) * block[1], ahead.shape[1], squared=True),)


def squares(block: Block, width: int) -> np.ndarray:
    """Weighted sum of the squares of each column."""
    return column_sums(block, block[1][None], width, squared=True)[0]


def total(parts: RDD, one: Callable[[Block], tuple]) -> tuple:
    """Sum of ``one`` over all blocks, first in each task, then in a tree."""
    def add(a: tuple, b: tuple) -> tuple:
        return tuple(x + y for x, y in zip(a, b))

    def run(found: Iterator[Block]) -> Iterator[tuple]:
        sums = None
        for block in found:
            sums = one(block) if sums is None else add(sums, one(block))
        if sums is not None:
            yield sums

    return parts.mapPartitions(run).treeReduce(add)


def minimize(
    f: Callable[[np.ndarray], tuple[float, np.ndarray]], x: np.ndarray, scale: np.ndarray,
    anew: Callable[[np.ndarray], np.ndarray], most: int,
) -> np.ndarray:
    """Minimum of a convex function that returns value and gradient, by L-BFGS on ``x / scale``.

    ``anew`` returns the scale to go on with, once the gradient is small enough for that. Where the search
    ends is told by the gradient in the first scale.
    """
    value, slope = f(x)
    own, steps, renewed = scale, [], False
    first = np.linalg.norm(slope * scale)
    for _ in range(most):
        size = np.linalg.norm(slope * scale)
        if size <= ARRIVED * first:
            break
        if not renewed and size <= SCALED_ANEW * first:
            own, steps, renewed = anew(x), [], True
        way, marks = -slope * own, []
        for s, y in reversed(steps):
            marks.append(np.vdot(s, way) / np.vdot(s, y))
            way = way - marks[-1] * y
        if steps:
            s, y = steps[-1]
            way = way * (np.vdot(s, y) / np.vdot(y, y))
        for (s, y), mark in zip(steps, reversed(marks)):
            way = way + (mark - np.vdot(y, way) / np.vdot(s, y)) * s
        length, down = 1.0 if steps else min(1.0, 1 / np.linalg.norm(way)), np.vdot(way, slope * own)
        while True:
            there, new_slope = f(x + length * way * own)
            if there <= value + 1e-4 * length * down or length < 1e-10:
                break
            length /= 2
        if there >= value:  # no digits left to gain
            break
        s, y = length * way, (new_slope - slope) * own
        if np.vdot(s, y) > 0:
            steps = [*steps, (s, y)][-MEMORY:]
        x, value, slope = x + s * own, there, new_slope
    return x


def tasks(rows: int) -> int:
    """Tasks of a pass: more of them at first, then larger ones."""
    return max(min(1 + rows // ROWS_PER_TASK, FEW_TASKS), 1 + rows // MOST_ROWS_PER_TASK)


@dataclass
class MultinomialRegression:
    """An estimator of ``label``, ``weight`` and ``features``: mean weighted loss plus ``penalty`` / 2 * |w|^2.

    The intercepts are free of it. Ends where the gradient has all but vanished, or after ``iterations`` steps.
    """

    penalty: float
    iterations: int = 1000

    def model(self, data: DataFrame, **bounds) -> LogisticRegressionModel:
        """MLlib's own; bounds that meet leave it nothing to search."""
        return LogisticRegression(
            family="multinomial", maxIter=0, regParam=self.penalty, standardization=False,
            weightCol="weight", aggregationDepth=3, **bounds).fit(data)

    def search(self, data: DataFrame) -> np.ndarray | None:
        """Classes by columns and the intercept; none if all rows are of one class."""
        rows, last, distinct = data.agg(F.count("*"), F.max("label"), F.count_distinct("label")).first()
        if distinct < 2:
            return None
        classes, width = int(last) + 1, data.select("features").first()[0].size + 1
        source = data.select("label", "weight", "features").rdd
        if source.getNumPartitions() > tasks(rows):
            source = source.coalesce(tasks(rows))
        parts = source.mapPartitions(lambda found: blocks(found, width - 1)).persist(StorageLevel.MEMORY_AND_DISK)
        context = data.sparkSession.sparkContext
        all_, weight = total(parts, lambda block: (squares(block, width), float(block[1].sum())))
        penalties = np.append(np.full(width - 1, self.penalty), 0.0)
        # the curvature where all classes are as likely
        start = (classes - 1) / classes ** 2 * all_ / weight

        def over_rows(one: Callable[[Block, np.ndarray], tuple], x: np.ndarray) -> tuple:
            sent = context.broadcast(x[:-1] - x[-1])
            found = total(parts, lambda block: one(block, sent.value))
            sent.destroy()
            return found

        def f(x: np.ndarray) -> tuple[float, np.ndarray]:
            value, slope = over_rows(loss, x)
            slope = np.concatenate([slope, -slope.sum(axis=0, keepdims=True)])
            return value / weight + float((penalties * x ** 2).sum()) / 2, slope / weight + penalties * x

        def anew(x: np.ndarray) -> np.ndarray:
            # the same scale for all classes, else what is added to all of them, which no row tells, is searched too
            (found,) = over_rows(curvature, x)
            return 1 / np.sqrt(np.maximum(found.max(axis=0) / weight, FLAT * start) + penalties)

        found = minimize(f, np.zeros((classes, width)), 1 / np.sqrt(start + penalties), anew, self.iterations)
        parts.unpersist()
        return found

    def fit(self, data: DataFrame) -> LogisticRegressionModel:
        found = self.search(data)
        if found is None:
            return self.model(data)
        classes, width = found.shape
        matrix = DenseMatrix(classes, width - 1, found[:, :-1].ravel(order="F"))
        starts = Vectors.dense(found[:, -1] - found[:, -1].mean())
        bounds = {
            "lowerBoundsOnCoefficients": matrix, "upperBoundsOnCoefficients": matrix,
            "lowerBoundsOnIntercepts": starts, "upperBoundsOnIntercepts": starts}
        model = self.model(data, **bounds)
        for name in bounds:  # they would be stored with the model
            model.clear(model.getParam(name))
        return model
