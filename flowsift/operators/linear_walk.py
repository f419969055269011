"""Linear SVMs over several classes, all fitted in shared passes.

Rows are held in blocks, in an order that their content decides. One pass over the blocks gives losses and
gradients of all models, which walk as those of the grid search do (`kernel_grid.Descent`). A model
takes the side of each class: +1, -1, or none for classes that it leaves out. A table of up to START_CELLS cells
is walked over by one task per model. In a larger one walks start from a sample of so many cells, go on over samples
GROWTH times as large, and end over all rows, which alone decide where.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsift.operators.kernel_grid import GROWTH, Descent, hinge, told

#: Half the width of the hinge's rounded corner; the rows are few numbers each, so it can be narrow.
SMOOTH = 0.002
BLOCK_ROWS = 4096
#: Cells, about, that a task fits a model on by itself.
START_CELLS = 4_000_000
BLOCKS = "x binary, label binary, weight binary, draw double"


def class_blocks(data: DataFrame, features: list[str], label: str, weight: str, tasks: int) -> DataFrame:
    """Rows packed in blocks: vectors, classes and weights, with `draw`, a number from 0 to 1 that the
    block's rows decide. A hash of the content shares rows out and orders them, so a block is a random sample."""

    def run(batches):
        for batch in batches:
            values = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(features))])
            if not np.isfinite(values).all():
                raise ValueError("a training row has no finite number for a feature")
            classes, weights = (batch.column(len(features) + i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for start in range(0, len(values), BLOCK_ROWS):
                own = slice(start, start + BLOCK_ROWS)
                x = np.ascontiguousarray(values[own], float).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x], pa.binary()), pa.array([classes[own].astype(np.int32).tobytes()], pa.binary()),
                     pa.array([weights[own].astype(float).tobytes()], pa.binary()),
                     pa.array([zlib.crc32(x) / 2**32])],
                    names=["x", "label", "weight", "draw"])

    cols = [F.col(f"`{f}`").cast("double") for f in features]
    order = F.xxhash64(*cols, F.col(label))
    rows = data.select(*cols, F.col(label).cast("int"), F.col(weight).cast("double"), order.alias("_order"))
    return rows.repartition(tasks, "_order").sortWithinPartitions("_order").mapInArrow(run, BLOCKS)


def _measured(row: dict, models: list[dict[int, int]], points: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """Loss, gradient and weight of a block's rows for every model that has a point."""
    classes = np.frombuffer(row["label"], np.int32)
    weight = np.frombuffer(row["weight"], float)
    x = np.frombuffer(row["x"], float).reshape(len(classes), -1)
    sums = {m: np.zeros(x.shape[1] + 3) for m in points}
    for c in np.unique(classes):
        own = classes == c
        z, w = x[own], weight[own]
        takes = [m for m in points if models[m].get(int(c))]
        if not takes:
            continue
        # Turned over, a model that has the class on its other side sees it as its own.
        side = np.array([float(models[m][int(c)]) for m in takes])[:, None]
        loss, slope = hinge(z, np.ones(len(z)), w, side * np.array([points[m] for m in takes]), SMOOTH)
        for m, one, g in zip(takes, loss, side * slope):
            sums[m] += np.concatenate(([one], g, [w.sum()]))
    return sums


def _told(walk: Descent, at: np.ndarray, got: np.ndarray, C: float, weight: float) -> None:
    """Hand a walk its objective; rows that were taken stand for all."""
    told(walk, at, got[:-1] * (weight / max(got[-1], 1e-12)), C, weight)


def _starts(
    blocks: DataFrame, models: list[dict[int, int]], size: int, C: float, weights: list[float], max_iter: int, tol: float
) -> dict[int, Descent]:
    """Models of the rows of the given blocks, START_CELLS about, in one job with a task per model."""

    def run(table: pa.Table) -> pa.Table:
        m = table.column("model")[0].as_py()
        rows = table.select(["x", "label", "weight"]).to_pylist()
        walk = Descent(size, max_iter, tol)
        while not walk.done:
            at = walk.point()
            _told(walk, at, sum(_measured(r, models, {m: at})[m] for r in rows), C, weights[m])
        return pa.table({"model": pa.array([m], pa.int32()), "walk": pa.array([pickle.dumps(walk)], pa.binary())})

    each = blocks.withColumn("model", F.explode(F.array(*[F.lit(m) for m in range(len(models))])))
    found = each.repartitionByRange(len(models), "model").groupBy("model").applyInArrow(run, "model int, walk binary")
    return {r["model"]: pickle.loads(r["walk"]) for r in found.collect()}


def _pass(blocks: DataFrame, models: list[dict[int, int]], points: dict[int, np.ndarray]) -> dict[int, np.ndarray]:
    """One pass: the sums of all blocks, of which every task sends its own."""

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row in batch.to_pylist():
                for m, got in _measured(row, models, points).items():
                    total[m] = total[m] + got if m in total else got
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(total)], pa.binary())], names=["sums"])

    parts = [pickle.loads(r["sums"]) for r in blocks.mapInArrow(run, "sums binary").collect()]
    return {m: sum(p[m] for p in parts if m in p) for m in points}


def fit_linear(
    blocks: DataFrame, n: int, models: list[dict[int, int]], weights: list[float], width: int, C: float,
    max_iter: int, tol: float,
) -> list[Descent]:
    """A model per entry of `models` (class -> side): |w|^2 / 2 + C * sum(weight * hinge) over the rows of
    its classes, divided by C and their weight, which `weights` gives. `n` rows of `width` features."""
    if not models:
        return []
    share = START_CELLS / max(n * width, 1)
    walks = _starts(blocks.where(F.col("draw") < share), models, width + 1, C, weights, max_iter, tol)
    while share < 1 or len(walks) < len(models):
        share *= GROWTH
        begun = {m: (w.x, w.pairs) for m, w in walks.items()}
        walks = {m: Descent(width + 1, max_iter, tol, *begun.get(m, ())) for m in range(len(models))}
        part = blocks.where(F.col("draw") < share) if share < 1 else blocks
        while points := {m: w.point() for m, w in walks.items() if not w.done}:
            sums = _pass(part, models, points)
            for m, at in points.items():
                _told(walks[m], at, sums[m], C, weights[m])
    return [walks[m] for m in range(len(models))]
