"""Hard negatives by inner product, found in cover trees over norm-augmented candidates.

Components are floored to whole numbers, so scores are exact. With one more component every
candidate gets the length of the longest, and an anchor gets none there: inner products stay, and
on that sphere a node whose rows lie within an angle of its centre bounds the inner products of all
of them from both sides.

The upper level of the tree is a net of rows that lie far apart, from a bounded sample; its cells
take in every row, and their covering angles are those of all their rows. A cell is dealt by hash
into blocks of bounded size, and each block grows the lower levels of its own tree: a node's
children are rows taken farthest first until all others are within the node's angle divided by BASE.

Anchors travel in packs. A pack goes to the blocks of its own cell first, and then to those of the
cells that a window of one of its anchors may still have a better row in. In a block it descends
the levels, drops the nodes that lie outside of all windows or below what is already found, takes
the remaining leaves best bound first and computes their inner products. Positives are found with an
open window; each of them then sets the window of its negatives.

Cases: rows without id or label, without a vector or with a component that is null or not finite
take no part; shorter vectors count as filled up with zeros; an anchor that appears twice is mined
twice, and its copy is another row; ties go to the smaller id; without positives or negatives there
are no rows; an empty table gives none; other columns are left out. Components beyond 64 bits count
as the largest that these hold, and so do scores.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowsift.llm.scratch import land

#: Rows that the upper net is taken from, its cells, rows of a block, anchors of a pack: at most.
SAMPLE = 40_000
MOST_CELLS = 4_096
BLOCK_ROWS = 4_096
PACK = 256
#: Rows of a cell that the net aims at; rows of a leaf; angle of a node over that of its children.
CELL_ROWS = 4_096
LEAF = 64
BASE = 1.3

NONE = np.iinfo(np.int64).min + 1  # it has an opposite
_SLACK = 1e-7
_PACKS = "block long, kind int, pack long, payload binary"


class Space:
    """Exact inner products and bounds among vectors of given size."""

    def __init__(self, width: int, largest: int, longest: float) -> None:
        self.width, self.longest = width, longest
        self.exact = width * largest * largest < 2 ** 53  # then float arithmetic is exact

    def dot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        if self.exact:
            return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
        limit = np.iinfo(np.int64).max - 1
        return np.clip(a.astype(object) @ b.astype(object).T, -limit, limit).astype(np.int64)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """Unit vectors of the augmented candidates."""
        x = x.astype(np.float64)
        rest = np.sqrt(np.maximum(self.longest ** 2 - (x * x).sum(axis=1), 0))
        return np.column_stack((x, rest)) / self.longest if self.longest else np.column_stack((x, rest + 1))

    def bounds(self, anchors: np.ndarray, centres: np.ndarray, angles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest inner product of each anchor with any row within the angle of a centre."""
        q = anchors.astype(np.float64)
        reach = np.sqrt((q * q).sum(axis=1))[:, None] * self.longest
        cosine = np.divide(q @ centres.astype(np.float64).T, reach, out=np.zeros((len(q), len(centres))), where=reach > 0)
        at = np.arccos(np.clip(cosine, -1, 1))
        slack = reach * _SLACK + _SLACK
        return (reach * np.cos(np.minimum(at + angles, np.pi)) - slack,
                reach * np.cos(np.maximum(at - angles, 0)) + slack)


def _angle(lifted: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(lifted @ centre, -1, 1)) + _SLACK


def net(lifted: np.ndarray, most: int, within: float = 0.0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Centres taken farthest first until every row is within the angle of one, or `most` are taken:
    places of the centres, each row's centre and its angle to it."""
    centres = [0]
    angle = _angle(lifted, lifted[0])
    own = np.zeros(len(lifted), np.int64)
    while len(centres) < most:
        far = int(angle.argmax())
        if angle[far] <= max(within, 2 * _SLACK):
            break
        other = _angle(lifted, lifted[far])
        nearer = other < angle
        own[nearer], angle[nearer] = len(centres), other[nearer]
        centres.append(far)
    return np.array(centres), own, angle


class Tree:
    """Nodes by level over the rows of a block, which are put into the order of the leaves; each
    node has a centre row, a covering angle, its range of rows, and its parent in the level above."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, space: Space) -> None:
        lifted = space.lifted(vectors)
        order = np.arange(len(vectors))
        _, _, angle = net(lifted, 1)
        level = [(0, 0, len(order), float(angle.max()), -1)]  # centre, first row, end, angle, parent
        self.levels, self.leaves = [], []
        while level:
            below = []
            for k, (_, start, end, wide, _) in enumerate(level):
                rows = order[start:end].copy()
                most = max(2, len(rows) // 8)
                centres, own, angle = net(lifted[rows], most, wide / BASE) if end - start > LEAF else ([0], None, None)
                if len(centres) == 1 or angle.max() > wide / BASE:  # small, or its rows share no parts
                    order[start:end] = rows[np.argsort(ids[rows], kind="stable")]
                    self.leaves.append((len(self.levels), k))
                    continue
                by = np.argsort(own, kind="stable")
                order[start:end] = rows[by]
                edges = np.searchsorted(own[by], np.arange(len(centres) + 1)) + start
                for c in range(len(centres)):
                    below.append((int(rows[centres[c]]), int(edges[c]), int(edges[c + 1]),
                                  float(angle[own == c].max()), k))
            self.levels.append(tuple(np.array(x) for x in zip(*level)))
            level = below
        self.order = order
        self.centres = [vectors[lv[0]] for lv in self.levels]

    def descend(self, anchors: np.ndarray, space: Space, wanted) -> list[tuple[float, int, int, np.ndarray, np.ndarray]]:
        """Leaves that `wanted` (of least and greatest inner products) keeps for any anchor, best
        bound first: bound, first row, end, and both bounds by anchor."""
        out, leaves = [], set(self.leaves)
        alive = None
        for depth, (_, start, end, wide, parent) in enumerate(self.levels):
            low, high = space.bounds(anchors, self.centres[depth], wide)
            keep = wanted(low, high)
            alive = keep if alive is None else keep & alive[:, parent]
            for k in np.flatnonzero(alive.any(axis=0)):
                if (depth, int(k)) in leaves:
                    out.append((float(high[alive[:, k], k].max()), int(start[k]), int(end[k]), low[:, k], high[:, k]))
        return sorted(out, key=lambda leaf: -leaf[0])


class Pack:
    """Anchors with their windows and what is found so far: the K best rows of each window."""

    def __init__(self, cell, rows, ids, labels, vectors, windows: int, most: int, same: bool, low=None, high=None):
        n = len(rows)
        self.cell, self.rows, self.ids, self.labels, self.vectors, self.same = cell, rows, ids, labels, vectors, same
        self.low = np.full((n, windows), NONE + 1) if low is None else low
        self.high = np.full((n, windows), np.iinfo(np.int64).max) if high is None else high
        self.score, self.found = np.full((n, windows, most), NONE), np.zeros((n, windows, most), np.int64)

    def wanted(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether rows between these bounds (anchors x nodes) may still get into a window."""
        keep = np.zeros(low.shape, bool)
        floor = np.maximum(self.low, self.score[:, :, -1])
        for w in range(floor.shape[1]):
            keep |= (high >= floor[:, w:w + 1]) & (low <= self.high[:, w:w + 1]) & (
                self.low[:, w] <= self.high[:, w])[:, None]
        return keep

    def take(self, at, score: np.ndarray, found: np.ndarray) -> None:
        """Merge rows (in the last axis) into those of the anchors, or anchors and windows, at `at`."""
        score = np.concatenate((self.score[at], score), axis=-1)
        found = np.concatenate((self.found[at], found), axis=-1)
        best = np.lexsort((found, -score), axis=-1)[..., :self.score.shape[2]]
        self.score[at] = np.take_along_axis(score, best, axis=-1)
        self.found[at] = np.take_along_axis(found, best, axis=-1)

    def visit(self, tree: Tree, rows, ids, labels, vectors, space: Space) -> None:
        """From here on the pack holds what this block has that is no worse than what was found."""
        most = self.score.shape[2]
        self.low = np.maximum(self.low, self.score[:, :, -1])
        self.score[:], self.found[:] = NONE, 0
        for _, start, end, low, high in tree.descend(self.vectors, space, self.wanted):
            at = np.flatnonzero(self.wanted(low[:, None], high[:, None])[:, 0])
            if not len(at):
                continue
            score = space.dot(self.vectors[at], vectors[start:end])
            fits = (labels[start:end] == self.labels[at][:, None]) == self.same
            fits &= rows[start:end] != self.rows[at][:, None]
            for w in range(self.low.shape[1]):
                floor = np.maximum(self.low[at, w], self.score[at, w, -1])
                own = fits & (score >= floor[:, None]) & (score <= self.high[at, w][:, None])
                hit = np.flatnonzero(own.any(axis=1))
                if len(hit):
                    # Rows of a leaf are in the order of their ids: a stable sort keeps ties so.
                    value = np.where(own[hit], score[hit], NONE)
                    top = np.argsort(-value, axis=1, kind="stable")[:, :most]
                    value = np.take_along_axis(value, top, axis=1)
                    self.take((at[hit], w), value, np.where(value > NONE, ids[start:end][top], 0))


def _vectors(column: pa.Array, kind: str, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(v.as_py() for v in column), kind).reshape(len(column), width)


def _prepared(rows: DataFrame, vec_id: str, vector: str, label: str, anchor: Column) -> DataFrame:
    """Rows that take part: row, id, label, anchor, and whole components."""
    x = F.col(vector)
    usable = x.isNotNull() & F.col(label).isNotNull() & F.col(vec_id).isNotNull() & F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    whole = F.transform(x, lambda v: F.floor(256 * v.cast("double")))
    return rows.where(usable).select(
        F.monotonically_increasing_id().alias("row"), F.col(vec_id).cast("long").alias("id"),
        F.col(label).cast("long").alias("label"), F.coalesce(anchor, F.lit(False)).alias("anchor"),
        whole.alias("whole"))


def _lengths(prepared: DataFrame) -> tuple[int, int, int, float]:
    """Rows, longest list, largest component, greatest length of a vector."""
    size = F.aggregate("whole", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    largest = F.array_max(F.transform("whole", lambda v: F.abs(F.greatest(v, F.lit(NONE + 1)))))
    got = prepared.agg(F.count(F.lit(1)), F.max(F.size("whole")), F.max(largest), F.max(size)).first()
    return got[0], got[1] or 0, got[2] or 0, float(got[3] or 0) ** 0.5 * (1 + 1e-12)


def _placed(prepared: DataFrame, centres, kind: str, space: Space) -> DataFrame:
    """Rows packed, with the nearest of the upper net and the angle to it."""
    width = space.width

    def run(batches):
        middle = space.lifted(centres.value)
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = batch.column(4)
            sizes = np.asarray(lists.value_lengths().fill_null(0)).astype(np.int64)
            vectors = np.zeros((len(lists), width), kind)
            flat = np.asarray(lists.flatten())
            row = np.repeat(np.arange(len(lists)), sizes)
            vectors[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = np.maximum(flat, NONE + 1)
            cosine = space.lifted(vectors) @ middle.T
            cell = cosine.argmax(axis=1)
            angle = np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1, 1)) + _SLACK
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k) for k in range(4)), pa.array(cell.astype(np.int64)), pa.array(angle),
                 pa.array([v.tobytes() for v in vectors], pa.binary())],
                names=["row", "id", "label", "anchor", "cell", "angle", "vec"])

    return prepared.mapInArrow(run, "row long, id long, label long, anchor boolean, cell long, angle double, vec binary")


def _group(table: pa.Table, kind: str, width: int) -> tuple[np.ndarray, ...]:
    table = table.sort_by("row")
    return (*(np.asarray(table.column(c).combine_chunks()) for c in ("row", "id", "label")),
            _vectors(table.column("vec").combine_chunks(), kind, width))


def _dealt(placed: DataFrame, counts: np.ndarray, size: int, name: str) -> DataFrame:
    """Rows with the number of their group: the rows of each cell, dealt by hash, about `size` a group."""
    parts = np.maximum(1, -(-counts // size))
    first = np.cumsum(parts) - parts
    # One short list of numbers for each cell, so at most MOST_CELLS of them.
    at = F.col("cell").cast("int") + 1
    number = F.element_at(F.lit(first.tolist()), at) + F.pmod(F.xxhash64("row"), F.element_at(F.lit(parts.tolist()), at))
    return placed.withColumn(name, number.cast("long"))


def _blocks(placed: DataFrame, counts: np.ndarray, kind: str, space: Space) -> DataFrame:
    width = space.width

    def run(table: pa.Table) -> pa.Table:
        rows, ids, labels, vectors = _group(table, kind, width)
        tree = Tree(vectors, ids, space)
        o = tree.order
        payload = pickle.dumps((tree, rows[o], ids[o], labels[o], vectors[o]), protocol=5)
        return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "kind": pa.array([0], pa.int32()),
                         "pack": pa.array([-1], pa.int64()), "payload": pa.array([payload], pa.binary())})

    return _dealt(placed, counts, BLOCK_ROWS, "block").select("block", "row", "id", "label", "vec").groupBy(
        "block").applyInArrow(run, _PACKS)


def _packs(placed: DataFrame, counts: np.ndarray, kind: str, width: int, most: int) -> DataFrame:
    def run(table: pa.Table) -> pa.Table:
        group = _group(table, kind, width)
        pack = Pack(table.column("cell")[0].as_py(), *group, windows=1, most=most, same=True)
        return pa.table({"pack": table.column("pack").slice(0, 1), "payload": pa.array([pickle.dumps(pack, protocol=5)], pa.binary())})

    return _dealt(placed.where("anchor"), counts, PACK, "pack").select(
        "pack", "cell", "row", "id", "label", "vec").groupBy("pack").applyInArrow(run, "pack long, payload binary")


def _routed(packs: DataFrame, cells, space: Space, own: bool) -> DataFrame:
    """A row for every block that a pack is to visit: those of its own cell, or of all others that
    may hold a better row."""

    def run(batches):
        centres, angles, first, parts = cells.value
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                pack = pickle.loads(payload)
                if own:
                    visited = np.array([pack.cell])
                else:
                    keep = pack.wanted(*space.bounds(pack.vectors, centres, angles)).any(axis=0)
                    keep[pack.cell] = False
                    visited = np.flatnonzero(keep)
                for c in visited.tolist():
                    blocks = np.arange(first[c], first[c] + parts[c])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(blocks), pa.array([1] * len(blocks), pa.int32()), pa.array([number] * len(blocks), pa.int64()),
                         pa.array([payload] * len(blocks), pa.binary())], names=["block", "kind", "pack", "payload"])

    return packs.select("pack", "payload").mapInArrow(run, _PACKS)


def _searched(blocks: DataFrame, routed: DataFrame, space: Space) -> DataFrame:
    """What each pack finds in each block that it visits. A block is read once; packs stream past it."""

    def run(batches):
        number, block = None, None
        for batch in batches:
            for b, k, p, payload in zip(*(batch.column(c).to_pylist() for c in range(4))):
                if k == 0:
                    number, block = b, pickle.loads(payload)
                    continue
                assert number == b
                pack = pickle.loads(payload)
                pack.visit(block[0], *block[1:], space)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p], pa.int64()), pa.array([pickle.dumps((pack.score, pack.found), protocol=5)], pa.binary())],
                    names=["pack", "payload"])

    both = blocks.unionByName(routed).repartition("block").sortWithinPartitions("block", "kind")
    return both.mapInArrow(run, "pack long, payload binary")


def _merged(packs: DataFrame, found: DataFrame) -> DataFrame:
    """Packs with all that was found; one pack is held at a time."""

    def run(batches):
        number, pack = None, None
        for batch in batches:
            for p, k, payload in zip(*(batch.column(c).to_pylist() for c in ("pack", "kind", "payload"))):
                if k == 0:
                    if pack is not None:
                        yield row(number, pack)
                    number, pack = p, pickle.loads(payload)
                else:
                    assert number == p
                    pack.take(slice(None), *pickle.loads(payload))
        if pack is not None:
            yield row(number, pack)

    def row(number, pack):
        return pa.RecordBatch.from_arrays(
            [pa.array([number], pa.int64()), pa.array([pickle.dumps(pack, protocol=5)], pa.binary())], names=["pack", "payload"])

    both = packs.select("pack", F.lit(0).alias("kind"), "payload").unionAll(
        found.select("pack", F.lit(1).alias("kind"), "payload"))
    return both.repartition("pack").sortWithinPartitions("pack", "kind").mapInArrow(run, "pack long, payload binary")


def _round(blocks: DataFrame, packs: DataFrame, cells, space: Space) -> DataFrame:
    """The packs after all blocks that may hold what their windows want."""
    for own in (True, False):
        packs = land(_merged(packs, _searched(blocks, _routed(packs, cells, space, own), space)), "packs")
    return packs


def _windows(packs: DataFrame, negatives: int, low: int, high: int) -> DataFrame:
    """Packs whose windows are those of the positives that they have found."""

    def run(batches):
        for batch in batches:
            for number, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                old = pickle.loads(payload)
                score, known = old.score[:, 0], old.score[:, 0] > NONE
                value = np.where(known, score, 0).astype(object)
                least = np.where(known, -((-low * value) // 100), 1).astype(np.int64)
                most = np.where(known, (high * value) // 100, 0).astype(np.int64)
                pack = Pack(old.cell, old.rows, old.ids, old.labels, old.vectors, score.shape[1], negatives, False, least, most)
                pack.positives = (score, old.found[:, 0])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), pa.array([pickle.dumps(pack, protocol=5)], pa.binary())],
                    names=["pack", "payload"])

    return packs.mapInArrow(run, "pack long, payload binary")


_RESULT = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
_RESULT_TYPES = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def _results(packs: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            for payload in batch.column(1).to_pylist():
                pack = pickle.loads(payload)
                a, w, k = np.nonzero(pack.score > NONE)
                score, positive = pack.positives
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pack.ids[a]), pa.array(positive[a, w]), pa.array((k + 1).astype(np.int32)),
                     pa.array(pack.found[a, w, k]), pa.array(score[a, w]), pa.array(pack.score[a, w, k])], names=_RESULT)

    return packs.mapInArrow(run, _RESULT_TYPES)


def mine(rows: DataFrame, anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for each anchor and
    each of its first `positives` rows of the same label, the first `negatives` rows of other labels
    that score between low and high hundredths of the positive."""
    spark = rows.sparkSession
    prepared = land(_prepared(rows, vec_id, vector, label, anchor), "vectors")
    n, width, largest, longest = _lengths(prepared)
    if not n:
        return spark.createDataFrame([], _RESULT_TYPES)
    space = Space(width, largest, longest)
    kind = next((k for k in ("<i2", "<i4") if largest < np.iinfo(k).max), "<i8")
    # A bounded sample gives the centres only; which rows it holds touches no result.
    sample = prepared.select("whole", F.xxhash64("id").alias("h")).orderBy("h").limit(SAMPLE).toArrow().column("whole")
    start = np.zeros((len(sample), width), kind)
    for k, v in enumerate(sample.to_pylist()):
        start[k, :len(v)] = np.maximum(v, NONE + 1)
    places, _, _ = net(space.lifted(start), min(MOST_CELLS, -(-n // CELL_ROWS)))
    centres = spark.sparkContext.broadcast(start[places])
    placed = land(_placed(prepared, centres, kind, space), "placed")
    counts, anchors, angles = (np.zeros(len(places), t) for t in (np.int64, np.int64, np.float64))
    for r in placed.groupBy("cell").agg(  # a row for each of at most MOST_CELLS cells
            F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("anchors"), F.max("angle").alias("angle")).collect():
        counts[r["cell"]], anchors[r["cell"]], angles[r["cell"]] = r["n"], r["anchors"], r["angle"]
    parts = np.maximum(1, -(-counts // BLOCK_ROWS))
    parts_before = np.cumsum(parts) - parts
    cells = spark.sparkContext.broadcast((start[places], angles, parts_before, np.where(counts > 0, parts, 0)))
    blocks = land(_blocks(placed, counts, kind, space), "blocks")
    packs = land(_packs(placed, anchors, kind, width, positives), "packs")
    packs = land(_windows(_round(blocks, packs, cells, space), negatives, low, high), "packs")
    return _results(_round(blocks, packs, cells, space))
