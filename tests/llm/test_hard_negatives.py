import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowsift.llm import hard_negatives
from flowsift.llm.catalog import mined_rows

TYPES = "vec_id long, embedding array<float>, label int"


def brute(rows, anchor):
    """rows: (vec_id, components, label) as given to the operator."""
    good = [(i, [math.floor(256 * float(x)) for x in v], c) for i, v, c in rows
            if None not in (i, v, c) and all(x is not None and math.isfinite(x) for x in v)]

    def score(a, b):
        return sum(x * y for x, y in zip(a, b))

    out = []
    for k, (i, v, c) in enumerate(good):
        if not anchor(i):
            continue
        scored = sorted((-score(v, w), j, d) for m, (j, w, d) in enumerate(good) if m != k)
        for p, j, _ in [s for s in scored if s[2] == c][:5]:
            fits = [s for s in scored if s[2] != c and 50 * -p <= 100 * -s[0] <= 95 * -p][:3]
            out += [(i, j, r + 1, m, -p, -s) for r, (s, m, _) in enumerate(fits)]
    return sorted(out)


def table(spark, rows, types=TYPES):
    return spark.createDataFrame(rows, types).repartition(3).withColumns(
        {c: F.lit("clash") for c in ("row", "id", "cell", "vec", "anchor", "angle", "pack", "block", "whole", "payload")})


def made(n, rng, width=6, groups=5):
    means = rng.normal(0, 0.6, (groups, width))
    rows = [(int(i), [float(np.float32(x)) for x in means[i % groups] + rng.normal(0, 0.15, width)], int(rng.integers(4)))
            for i in range(n)]
    rows += [(i + n, rows[3][1], 1 + i % 2) for i in range(n // 3)]  # a third of the rows alike
    return rows


ODD = [(None, [0.1] * 6, 1), (1, None, 1), (2, [0.1] * 5 + [None], 1), (3, [float("nan")] * 6, 1),
       (5, [float("inf")] * 6, 0), (6, [0.2] * 6, None), (10, [0.0] * 6, 1), (20, [], 2), (30, [0.5, 0.5], 2)]


@pytest.mark.parametrize("sizes", [{}, {"CELL_ROWS": 60, "BLOCK_ROWS": 40, "PACK": 4, "LEAF": 4}])
def test_equals_brute_force(spark, monkeypatch, sizes):
    for name, value in sizes.items():
        monkeypatch.setattr(hard_negatives, name, value)
    rows = made(300, np.random.default_rng(2)) + ODD
    rows += [rows[50], rows[50], rows[7]]  # repeated rows, one an anchor
    got = hard_negatives.mine(table(spark, rows), F.col("vec_id") % 50 == 0)
    want = brute(rows, lambda i: i % 50 == 0)
    assert len(want) > 20
    assert sorted(tuple(r) for r in got.collect()) == want


def test_large_components_stay_exact(spark):
    rng = np.random.default_rng(4)
    rows = [(i, [float(x) for x in rng.integers(-2 ** 20, 2 ** 20, 4)], int(rng.integers(2))) for i in range(60)]
    got = hard_negatives.mine(table(spark, rows, "vec_id long, embedding array<double>, label int"), F.col("vec_id") % 10 == 0)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, lambda i: i % 10 == 0)


def test_empty_and_lonely(spark):
    anchor = F.col("vec_id") % 50 == 0
    assert hard_negatives.mine(table(spark, []), anchor).collect() == []
    assert hard_negatives.mine(table(spark, ODD[:6]), anchor).collect() == []
    assert hard_negatives.mine(table(spark, [(50, [0.1], 1)]), anchor).collect() == []
    assert hard_negatives.mine(table(spark, [(51, [0.1], 1), (52, [0.1], 2)]), anchor).collect() == []


def test_query_labels(spark):
    rows = spark.createDataFrame([(7, [1.0], 9), (8, [1.0], 9), (None, [1.0], 9), (14, [1.0], None)], TYPES)
    assert [r.label for r in mined_rows(rows).orderBy("vec_id").collect()] == [9, 0, 9, None]


def test_bounds_hold_and_skip_nodes():
    rng = np.random.default_rng(5)
    vectors = np.concatenate([rng.integers(-60, 60, 8) + rng.integers(-5, 6, (200, 8)) for _ in range(10)]).astype(np.int16)
    space = hard_negatives.Space(8, 100, float(np.sqrt((vectors.astype(float) ** 2).sum(axis=1).max())))
    tree = hard_negatives.Tree(vectors, np.arange(len(vectors)), space)
    assert sorted(tree.order.tolist()) == list(range(len(vectors)))
    held = vectors[tree.order]
    anchors = vectors[::100]
    scores = space.dot(anchors, held)
    assert (scores == anchors.astype(int) @ held.astype(int).T).all()
    seen = np.zeros(len(held), int)
    for _, start, end, low, high in tree.descend(anchors, space, lambda lo, hi: np.ones(lo.shape, bool)):
        seen[start:end] += 1
        assert (scores[:, start:end] >= low[:, None]).all() and (scores[:, start:end] <= high[:, None]).all()
    assert (seen == 1).all()
    top = scores.max(axis=1)
    kept = sum(end - start for _, start, end, _, _ in tree.descend(
        anchors[:1], space, lambda lo, hi: hi >= top[:1, None]))
    assert kept < len(held) / 2
