"""Hard negatives against every pair of rows, in plain integers."""

import math
import random

import pytest

from threadloom.llm import negatives

VECTORS = "vec_id long, embedding array<double>, label int, rank string, id string, x string, rb string"


def plain(rows, every=100, low=80, high=100, k=5):
    kept = {}
    for vec_id, v, label, *_ in rows:
        if vec_id is None or label is None or v is None or any(c is None or not math.isfinite(c) for c in v):
            continue
        row = (label, [math.floor(256 * c) for c in v])
        kept[vec_id] = min(kept.get(vec_id, row), row)
    out = []
    for a, (label, x) in kept.items():
        if a % every:
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), other, m) for other, (m, y) in kept.items() if other != a and len(x) == len(y)]
        for p, positive, _ in sorted(s for s in scored if s[2] == label)[:k]:
            fitting = sorted(s for s in scored if s[2] != label and low * -p <= 100 * -s[0] <= high * -p)[:k]
            out += [(a, positive, rank, n, -p, -s) for rank, (s, n, _) in enumerate(fitting, 1)]
    return sorted(out)


def table(n=700, scale=1.0, seed=5):
    rng = random.Random(seed)
    base = [[rng.gauss(0, 0.3) for _ in range(6)] for _ in range(5)]
    rows = [(i, [scale * (c + rng.gauss(0, 0.1)) for c in rng.choice(base)], rng.choice([0, 0, 0, 1, 2]), "r", "i", "x", "b") for i in range(n)]
    rows += [(n + i, [round(c, 1) for c in rows[i][1]], rows[i][2], None, None, None, None) for i in range(60)]  # ties
    rows += [(2000 + i, [0.1 * i, 1.0], i % 2, None, None, None, None) for i in range(12)]  # of another length
    rows += [
        (None, [1.0] * 6, 1, None, None, None, None), (3001, None, 1, None, None, None, None), (3002, [1.0] * 6, None, None, None, None, None),
        (3003, [None] + [1.0] * 5, 1, None, None, None, None), (3004, [float("nan")] * 6, 1, None, None, None, None),
        (3005, [float("inf")] * 6, 1, None, None, None, None), (3000, [], 1, None, None, None, None), (3006, [], 1, None, None, None, None),
        (3007, [], 2, None, None, None, None), (3100, [0.0] * 6, 0, None, None, None, None), rows[0], (100, [9.0] * 6, 2, None, None, None, None),
    ]
    return rows


@pytest.mark.parametrize("blocks", [{}, {"rows": 100, "anchors": 3}])
def test_equals_all_pairs(spark, blocks):
    rows = table()
    found = negatives.mine(spark.createDataFrame(rows, VECTORS).repartition(5), **blocks)
    assert sorted(tuple(r) for r in found.collect()) == plain(rows)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


@pytest.mark.parametrize("scale", [300.0, 1e5])
def test_large_components_stay_exact(spark, scale):
    rows = table(200, scale)
    assert sorted(tuple(r) for r in negatives.mine(spark.createDataFrame(rows, VECTORS), every=20).collect()) == plain(rows, every=20)


def test_empty_table(spark):
    assert negatives.mine(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("top", [0, 1, 200, 10**6, 10**12, 2**63 - 1])
def test_packed_products_are_exact(top):
    rng = random.Random(top)
    rows = [[rng.randint(-top, top) for _ in range(7)] for _ in range(50)]
    anchors = [[rng.randint(-top, top) for _ in range(7)] for _ in range(5)] + [[top] * 7, [-top] * 7, [0] * 7]
    packed = negatives.Packed(rows, top, fields=16)
    for a in anchors:
        want = [max(-(2**63 - 1), min(2**63 - 1, sum(p * q for p, q in zip(a, r)))) for r in rows]
        assert packed.scores(a).tolist() == want
