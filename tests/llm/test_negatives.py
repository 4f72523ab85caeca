"""Hard negatives against scoring every anchor with every row."""

import math
import random

import pytest
from pyspark.sql import functions as F

from parcelflow.llm import negatives

SCHEMA = "vec_id long, embedding array<double>, label int, cell string, q string, windows string"


def brute_force(rows, every, positives=5, count=5, low=80, high=100):
    part = {}
    for i, x, label in rows:
        if i is None or label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        q = [math.floor(256 * v) for v in x]
        if math.hypot(*x) * 256 > negatives.MOST_NORM / 2:
            continue
        part[i] = min(part.get(i, (label, q)), (label, q))
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, q) in part.items():
        if a % every:
            continue
        scored = sorted((-score(q, r), i, other) for i, (other, r) in part.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == label][:positives]:
            near = [x for x in scored if x[2] != label and -low * s <= -100 * x[0] <= -high * s][:count]
            out += [(a, p, k, n, -s, -t) for k, (t, n, _) in enumerate(near, 1)]
    return sorted(out)


def run(spark, rows, every, **options):
    df = spark.createDataFrame([(*r, "mine", "mine", "mine") for r in rows], SCHEMA).repartition(4)
    return sorted(map(tuple, negatives.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect()))


def clustered(rng, n, dim, spread):
    centres = [[rng.gauss(0, 1) for _ in range(dim)] for _ in range(12)]
    return [(i, [c + rng.gauss(0, spread) for c in rng.choice(centres)], rng.randrange(4)) for i in range(n)]


@pytest.mark.parametrize("dim, spread", [(64, 0.1), (64, 1.0), (3, 0.3), (1, 1.0)])
def test_equals_brute_force(spark, dim, spread):
    rng = random.Random(dim)
    rows = clustered(rng, 400, dim, spread)
    got = run(spark, rows, 20)
    assert got == brute_force(rows, 20) and got


def test_hot_vectors_ties_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 16)  # the cell of the hot vector makes many blocks
    monkeypatch.setattr(negatives, "GROUP_ANCHORS", 4)
    monkeypatch.setattr(negatives, "FIRST_CELLS", 2)
    monkeypatch.setattr(negatives, "WAVE_GROWTH", 2)
    rng = random.Random(5)
    rows = clustered(rng, 150, 6, 0.2)
    hot = rows[0][1]
    rows += [(1000 + i, hot, i % 3) for i in range(80)]
    rows += [(2000, None, 1), (2001, hot, None), (None, hot, 1), (2002, [None] * 6, 1), (2003, [math.nan] * 6, 1), (2004, [math.inf] * 6, 1)]
    rows += [(2010, [1e300] * 6, 1), (2020, [0.0] * 6, 2), (2030, [3e5, -2e5, 1e5, 0.0, 1.0, 2.0], 2), (2040, [3e5, -2e5, 1e5, 0.0, 1.0, 3.0], 1), (2050, [3e5, -2e5, 1e5, 0.0, 0.5, 2.0], 2)]
    rows += [(2060, [], 3), (2070, [0.5, 0.25], 3), (10, [9.0] * 6, 0), (10, hot, 0), rows[3], rows[3]]
    rows += [(-20, [-v for v in hot], 9)]
    assert run(spark, rows, 10) == brute_force(rows, 10)
    assert run(spark, rows, 10, positives=2, negatives=3, low=50, high=90) == brute_force(rows, 10, 2, 3, 50, 90)


def test_nothing_to_mine(spark):
    assert run(spark, [], 10) == []
    assert run(spark, [(10, None, 1)], 10) == []
    assert run(spark, [(11, [1.0], 1), (12, [1.0], 2)], 10) == []
    assert run(spark, [(10, [1.0], 1), (12, [1.0], 1)], 10) == []


def test_anchors_stop_at_certified_windows(spark):
    """In separate clusters an anchor needs few cells: the bounds turn the others away."""
    rng = random.Random(9)
    centres = [[20.0 * (rng.random() < 0.5) - 10 for _ in range(16)] for _ in range(10)]
    rows = [(i, [v + rng.gauss(0, 0.01) for v in centres[i % 10]], i // 10 % 2) for i in range(2000)]
    index = negatives.MultiIndex(negatives.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    anchors = index.rows.where("vec_id % 100 = 0").select("vec_id", "label", "q")
    seen = [index.index.bounds(negatives._matrix(anchors.toArrow().column("q"), 16))]
    for left, right in zip(*seen[0]):
        bounds = [b for _, b in index.index.cells(left, right)]
        assert bounds == sorted(bounds, reverse=True) and len(bounds) == len(index.index.filled)
        assert bounds[2] < 0.9 * bounds[0]
