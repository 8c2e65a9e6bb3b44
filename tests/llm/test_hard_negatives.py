"""Hard negatives against brute force, and the bounds of the segments' summaries."""

import math

import numpy as np
import pytest

from navloom.llm import hard_negatives


def by_hand(rows, every=100):
    taking = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        label = (label + 1) % 10 if i % 7 == 0 else label
        taking[i] = max(taking.get(i, (label, v)), (label, v))
    whole = {i: (label, [math.floor(256 * x) for x in v]) for i, (label, v) in taking.items()}
    most = (1 << 63) - 1
    out = []
    for anchor in whole:
        if anchor % every:
            continue
        label, v = whole[anchor]
        scored = [(max(-most, min(most, sum(a * b for a, b in zip(v, w)))), i, other) for i, (other, w) in whole.items()
                  if i != anchor and len(w) == len(v)]
        scored.sort(key=lambda s: (-s[0], s[1]))
        for p, i, _ in [s for s in scored if s[2] == label][:5]:
            fitting = [s for s in scored if s[2] != label and 30 * p <= 100 * s[0] <= 90 * p]
            out += [(anchor, i, rank, s[1], p, s[0]) for rank, s in enumerate(fitting[:10], 1)]
    return sorted(out)


def rows_of(rng, count, dim, spread):
    centres = rng.standard_normal((10, dim))
    out = []
    for i in range(count):
        v = centres[i % 10] + spread * rng.standard_normal(dim)
        out.append((i, [float(np.float32(x)) for x in v / np.linalg.norm(v)], i % 10 if i % 13 else (i + 3) % 10))
    return out


@pytest.mark.parametrize("dim,spread,values,look", [(32, 0.6, 64, 40), (7, 1.0, 1 << 20, 1 << 20), (1, 0.3, 3, 1)])
def test_mine(spark, dim, spread, values, look):
    rng = np.random.default_rng(dim)
    rows = rows_of(rng, 700, dim, spread)
    rows += [(800 + n, rows[n % 9][1], n % 10) for n in range(60)]  # ties
    rows += [(1000, rows[3][1], None), (1100, None, 3), (1200, [None] + [1.0] * (dim - 1), 3), (1300, [math.inf] * dim, 3),
             (1400, [math.nan] * dim, 3), (None, rows[3][1], 3), (1500, [0.1, 0.2] * 20, 3), (1501, [0.2, 0.2] * 20, 3),
             (1502, [0.1, 0.1] * 20, 4), (1600, [], 3), (1601, [], 3), (1602, [], 4), (1700, [0.0] * dim, 3),
             (-100, rows[5][1], 5), rows[200], (200, rows[4][1], 1)]
    frame = spark.createDataFrame([(*r, 1.0, 2) for r in rows], "vec_id long, embedding array<double>, label int, score double, id int")
    got = hard_negatives.mine(frame.repartition(3), block_values=values, look_rows=look)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    want = by_hand(rows)
    assert sorted(map(tuple, got.collect())) == want and len(want) >= 50


def test_huge_components_and_empty_tables(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.uniform(0.2, 1, 4) * [1.0, 3e6, 1e8, 1e160, -1e300][i % 5]], i % 3) for i in range(150)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = sorted(map(tuple, hard_negatives.mine(frame, every=10).collect()))
    assert got == by_hand(rows, 10) and got
    assert hard_negatives.mine(frame.where("false")).collect() == []
    assert hard_negatives.mine(frame.where("vec_id = 100")).collect() == []


def test_bounds_hold_at_every_level():
    rng = np.random.default_rng(2)
    for dim in (1, 2, 5, 64, 100):
        a, b = (np.floor(256 * rng.standard_normal((40, dim))) for _ in range(2))
        exact, before = a @ b.T, None
        for (m, s), (n, t) in zip(*(hard_negatives.levels_of(hard_negatives.summaries(x), dim) for x in (a, b))):
            middle, reach = m @ n.T, s @ t.T
            assert (np.abs(exact - middle) <= reach + 1e-6 * (1 + np.abs(exact))).all()
            if before is not None:
                assert reach.sum() <= before + 1e-6
            before = reach.sum()


def test_most_pairs_are_dropped_before_they_are_scored():
    """Clustered rows: bounds alone leave a small share of the pairs to exact scores."""
    rng = np.random.default_rng(3)
    steps = np.repeat(rng.standard_normal((10, 8)), 8, axis=1)
    rows = np.floor(256 * (steps[np.arange(4000) % 10] + 0.1 * rng.standard_normal((4000, 64))))
    labels, ids = np.arange(4000) % 10, np.arange(4000)
    summary = hard_negatives.summaries(rows)
    most = np.full((40, 1), hard_negatives.MOST)
    block = hard_negatives.Block(ids[:40], labels[:40], rows[:40], summary[:40], -most, most, 64, 5, True)
    block.add(ids[:400], labels[:400], rows[:400], summary[:400])
    i, _ = block.pairs(ids[400:], labels[400:], summary[400:])
    assert len(i) < 0.35 * 360 * 40  # of those with the same label
