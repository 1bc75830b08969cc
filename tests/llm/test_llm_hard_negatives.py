import math

import numpy as np
import pytest

from shipcast.llm import hard_negatives as H

SCHEMA = "vec_id long, embedding array<float>, label int, row int, v string, slot string, rank int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 1, "x", "y", 2) for i, v, l in rows], SCHEMA)


def brute(rows, every):
    kept = []
    for i, v, l in rows:
        if i is None or l is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        w = [max(-H.LIMIT, min(H.LIMIT, math.floor(256 * float(np.float32(x))))) for x in v]
        kept.append((i, (l + 1) % 10 if i % 7 == 0 else l, w))
    out = []
    for a, (i, l, v) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, b, m) for b, (j, m, w) in enumerate(kept) if b != a)
        for p, j, _, _ in [s for s in scored if s[3] == l][:5]:
            window = [s for s in scored if s[3] != l and 80 * -p <= 100 * -s[0] <= 100 * -p]
            out += [(i, j, r + 1, s[1], -p, -s[0]) for r, s in enumerate(window[:5])]
    return sorted(out)


def run(spark, rows, every=100):
    from pyspark.sql import functions as F
    out = H.hard_negatives(H.labelled_vectors(frame(spark, rows)), F.col("vec_id") % every == 0)
    return sorted(map(tuple, out.collect()))


def near_rows(n, width, seed):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=width)
    return [(i, [float(x) for x in centre + 0.4 * rng.normal(size=width)], int(rng.integers(4))) for i in range(n)]


def test_equals_brute_force_with_a_hot_vector_and_label(spark):
    rows = near_rows(300, 12, 0)
    hot = rows[3][1]
    rows = [(i, hot if i % 3 == 0 else v, 1 if i % 3 else l) for i, v, l in rows]
    rows += rows[:60]                                               # repeated rows and anchors
    rows += [(100, rows[5][1], 2), (-50, hot, 0), (None, hot, 0), (901, None, 0), (902, hot, None),
             (903, [None] * 12, 1), (904, [float("nan")] * 12, 1), (905, [float("-inf")] * 12, 1),
             (906, [0.5], 3), (950, [], 2), (907, [3e38, -3e38], 1), (1000, [1e5] * 12, 1)]
    got = run(spark, rows, every=50)
    assert got == brute(rows, 50) and len(got) > 50


def test_several_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(H, "BLOCK", 4)
    monkeypatch.setattr(H, "ANCHOR_TILE", 3)
    monkeypatch.setattr(H, "ROW_TILE", 16)
    rows = near_rows(200, 8, 1)
    assert run(spark, rows, every=10) == brute(rows, 10)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(i * 100, [1.0, 0.5 * i], i % 2) for i in range(n)]
    assert run(spark, rows) == brute(rows, 100) == []


def test_scores_around_zero(spark):
    rows = [(0, [1.0, 0.0], 2), (100, [0.0, 1.0], 3), (1, [0.0, 1.0], 3), (2, [0.0, -1.0], 3), (3, [-1.0, 0.0], 3),
            (4, [0.0, 2.0], 4), (5, [-1.0, -1.0], 4), (6, [0.0, 0.0], 5)]
    assert run(spark, rows) == brute(rows, 100)


@pytest.mark.parametrize("width,size", [(1, 3), (64, 200), (3000, 140), (7, 1 << 24), (4096, 1 << 24)])
def test_products_are_exact(width, size):
    rng = np.random.default_rng(width)
    a, b = (rng.integers(-size, size + 1, (9, width)) for _ in range(2))
    a[0] = size
    b[0], b[1] = size, -size                                        # the largest scores of both signs
    numbers = H.ResidueNumbers(width * size * size)
    got = numbers.product(numbers.residues(a), numbers.residues(b))
    want = a.astype(object) @ b.T.astype(object)
    assert (got.astype(object).astype(np.int64) == want.astype(np.int64)).all()
    assert numbers.kind is (np.float64 if width * size * size < 2**50 else np.int64)
