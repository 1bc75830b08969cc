import math

import numpy as np
import pytest

from shipcast.llm import topk as K

SCHEMA = "vec_id long, embedding array<float>, label int, v int, d string, score string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "x", "y") for i, v in rows], SCHEMA)


def brute(rows, k, every):
    good = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        good.append((i, [math.floor(256 * float(np.float32(x))) for x in v]))
    out = []
    for n, (q, a) in enumerate(good):
        if q % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(good) if m != n)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, k=5, every=50):
    v = K.integer_vectors(frame(spark, rows))
    return sorted(map(tuple, K.top_k(v, v.where(f"vec_id % {every} = 0"), k).collect()))


def test_equals_brute_force_with_ties_and_a_hot_vector(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[200:400] = x[7]                                   # a third of all rows are one vector
    rows = [(int(i), [float(y) for y in v]) for i, v in enumerate(x)]
    rows += rows[:50]                                   # repeated rows
    rows += [(100, rows[9][1]), (100, rows[10][1]), (60, rows[11][1])]       # repeated ids with other vectors
    rows += [(-50, rows[3][1]), (None, rows[3][1]), (9001, None), (9002, [None] * 16),
             (9003, [float("nan")] * 16), (9004, [float("inf")] * 16), (9050, [0.5]), (9100, [])]
    assert run(spark, rows) == brute(rows, 5, 50)


def test_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(K, "BLOCK", 3)
    monkeypatch.setattr(K, "SAMPLE", 16)
    monkeypatch.setattr(K, "STEP", 4)
    rng = np.random.default_rng(1)
    rows = [(i, [float(y) for y in rng.normal(size=8)]) for i in range(150)]
    assert run(spark, rows, every=10) == brute(rows, 5, 10)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(i * 50, [1.0, float(i)]) for i in range(n)]
    assert run(spark, rows) == brute(rows, 5, 50)


def test_bound_eliminates_candidates():
    """Evaluated candidates stay far below all on clustered vectors."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 32)) * 300
    x = np.floor(centres[rng.integers(0, 40, 4000)] + rng.normal(size=(4000, 32)) * 10)
    pivots = K.choose_pivots(x[:500], 32)
    d, norms, seen = K.distances(x, pivots), (x * x).sum(1), []
    original = K.best

    def counting(scores, ids, k):
        seen.append(len(scores))
        return original(scores, ids, k)

    K.best = counting
    try:
        got = K.search_one(x[0], norms[0], d[0], 0, x, norms, d, np.arange(4000), (np.empty(0), np.empty(0, int)), 5)
    finally:
        K.best = original
    want = original(np.delete(x @ x[0], 0), np.arange(1, 4000), 5)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()
    assert sum(seen) < 1000
