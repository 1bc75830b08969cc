import numpy as np
import pandas as pd
import pytest

from shipcast.functions.comoments import pair_correlations
from shipcast.operators.reports import correlation_matrix

COLS = list("abcdef")


def table(n):
    """Gaps of their own in every column, far-off means, a constant and an empty column."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, 4)) @ rng.normal(size=(4, 4)) + [0, 1e6, -3, 1e9]
    rows = [[None if rng.random() < 0.3 else float(v) for v in r] + [7.0, None] for r in x]
    return rows


@pytest.mark.parametrize("n, parts", [(1, 1), (40, 5), (3_000, 3)])
def test_pairwise_complete_correlation_equals_pandas(spark, n, parts):
    rows = table(n)
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in COLS)).repartition(parts)
    frame = pd.DataFrame(rows, columns=COLS, dtype=float)
    got = {(r.col_a, r.col_b): r["corr"] for r in correlation_matrix(df, COLS).collect()}
    assert len(got) == len(COLS) ** 2 and all(got[c, c] == 1.0 for c in COLS)
    for a in COLS:
        for b in COLS:
            both = frame[[a, b]].dropna()
            if a != b and len(both) > 1 and both.std().min() > 0:
                assert got[a, b] == pytest.approx(np.corrcoef(both[a], both[b])[0, 1], abs=1e-6)
            elif a != b:
                assert got[a, b] is None


def test_an_empty_table_has_no_pairs(spark):
    df = spark.createDataFrame([], "a double, b int")
    assert pair_correlations(df, ["a", "b"]).count() == 0
    assert [r["corr"] for r in correlation_matrix(df, ["a", "b"]).where("col_a <> col_b").collect()] == [None, None]
