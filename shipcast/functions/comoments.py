"""Pairwise-complete correlation of many columns from masked co-moments.

A task multiplies value and mask matrices batch by batch into one buffer of all pairs, on values
shifted by its first batch's means, so that nothing cancels; one row a pair and task is merged by pair."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per(value: np.ndarray, n: np.ndarray) -> np.ndarray:
    """``value / n``, 0 where nothing was counted."""
    return np.divide(value, n, out=np.zeros_like(value), where=n > 0)


def _merge(p: pd.DataFrame) -> pd.DataFrame:
    """One pair's correlation from its tasks' counts, means and centred sums of products."""
    n = p["n"].sum()
    a, b = ((p["n"] * p[m]).sum() / n for m in ("mean_a", "mean_b"))
    da, db = p["mean_a"] - a, p["mean_b"] - b
    ab, aa, bb = ((p[c] + p["n"] * x * y).sum() for c, x, y in (("ab", da, db), ("aa", da, da), ("bb", db, db)))
    scale = float(np.sqrt(aa) * np.sqrt(bb))
    return pd.DataFrame({"pair": p["pair"].iloc[:1], "corr": [ab / scale if n > 1 and scale > 0 else None]})


def pair_correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """pair, corr for every two of ``cols`` (numeric; pairs in the order of the columns, from 0)
    over the rows that hold both; null where fewer than two do or a side doesn't vary. Pairs
    that no row holds have no row."""
    left, right = np.triu_indices(len(cols), 1)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shift = sums = None
        for batch in batches:
            if not batch.num_rows:
                continue
            mask = np.column_stack([c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)
            x = np.column_stack([c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns])
            if shift is None:
                shift = _per(x.sum(axis=0), mask.sum(axis=0))
            x = (x - shift) * mask
            # [a, b]: rows with both, and the sums of a, a*a and a*b over them
            part = np.stack([mask.T @ mask, x.T @ mask, (x * x).T @ mask, x.T @ x])
            sums = part if sums is None else sums + part
        if sums is None:
            return
        n, s, q, p = sums
        mean, square = _per(s, n), q - _per(s * s, n)
        cross = p - _per(s * s.T, n)
        met = np.flatnonzero(n[left, right] > 0)
        i, j = left[met], right[met]
        yield pa.RecordBatch.from_pydict({
            "pair": met.astype(np.int32), "n": n[i, j], "mean_a": shift[i] + mean[i, j], "mean_b": shift[j] + mean[j, i],
            "ab": cross[i, j], "aa": np.maximum(square[i, j], 0), "bb": np.maximum(square[j, i], 0)})

    rows = df.select(*[F.col(c).cast("double").alias(c) for c in cols])
    parts = rows.mapInArrow(moments, "pair int, n double, mean_a double, mean_b double, ab double, aa double, bb double")
    return parts.groupBy("pair").applyInPandas(_merge, "pair int, corr double")
