"""Scalar subqueries: small global values (means, medians, edges) used inside a plan.

Several values of one aggregate are fetched through ONE struct-valued scalar subquery, so
the aggregate runs once and the plan carries a single copy of its lineage.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def scalars(one_row: DataFrame, cols: Sequence[str] | None = None) -> dict[str, Column]:
    """Map column name -> Column reading that field of ``one_row`` (a one-row frame)."""
    cols = list(cols or one_row.columns)
    sub = one_row.select(F.struct(*[F.col(c) for c in cols]).alias("s")).scalar()
    return {c: sub[c] for c in cols}
