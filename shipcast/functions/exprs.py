"""Scalar expression helpers: clip, haversine, right-closed bins, quantile tiers, rounding."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clip(c, lo: float, hi: float) -> Column:
    """Clip to [lo, hi] keeping NULL as NULL (PRJ-02)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def clip_between(c, lo: Column, hi: Column) -> Column:
    """Clip to per-row bounds (PRJ-20)."""
    c = _c(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, hi), lo))


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance; NULL if any coordinate is NULL (PRJ-08)."""
    la1, lo1, la2, lo2 = (F.radians(_c(x)) for x in (lat1, lon1, lat2, lon2))
    a = F.pow(F.sin((la2 - la1) / 2), 2) + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * 2 * F.asin(F.sqrt(a))


def snap(c) -> Column:
    """The value rounded to 9 places before it is compared with a fixed edge: a value whose
    exact result lies on the edge (an error of exactly 2 days) can come out one bit either
    side depending on summation order; snapping puts it on the edge in every engine."""
    return F.round(_c(c).cast("double"), 9)


def snap_sql(expr: str) -> str:
    return f"round(CAST({expr} AS DOUBLE), 9)"


def bucket(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Right-closed, left-open bins (lo, hi] -> label; outside every bin -> NULL (PRJ-12)."""
    assert len(edges) == len(labels) + 1
    c = snap(c)
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = F.lit(True)
        if not math.isinf(lo):
            cond = cond & (c > F.lit(lo))
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def bucket_order(c, edges: Sequence[float]) -> Column:
    """Index (0-based) of the right-closed bin, NULL outside."""
    c = snap(c)
    out = None
    for i, (lo, hi) in enumerate(zip(edges[:-1], edges[1:])):
        cond = F.lit(True)
        if not math.isinf(lo):
            cond = cond & (c > F.lit(lo))
        if not math.isinf(hi):
            cond = cond & (c <= F.lit(hi))
        out = F.when(cond, F.lit(i)) if out is None else out.when(cond, F.lit(i))
    return out


def sql_bucket(expr: str, edges: Sequence[float], labels: Sequence[str]) -> str:
    """The same right-closed binning as a SQL CASE (used by the DuckDB oracle)."""
    expr = snap_sql(expr)
    parts = []
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        conds = []
        if not math.isinf(lo):
            conds.append(f"{expr} > {lo!r}")
        if not math.isinf(hi):
            conds.append(f"{expr} <= {hi!r}")
        parts.append(f"WHEN {' AND '.join(conds) or 'TRUE'} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


def half_even(c, places: int) -> Column:
    """Round half to even on the binary-scaled value (x * 10^places), with the same IEEE
    operations as ``half_even_sql`` so that Spark and SQL engines agree bit for bit."""
    scale = float(10 ** places)
    r = F.round(_c(c).cast("double"), 9) * scale   # snap last-bit noise first
    f = F.floor(r).cast("double")
    d = r - f
    up = (d > 0.5) | ((d == 0.5) & (F.pmod(f, F.lit(2.0)) == 1.0))
    return F.when(r.isNull(), F.lit(None).cast("double")).otherwise(
        F.when(up, f + 1.0).otherwise(f) / scale)


def half_even_sql(expr: str, places: int) -> str:
    scale = f"{float(10 ** places)!r}"
    r = f"(round(CAST({expr} AS DOUBLE), 9) * {scale})"
    return (f"(CASE WHEN {r} - floor({r}) > 0.5 OR ({r} - floor({r}) = 0.5 AND floor({r}) % 2 = 1) "
            f"THEN floor({r}) + 1 ELSE floor({r}) END / {scale})")
