"""Registry of queries: SURVEY section 2 id -> (Spark callable, DuckDB oracle SQL).

Each callable takes ``(spark, sf_dir)`` and returns a lazy DataFrame whose columns carry
plain types (BIGINT, DOUBLE rounded for cross-engine comparison, STRING, BOOLEAN)."""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from ..sources.tables import Market, load_market
from .oracle_views import with_views

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(key: str, sql: str | None = None, extra_ctes: str = ""):
    """Register ``fn`` under ``key``; ``sql`` (DuckDB dialect, may use the v_* views) is its
    oracle. Queries without SQL get the driver's rows-only check."""

    def deco(fn: QueryFn) -> QueryFn:
        if key in QUERIES:
            raise ValueError(f"duplicate query id {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = with_views(stable_rounding(half_even_rounding(sql)), extra_ctes)
        return fn

    return deco


def stable_rounding(sql: str, places: int = 6) -> str:
    """Rewrite every ``round(<expr>, 6)`` as ``floor(round(<expr>, 9) * 1e6 + 0.5) / 1e6``, the
    twin of ``finalize``. Engines disagree on ties: one rounds the exact decimal form of a
    double (0.0010105 -> 0.001011), the other scales in binary first (-> 0.00101), and sums
    taken in a different order differ in the last bit. Snapping to 9 places and then doing
    the same three IEEE operations in both engines gives bit-identical results."""
    out, i, pat = [], 0, "round("
    while True:
        j = sql.find(pat, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(pat)
        while depth and k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(pat):k - 1]
        # split off the last top-level argument
        d, cut = 0, -1
        for idx, ch in enumerate(inner):
            d += {"(": 1, ")": -1}.get(ch, 0)
            if ch == "," and d == 0:
                cut = idx
        if cut >= 0 and inner[cut + 1:].strip() == str(places):
            expr = stable_rounding(inner[:cut], places)
            scale = f"1e{places}"
            out.append(sql[i:j] + f"(floor(round({expr}, 9) * {scale} + 0.5) / {scale})")
        else:
            out.append(sql[i:j] + pat + stable_rounding(inner, places) + ")")
        i = k


def half_even_rounding(sql: str) -> str:
    """Rewrite ``round_even(<expr>, n)`` as the IEEE half-even expression of
    ``functions.exprs.half_even_sql`` (the twin of the Spark-side ``half_even``)."""
    from ..functions.exprs import half_even_sql
    out, i, pat = [], 0, "round_even("
    while True:
        j = sql.find(pat, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(pat)
        while depth and k < len(sql):
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = sql[j + len(pat):k - 1]
        d, cut = 0, -1
        for idx, ch in enumerate(inner):
            d += {"(": 1, ")": -1}.get(ch, 0)
            if ch == "," and d == 0:
                cut = idx
        out.append(sql[i:j] + half_even_sql(half_even_rounding(inner[:cut]), int(inner[cut + 1:].strip())))
        i = k


@lru_cache(maxsize=8)
def _market(spark: SparkSession, sf_dir: str) -> Market:
    return load_market(spark, sf_dir)


def market(spark: SparkSession, sf_dir: str) -> Market:
    return _market(spark, sf_dir.rstrip("/"))


_PERSISTED: dict[tuple, DataFrame] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """Build once per (application, dataset) and keep as a Parquet table in the shared checkpoint folder:
    that cuts the lineage (later plans and their scalar subqueries stay small) and survives the loss of an
    executor. Rows are wide; columnar files are a fraction of a checkpoint, and readers take the columns they use."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _PERSISTED if k[0] != app]:    # frames of ended applications
        del _PERSISTED[old]
    key = (app, sf_dir.rstrip("/"), name)
    if key not in _PERSISTED:
        built = build()
        path = scratch_path(spark, f"shared/{app}/{folder_tag(sf_dir)}/{name}-{uuid.uuid4().hex}")
        built.write.parquet(path)
        _PERSISTED[key] = spark.read.schema(built.schema).parquet(path)
    return _PERSISTED[key]


def derived(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """As ``shared``, for a frame that is a projection or filter of a stored one: it is planned once, its rows are
    not written again."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)
    if key not in _PERSISTED:
        _PERSISTED[key] = build()
    return _PERSISTED[key]


def folder_tag(sf_dir: str) -> str:
    """A name for a data folder in scratch paths: of two folders of one name, each has its own."""
    folder = sf_dir.rstrip("/")
    return f"{os.path.basename(folder)}-{hashlib.md5(folder.encode()).hexdigest()[:8]}"


def forget() -> None:
    """Drop every frame and run kept between queries (the bench times each query alone)."""
    _PERSISTED.clear()
    _market.cache_clear()


def finalize(df: DataFrame, places: int = 6) -> DataFrame:
    """Plain output types: integers -> BIGINT, floating -> DOUBLE rounded to ``places``,
    timestamps -> text."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            r = F.round(c.cast("double"), 9)
            scale = float(10 ** places)
            c = F.when(F.isnan(r) | r.isin(float("inf"), float("-inf")), r).otherwise(
                F.floor(r * scale + 0.5) / scale)
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def ts_sql(expr: str) -> str:
    """DuckDB twin of the timestamp rendering in ``finalize``."""
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"


def days_sql(end: str, start: str) -> str:
    """DuckDB twin of ``timeops.frac_days``."""
    return f"((epoch_us({end}) - epoch_us({start})) / 86400e6)"


def floor_days_sql(end: str, start: str) -> str:
    return f"CAST(floor({days_sql(end, start)}) AS BIGINT)"


def hist_sql(source: str, expr: str, bins: int, lo_clip=None, hi_clip=None) -> str:
    """DuckDB twin of ``reports.histogram`` without groups."""
    x = f"CAST({expr} AS DOUBLE)"
    if lo_clip is not None:
        x = f"greatest(least({x}, {hi_clip}), {lo_clip})"
    return f"""WITH v AS (SELECT {x} AS x FROM {source} WHERE {expr} IS NOT NULL),
 r AS (SELECT CASE WHEN max(x) = min(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
   CASE WHEN max(x) = min(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v),
 c AS (SELECT CAST(least(floor((x - lo) / (hi - lo) * {bins}), {bins - 1}) AS BIGINT) AS bin, count(*) AS cnt FROM v, r GROUP BY 1),
 g AS (SELECT range AS bin FROM range({bins}))
 SELECT g.bin, round(lo + g.bin * ((hi - lo) / {bins}), 6) AS bin_low, round(lo + (g.bin + 1) * ((hi - lo) / {bins}), 6) AS bin_high,
 coalesce(c.cnt, 0) AS count FROM g CROSS JOIN r LEFT JOIN c ON g.bin = c.bin"""
