"""Exact, interpolated quantiles (pandas ``quantile`` / DuckDB ``quantile_cont`` semantics) by
radix selection.

A double becomes a 64-bit integer of the same order. The first pass counts the values by their
leading bits, group and column; running counts tell which of these buckets hold the ranks around
the quantiles. The passes that follow count inside those buckets only, by more bits, until a bucket
is one value. All columns and probabilities share the passes; counts move between the tasks,
values do not, and a group that has a third of all rows is counted in every task.

The open buckets (a few a group) are sent to the tasks. Where the groups are too many for that, or
their keys are not plain values, equal values are counted and dealt by range of (group, value), and one
row per (partition, group) tells how many rows of the group stand before it."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Bits that are left after each pass.
SHIFTS = (42, 21, 0)
# Open buckets that are sent to the tasks, at most.
OPEN_BUCKETS = 100_000
# With this many rows in all open buckets or fewer, the next pass counts single values.
LAST_ROWS = 200_000
# Types of keys that a JSON string holds without loss.
_PLAIN = (T.StringType, T.IntegralType, T.BooleanType, T.DateType)


def ordered_bits(x: np.ndarray) -> np.ndarray:
    """Integers in the order of the doubles ``x``; both zeros are one."""
    bits = (x + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.iinfo(np.int64).max)


def from_ordered_bits(key: int) -> float:
    bits = np.array([key], np.int64)
    return float((bits ^ ((bits >> 63) & np.iinfo(np.int64).max)).view(np.float64)[0])


def _counted(rows: DataFrame, n_cols: int, shift: int, inside: tuple[int, dict] | None) -> DataFrame:
    """g, c, bucket, n: rows of every group and column by the bits above ``shift``. ``inside``: the shift
    of the last pass and, by (group, column), its open buckets; other rows are not counted.
    The first pass has a row without bucket for every group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column(0).dictionary_encode()
            code = groups.indices.to_numpy(zero_copy_only=False)
            names = groups.dictionary.to_pylist()
            for c in range(n_cols):
                x = batch.column(1 + c).to_numpy(zero_copy_only=False)
                ok = ~np.isnan(x)
                key = ordered_bits(x[ok])
                f = pd.DataFrame({"g": code[ok], "bucket": key >> shift})
                if inside:
                    last, opened = inside
                    pairs = [(i, b) for i, name in enumerate(names) for b in opened.get((name, c), ())]
                    known = pd.DataFrame(pairs, columns=["g", "b"], dtype=np.int64)
                    f = f.assign(b=key >> last).merge(known, on=["g", "b"])
                found = f.groupby(["g", "bucket"]).size()
                g = found.index.get_level_values(0).to_numpy().tolist()
                bucket, n = found.index.get_level_values(1).to_numpy().tolist(), found.to_numpy().tolist()
                if not inside:
                    g, bucket, n = g + list(range(len(names))), bucket + [None] * len(names), n + [0] * len(names)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i in g], pa.string()), pa.array([c] * len(g), pa.int32()),
                     pa.array(bucket, pa.int64()), pa.array(n, pa.int64())], ["g", "c", "bucket", "n"])

    parts = rows.mapInArrow(run, "g string, c int, bucket long, n long")
    return parts.groupBy("g", "c", "bucket").agg(F.sum("n").alias("n"))


def _selected(rows: DataFrame, n_cols: int, probs: Sequence[float]) -> dict[tuple[str, int], list] | None:
    """The quantiles of every (group, column); None if the groups are too many."""
    spark = rows.sparkSession
    found: dict[tuple[str, int], list] = {}
    ends = lambda n, p: (math.floor((n - 1) * p), math.ceil((n - 1) * p))
    inside, opened, sizes = None, None, {}
    shifts = list(SHIFTS)
    while shifts:
        shift = shifts.pop(0)
        counted = _counted(rows, n_cols, shift, inside)
        if opened is None:
            part = Window.partitionBy("g", "c")
            size = F.sum("n").over(part)
            ranks = [f((F.col("size") - 1) * F.lit(float(p))) for p in probs for f in (F.floor, F.ceil)]
            ranked = counted.withColumn("size", size).select(
                "*", F.lit(None).cast("long").alias("parent"), F.array_distinct(F.array(*ranks)).alias("ranks"))
        else:
            # at most OPEN_BUCKETS rows
            asked: dict[tuple, list] = {}
            for g, c, bucket, rank in opened:
                asked.setdefault((g, c, bucket), []).append(rank)
            some = spark.createDataFrame([(*k, v) for k, v in asked.items()],
                                         "g string, c int, parent long, ranks array<long>")
            part = Window.partitionBy("g", "c", "parent")
            ranked = (counted.withColumn("parent", F.shiftright("bucket", last - shift))
                      .join(F.broadcast(some), ["g", "c", "parent"]).withColumn("size", F.lit(None).cast("long")))
        upto = F.sum("n").over(part.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0))
        placed = ranked.select("*", (upto - F.col("n")).alias("start"))
        hit = F.filter("ranks", lambda r: (r >= F.col("start")) & (r < F.col("start") + F.col("n")))
        hits = (placed.select("g", "c", "parent", "bucket", "n", "size", "start", hit.alias("hit"))
                .where((F.size("hit") > 0) | (F.col("size") == 0)).limit(OPEN_BUCKETS + 1).collect())
        if len(hits) > OPEN_BUCKETS:
            return None
        if opened is None:
            sizes = {(r["g"], r["c"]): r["size"] for r in hits}
            # by bucket and rank in it: the rank in its group
            whole = {(r["g"], r["c"], r["bucket"], k - r["start"]): [k] for r in hits for k in r["hit"]}
        else:
            # a rank in the bucket of the last pass stands for ranks in the group
            before, whole = whole, {}
            for r in hits:
                for k in r["hit"]:
                    whole.setdefault((r["g"], r["c"], r["bucket"], k - r["start"]), []).extend(
                        before[r["g"], r["c"], r["parent"], k])
        opened, last = sorted(whole), shift
        by_group: dict[tuple, set] = {}
        for g, c, bucket, _ in opened:
            by_group.setdefault((g, c), set()).add(bucket)
        inside = shift, by_group
        if sum(r["n"] for r in hits) <= LAST_ROWS:
            shifts = shifts[-1:]
    value = {(g, c, k): from_ordered_bits(bucket) for (g, c, bucket, _), ks in whole.items() for k in ks}
    for (g, c), n in sizes.items():
        out = []
        for p in probs:
            lo, hi = ((value[g, c, k] for k in ends(n, p)) if n else (None, None))
            h = (n - 1) * float(p)
            out.append(lo + (h - math.floor(h)) * (hi - lo) if n else None)
        found[g, c] = out
    return found


def column_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> dict[str, list]:
    """The quantiles of several columns of all rows, by column; None where a column has no value.
    NULL and NaN values are skipped."""
    rows = df.select(F.lit("").alias("g"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    found = _selected(rows, len(cols), probs)
    return {c: found.get(("", i), [None] * len(probs)) for i, c in enumerate(cols)}


def _same(left: str, right: str, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def quantiles(df: DataFrame, value, probs: Mapping[str, float],
              keys: Sequence[str] = ()) -> DataFrame:
    """One row per group (or one row overall) with a column per requested probability.

    NULL and NaN values are skipped; an all-missing group gives NULL quantiles."""
    keys = list(keys)
    x = F.col(value) if isinstance(value, str) else value
    typed = df.select(*keys).schema
    if all(isinstance(f.dataType, _PLAIN) for f in typed):
        g = F.to_json(F.struct(*keys), {"ignoreNullFields": "false"}) if keys else F.lit("")
        found = _selected(df.select(g.alias("g"), x.cast("double").alias("x0")), 1, list(probs.values()))
        if found is not None:
            if not keys:
                found.setdefault(("", 0), [None] * len(probs))
            names = [f"__q{i}" for i in range(len(probs))]
            out = df.sparkSession.createDataFrame([(g, *q) for (g, _), q in found.items()],
                                                  ", ".join(["__g string", *[f"{n} double" for n in names]]))
            back = F.from_json("__g", typed)
            return out.select(*[back[k].alias(k) for k in keys], *[F.col(n).alias(p) for n, p in zip(names, probs)])
    return _dealt(df, x, probs, keys)


def _dealt(df: DataFrame, x: Column, probs: Mapping[str, float], keys: list[str]) -> DataFrame:
    # NULL and NaN are both missing values (pandas skips NaN in quantiles)
    data = df.select(*keys, x.cast("double").alias("__x")).where(
        F.col("__x").isNotNull() & ~F.isnan("__x"))
    counted = data.groupBy(*keys, "__x").agg(F.count(F.lit(1)).alias("__c"))
    # checkpointed: two branches read the dealt rows and must see the same boundaries
    dealt = (counted.repartitionByRange(*keys, "__x").withColumn("__pid", F.spark_partition_id())
             .checkpoint(eager=True))
    part = ["__pid", *keys]
    sums = dealt.groupBy(*part).agg(F.sum("__c").alias("__pc"))
    group = Window.partitionBy(*keys)
    before = group.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*part, F.coalesce(F.sum("__pc").over(before), F.lit(0)).alias("__before"),
                       F.sum("__pc").over(group).alias("__n"))
    upto = Window.partitionBy(*part).orderBy("__x").rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.select("*", F.sum("__c").over(upto).alias("__upto"))
    placed = local.alias("l").join(sums.alias("s"), _same("l", "s", part)).select(
        *[F.col(f"l.{k}") for k in keys], "__x", "__n",
        (F.col("__before") + F.col("__upto")).alias("__end"),
        (F.col("__before") + F.col("__upto") - F.col("__c")).alias("__start"))
    aggs = [F.max("__n").alias("__n")]
    for i, p in enumerate(probs.values()):
        h = (F.col("__n") - 1) * F.lit(float(p))
        for side, rank in (("lo", F.floor(h)), ("hi", F.ceil(h))):
            inside = (F.col("__start") <= rank) & (rank < F.col("__end"))
            aggs.append(F.max(F.when(inside, F.col("__x"))).alias(f"__{side}{i}"))
    found = placed.groupBy(*keys).agg(*aggs)
    cols = []
    for i, (name, p) in enumerate(probs.items()):
        h = (F.col("__n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        cols.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    out = found.select(*keys, *cols)
    if not keys:
        return out
    # groups whose values are all missing still get a row (with NULL quantiles)
    every = df.select(*keys).distinct()
    return every.alias("e").join(out.alias("o"), _same("e", "o", keys), "left").select(
        *[F.col(f"e.{k}") for k in keys], *list(probs))
