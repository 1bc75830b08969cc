"""Exact k-th row under a total order, and running sums, without a one-partition global sort:
rows are dealt by range of the order, and a table of one row per partition tells what stands
before each partition."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import accumulate
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def keys_at(df: DataFrame, cols: Sequence[Column | str], ranks: Callable[[int], Sequence[int]]) -> list[tuple | None]:
    """Values of ``cols`` at the 0-based ranks of their ascending lexicographic order that ``ranks``
    names once the number of rows is known, all from one exchange; None where there is no such rank."""
    names = [f"__k{i}" for i in range(len(cols))]
    data = df.select(*[(F.col(c) if isinstance(c, str) else c).alias(nm)
                       for c, nm in zip(cols, names)])
    dealt = (data.repartitionByRange(*names).withColumn("__pid", F.spark_partition_id())
             .checkpoint(eager=True))
    # one row per partition
    sizes = dealt.groupBy("__pid").agg(F.count(F.lit(1)).alias("c")).orderBy("__pid").collect()
    ends = list(accumulate(r["c"] for r in sizes))
    wanted = list(ranks(ends[-1] if ends else 0))
    homes = {}
    for k in wanted:
        at = bisect_right(ends, k)
        if 0 <= k and at < len(ends):
            homes[k] = sizes[at]["__pid"], k - (ends[at] - sizes[at]["c"]) + 1
    if not homes:
        return [None] * len(wanted)
    rank = F.row_number().over(Window.partitionBy("__pid").orderBy(*names))
    rows = (dealt.where(F.col("__pid").isin(*{pid for pid, _ in homes.values()})).withColumn("__r", rank)
            .where(reduce(or_, [(F.col("__pid") == pid) & (F.col("__r") == r) for pid, r in homes.values()])).collect())
    found = {(row["__pid"], row["__r"]): tuple(row[c] for c in names) for row in rows}
    return [found[homes[k]] if k in homes else None for k in wanted]


def kth_key(df: DataFrame, cols: Sequence[Column | str], k: int) -> tuple:
    """Values of ``cols`` at 0-based rank k of their ascending lexicographic order."""
    key, = keys_at(df, cols, lambda n: [k])
    if key is None:
        raise IndexError(f"no row at rank {k}")
    return key


def global_running_sum(df: DataFrame, order: Sequence[Column], value: str) -> DataFrame:
    """Global 1-based rank (``__rank``) and running sum of ``value`` (``__cum``) under a total
    order, without a one-partition window: rows are range-partitioned on the order (balanced
    by sampling; the order must be total, e.g. end with a unique id), each partition computes
    its local running values, and the per-partition totals (one row per partition) give the
    offsets through a window over that tiny table."""
    # checkpointed: read by two branches below, and a re-executed range exchange could
    # sample different boundaries (row order after a shuffle is not deterministic)
    r = df.repartitionByRange(*order).withColumn("__pid", F.spark_partition_id()) \
          .checkpoint(eager=True)
    lw = Window.partitionBy("__pid").orderBy(*order)
    local = r.select("*", F.row_number().over(lw).alias("__lrank"),
                     F.sum(value).over(lw.rowsBetween(Window.unboundedPreceding, 0)).alias("__lsum"))
    tot = local.groupBy("__pid").agg(F.max("__lrank").alias("__pcnt"), F.sum(value).alias("__psum"))
    before = Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)
    off = tot.select("__pid", F.coalesce(F.sum("__pcnt").over(before), F.lit(0)).alias("__roff"),
                     F.coalesce(F.sum("__psum").over(before), F.lit(0)).alias("__soff"))
    # ``off`` has one row per partition (bounded by the partition count): broadcast it
    out = local.join(F.broadcast(off), "__pid")
    return out.select(*df.columns, (F.col("__roff") + F.col("__lrank")).alias("__rank"),
                      (F.col("__soff") + F.col("__lsum")).alias("__cum"))
