"""Helpers shared by the operators: word patterns, checkpoints, size-checked joins and
distributed prefix sums."""

from __future__ import annotations

import string
import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import ensure_checkpoint_dir

# Words between ASCII white space (space, tab to carriage return).
SPACE_WORD = r"[^\x20\x09-\x0D]+"
# A side may be broadcast up to this many narrow rows (tens of MB); beyond it the join shuffles.
MAX_BROADCAST_ROWS = 100_000


def documents(spark, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text, null as the empty string."""
    return F.coalesce(F.col(name), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-cases A-Z only; every other character stays."""
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def ascii_lower_sql(expr: str) -> str:
    return f"translate({expr}, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared checkpoint folder."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def join_small(df: DataFrame, small: DataFrame, on, how: str = "inner",
               max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Join a side that is expected to be small: broadcast when a count shows it to hold at
    most ``max_rows`` narrow rows, else an ordinary shuffled join (AQE splits hot keys).
    ``small`` should be checkpointed, so that counting it is cheap."""
    fits = small.limit(max_rows + 1).count() <= max_rows
    return df.join(F.broadcast(small) if fits else small, on, how)


def prefix_sums(df: DataFrame, order: Sequence[str], sums: dict[str, Column]) -> DataFrame:
    """``df`` with one column per entry of ``sums``: the sum of that expression over all rows
    that stand before the row in ``order`` (0 for the first), over the whole table.

    Rows are dealt by range of the order columns, so a key that holds a third of all rows is
    spread as long as the order columns tell its rows apart (rows equal in all of them are
    told apart by a running id: their order among themselves is arbitrary). Each partition
    is summed on its own, and a table of one row per partition gives what stands before it.
    The dealt rows are checkpointed because two branches read them and both must see the
    same boundaries. Input column names must not start with ``__ps_``."""
    vals = {f"__ps_v{i}": c for i, c in enumerate(sums.values())}
    dealt = (df.select("*", *[c.cast("long").alias(n) for n, c in vals.items()],
                       F.monotonically_increasing_id().alias("__ps_id"))
             .repartitionByRange(*[F.col(f"`{o}`") for o in order], "__ps_id")
             .withColumn("__ps_part", F.spark_partition_id()))
    dealt = checkpointed(dealt)
    totals = dealt.groupBy("__ps_part").agg(*[F.sum(n).alias(n) for n in vals])
    before = Window.orderBy("__ps_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("__ps_part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(n + "o")
                                           for n in vals])
    inside = (Window.partitionBy("__ps_part").orderBy(*[F.col(f"`{o}`") for o in order], "__ps_id")
              .rowsBetween(Window.unboundedPreceding, -1))
    local = dealt.select("*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(n + "l") for n in vals])
    # one row per partition: bounded by the number of shuffle partitions
    joined = local.join(F.broadcast(offsets), "__ps_part")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns],
                         *[(F.col(n + "l") + F.col(n + "o")).alias(name)
                           for n, name in zip(vals, sums)])


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared checkpoint folder and read it back: a
    checkpoint for wide rows, columnar and compressed. The folder is the cluster's scratch space."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def scratch_folder(spark) -> str:
    """A new folder for tables in the shared checkpoint folder; ``discard`` it when they are read."""
    return f"{ensure_checkpoint_dir(spark)}/tables/{uuid.uuid4().hex}"


def discard(spark, path: str) -> None:
    """Delete a scratch folder, wherever Spark keeps it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _forest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Union-find over the links of one task: every node with its root."""
    parent: dict = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        for u, v in zip(b["u"], b["v"]):
            ru, rv = root(u), root(v)
            if ru != rv:
                parent[max(ru, rv)] = min(ru, rv)
    nodes = [x for x in parent if root(x) != x]
    yield pd.DataFrame({"u": nodes, "v": [root(x) for x in nodes]})


def components(links: DataFrame) -> DataFrame:
    """node, root for every node of ``links`` (u, v: one type) that is not its component's smallest.

    Each task first joins its own links by union-find; the forests left are merged by large-star
    and small-star rounds, as many as the logarithm of the table. The smallest neighbours are
    checkpointed before they are joined, so that both sides of the join are plain exchanges and
    a node with very many links is split over tasks."""
    kind = links.schema["u"].dataType.simpleString()
    edges = checkpointed(links.select("u", "v").mapInPandas(_forest, f"u {kind}, v {kind}").distinct())
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = checkpointed(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = (both.join(low, "u").where(F.col("v") > F.col("u"))
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct())
        large = checkpointed(large)
        low = checkpointed(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), "m").where("u <> m")
        small = checkpointed(small.unionByName(low).select("u", F.col("m").alias("v")).distinct())
        # stable when every node has one link, to a node that has none
        nodes = checkpointed(small.groupBy("u").count())
        if not small.join(nodes.select(F.col("u").alias("v")), "v", "left_semi").limit(1).count() \
                and not nodes.where("count > 1").limit(1).count():
            return small.select(F.col("u").alias("node"), F.col("v").alias("root"))
        edges = small
