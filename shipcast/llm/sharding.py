"""Byte-balanced contiguous shards from global prefix sums (operator 9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import scalars
from .common import documents, prefix_sums, whole_text

SHARDS = 8


def shard_by_bytes(rows: DataFrame, size: str, order: list[str], n_shards: int) -> DataFrame:
    """``rows`` plus ``shard`` (0 .. n_shards-1) and ``slot`` (gapless from 0 in each shard).

    Rows are put in ``order``; the global prefix sum of ``size`` is cut at equal targets, and
    a row goes to the shard that holds its middle byte, so a shard differs from the target by
    at most one row at either end. Equal rows may swap places. A row larger than a target
    leaves neighbouring shards empty; an empty table gives an empty result. ``size`` must be
    positive and not null; extra columns are kept, their names must not start with ``__``."""
    placed = prefix_sums(rows, order, {"__before": F.col(size), "__row": F.lit(1)})
    total = placed.agg(F.max(F.col("__before") + F.col(size)).alias("total"))
    middle = (F.col("__before") * 2 + F.col(size)) * n_shards
    placed = placed.withColumn("shard", F.floor(middle / (scalars(total)["total"] * 2)).cast("int"))
    # one row per shard
    starts = placed.groupBy("shard").agg(F.min("__row").alias("__start"))
    return (placed.join(F.broadcast(starts), "shard")
            .withColumn("slot", F.col("__row") - F.col("__start"))
            .select(*[F.col(f"`{c}`") for c in rows.columns], "shard", "slot"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, size (UTF-8 bytes + 1; null text counts as empty) and CRC-32 of the text."""
    return docs.select("doc_id", (F.octet_length(whole_text()) + 1).cast("long").alias("size"),
                       F.crc32(F.encode(whole_text(), "UTF-8")).alias("text_crc32"))


def op9_sharding(spark, sf_dir: str) -> DataFrame:
    narrow = document_sizes(documents(spark, sf_dir))
    out = shard_by_bytes(narrow, "size", ["doc_id", "size", "text_crc32"], SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))
