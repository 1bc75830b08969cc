"""Mixing sources to target weights (operator 6): hash-random keys, a range sort within each
source, distributed prefix sums of word counts, and a cut at each source's exact budget."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import scalars
from .common import SPACE_WORD, checkpointed, documents, join_small, prefix_sums, whole_text

WEIGHTS = (3, 1, 2)
# All targets together, and the most a source may be repeated, as multiples of the sizes.
SHARE_NUM, SHARE_DEN = 3, 2
MAX_EPOCHS = 2
SEED = "mix-1"


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(SPACE_WORD)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source of ``sizes`` (source, size): its rank by code point (null last),
    weight, size, first word's place in rank order, and target.

    Targets share SHARE_NUM/SHARE_DEN of all words by weight; a target stops at MAX_EPOCHS
    times its source, and the excess is shared again among the others until none is above.
    That fixed point takes the sources in order of cap per weight: one is capped if its cap is
    at most its share of what the sources before it leave. Nothing is gathered in one task:
    ranks and running totals are distributed prefix sums. Sources without words get 0."""
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("is_null", F.col("source").isNull()))
    per = prefix_sums(per, ["is_null", "source"],
                      {"source_rank": F.lit(1), "source_start": F.col("source_size")})
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]),
                          (F.col("source_rank") % len(WEIGHTS) + 1).cast("int"))
    per = (per.withColumn("weight", weight.cast("long"))
           .withColumn("cap", F.col("source_size") * MAX_EPOCHS)
           .withColumn("cap_per_weight", F.col("cap") / F.col("weight")))
    per = checkpointed(prefix_sums(per, ["cap_per_weight", "source_rank"],
                                   {"cap_before": F.col("cap"), "weight_before": F.col("weight")}))
    totals = scalars(per.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")))
    budget = totals["size"] * SHARE_NUM / SHARE_DEN
    share = F.col("weight") * (budget - F.col("cap_before")) / (totals["weight"] - F.col("weight_before"))
    per = per.withColumn("capped", F.col("cap") <= share)
    taken = scalars(per.where("capped").agg(F.coalesce(F.sum("cap"), F.lit(0)).alias("cap"),
                                            F.coalesce(F.sum("weight"), F.lit(0)).alias("weight")))
    free = F.col("weight") * (budget - taken["cap"]) / (totals["weight"] - taken["weight"])
    return per.select("source", "source_rank", "source_start", "source_size",
                      F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(free).alias("target"))


def hash_key(doc_id: Column, seed: str) -> Column:
    return F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("null")))), 1, 16)


def mix(rows: DataFrame, seed: str = SEED) -> DataFrame:
    """``rows`` (doc_id, source, size, tie; extra columns are kept, names not starting with
    ``__``) plus source_size, target, ``taken`` and ``epochs`` and ``more``.

    Every source is put in the order of a hash of the id and cut at its rounded target:
    whole epochs first, then documents from the start of the order. ``taken`` counts words,
    so only the document on the cut is taken in part. For whole documents, ``epochs + more``
    is the number of copies: ``more`` is 1 up to the cut, the document on it included if its
    middle is. Equal ids are ordered by size and ``tie``; equal rows may swap places. Null
    ids hash like the text 'null'; null sources are a source; empty documents take 0 words."""
    rows = checkpointed(rows.withColumn("__key", hash_key(F.col("doc_id"), seed)))
    per = checkpointed(source_targets(rows)).select(
        F.col("source").alias("__source"), F.col("source_rank").alias("__rank"),
        F.col("source_start").alias("__start"), "source_size", "target")
    joined = join_small(rows, per, F.col("source").eqNullSafe(F.col("__source")), "inner")
    placed = prefix_sums(joined, ["__rank", "__key", "doc_id", "size", "tie"], {"__place": F.col("size")})
    words = F.round(F.col("target")).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(words / F.col("source_size"))).otherwise(0).cast("long")
    before = F.col("__place") - F.col("__start")
    rest = words - epochs * F.col("source_size")
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - before))
    more = F.when((rest > 0) & (before * 2 + F.col("size") <= rest * 2), 1).otherwise(0)
    return placed.select(
        *[F.col(f"`{c}`") for c in rows.columns if c != "__key"], "source_size", "target",
        (epochs * F.col("size") + part).cast("long").alias("taken"),
        epochs.cast("int").alias("epochs"), more.alias("more"))


def mix_documents(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """The mix itself: the rows of ``docs`` (doc_id, source, text and others), each as often as it is
    taken whole. Copies go by whole documents, so a source is off its target by half a document
    at most.

    In hash order a source's last partial epoch is a prefix, so one boundary row per source
    tells every document its copies and the texts are not shuffled."""
    placed = mix(document_rows(docs), seed)
    order = F.struct(hash_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id"), F.col("size"), F.col("tie"))
    per = checkpointed(placed.groupBy(F.col("source").alias("__source")).agg(
        F.max("epochs").alias("__epochs"), F.max(F.when(F.col("more") == 1, order)).alias("__last")))
    rows = join_small(docs, per, F.col("source").eqNullSafe(F.col("__source")), "inner")
    mine = F.struct(hash_key(F.col("doc_id"), seed).alias("key"), F.col("doc_id"),
                    word_count(whole_text()).alias("size"), F.md5(whole_text()).alias("tie"))
    # most rows are decided by the key alone
    key = F.col("__last.key")
    inside = F.when(F.col("__last").isNull(), 0).when(mine["key"] != key, (mine["key"] < key).cast("int")) \
        .otherwise((mine <= F.col("__last")).cast("int"))
    copies = F.col("__epochs") + inside
    return (rows.withColumn("__copies", copies).where("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


def document_rows(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", word_count(whole_text()).alias("size"),
                       F.md5(whole_text()).alias("tie"))


def op6_mixing(spark, sf_dir: str) -> DataFrame:
    out = mix(document_rows(documents(spark, sf_dir)))
    return out.select("doc_id", "size", "source_size", "target", "taken")
