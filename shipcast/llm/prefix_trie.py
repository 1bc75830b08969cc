"""The trie of conversation prefixes (operator 12), found by truncation peeling.

A node of depth d stands for one sequence of first d turns. Peeling starts at the greatest
depth: the conversations that end there meet the nodes that survive from below, rows with one
prefix are one node, its last turn is stripped, and what is left goes one level up. So
every level finds its nodes and all their sums over subtrees in one pass.

A prefix is named by 128 bits: the exclusive or of one hash for each of its turns, which depends
on the turn's place, role and text. Stripping a turn takes its hash away again, so no row
carries a prefix. Texts themselves are never shuffled, only their digests and lengths.

Levels that many conversations reach are peeled one at a time by a grouping with partial sums:
a node that a third of all rows share is pre-aggregated in every task. Deeper levels, which
few conversations reach, are peeled many at a time: a block of levels with at most
BLOCK_TURNS turns in all is grouped by the prefix above it, and each group peeled in a task."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, discard, documents, prefix_sums, scratch_folder

# The rule of the query: a conversation's first turns come from the first of its hundred.
FAMILY, HEADS = 100, 6
# Levels that at most so many different conversations reach may be peeled in blocks, of at most so many turns.
WIDE = 2_000
BLOCK_TURNS = 100_000

NODE = ("depth long, a long, b long, conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, pa long, pb long")
NODE_COLUMNS = [c.split()[0] for c in NODE.split(", ")]


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 0), role, digest (MD5 of the text), chars (code points of the text).

    Turns stand by number, null first; turns of one number by role, then by their texts' digest.
    Null roles and texts are empty; rows without a conv_id belong to no conversation."""
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
        F.md5(F.coalesce("text", F.lit(""))).alias("digest"),
        F.length(F.coalesce("text", F.lit(""))).cast("long").alias("chars"))
    ranked = checkpointed(prefix_sums(rows, ["conv_id", "turn", "role", "digest"], {"rank": F.lit(1)}))
    first = checkpointed(ranked.groupBy("conv_id").agg(F.min("rank").alias("first")))
    return ranked.join(first, "conv_id").select("conv_id", (F.col("rank") - F.col("first")).alias("pos"),
                                                "role", "digest", "chars")


def rebuilt(turns: DataFrame, family: int = FAMILY, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Turns and conversations (conv_id) after the first h turns of every conversation c are those of
    conversation c - c % family, h = crc32(c) % heads; its own follow after its first h."""
    turns = checkpointed(turns)
    sizes = checkpointed(turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")))
    convs = sizes.select("conv_id", (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
                         (F.col("conv_id") - F.col("conv_id") % family).alias("base"))
    lead = sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    convs = checkpointed(convs.join(lead, "base", "left").withColumn(
        "led", F.least("h", F.coalesce("base_n", F.lit(0)))))
    own = turns.join(convs.select("conv_id", "h", "led"), "conv_id").where("pos >= h")
    own = own.withColumn("pos", F.col("led") + F.col("pos") - F.col("h"))
    # at most ``heads`` - 1 turns for each conversation of a family
    heads_of = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base")
    borrowed = heads_of.join(convs.select("conv_id", "base", "led"), "base").where("pos < led")
    columns = ["conv_id", "pos", "role", "digest", "chars"]
    return own.select(*columns).unionByName(borrowed.select(*columns)), convs.select("conv_id")


def _peel(group: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one block of levels under one prefix: rows of conversations that end in the
    block and of nodes that survive from below it, with the turns of the block that lead to them
    (hashes and lengths). The nodes of the top level carry the prefix above as their parent."""
    low = int(group["low"].iloc[0])
    ending: dict[int, list] = {}
    for r in group.itertuples(index=False):
        ending.setdefault(r.depth, []).append(
            ((r.a, r.b), [r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ta, r.tb, r.tc]))
    out, above = [], []
    for depth in range(max(ending), low, -1):
        nodes: dict[tuple, list] = {}
        for key, row in ending.get(depth, []) + above:
            if key not in nodes:
                nodes[key] = list(row)
            else:
                node = nodes[key]
                if row[0] < node[0]:
                    node[0] = row[0]
                for i in (1, 2, 3, 4):
                    node[i] += row[i]
        above = []
        for (a, b), (conv, n, children, leaves, saved, ta, tb, tc) in nodes.items():
            at = depth - low - 1
            leaves = leaves if children else 1
            saved += (n - 1) * int(tc[at])
            parent = (a ^ int(ta[at]), b ^ int(tb[at]))
            out.append((depth, a, b, conv, n, children, leaves, saved, *parent))
            above.append((parent, [conv, n, 1, leaves, saved, ta, tb, tc]))
    return pd.DataFrame(out, columns=NODE_COLUMNS)


def _block(rows: DataFrame, turns: DataFrame, low: int, high: int) -> DataFrame:
    """The nodes of the levels low + 1 to high, of ``rows`` (depth, a, b, conv_id and sums)."""
    path = (turns.where((F.col("pos") >= low) & (F.col("pos") < high)).groupBy("conv_id")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "a", "b", "chars"))).alias("path")))
    path = path.withColumnRenamed("conv_id", "conv")
    rows = rows.join(path, F.col("conv_id") == F.col("conv"))
    rows = rows.withColumn("path", F.slice("path", 1, (F.col("depth") - low).cast("int")))

    def above(key: str):
        return F.aggregate("path", F.col(key), lambda acc, t: acc.bitwiseXOR(t[key]))

    rows = rows.select("depth", "a", "b", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                       F.lit(low).cast("long").alias("low"), F.col("path.a").alias("ta"), F.col("path.b").alias("tb"),
                       F.col("path.chars").alias("tc"), above("a").alias("a0"), above("b").alias("b0"))
    return rows.groupBy("a0", "b0").applyInPandas(_peel, NODE)


def _level(rows: DataFrame, turns: DataFrame, depth: int) -> DataFrame:
    """The nodes of one level, of ``rows`` at that level."""
    nodes = rows.groupBy("a", "b").agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).alias(c) for c in
                                             ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    last = turns.where(F.col("pos") == depth - 1).select(
        F.col("conv_id").alias("conv"), F.col("a").alias("ta"), F.col("b").alias("tb"), "chars")
    nodes = nodes.join(last, F.col("conv_id") == F.col("conv"))
    return nodes.select(
        F.lit(depth).cast("long").alias("depth"), "a", "b", "conv_id", "n_convs", "n_children",
        F.when(F.col("n_children") == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("chars")).alias("saved_tokens"),
        F.col("a").bitwiseXOR(F.col("ta")).alias("pa"), F.col("b").bitwiseXOR(F.col("tb")).alias("pb"))


def _id_chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of rows sorted by node and conv_id: the comma-joined ids of every run of a node in a batch."""
    for b in batches:
        yield (b.assign(text=b["conv_id"].astype(str)).groupby(["depth", "a", "b"], sort=False)
               .agg(first=("conv_id", "first"), text=("text", ",".join)).reset_index())


def _id_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of chunks sorted by node and first id: the SHA-256 of a node's chunks, comma-joined, fed
    into the hash one by one."""
    key = state = None
    for b in batches:
        out = []
        for *node, text in b[["depth", "a", "b", "text"]].itertuples(index=False):
            if node == key:
                state.update(b",")
            else:
                if key is not None:
                    out.append((*key, state.hexdigest()))
                key, state = node, hashlib.sha256()
            state.update(text.encode())
        yield pd.DataFrame(out, columns=["depth", "a", "b", "ends_sha256"])
    if key is not None:
        yield pd.DataFrame([(*key, state.hexdigest())], columns=["depth", "a", "b", "ends_sha256"])


def end_digests(ends: DataFrame) -> DataFrame:
    """depth, a, b, ends_sha256 of every node where conversations end (``ends``: depth, a, b,
    conv_id). Ids are sorted by range over all tasks and joined in chunks; only a node's
    chunks meet, in order, and pass through one hash (SHA-256 can't be merged)."""
    keys = ["depth", "a", "b"]
    dealt = ends.select(*keys, "conv_id").repartitionByRange(*keys, "conv_id").sortWithinPartitions(*keys, "conv_id")
    chunks = dealt.mapInPandas(_id_chunks, "depth long, a long, b long, first long, text string")
    chunks = checkpointed(chunks).repartition(*keys).sortWithinPartitions(*keys, "first")
    return chunks.mapInPandas(_id_digests, "depth long, a long, b long, ends_sha256 string")


def prefix_trie(turns: DataFrame, convs: DataFrame, wide: int = WIDE, block_turns: int = BLOCK_TURNS) -> DataFrame:
    """One row per node of the trie of ``turns`` (conv_id, pos without gaps from 0, role, digest,
    chars) over the conversations ``convs`` (conv_id, distinct; those without turns end at the
    root): conv_id (its smallest member), depth, parent_conv_id (null for the root), n_convs,
    n_children, n_leaves, saved_tokens (over the subtree: members but one, times the code points of
    the node's last turn) and ends_sha256 of the ids of the conversations that end there.

    Without conversations there are no rows, not even a root. Nulls, empty and very long texts,
    ties and repeated rows are settled by ordered_turns."""
    spark = turns.sparkSession
    hashed = turns.select("conv_id", "pos", F.xxhash64("pos", "role", "digest").alias("a"),
                          F.xxhash64("digest", F.lit("second"), "role", "pos").alias("b"), "chars")
    turns = checkpointed(hashed.repartitionByRange("pos", "conv_id"))
    ends = turns.groupBy("conv_id").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
                                        F.count(F.lit(1)).alias("depth"))
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("a", "b", "depth")]
    ends = checkpointed(convs.join(ends, "conv_id", "left").select("conv_id", *zero))
    none = [F.lit(0).cast("long").alias(c) for c in ("n_children", "n_leaves", "saved_tokens")]
    ended = checkpointed(ends.groupBy("depth", "a", "b").agg(F.min("conv_id").alias("conv_id"),
                                                             F.count(F.lit(1)).alias("n_convs")).select("*", *none))
    # one row per depth: different conversations that reach it
    reach = {r["depth"]: r["n"] for r in ended.groupBy("depth").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not reach:
        return spark.createDataFrame([], "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
                                         "n_leaves long, saved_tokens long, ends_sha256 string")
    high = max(reach)
    for depth in range(high - 1, -1, -1):
        reach[depth] = reach.get(depth, 0) + reach[depth + 1]

    folder = scratch_folder(spark)
    above, columns = None, [c for c in NODE_COLUMNS if c not in ("pa", "pb")]
    while high > 0:
        low, held = high - 1, reach[high]
        while low > 0 and reach[low] <= wide and held + reach[low] <= block_turns:
            held += reach[low]
            low -= 1
        rows = ended.where((F.col("depth") > low) & (F.col("depth") <= high)).select(*columns)
        if above is not None:
            rows = rows.unionByName(above)
        small = reach[high] <= wide and held <= block_turns
        nodes = _block(rows, turns, low, high) if small else _level(rows, turns, high)
        nodes.write.parquet(f"{folder}/{high}")
        # the level's nodes, their last turn stripped, go on as children
        done = spark.read.schema(NODE).parquet(f"{folder}/{high}").where(F.col("depth") == low + 1)
        above = done.select(F.lit(low).cast("long").alias("depth"), F.col("pa").alias("a"), F.col("pb").alias("b"),
                            "conv_id", "n_convs", F.lit(1).cast("long").alias("n_children"), "n_leaves", "saved_tokens")
        high = low
    top = ended.where("depth = 0").select(*columns)
    top = (top if above is None else top.unionByName(above)).agg(
        F.min("conv_id").alias("conv_id"), *[F.sum(c).cast("long").alias(c) for c in
                                             ("n_convs", "n_children", "n_leaves", "saved_tokens")])
    top = top.select(*[F.lit(0).cast("long").alias(c) for c in ("depth", "a", "b")], "conv_id", "n_convs", "n_children",
                     F.greatest("n_leaves", F.lit(1)).alias("n_leaves"), "saved_tokens",
                     *[F.lit(None).cast("long").alias(c) for c in ("pa", "pb")])
    top.write.parquet(f"{folder}/0")
    nodes = spark.read.schema(NODE).parquet(f"{folder}/*")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                           F.col("conv_id").alias("parent_conv_id"))
    out = (nodes.join(parents, ["depth", "pa", "pb"], "left")
           .join(end_digests(ends), ["depth", "a", "b"], "left")
           .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                   F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
    out = checkpointed(out)
    discard(spark, folder)
    return out


def op12_prefix_trie(spark, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(ordered_turns(documents(spark, sf_dir, "conversations"))))
