"""MinHash near-dedup (operator 8): SuperMinHash signatures, banding, verification on full sets
and union-find grouping.

A document's set holds its distinct five-word shingles (64-bit hashes); two documents are
linked if 100 * |A and B| >= percent * |A or B|. Rows with one set form one class, so exact
copies never meet as pairs. Classes that agree in a whole band of their signatures share a
bucket; a link of similarity 0.85 misses all buckets with probability 3e-8, one of 0.80 with 7e-6.

No bucket is expanded into its pairs and none is capped:
1. every member of a bucket is verified against the bucket's hub, the member that shares most
   buckets with others (a star, as many pairs as members);
2. the links found are contracted to components, and buckets inside one component are done;
3. in the others, members of different components are compared in blocks: under every hub,
   those outside its largest component with each other and with that component. A task
   holds the sets of two blocks and answers with links only, so no pairs travel.
So every pair of a bucket is linked, verified apart, bounded apart or already together. The
cost beyond linear is step 3: members times blocks of one hub, for groups of similar texts that
the limit splits into many components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, documents, join_small, whole_text

SHINGLE = 5
# Two sets are linked at this similarity, in per cent, unless the caller says otherwise.
PERCENT = 85
# The bands are laid out for limits from here on; a lower one would miss links.
LEAST_PERCENT = 80
BANDS, ROWS = 30, 5
SLOTS = BANDS * ROWS
# Elements that hold a permutation at a time; words whose hashes are remembered.
CHUNK = 40_000
MEMO_WORDS = 300_000
# Sets and shingles of a block; columns of the 0/1 matrix that a task holds at a time.
BLOCK_NODES, BLOCK_SHINGLES, COLUMNS = 128, 60_000, 8192
# Ids (8 bytes each) that may be broadcast to pick the rows whose sets are verified.
MAX_IDS = 1_000_000

_U = np.uint64
_GOLD = _U(0x9E3779B97F4A7C15)
_WEIGHTS = np.array([(0xD1B54A32D192ED03 * (2 * i + 1) ** 3) % 2**64 | 1 for i in range(SHINGLE)], _U)


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that scrambles 64 bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: str | None, memo: dict[bytes, int]) -> np.ndarray:
    """The sorted distinct shingle hashes of one whole text; empty without words."""
    import xxhash       # found when first used

    words = (text or "").encode("utf-8", "replace").lower().split()     # bytes: ASCII rules only
    if not words:
        return np.zeros(0, _U)
    if len(memo) > MEMO_WORDS:
        memo.clear()
    for w in set(words):
        if w not in memo:
            memo[w] = xxhash.xxh3_64_intdigest(w)
    h = np.fromiter(map(memo.__getitem__, words), _U, len(words))
    k = min(SHINGLE, len(h))
    total = np.zeros(len(h) - k + 1, _U)
    for i in range(k):
        total += h[i:len(h) - k + 1 + i] * _WEIGHTS[i]
    return np.unique(mix(total + _U(k)))


def super_minhash(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """SuperMinHash signatures, one row per set (no set may be empty).

    Each element owns a random permutation of the slots, drawn step by step; in step j it
    offers the value j + (a random fraction) to the slot that its permutation puts j-th. A slot
    keeps its minimum. Once every slot of a set holds a value below j + 1, later steps cannot
    change it and the set stops. Values are kept as 8 bits of step and 24 bits of fraction."""
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if sets else np.zeros(0, _U)
    sig = np.full((len(sets), slots), np.iinfo(np.uint32).max, np.uint32)
    flat = sig.reshape(-1)
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(x), 1))
    for j in range(slots):
        if not len(x):
            break
        h = mix(x + _U((j + 1) * int(_GOLD) % 2**64))
        k = j + ((h & _U(0xFFFFFFFF)) * _U(slots - j) >> _U(32)).astype(np.int64)
        rows = np.arange(len(x))
        slot = order[rows, k]
        order[rows, k] = order[:, j]
        value = ((h >> _U(40)) | _U(j << 24)).astype(np.uint32)
        np.minimum.at(flat, owner * slots + slot, value)
        open_ = (sig >= np.uint32((j + 1) << 24)).any(axis=1)[owner] if j + 1 < slots else np.zeros(len(x), bool)
        if not open_.all():
            x, owner, order = x[open_], owner[open_], order[open_]
    return sig


def bands(sig: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    parts = sig.reshape(len(sig), BANDS, ROWS).astype(_U)
    key = np.tile(np.arange(1, BANDS + 1, dtype=_U) * _GOLD, (len(sig), 1))
    for i in range(ROWS):
        key = mix(key + parts[:, :, i] * _GOLD + _U(i))
    return key.view(np.int64)


def digest(s: np.ndarray) -> bytes:
    """128 bits that name a set."""
    return hashlib.blake2b(s.tobytes(), digest_size=16).digest()


def _signed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict[bytes, int] = {}
    for b in batches:
        sets = [shingles(t, memo) for t in b["text"]]
        keys: list[np.ndarray | None] = [None] * len(sets)
        at = 0
        while at < len(sets):
            size, end = 0, at
            while end < len(sets) and (end == at or size + len(sets[end]) <= CHUNK):
                size += len(sets[end])
                end += 1
            some = [i for i in range(at, end) if len(sets[i])]
            if some:
                for i, row in zip(some, bands(super_minhash([sets[i] for i in some]))):
                    keys[i] = row
            at = end
        yield pd.DataFrame({
            "doc_id": b["doc_id"], "text_key": b["text_key"], "n": [len(s) for s in sets],
            "fp": [digest(s) if len(s) else None for s in sets], "keys": keys})


def _sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    memo: dict[bytes, int] = {}
    for b in batches:
        for at in range(0, len(b), 500):
            sets = [shingles(t, memo) for t in b["text"].iloc[at:at + 500]]
            sets = [s for s in sets if len(s)]
            yield pd.DataFrame({"fp": [digest(s) for s in sets], "shingles": [s.view(np.int64) for s in sets]})


def linked(inter: Column, n: Column, m: Column, percent: int = PERCENT) -> Column:
    return inter * 100 >= (n + m - inter) * percent


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (u, v) with n_u, n_v and inter, the size of the intersection of the full sets."""
    left = sets.select(F.col("fp").alias("u"), F.col("shingles").alias("a"))
    right = sets.select(F.col("fp").alias("v"), F.col("shingles").alias("b"))
    both = pairs.join(left, "u").join(right, "v")
    return both.select("u", "v", F.size("a").alias("n_u"), F.size("b").alias("n_v"),
                       F.size(F.array_intersect("a", "b")).alias("inter"))


def _compare(p: pd.DataFrame, percent: int) -> pd.DataFrame:
    """The links between different components among the sets of one task, all compared exactly;
    of links that join the same components one is enough."""
    sets = [np.asarray(x) for x in p["shingles"]]
    sizes = np.array([len(x) for x in sets])
    _, place, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    twice = times > 1
    column = np.cumsum(twice) - 1
    held = twice[place]
    owner, column = owner[held], column[place[held]]
    inter = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(twice.sum()), COLUMNS):
        mine = (column >= at) & (column < at + COLUMNS)
        has = np.zeros((len(sets), COLUMNS), np.float32)
        has[owner[mine], column[mine] - at] = 1
        inter += has @ has.T
    either = sizes[:, None] + sizes[None, :] - inter
    pairs = np.argwhere(np.triu(inter * 100 >= either * percent, 1))
    fps, roots = [bytes(x) for x in p["fp"]], [bytes(x) for x in p["root"]]
    parent: dict[bytes, bytes] = {}

    def top(x: bytes) -> bytes:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in pairs.tolist():
        a, b = top(roots[i]), top(roots[j])
        if a != b:
            parent[max(a, b)] = min(a, b)
            out.append((fps[i], fps[j]))
    return pd.DataFrame(out, columns=["u", "v"])


def block_links(nodes: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Links (u, v) between different components of ``nodes`` (hub, fp, n, root), as many as join
    them, among all pairs of nodes under one hub.

    A node of whose shingles other nodes hold less than ``percent`` has no link and goes. Under each
    hub, nodes outside its largest component are compared with each other and with that
    component, block by block: a node travels once for every block it meets, and a task
    holds the sets of two blocks, compares them in memory and answers with links only."""
    single = (sets.join(nodes.select("fp").distinct(), "fp", "left_semi")
              .select("fp", F.explode("shingles").alias("shingle"))
              .groupBy("shingle").agg(F.count(F.lit(1)).alias("c"), F.min("fp").alias("fp")).where("c = 1")
              .groupBy("fp").agg(F.count(F.lit(1)).alias("single")))
    alive = nodes.join(single, "fp", "left").where(
        (F.col("n") - F.coalesce("single", F.lit(0))) * 100 >= F.col("n") * percent).drop("single")
    alive = checkpointed(alive)
    # what is known of a hub is checkpointed before it is joined: then both sides of the join are
    # plain exchanges, and the many nodes of one hub are split over tasks
    largest = checkpointed(alive.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("c"))
               .groupBy("hub").agg(F.max(F.struct("c", "root")).alias("top"))
               .select("hub", F.col("top.root").alias("main")))
    alive = checkpointed(alive.join(largest, "hub").withColumn("rest", F.col("root") != F.col("main")))

    def blocks(flag: Column) -> Column:
        n = F.sum(F.when(flag, F.col("n")).otherwise(0))
        return F.ceil(F.greatest(F.count_if(flag) / BLOCK_NODES, n / BLOCK_SHINGLES)).cast("int")

    sizes = alive.groupBy("hub").agg(blocks(F.col("rest")).alias("rests"), blocks(~F.col("rest")).alias("mains"))
    alive = alive.join(checkpointed(sizes.where("rests > 0")), "hub")
    mine = F.pmod(F.xxhash64("fp"), F.when(F.col("rest"), F.col("rests")).otherwise(F.col("mains"))).cast("int")

    def meet(count: str, task) -> Column:
        none = F.expr("cast(array() as array<struct<kind:int,i:int,j:int>>)")
        return F.when(F.col(count) > 0, F.transform(F.sequence(F.lit(0), F.col(count) - 1), lambda other: F.struct(
            *[x.cast("int").alias(n) for n, x in zip(("kind", "i", "j"), task(other))]))).otherwise(none)

    tasks = F.when(F.col("rest"), F.concat(
        meet("rests", lambda o: (F.lit(0), F.least(F.col("mine"), o), F.greatest(F.col("mine"), o))),
        meet("mains", lambda o: (F.lit(1), F.col("mine"), o)))).otherwise(
        meet("rests", lambda o: (F.lit(1), o, F.col("mine"))))
    sent = alive.withColumn("mine", mine).select("hub", "fp", "root", F.explode(tasks).alias("task"))
    sent = sent.select("hub", "fp", "root", "task.*").join(sets, "fp")
    return sent.groupBy("hub", "kind", "i", "j").applyInPandas(
        lambda p: _compare(p, percent), "u binary, v binary")


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns ignored): doc_id, text_key (a
    64-bit hash of the text), n_shingles and component_id, the smallest doc_id among the rows
    that links of ``percent`` similarity or more reach, the row's own included.

    Rows without words (null, empty, white space) have no shingles and stay alone. Repeated
    rows and repeated ids are rows like others; a null id never names a component that has
    another id, and a component of null ids only is named null. An empty table gives no rows."""
    return _grouped(docs, percent).drop("root")


def _grouped(docs: DataFrame, percent: int) -> DataFrame:
    """The rows of near_duplicates with root, the set that tells their component from others of
    one name (repeated and null ids); null without shingles."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"the limit must be at least {LEAST_PERCENT} per cent, not {percent}")
    rows = docs.select("doc_id", whole_text().alias("text"), F.xxhash64(whole_text()).alias("text_key"))
    rows = checkpointed(rows.mapInPandas(
        _signed, "doc_id long, text_key long, n long, fp binary, keys array<long>"))
    # one row a class: copies go before their keys are dealt to buckets
    classes = checkpointed(rows.where(F.col("fp").isNotNull()).groupBy("fp").agg(
        F.min("doc_id").alias("label"), F.first("n").cast("int").alias("n"), F.first("keys").alias("keys")))

    # buckets of two classes or more
    members = checkpointed(classes.select("fp", "n", F.explode("keys").alias("key")))
    classes = classes.select("fp", "label")
    sizes = members.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = checkpointed(members.join(sizes, "key"))
    central = shared.groupBy("fp").agg(F.sum("size").alias("weight"))
    hubs = (shared.join(central, "fp").groupBy("key")
            .agg(F.max(F.struct("weight", "n", "fp")).alias("top"))
            .select("key", F.col("top.fp").alias("hub")))
    shared = checkpointed(shared.join(hubs, "key").select("key", "fp", "n", "hub"))

    # the sets of all classes in shared buckets, made again from the texts of their rows
    wanted = checkpointed(shared.select("fp").distinct())
    ids = checkpointed(classes.join(wanted, "fp", "left_semi").select(F.col("label").alias("__id")).distinct())
    texts = join_small(docs.select("doc_id", whole_text().alias("text")), ids,
                       F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi", MAX_IDS)
    sets = texts.select("text").mapInPandas(_sets, "fp binary, shingles array<long>")
    sets = checkpointed(sets.join(wanted, "fp", "left_semi").groupBy("fp").agg(F.first("shingles").alias("shingles")))

    stars = shared.where("fp <> hub").select(F.col("fp").alias("u"), F.col("hub").alias("v")).distinct()
    stars = checkpointed(verify(stars, sets))
    links = stars.where(linked(F.col("inter"), F.col("n_u"), F.col("n_v"), percent)).select("u", "v")
    roots = components(links)

    # members of buckets that more than one component shares
    placed = (shared.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    open_ = (placed.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("b"))
             .where("a <> b").select("key"))
    placed = checkpointed(placed.join(open_, "key").select("hub", "fp", "n", "root").distinct())
    more = checkpointed(block_links(placed, sets, percent))
    roots = components(links.unionByName(more))

    named = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    names = named.groupBy("root").agg(F.min("label").alias("component_id"))
    named = checkpointed(named.join(names, "root").select("fp", "root", "component_id"))
    out = rows.drop("keys").join(named, "fp", "left")
    return out.select("doc_id", "text_key", F.col("n").alias("n_shingles"),
                      F.when(F.col("fp").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
                      .alias("component_id"), "root")


def drop_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: of every component one row, of the
    smallest doc_id (of its texts under that id the one of the smallest hash, of repeated rows any
    one). Rows without words have no component and all stay. Columns of ``docs`` must not start with ``__``."""
    rows = _grouped(docs, percent)
    stay = (rows.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("root", F.col("doc_id").alias("__id"), F.col("text_key").alias("__key"))
            .agg(F.count(F.lit(1)).alias("__n"), F.max("n_shingles").alias("__size")))
    alone = [F.when(F.col("root").isNull(), F.col(c)) for c in ("__id", "__key")]       # no shingles: all stay
    stay = (stay.groupBy("root", *alone).agg(F.min(F.struct("__key", "__id", "__n", "__size")).alias("first"))
            .select("first.*"))
    stay = checkpointed(stay)
    on = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64(whole_text()) == F.col("__key"))
    kept = docs.join(stay.where("__n = 1 OR __size = 0").select("__id", "__key"), on, "left_semi")
    again = stay.where("__n > 1 AND __size > 0").select("__id", "__key")
    copies = docs.join(again, on, "left_semi").withColumn("__key", F.xxhash64(whole_text()))
    return kept.unionByName(copies.dropDuplicates(["doc_id", "__key"]).drop("__key"))


def op8_near_dedup(spark, sf_dir: str) -> DataFrame:
    out = near_duplicates(documents(spark, sf_dir))
    return out.select("doc_id", "n_shingles", "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()
                                 & F.col("doc_id").isNull()).alias("kept"))
