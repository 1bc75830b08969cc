"""SimHash near-dedup (operator 13): fingerprints of 64 bits, compared bit-sliced.

Two fingerprints are linked if at most two bits differ. Equal fingerprints form one class.
Of four equal blocks of the bits at least two agree in every linked pair, so six buckets a
class (one for each two blocks) miss no link. A bucket of more than LARGE classes is dealt
again by the bits that its key does not hold: by 16 of 32, then by 8 of 16; after that at most
2^8 different fingerprints can share a bucket, so no bucket needs a cap.

Inside a bucket the fingerprints stand vertically: word p, i of the planes holds bit p of 64
of them. One comparison of a fingerprint with a word updates 64 distances at once, kept as
carry-save bit counters, and a word goes as soon as all of its 64 distances exceed the radius.
A task answers with a spanning forest of the links it found, never with all of them."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, documents, whole_text

SHINGLE = 3
SEED = 42
BITS = 64
RADIUS = 2
# Classes of a bucket that is compared as it is; a larger one is dealt again.
LARGE = 2048
# Shingles whose bits are counted at a time; words of planes and pairs of words compared at a time.
CHUNK = 100_000
BATCH = 65_536
PAIRS = 1024
# Planes between two looks at which words are left.
LOOK = 6
_ALL = np.uint64(2**64 - 1)


def fingerprint(text: str | None) -> int:
    """The signed 64-bit SimHash of a whole text: a bit is 1 if it is set in over half the hashes
    of the shingles, repeats included; 0 without words."""
    import xxhash       # found when first used

    words = (text or "").encode("utf-8", "replace").lower().split()     # bytes: ASCII rules only
    if not words:
        return 0
    joined, k = b" ".join(words), min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    starts, ends = starts[:len(words) - k + 1], ends[k - 1:]
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(starts), CHUNK):
        h = np.array([xxhash.xxh64_intdigest(joined[s:e], SEED) for s, e in
                      zip(starts[at:at + CHUNK].tolist(), ends[at:at + CHUNK].tolist())], "<u8")
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(starts), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fp (long) for every row of ``docs`` (doc_id, text; other columns ignored)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def planes(x: np.ndarray) -> np.ndarray:
    """The bit planes of ``x`` (a multiple of 64 fingerprints): [bit, word], one bit a fingerprint."""
    bits = np.unpackbits(x.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view("<u8")


def _search(x: np.ndarray, sliced: np.ndarray, query: np.ndarray, word: np.ndarray, radius: int):
    """Pairs (i, j): fingerprint ``query[k]`` and those of word ``word[k]`` within the radius."""
    counters = [np.zeros(len(query), np.uint64) for _ in range((radius + 1).bit_length())]
    over = np.zeros(len(query), np.uint64)        # distances that have left the counters
    for p in range(BITS):
        ones = np.uint64(0) - ((x[query] >> np.uint64(p)) & np.uint64(1))      # the query's bit, 64 times
        carry = sliced[p, word] ^ ones
        for c in range(len(counters)):            # carry-save: add a bit to every counter at once
            counters[c], carry = counters[c] ^ carry, counters[c] & carry
        over |= carry
        if p % LOOK == LOOK - 1 or p == BITS - 1:
            left = _within(counters, over, radius)
            alive = np.flatnonzero(left)
            if len(alive) < len(query):
                query, word, over = query[alive], word[alive], over[alive]
                counters = [c[alive] for c in counters]
                left = left[alive]
            if not len(query):
                return np.zeros(0, np.int64), np.zeros(0, np.int64)
    bits = np.unpackbits(left.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    k, bit = np.nonzero(bits)
    return query[k], word[k] * 64 + bit


def _within(counters: list[np.ndarray], over: np.ndarray, radius: int) -> np.ndarray:
    """Bits of the distances that are at most ``radius``: compared bit by bit from the highest."""
    less, equal = np.zeros_like(over), np.full_like(over, _ALL)
    for c in reversed(range(len(counters))):
        if radius >> c & 1:
            less |= equal & ~counters[c]
            equal &= counters[c]
        else:
            equal &= ~counters[c]
    return (less | equal) & ~over


def near_pairs(x: np.ndarray, run: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of places i < j in ``x`` within the radius: all pairs of one run (``run`` ascends),
    and those of neighbouring runs that share a word."""
    n = len(x)
    fill = -n % 64
    padded = np.concatenate([x.astype(np.uint64), np.zeros(fill, np.uint64)])
    sliced = planes(padded)
    words = len(padded) // 64
    # the last word that holds a member of the run in which a word ends
    ends = np.append(np.flatnonzero(np.diff(run)), n - 1)
    last = ends[np.searchsorted(ends, np.minimum(np.arange(words) * 64 + 63, n - 1))] // 64
    spans = last - np.arange(words) + 1
    first = np.repeat(np.arange(words), spans)
    second = first + np.arange(len(first)) - np.repeat(np.cumsum(spans) - spans, spans)
    for at in range(0, len(first), PAIRS):
        query = (first[at:at + PAIRS, None] * 64 + np.arange(64)).ravel()
        i, j = _search(padded, sliced, query, np.repeat(second[at:at + PAIRS], 64), radius)
        good = (i < j) & (j < n)
        yield i[good], j[good]


def spanning(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest place that links reach from each place."""
    label = np.arange(n)
    for u, v in pairs:
        while True:
            low = np.minimum(label[u], label[v])
            if (label[u] == low).all() and (label[v] == low).all():
                break
            for w in (u, v):
                np.minimum.at(label, label[w], low)       # the roots of both ends meet
            while (label[label] != label).any():
                label = label[label]
    return label


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spanning forests (u, v) of the links inside the buckets of one task, whose rows are
    sorted by bucket."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])
    held: list[pa.RecordBatch] = []

    def answer(rows: pa.Table) -> pa.RecordBatch:
        x = rows["fp"].to_numpy()
        keys = np.stack([rows[k].to_numpy() for k in ("k1", "k2", "k3")])
        run = np.cumsum(np.append(0, (np.diff(keys, axis=1) != 0).any(axis=0)))
        # a fingerprint may stand in several runs of a batch: its places are one node
        node, place = np.unique(x, return_inverse=True)
        pairs = near_pairs(x.view(np.uint64), run)
        label = spanning(len(node), ((place[i], place[j]) for i, j in pairs))
        moved = np.flatnonzero(label != np.arange(len(node)))
        return pa.RecordBatch.from_arrays([pa.array(node[moved]), pa.array(node[label[moved]])], schema=schema)

    for b in batches:
        held.append(b)
        if sum(len(x) for x in held) >= BATCH:
            rows = pa.Table.from_batches(held)
            keys = np.stack([rows[k].to_numpy() for k in ("k1", "k2", "k3")])
            change = np.flatnonzero((np.diff(keys, axis=1) != 0).any(axis=0))
            if len(change):                       # the last bucket may go on: it waits
                cut = int(change[-1]) + 1
                yield answer(rows.slice(0, cut))
                held = rows.slice(cut).combine_chunks().to_batches()
    if held:
        yield answer(pa.Table.from_batches(held))


def _dealt(rows: DataFrame, width: int, key: str) -> DataFrame:
    """Every row (fp, rest: its ``width`` bits that no key holds yet) once for each two of the four
    blocks of ``rest``: their bits in ``key``, the others in ``rest``."""
    size = width // 4

    def block(i: int) -> Column:
        return F.shiftrightunsigned(F.col("rest"), i * size).bitwiseAND(F.lit((1 << size) - 1))

    def joined(i: int, j: int) -> Column:
        return F.shiftleft(block(i), size).bitwiseOR(block(j))

    ways = []
    for t, (i, j) in enumerate(combinations(range(4), 2)):
        k, l = (b for b in range(4) if b not in (i, j))
        ways.append(F.struct(joined(i, j).bitwiseOR(F.lit(t << 2 * size)).alias("key"), joined(k, l).alias("rest")))
    return rows.withColumn("way", F.explode(F.array(*ways))).withColumns(
        {key: F.col("way.key"), "rest": F.col("way.rest")}).drop("way")


def fingerprint_links(classes: DataFrame, large: int = LARGE) -> DataFrame:
    """Links (u, v) that join all fingerprints of ``classes`` (fp, distinct) within the radius
    to their components: a forest from every task, not every pair."""
    todo = classes.select("fp", F.col("fp").alias("rest"),
                          *[F.lit(-1).cast("long").alias(k) for k in ("k1", "k2", "k3")])
    found = None
    for width, key in ((BITS, "k1"), (BITS // 2, "k2"), (BITS // 4, "k3")):
        members = checkpointed(_dealt(todo, width, key))
        keys = ["k1", "k2", "k3"]
        sizes = checkpointed(members.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        members = members.join(sizes, keys)
        most = F.lit(True) if key == "k3" else F.col("n") <= large
        # dealt by a hash of its own: rows already dealt by the keys are not shuffled again, and if the join above then
        # turns into a broadcast, its shuffle is read where it was written and buckets fall apart
        ready = (members.where(most).select("fp", *keys).repartition(F.xxhash64(*keys))
                 .sortWithinPartitions(*keys))
        links = ready.mapInArrow(_links, "u long, v long")
        found = links if found is None else found.unionByName(links)
        if key == "k3" or not sizes.where(F.col("n") > large).limit(1).count():
            return found
        todo = members.where(~most).select("fp", "rest", *keys)
    raise AssertionError("unreachable")


def simhash_groups(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text; other columns ignored): doc_id, fp (the 64-bit
    fingerprint as a long) and component_id, the smallest doc_id among the rows that links
    reach, the row's own included.

    Rows without words (null, empty, white space) have fingerprint zero and are linked like
    others. Repeated rows and repeated ids are rows like others; a null id never names a
    component that has another id, and a component of null ids only is named null. Texts are
    hashed whole, whatever their length. An empty table gives no rows."""
    rows = checkpointed(fingerprints(docs))
    classes = checkpointed(rows.groupBy("fp").agg(F.min("doc_id").alias("label")))
    roots = components(fingerprint_links(classes))
    named = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
             .withColumn("root", F.coalesce("root", "fp")))
    names = named.groupBy("root").agg(F.min("label").alias("component_id"))
    named = checkpointed(named.join(names, "root").select("fp", "component_id"))
    return rows.join(named, "fp").select("doc_id", "fp", "component_id")


def op13_simhash(spark, sf_dir: str) -> DataFrame:
    groups = simhash_groups(documents(spark, sf_dir))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
