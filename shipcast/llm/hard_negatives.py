"""Hard-negative mining by a residue-number-system GEMM (operator 11).

Scores are integer inner products of integer vectors. Every component is taken modulo several
small primes, symmetrically around zero; a block of anchors times a block of rows is then one
float32 matrix product for each prime, exact because no partial sum reaches 2^24. The signed
scores are put together by Chinese remaindering in mixed radix, exact as the product of
the primes exceeds twice the largest norm. Windowed selection follows: the best positives of
an anchor, then for each positive the best rows of other labels within its score window.

Anchors go in blocks of bounded size, each sent to the tasks that hold the rows; every task
keeps its own k best of a slot, and a grouping over these few rows gives the k best of all. A
block's results are written before the next block starts, and its broadcasts are destroyed."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, discard, documents, scratch_folder

ANCHOR_EVERY, RELABEL_EVERY, LABELS = 100, 7, 10
POSITIVES = NEGATIVES = 5
# A negative's score lies between LOW / DEN of the positive's and all of it.
LOW, DEN = 80, 100
# Components are cut to this size, so that scores of up to 2^14 components fit a long.
LIMIT = 1 << 24
# Anchors sent at once; anchors and rows of one matrix product.
BLOCK, ANCHOR_TILE, ROW_TILE = 4096, 256, 2048
FLOAT_EXACT = 1 << 24
RESULT = ("anchor_id long, positive_id long, rank int, negative_id long, positive_score long, "
          "negative_score long")


def odd_primes_below(limit: int) -> list[int]:
    return [p for p in range(limit - 1, 2, -1) if all(p % q for q in range(2, math.isqrt(p) + 1))]


class ResidueNumbers:
    """Exact products of integer matrices whose entries are at most ``bound`` in size."""

    def __init__(self, bound: int):
        self.primes: list[int] = []
        for p in odd_primes_below(256):
            if math.prod(self.primes) > 2 * bound + 64:
                break
            self.primes.append(p)
        product = math.prod(self.primes)
        self.kind = np.float64 if product < 1 << 53 else np.int64
        # columns whose residue products add up exactly
        self.columns = (FLOAT_EXACT - 1024) // max(p // 2 for p in self.primes) ** 2

    @staticmethod
    def reduce(x: np.ndarray, p: int) -> np.ndarray:
        """``x`` (whole, below 2^24 in size) modulo p around zero, in place."""
        x -= np.float32(p) * np.rint(x * np.float32(1 / p))
        return x

    def residues(self, x: np.ndarray) -> list[np.ndarray]:
        x = x.astype(np.float64)
        return [(x - p * np.rint(x / p)).astype(np.float32) for p in self.primes]

    def product(self, a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """The exact matrix a @ b.T of two matrices given by their residues."""
        digits: list[np.ndarray] = []
        for p, x, y in zip(self.primes, a, b):
            s = np.zeros((len(x), len(y)), np.float32)
            for at in range(0, x.shape[1], self.columns):
                s += self.reduce(x[:, at:at + self.columns] @ y[:, at:at + self.columns].T, p)
                self.reduce(s, p)
            # the next digit of the mixed radix system of the primes so far
            for q, d in zip(self.primes, digits):
                s -= d
                s *= np.float32(_around_zero(pow(q, -1, p), p))
                self.reduce(s, p)
            digits.append(s)
        out = digits[-1].astype(self.kind)
        for p, d in zip(reversed(self.primes[:-1]), reversed(digits[:-1])):
            out *= self.kind(p)
            out += d.astype(self.kind) if self.kind is np.int64 else d
        return out


def _around_zero(x: int, p: int) -> int:
    return x - p if x > p // 2 else x


class Best:
    """The k best (highest score, then smallest id) of what is offered to each of n slots, and in
    every slot the least score that can still enter."""

    def __init__(self, floors: np.ndarray, k: int):
        self.k, self.floors = k, floors.astype(np.int64)
        self.slot = self.score = self.vec = self.row = np.zeros(0, np.int64)

    def offer(self, slot, score, vec, row) -> None:
        slot, score, vec, row = (np.concatenate(x) for x in zip(
            (self.slot, self.score, self.vec, self.row), (slot, score, vec, row)))
        order = np.lexsort((row, vec, -score, slot))
        slot = slot[order]
        first = np.searchsorted(slot, slot, "left")
        keep = np.arange(len(slot)) - first < self.k
        order = order[keep]
        self.slot, self.score, self.vec, self.row = slot[keep], score[order], vec[order], row[order]
        full = np.flatnonzero((np.arange(len(slot)) - first)[keep] == self.k - 1)      # a slot's k-th
        self.floors[self.slot[full]] = np.maximum(self.floors[self.slot[full]], self.score[full])

    def table(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (self.slot, self.score, self.vec, self.row)],
                                          ["slot", "score", "vec_id", "row"])


def labelled_vectors(embeddings: DataFrame, relabel_every: int = RELABEL_EVERY) -> DataFrame:
    """vec_id, label, v: floor(256 * x) of every component x, cut to LIMIT. Rows whose vec_id,
    label or vector is null, or whose vector holds a null, NaN or infinite component, are left out; every
    other row stays, repeated rows and ids included. Where ``relabel_every`` divides vec_id the
    label becomes (label + 1) % LABELS."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = embeddings.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    whole = F.transform("embedding", lambda x: F.least(F.greatest(
        F.floor(x.cast("double") * 256), F.lit(float(-LIMIT))), F.lit(float(LIMIT))).cast("int"))
    label = F.col("label").cast("long")
    return good.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.when(F.col("vec_id") % relabel_every == 0, (label + 1) % LABELS).otherwise(label).alias("label"),
                       whole.alias("v"))


def _matrix(v: pa.ListArray, width: int) -> np.ndarray:
    """Rows padded with zeros to one width (a missing component adds nothing to a product)."""
    flat, ends = v.flatten().to_numpy(zero_copy_only=False), np.diff(v.offsets.to_numpy())
    if (ends == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(v), width), np.int64)
    out[np.repeat(np.arange(len(v)), ends), np.arange(len(flat)) - np.repeat(ends.cumsum() - ends, ends)] = flat
    return out


def _tiles(batches: Iterator[pa.RecordBatch], numbers: ResidueNumbers, width: int):
    for b in batches:
        x = _matrix(b.column("v"), width)
        rest = [b.column(c).to_numpy() for c in ("vec_id", "label", "row")]
        for at in range(0, len(x), ROW_TILE):
            yield (numbers.residues(x[at:at + ROW_TILE]), *[c[at:at + ROW_TILE] for c in rest])


def _selected(table: DataFrame, numbers: ResidueNumbers, width: int, anchors: dict, floors: np.ndarray,
              k: int, pick: Callable) -> DataFrame:
    """slot, score, vec_id, row, rank: the k best rows of ``table`` (row, vec_id, label, v) for every
    slot of a block of ``anchors``. ``pick`` names the offers of one tile of scores."""
    sent = table.sparkSession.sparkContext.broadcast((anchors, floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, floors = sent.value
        tiles = [slice(at, at + ANCHOR_TILE) for at in range(0, len(anchors["row"]), ANCHOR_TILE)]
        factors = [numbers.residues(anchors["v"][t]) for t in tiles]
        best = Best(floors, k)
        for y, vec, label, row in _tiles(batches, numbers, width):
            for t, x in zip(tiles, factors):
                slot, place, score = pick(numbers.product(x, y), {c: anchors[c][t] for c in anchors},
                                          best.floors, t.start, label, row)
                if len(slot):
                    best.offer(slot, score.astype(np.int64), vec[place], row[place])
        yield best.table()

    found = table.mapInArrow(run, "slot long, score long, vec_id long, row long")
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id", "row")
    # at most k rows of a slot from each task
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k), sent


def _pick_positives(scores, anchors, floors, start, label, row):
    floor = floors[start:start + len(scores), None]
    good = (scores >= floor) & (anchors["label"][:, None] == label[None, :])
    i, j = np.nonzero(good)
    other = anchors["row"][i] != row[j]
    i, j = i[other], j[other]
    return i + start, j, scores[i, j]


def _pick_negatives(scores, anchors, floors, start, label, row):
    """Slots are (anchor, positive); ``top`` is the positive's score, floors start at its window's end."""
    n, width = anchors["top"].shape
    floor = floors.reshape(-1, width)[start:start + n]
    low, high = floor.min(1)[:, None], np.where(anchors["top"] >= 0, anchors["top"], -1).max(1)[:, None]
    good = (scores >= low) & (scores <= high) & (anchors["label"][:, None] != label[None, :])
    i, j = np.nonzero(good)
    s = scores[i, j]
    slots, places, found = [], [], []
    for c in range(width):
        fits = (s >= floor[i, c]) & (s <= anchors["top"][i, c])
        slots.append((i[fits] + start) * width + c)
        places.append(j[fits])
        found.append(s[fits])
    return np.concatenate(slots), np.concatenate(places), np.concatenate(found)


def hard_negatives(vectors: DataFrame, is_anchor, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: for every row of
    ``vectors`` (vec_id, label, v) where ``is_anchor`` holds, its ``positives`` best other rows of its
    label, and for each of them the ``negatives`` best rows of other labels in its score window.
    Higher scores come first, ties by smaller vec_id (rows of one id in any order). A window of a negative positive score
    is empty. Repeated rows and ids are rows of their own, so their results repeat.
    Vectors of different lengths count as padded with zeros. No anchors, or no rows: no rows."""
    spark = vectors.sparkSession
    table = checkpointed(vectors.select("vec_id", "label", "v", F.monotonically_increasing_id().alias("row")))
    norm = F.aggregate("v", F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long") * x)
    sizes = table.agg(F.max(norm).alias("norm"), F.max(F.size("v")).alias("width"),
                      F.count_if(is_anchor).alias("anchors")).first()
    if not sizes["anchors"]:
        return spark.createDataFrame([], RESULT)
    # a product of two vectors is at most the larger of their squared norms
    numbers, width = ResidueNumbers(sizes["norm"]), max(1, sizes["width"])
    anchors = checkpointed(table.where(is_anchor))
    blocks = math.ceil(sizes["anchors"] / BLOCK)
    folder = scratch_folder(spark)
    lowest = np.iinfo(np.int64).min
    for block in range(blocks):
        mine = anchors.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toArrow()
        if not len(mine):
            continue
        v = mine["v"].combine_chunks()
        held = {"v": _matrix(v, width), **{c: mine[c].to_numpy() for c in ("vec_id", "label", "row")}}
        first, sent = _selected(table, numbers, width, held, np.full(len(mine), lowest), positives, _pick_positives)
        known = first.select("slot", "rank", "score", "vec_id").toPandas()      # some rows an anchor
        sent.destroy()
        place = (known["slot"].to_numpy(), known["rank"].to_numpy() - 1)
        there = np.zeros((len(mine), positives), bool)
        there[place] = True
        top, ids = (np.zeros((len(mine), positives), np.int64) for _ in range(2))
        top[place], ids[place] = known["score"], known["vec_id"]
        top[~there] = -1
        floors = np.where(top >= 0, -(-top * LOW // DEN), np.iinfo(np.int64).max).ravel()
        held["top"] = top
        second, sent = _selected(table, numbers, width, held, floors, negatives, _pick_negatives)
        names = spark.createDataFrame(pd.DataFrame({
            "slot": np.arange(len(mine) * positives), "anchor_id": np.repeat(held["vec_id"], positives),
            "positive_id": ids.ravel(), "positive_score": top.ravel()}))
        # a block has at most BLOCK * positives slots
        rows = second.join(F.broadcast(names), "slot")
        rows.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")).write.parquet(f"{folder}/{block}")
        sent.destroy()
    out = checkpointed(spark.read.schema(RESULT).parquet(f"{folder}/*"))
    discard(spark, folder)
    return out


def op11_hard_negatives(spark, sf_dir: str) -> DataFrame:
    vectors = labelled_vectors(documents(spark, sf_dir, "embeddings"))
    return hard_negatives(vectors, F.col("vec_id") % ANCHOR_EVERY == 0)
