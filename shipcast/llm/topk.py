"""Exact top-k inner products by pivot-table elimination (operator 2).

A pivot table keeps every vector's distances to some pivots. By the triangle inequality the
largest difference between a query's and a candidate's distance to one pivot bounds
their distance from below, and so, with both norms, their inner product from above. Candidates
are evaluated in the order of that bound until it falls below the k-th score found: what is
left cannot enter the result, so the result is exact. Queries go in blocks of bounded size,
each sent to the tasks that hold the candidates; every task answers with its own k best."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import checkpointed, discard, documents, scratch_folder

K = 5
QUERY_EVERY = 50
PIVOTS = 32
# Pivots are chosen, and first thresholds found, among about this many vectors (under twice).
SAMPLE = 4096
# Queries sent to the tasks at once (with 64 components, 1 MB).
BLOCK = 2048
# Candidates evaluated between two looks at the bound.
STEP = 128


def integer_vectors(embeddings: DataFrame) -> DataFrame:
    """row, vec_id, v: floor(256 * x) of every component. Vectors that are null, or hold a null, NaN
    or infinite component, and rows without an id are left out. Every other row counts, repeated
    rows and ids too: ``row`` tells them apart."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = embeddings.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    v = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256).cast("long"))
    return checkpointed(good.select(F.monotonically_increasing_id().alias("row"), "vec_id", v.alias("v")))


def matrix(vectors, width: int) -> np.ndarray:
    """Rows padded with zeros to one width (a missing component adds nothing to a product)."""
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def choose_pivots(x: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first: each next pivot is the vector farthest from all chosen ones."""
    chosen = [int(np.argmax((x * x).sum(1)))]
    near = distances(x, x[chosen])[:, 0]
    while len(chosen) < min(count, len(x)) and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((ids, -scores))[:k]
    return scores[order], ids[order]


def search_one(q, q_norm, q_dist, q_row, x, norms, dist, ids, kept, k, rows=None) -> tuple:
    """The k best of ``kept`` (scores, ids) and the candidates ``x``, in bound order; ``rows`` name the
    candidates (their ids, if not given), of which ``q_row`` is the query itself."""
    rows = ids if rows is None else rows
    scores, found = kept
    low = np.abs(dist - q_dist).max(1)
    bound = (q_norm + norms - low * low) / 2
    bound += 1e-9 * (q_norm + norms) + 1e-6          # above rounding errors
    floor = scores[-1] if len(scores) == k else -np.inf
    left = np.flatnonzero((bound >= floor) & (rows != q_row))
    left = left[np.argsort(-bound[left], kind="stable")]
    for at in range(0, len(left), STEP):
        if len(scores) == k and bound[left[at]] < scores[-1]:
            break
        some = left[at:at + STEP]
        scores, found = best(np.concatenate([scores, np.rint(x[some] @ q)]),
                             np.concatenate([found, ids[some]]), k)
    return scores, found


RESULT = "query_id long, rank int, vec_id long, score long"


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: for every row of ``queries`` the ``k`` other rows of ``vectors``
    (both row, vec_id, v) with the highest inner products, ties to the smaller id; fewer where there
    are fewer. Rows that repeat an id are candidates, and queries, of their own. Either frame
    empty: no rows. Queries are worked off in blocks; a block's rows are written before the next starts."""
    spark = vectors.sparkSession
    sizes = vectors.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("width")).first()
    n, width = sizes["n"], sizes["width"] or 1
    if not n:
        return spark.createDataFrame([], RESULT)
    # every row counts alike, and tasks send only rows of the sample to the driver
    keep = F.pmod(F.xxhash64("vec_id", "row"), F.lit(max(1, n // SAMPLE))) == 0
    sample = vectors.where(keep).toPandas()
    if sample.empty:
        sample = vectors.limit(1).toPandas()
    known, known_rows = matrix(sample["v"], width), sample["row"].to_numpy("int64")
    pivots = choose_pivots(known, PIVOTS)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b.assign(d=list(distances(matrix(b["v"], width), pivots)))

    table = checkpointed(vectors.mapInPandas(measure, "row long, vec_id long, v array<long>, d array<double>"))
    queries = checkpointed(queries.select("row", "vec_id", "v"))
    blocks = max(1, math.ceil(queries.count() / BLOCK))
    folder = scratch_folder(spark)
    spark.createDataFrame([], RESULT).write.parquet(f"{folder}/none")
    for block in range(blocks):
        mine = queries.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).toPandas()
        if mine.empty:
            continue
        q, q_rows = matrix(mine["v"], width), mine["row"].to_numpy("int64")
        # scores within the sample: a k-th of them is a floor under the true k-th score
        first = np.rint(q @ known.T)
        first[q_rows[:, None] == known_rows[None, :]] = -np.inf
        floors = np.sort(first, axis=1)[:, -k] if first.shape[1] >= k else np.full(len(q), -np.inf)
        sent = spark.sparkContext.broadcast((q, q_rows, (q * q).sum(1), distances(q, pivots), floors))

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            q, q_rows, q_norms, q_dist, floors = sent.value
            # placeholders under the floor (ids beyond all) let the bound stop from the start
            kept = [(np.full(k, f - 0.5), np.full(k, np.iinfo("int64").max)) if np.isfinite(f)
                    else (np.empty(0), np.empty(0, "int64")) for f in floors]
            for b in batches:
                x, ids, rows = matrix(b["v"], width), b["vec_id"].to_numpy("int64"), b["row"].to_numpy("int64")
                norms, dist = (x * x).sum(1), np.stack(b["d"].to_numpy())
                for i in range(len(q)):
                    kept[i] = search_one(q[i], q_norms[i], q_dist[i], q_rows[i], x, norms, dist, ids, kept[i], k, rows)
            out = [(i, v, int(s)) for i, (scores, ids) in enumerate(kept)
                   for s, v in zip(scores.tolist(), ids.tolist()) if v != np.iinfo("int64").max]
            yield pd.DataFrame(out, columns=["slot", "vec_id", "score"]).astype("int64")

        # at most k rows of a query from each task, and BLOCK queries
        order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
        found = table.mapInPandas(search, "slot long, vec_id long, score long").withColumn(
            "rank", F.row_number().over(order)).where(F.col("rank") <= k)
        names = spark.createDataFrame(pd.DataFrame({"slot": np.arange(len(mine)), "query_id": mine["vec_id"]}))
        found.join(F.broadcast(names), "slot").select("query_id", "rank", "vec_id", "score").write.parquet(f"{folder}/{block}")
        sent.destroy()
    out = checkpointed(spark.read.schema(RESULT).parquet(f"{folder}/*"))
    discard(spark, folder)
    return out


def op2_topk(spark, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(documents(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
