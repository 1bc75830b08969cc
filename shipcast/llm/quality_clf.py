"""Quality classifier (operator 7): ridge regression on random Fourier features of document
statistics, fitted from partition-summed normal equations, then isotonic calibration.

Only statistics of the text enter a score. Moments, normal equations and calibration
counts are sums over all labelled training rows; what reaches the driver has a size fixed by
the parameters (features squared, calibration bins), whatever the number of rows."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import checkpointed, documents, whole_text

FEATURES = 256
RIDGE = 1.0
BINS = 2000
SEED = 7
# Partial sums are added in groups of this many tasks before they meet.
FAN_IN = 32

_GROUPS = {
    "upper": range(65, 91), "lower": range(97, 123), "digit": range(48, 58), "beyond_ascii": range(128, 256),
    "space": (32,), "newline": (10,), "symbol": b"#*$%&|<>", "mark": b"!?", "stop": b".,;:",
    "bracket": b"()[]{}", "quote": b"\"'`", "at": b"@/_-=+\\^~",
}
_MASKS = np.zeros((256, len(_GROUPS)))
for _i, _g in enumerate(_GROUPS.values()):
    _MASKS[list(_g), _i] = 1
N_STATS = len(_GROUPS) + 13


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text; an empty or null text gives zeros."""
    raw = (text or "").encode("utf-8", "replace")
    words = raw.split()
    if not words:
        return [0.0] * N_STATS
    n = len(words)
    shares = np.bincount(np.frombuffer(raw, np.uint8), minlength=256) @ _MASKS / len(raw)
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x.strip()]
    lengths = np.fromiter(map(len, words), np.int64, n)
    triples = len(set(zip(words, words[1:], words[2:]))) / max(1, n - 2)
    windows = [hash(w) for w in zip(*[words[i:] for i in range(8)])]
    return [*shares.tolist(), np.log1p(n), np.log1p(len(lines)), lengths.mean(), lengths.std(),
            len(counts) / n, np.log1p(max(counts.values()) / n * 100), triples,
            1 - len(set(windows)) / max(1, len(windows)),
            sum(a == b for a, b in zip(words, words[1:])) / n,
            (len(lines) - len(set(lines))) / len(lines),
            sum(w.endswith(b"!!") for w in words) / n,
            sum(w[-1] in b"#*$%&|<>" for w in words) / n, float(n < 20)]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def text_statistics(texts: pd.Series) -> pd.Series:
    return texts.map(statistics)


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray        # raw scores, increasing
    levels: np.ndarray       # calibrated scores at the knots

    def fourier(self, stats: np.ndarray) -> np.ndarray:
        z = np.clip((stats - self.mean) / self.scale, -6, 6)
        return np.sqrt(2 / len(self.phases)) * np.cos(z @ self.directions + self.phases)

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return np.column_stack([self.fourier(stats), np.ones(len(stats))]) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)


def _rows(s: pd.Series) -> np.ndarray:
    return np.array(s.tolist(), dtype=float).reshape(len(s), N_STATS)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators over points in order of ``x``: block centres and levels."""
    blocks: list[list[float]] = []
    for xi, yi, wi in zip(x, y, w):
        blocks.append([xi * wi, yi * wi, wi])
        while len(blocks) > 1 and blocks[-2][1] / blocks[-2][2] >= blocks[-1][1] / blocks[-1][2]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    b = np.array(blocks)
    return b[:, 0] / b[:, 2], b[:, 1] / b[:, 2]


def fit(labelled: DataFrame, features: int = FEATURES, ridge: float = RIDGE, seed: int = SEED) -> QualityModel:
    """Fit on ``labelled`` (stats array, label 0/1). Without rows every score is 0.5; with one label
    only, every score is that label."""
    labelled = labelled.select("stats", F.col("label").cast("double").alias("label"))
    rng = np.random.default_rng(seed)
    directions = rng.normal(size=(N_STATS, features)) / np.sqrt(N_STATS)
    phases = rng.uniform(0, 2 * np.pi, features)
    cols = [F.col("stats")[i] for i in range(N_STATS)]
    m = labelled.agg(F.count("label").alias("n"),
                     *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
                     *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)]).first()
    if not m["n"]:
        flat = np.zeros(features + 1)
        return QualityModel(np.zeros(N_STATS), np.ones(N_STATS), directions, phases, flat,
                            np.array([0.0]), np.array([0.5]))
    mean = np.array([m[f"m{i}"] for i in range(N_STATS)])
    scale = np.array([m[f"s{i}"] or 1.0 for i in range(N_STATS)])
    start = QualityModel(mean, scale, directions, phases, np.zeros(features + 1), np.zeros(1), np.zeros(1))

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((features + 1, features + 2))
        for b in batches:
            z = np.column_stack([start.fourier(_rows(b["stats"])), np.ones(len(b))])
            total += z.T @ np.column_stack([z, b["label"].to_numpy()])
        yield pd.DataFrame({"row": np.arange(len(total)), "sums": list(total)})

    def add(p: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"row": p["row"].iloc[:1], "sums": [np.sum(np.stack(p["sums"].to_numpy()), axis=0)]})

    schema = "row long, sums array<double>"
    parts = labelled.mapInPandas(partial, schema).withColumn("part", F.spark_partition_id() % FAN_IN)
    parts = parts.groupBy("row", "part").applyInPandas(add, schema)
    rows = parts.groupBy("row").applyInPandas(add, schema).orderBy("row").collect()   # features + 1 rows
    sums = np.array([r["sums"] for r in rows])
    gram, target = sums[:, :-1], sums[:, -1]
    penalty = ridge * np.eye(features + 1)
    penalty[-1, -1] = 1e-9
    weights = np.linalg.solve(gram + penalty, target)
    raw = QualityModel(mean, scale, directions, phases, weights, np.zeros(1), np.zeros(1))

    @F.pandas_udf("long")
    def place(s: pd.Series) -> pd.Series:
        # raw scores lie about 0 to 1; the outer bins take what is beyond -1 and 2
        return pd.Series(np.clip((raw.raw(_rows(s)) + 1) / 3 * BINS, 0, BINS - 1).astype("int64"))

    bins = (labelled.groupBy(place("stats").alias("bin"))
            .agg(F.count("label").alias("n"), F.avg("label").alias("y")).orderBy("bin").toPandas())
    knots, levels = isotonic((bins["bin"].to_numpy() + 0.5) / BINS * 3 - 1, bins["y"].to_numpy(),
                             bins["n"].to_numpy(dtype=float))
    return QualityModel(mean, scale, directions, phases, weights, knots, levels)


def score(stats: Column, model: QualityModel) -> Column:
    @F.pandas_udf("double")
    def scored(s: pd.Series) -> pd.Series:
        return pd.Series(model.score(_rows(s)))

    return scored(stats)


def held_out() -> Column:
    """Rows that no label is learnt from; a null id has no checksum and is held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(True))


def labelled_rows(stats: DataFrame, labels: DataFrame) -> DataFrame:
    """Training rows: stats (doc_id, stats) joined with their labels. Null labels are left out; a
    document with several labels, or several rows, gives a row for each pair."""
    known = labels.where(F.col("quality").isNotNull()).select("doc_id", F.col("quality").alias("label"))
    return stats.where(~held_out()).join(known, "doc_id").select("stats", "label")


def op7_quality(spark, sf_dir: str) -> DataFrame:
    stats = checkpointed(documents(spark, sf_dir).select("doc_id", text_statistics(whole_text()).alias("stats")))
    model = fit(checkpointed(labelled_rows(stats, documents(spark, sf_dir, "labels"))))
    out = stats.select("doc_id", held_out().alias("held_out"), score(F.col("stats"), model).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
