"""Linear models from sums (ML-02): one pass adds up the Gram matrix of the encoded features and the
target, partition by partition; least squares, ridge and lasso are then solved from it alone.

The matrix has a row for each feature, whatever the data, so the driver's part is bounded."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Directions of the centred Gram matrix below this share of the largest carry no information.
RANK_TOLERANCE = 1e-10
LASSO_GAP, LASSO_SWEEPS = 1e-6, 1000


def gram_partials(encoded: DataFrame, label: str) -> DataFrame:
    """One row per partition: the sums of products of (1, features, target), as packed doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if not len(b):
                continue
            x = b.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), -1)
            z = np.column_stack([np.ones(len(b)), x, b.column("y").to_numpy()])
            total = z.T @ z if total is None else total + z.T @ z
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["sums"])

    rows = encoded.where(F.col(label).isNotNull()).select(vector_to_array("features").alias("x"),
                                                          F.col(label).cast("double").alias("y"))
    return rows.mapInArrow(run, "sums binary")


def gram(encoded: DataFrame, label: str) -> np.ndarray:
    """Sums of products of every two of (1, features..., target) over all rows; merged as a tree."""
    parts = gram_partials(encoded, label).rdd.map(lambda r: np.frombuffer(r["sums"]))
    if parts.isEmpty():
        return np.zeros((0, 0))
    flat = parts.treeReduce(lambda a, b: a + b)
    size = int(round(len(flat) ** 0.5))
    return flat.reshape(size, size)


def centred(g: np.ndarray) -> tuple[float, np.ndarray, float, np.ndarray, np.ndarray]:
    """n, feature means, target mean, and the centred sums X'X and X'y."""
    n, s = g[0, 0], g[0, 1:]
    c = g[1:, 1:] - np.outer(s, s) / n
    return n, s[:-1] / n, s[-1] / n, c[:-1, :-1], c[:-1, -1]


def least_squares(xx: np.ndarray, xy: np.ndarray) -> np.ndarray:
    """The shortest solution: directions without variance (one-hot columns add up to one) get nothing."""
    values, vectors = np.linalg.eigh(xx)
    keep = values > RANK_TOLERANCE * max(values.max(initial=0.0), 1e-300)
    return vectors[:, keep] @ ((vectors[:, keep].T @ xy) / values[keep])


def ridge(xx: np.ndarray, xy: np.ndarray, alpha: float) -> np.ndarray:
    low = np.linalg.cholesky(xx + alpha * np.eye(len(xx)))
    return np.linalg.solve(low.T, np.linalg.solve(low, xy))


def lasso(xx: np.ndarray, xy: np.ndarray, yy: float, n: float, alpha: float) -> np.ndarray:
    """Coordinate descent on 1/(2n) |y - Xw|^2 + alpha |w|_1 until the duality gap is below
    LASSO_GAP of the target's sum of squares, or after LASSO_SWEEPS rounds (the reference's limit)."""
    w, limit = np.zeros(len(xy)), alpha * n
    left = xy.copy()                                     # X'(y - Xw)
    for sweep in range(LASSO_SWEEPS):
        for j in np.flatnonzero(np.diag(xx) > 0):
            old, rho = w[j], left[j] + xx[j, j] * w[j]
            w[j] = np.sign(rho) * max(abs(rho) - limit, 0.0) / xx[j, j]
            if w[j] != old:
                left -= xx[:, j] * (w[j] - old)
        if sweep % 10 == 9:
            rest = yy - w @ xy - w @ left                # |y - Xw|^2
            scale = min(1.0, limit / max(np.abs(left).max(initial=0.0), 1e-300))
            dual = scale * (yy - w @ xy) - scale ** 2 * rest / 2
            if rest / 2 + limit * np.abs(w).sum() - dual <= LASSO_GAP * max(yy, 1e-300):
                break
    return w


class LinearModel(Model, HasFeaturesCol, HasPredictionCol, MLWritable, MLReadable):
    """intercept + coefficients . features, as one Spark expression."""

    @keyword_only
    def __init__(self, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._setDefault(featuresCol="features", predictionCol="prediction")
        self._set(**self._input_kwargs)
        self.coefficients, self.intercept = DenseVector([]), 0.0

    @classmethod
    def of(cls, w: np.ndarray, x_mean: np.ndarray, y_mean: float) -> LinearModel:
        out = cls()
        out.coefficients, out.intercept = DenseVector(w), float(y_mean - w @ x_mean)
        return out

    def _transform(self, dataset: DataFrame) -> DataFrame:
        w = F.array(*[F.lit(float(x)) for x in self.coefficients])
        terms = F.zip_with(vector_to_array(self.getFeaturesCol()), w, lambda a, b: a * b)
        total = F.aggregate(terms, F.lit(self.intercept), lambda a, b: a + b)
        return dataset.withColumn(self.getPredictionCol(), total)

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: LinearModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        extra = {"intercept": self.model.intercept, "coefficients": self.model.coefficients.toArray().tolist()}
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession, extraMetadata=extra)


class _Reader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> LinearModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        out = self.cls()
        DefaultParamsReader.getAndSetParams(out, metadata)
        out._resetUid(metadata["uid"])
        out.intercept, out.coefficients = metadata["intercept"], DenseVector(metadata["coefficients"])
        return out
