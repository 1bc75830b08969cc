"""Delivery-time models (ML-01..ML-05, ML-08, ML-09, TK-01, TK-04, SNK-03/04, SRC-03).

Preprocessing is part of the fitted ``PipelineModel`` (exact train medians, means and deviations as a
SQL transformer, string indexer + one-hot encoder that maps unseen categories to all zeros). The
linear candidates are solved from one Gram matrix, the tree candidates grow on one binned matrix
(``trees``); candidates are fitted at the same time from a few driver threads.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.quantile import column_quantiles
from . import linear, trees
from .audit import metrics
from .features import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET

SEED = 42
DEFAULT_TREES = 200
# Name of the seventh candidate: second-order boosting with L2 leaves and columns drawn once a tree.
SECOND_ORDER = "Second-Order Boosting"


def _cat_col(c: str) -> str:
    return f"{c}__s"


def scales(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES) -> list[dict]:
    """ML-01: feature, median, mean and population deviation (both after the median has filled nulls) of
    the numerics of ``train``, one row each. A feature without values has 0, 0 and 0."""
    if not numeric:
        return []
    medians = {c: (0.0 if m is None else m) for c, (m,) in column_quantiles(train, numeric, [0.5]).items()}
    filled = {c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c]))) for c in numeric}
    row = train.agg(*[f(x).alias(f"{n}__{c}") for c, x in filled.items()
                      for n, f in (("mean", F.avg), ("std", F.stddev_pop))]).first()
    return [{"feature": c, "median": float(medians[c]), "mean": row[f"mean__{c}"] or 0.0, "std": row[f"std__{c}"] or 0.0}
            for c in numeric]


def preprocessing(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                  categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list:
    """ML-01: stages that impute numerics with their exact train median and standardise them,
    fill categoricals with 'missing' and one-hot encode them (alphabetical categories,
    unseen -> all zeros)."""
    def number(x: float) -> str:
        return f"CAST('{float(x)!r}' AS DOUBLE)"

    fills = ", ".join(
        [f"(coalesce(CAST(`{r['feature']}` AS DOUBLE), {number(r['median'])}) - {number(r['mean'])}) "
         f"/ {number(r['std'] or 1.0)} AS `{r['feature']}__n`" for r in scales(train, numeric)]
        + [f"coalesce(CAST(`{c}` AS STRING), 'missing') AS `{_cat_col(c)}`" for c in categorical])
    encode = SQLTransformer(statement=f"SELECT *, {fills} FROM __THIS__")
    idx = StringIndexer(inputCols=[_cat_col(c) for c in categorical],
                        outputCols=[f"{c}__i" for c in categorical],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    ohe = OneHotEncoder(inputCols=[f"{c}__i" for c in categorical],
                        outputCols=[f"{c}__v" for c in categorical], dropLast=True)
    assemble = VectorAssembler(inputCols=[*[f"{c}__n" for c in numeric], *[f"{c}__v" for c in categorical]],
                               outputCol="features")
    return [encode, idx, ohe, assemble]


def fit_preprocessing(train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                      categorical: Sequence[str] = CATEGORICAL_FEATURES) -> PipelineModel:
    return Pipeline(stages=preprocessing(train, numeric, categorical)).fit(train)


# fixed values of the reference: penalties of the linear models, depths, and the seed
RIDGE_ALPHA, LASSO_ALPHA = 1.0, 0.01
TREE_DEPTH, FOREST_DEPTH = 10, 15


def candidates(encoded: DataFrame, label: str = TARGET, n_trees: int = DEFAULT_TREES,
               gbt_step: float = 0.05, gbt_depth: int = 5, rf_min_leaf: int = 5,
               gbt_subsample: float = 0.8, columns: float = 0.8) -> tuple[dict, trees.Binned]:
    """ML-02: the seven regressors, each as a function that fits it on the encoded training rows, and
    the binned matrix that the tree models share (release it after the fits). The three linear
    models share one Gram matrix."""
    n, x_mean, y_mean, xx, xy = linear.centred(linear.gram(encoded, label))
    target = encoded.agg(F.sum((F.col(label) - y_mean) ** 2).alias("yy")).first()["yy"]
    data = trees.binned(encoded, label)
    boosted = trees.Growth(gbt_depth, seed=SEED)
    drawn = trees.replace(trees.second_order(boosted), columns=columns)

    def solved(w):
        return linear.LinearModel.of(w, x_mean, y_mean)

    return {
        "Linear Regression": lambda: solved(linear.least_squares(xx, xy)),
        "Ridge": lambda: solved(linear.ridge(xx, xy, RIDGE_ALPHA)),
        "Lasso": lambda: solved(linear.lasso(xx, xy, target, n, LASSO_ALPHA)),
        "Decision Tree": lambda: trees.fit_tree(data, trees.Growth(TREE_DEPTH, seed=SEED)),
        "Random Forest": lambda: trees.fit_forest(data, n_trees, trees.Growth(FOREST_DEPTH, rf_min_leaf, seed=SEED)),
        "Gradient Boosting": lambda: trees.fit_boosted(data, n_trees, gbt_step, boosted, gbt_subsample),
        SECOND_ORDER: lambda: trees.fit_boosted(data, n_trees, gbt_step, drawn, gbt_subsample),
    }, data


# Candidates that are fitted at the same time, each from a driver thread of its own.
FIT_THREADS = 4


@dataclass
class Comparison:
    results: DataFrame                      # one row per model, validation metrics, best first
    pipelines: dict = field(default_factory=dict)
    best_name: str = ""
    feature_names: list = field(default_factory=list)
    encoded_train: DataFrame | None = None
    feature_means: list = field(default_factory=list)   # of the encoded training rows
    n_trees: int = 0


def _metric_row(df: DataFrame, prefix: str, label: str = TARGET) -> dict:
    m = metrics(df, label).first().asDict()
    return {f"{prefix}_{k}": m[k] for k in ("MAE", "RMSE", "R2", "within_2d", "within_1d")}


def compare(train: DataFrame, val: DataFrame, n_trees: int = DEFAULT_TREES,
            numeric: Sequence[str] = NUMERIC_FEATURES, categorical: Sequence[str] = CATEGORICAL_FEATURES,
            label: str = TARGET, only: Sequence[str] | None = None, **params) -> Comparison:
    """ML-03 / ML-04 / TK-01: fit every candidate (preprocessing inside the pipeline), score
    train and validation, rank by validation MAE."""
    train = train.where(F.col(label).isNotNull())
    # preprocessing is fitted once; its encoded train / validation frames are checkpointed
    # (lineage cut, executor-loss safe) and shared by the seven regressors
    pre = fit_preprocessing(train, numeric, categorical)
    enc_train = pre.transform(train).checkpoint()
    enc_val = pre.transform(val).checkpoint()
    fits, data = candidates(enc_train, label, n_trees, **params)

    def fitted(name: str) -> tuple:
        reg = fits[name]()
        row = {"model": name, **_metric_row(reg.transform(enc_train), "train", label),
               **_metric_row(reg.transform(enc_val), "val", label)}
        if hasattr(reg, "release"):     # a model's broadcast stays at the driver, beside the model
            reg.release()
        return reg, row

    names = [name for name in fits if not only or name in only]
    with ThreadPoolExecutor(FIT_THREADS) as pool:
        # the last candidates take the most passes one after the other, so they start first
        started = [pool.submit(inheritable_thread_target(train.sparkSession)(fitted), name) for name in reversed(names)]
        done = [f.result() for f in reversed(started)]
    data.release()
    pipes = {name: PipelineModel(stages=[*pre.stages, reg]) for name, (reg, _) in zip(names, done)}
    spark = train.sparkSession
    results = spark.createDataFrame([row for _, row in done]).orderBy("val_MAE", "model")
    best = results.first()["model"]
    means = enc_train.select(Summarizer.mean(F.col("features")).alias("m")).first()
    means = means["m"].toArray().tolist() if means["m"] is not None else []
    return Comparison(results, pipes, best, feature_names(pipes[best], numeric, categorical), enc_train,
                      means, n_trees)


def feature_names(model: PipelineModel, numeric: Sequence[str] = NUMERIC_FEATURES,
                  categorical: Sequence[str] = CATEGORICAL_FEATURES) -> list[str]:
    """ML-05: encoded feature names: the numerics, then ``<column>_<category>`` for every
    category seen in training (alphabetical), in vector order."""
    idx = next(s for s in model.stages if hasattr(s, "labelsArray"))
    names = list(numeric)
    for c, labels in zip(categorical, idx.labelsArray):
        names.extend(f"{c}_{lab}" for lab in labels)
    return names


def importances(model: PipelineModel, names: Sequence[str]) -> list[tuple[str, float]]:
    """ML-05: tree importances, or absolute coefficients for linear models."""
    reg = model.stages[-1]
    if hasattr(reg, "featureImportances"):
        vals = reg.featureImportances.toArray().tolist()
    else:
        vals = [abs(v) for v in reg.coefficients.toArray().tolist()]
    return list(zip(names, vals))


def importance_frame(spark, model: PipelineModel, names: Sequence[str]) -> DataFrame:
    return spark.createDataFrame(importances(model, names), "feature string, importance double")


def metadata_frame(spark, comp: Comparison, test_metrics: dict,
                   numeric: Sequence[str] = NUMERIC_FEATURES,
                   categorical: Sequence[str] = CATEGORICAL_FEATURES) -> DataFrame:
    """SNK-04: the run metadata as one nested row."""
    val_rows = [r.asDict() for r in comp.results.collect()]  # seven rows
    meta = {"best_model": comp.best_name, "feature_names": comp.feature_names,
            "numeric_features": list(numeric), "categorical_features": list(categorical),
            "target": TARGET, "feature_means": comp.feature_means, "test_metrics": test_metrics, "val_results": val_rows,
            "n_trees": comp.n_trees,
            "note": f"{SECOND_ORDER}: second-order gain, L2 leaves, columns drawn once a tree, on binned features"}
    return spark.read.json(spark.sparkContext.parallelize([json.dumps(meta)]))


def save_run(comp: Comparison, meta: DataFrame, path: str) -> None:
    """SNK-03 / SNK-04: persist the best pipeline and the metadata."""
    comp.pipelines[comp.best_name].write().overwrite().save(f"{path}/best_pipeline")
    meta.coalesce(1).write.mode("overwrite").json(f"{path}/metadata")


def load_run(spark, path: str) -> tuple[PipelineModel, DataFrame]:
    """SRC-03: re-load the pipeline and the metadata."""
    return PipelineModel.load(f"{path}/best_pipeline"), spark.read.json(f"{path}/metadata")


# --- the run store ----------------------------------------------------------------------------------
def _file_system(spark, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def input_state(spark, folder: str) -> list[tuple]:
    """Name, size and time of change of every file of a folder of tables, one level of folders deep."""
    fs, top = _file_system(spark, folder)
    out, todo = [], [top]
    while todo:
        for f in fs.listStatus(todo.pop()):
            if f.isDirectory():
                todo.append(f.getPath())
            else:
                out.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    return sorted(out)


def committed(spark, path: str) -> bool:
    """Whether a run was stored under ``path`` as a whole."""
    fs, folder = _file_system(spark, path)
    return fs.exists(spark._jvm.org.apache.hadoop.fs.Path(folder, "_COMMITTED"))


def commit_run(spark, path: str, write) -> None:
    """Store a run: ``write(folder)`` fills a folder of its own, which then takes the run's name in
    one rename. Of several writers the first wins; the others' folders go."""
    tmp = f"{path}.{uuid.uuid4().hex}"
    write(tmp)
    fs, source = _file_system(spark, tmp)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    fs.create(hadoop(source, "_COMMITTED")).close()
    if fs.exists(hadoop(path)) or not fs.rename(source, hadoop(path)):
        fs.delete(source, True)


def loaded_run(spark, path: str, train: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
               categorical: Sequence[str] = CATEGORICAL_FEATURES) -> tuple[Comparison, dict]:
    """A stored run's comparison (its best pipeline only) and test metrics; nothing is fitted."""
    model, meta = load_run(spark, path)
    m = meta.first().asDict(recursive=True)                # one row
    results = spark.createDataFrame(m["val_results"]).orderBy("val_MAE", "model")
    encoded = PipelineModel(stages=model.stages[:-1]).transform(train)
    return Comparison(results, {m["best_model"]: model}, m["best_model"], m["feature_names"], encoded,
                      m["feature_means"], m["n_trees"]), m["test_metrics"]
