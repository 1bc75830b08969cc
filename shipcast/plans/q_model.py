"""Queries: models, scoring and sinks (ML-01..ML-09, TK-01/04/05, PRJ-17/18/19, SNK-01..04,
SRC-03). Fitted-model outputs get the rows-only check; the projections that do not depend on
a fitted model (note, validation, rounding, sinks) are checked against DuckDB."""

from __future__ import annotations

import hashlib
import json

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import audit as au
from ..operators import linear
from ..operators import model as md
from ..operators import scoring as sc
from ..operators import split as sp
from ..operators.features import CATEGORICAL_FEATURES, FEATURE_COLUMNS, NUMERIC_FEATURES, TARGET
from ..session import scratch_path
from .catalog import finalize, folder_tag, query, ts_sql
from .q_audit import AUDIT_CTES, fixed_predictions
from .q_features import FEATURE_CTES, FEATURE_SELECT_SQL, features
from .q_split import SPLIT_CTES, _model_cols_sql, model_frame, notebook_frame

_RUNS: dict = {}


def run_key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    """Key of a cached run; runs of applications that have ended are forgotten."""
    app = spark.sparkContext.applicationId
    for old in [k for k in _RUNS if k[0] != app]:
        del _RUNS[old]
    return app, sf_dir.rstrip("/"), name


def n_trees(spark: SparkSession, default: int = md.DEFAULT_TREES) -> int:
    """Trees per ensemble: ``shipcast.model.trees`` when the job sets it, else ``default``."""
    return int(spark.conf.get("shipcast.model.trees", None) or default)


def store_path(spark: SparkSession, sf_dir: str, name: str, trees: int) -> str:
    """Where a fitted run of these tables and settings is kept: in ``shipcast.run.store`` if the job
    names one, else in the checkpoint folder. Other input files or settings give another path."""
    told = [name, trees, md.SEED, NUMERIC_FEATURES, CATEGORICAL_FEATURES, md.input_state(spark, sf_dir.rstrip("/"))]
    key = hashlib.sha256(json.dumps([RUN_FORMAT, *told]).encode()).hexdigest()[:32]
    base = spark.conf.get("shipcast.run.store", None) or scratch_path(spark, "runs")
    return f"{base.rstrip('/')}/{key}"


# Raise it when the way models are fitted changes: stored runs of other formats are not read.
RUN_FORMAT = 1


def main_run(spark: SparkSession, sf_dir: str) -> dict:
    """Fit the seven candidates on train, rank on validation, score test once; a run that any session
    has stored is loaded instead."""
    key = run_key(spark, sf_dir, "main")
    if key not in _RUNS:
        trees = n_trees(spark)
        path = store_path(spark, sf_dir, "main", trees)
        mf = model_frame(spark, sf_dir)
        train, val, test = (mf.where(F.col("split") == s) for s in ("train", "val", "test"))
        if md.committed(spark, path):
            comp, test_metrics = md.loaded_run(spark, path, train)
        else:
            comp = md.compare(train, val, n_trees=trees)
            test_metrics = au.metrics(comp.pipelines[comp.best_name].transform(test)).first().asDict()
            md.commit_run(spark, path, lambda p: md.save_run(comp, md.metadata_frame(spark, comp, test_metrics), p))
        _RUNS[key] = {"comp": comp, "best": comp.pipelines[comp.best_name], "test": test,
                      "test_metrics": test_metrics}
    return _RUNS[key]


# fixed values of the reference: the notebook's model presets
NB_PRESETS = dict(gbt_step=0.1, gbt_depth=5, rf_min_leaf=1, gbt_subsample=1.0, columns=1.0)
NB_TREES = 100


def notebook_run(spark: SparkSession, sf_dir: str) -> dict:
    """ML-08 / ML-09: the notebook's log-target experiment with its model presets."""
    key = run_key(spark, sf_dir, "notebook")
    if key not in _RUNS:
        trees = n_trees(spark, NB_TREES)
        path = store_path(spark, sf_dir, "notebook", trees)
        if not md.committed(spark, path):
            nb = notebook_frame(spark, sf_dir)
            cols = list(dict.fromkeys(sp.NOTEBOOK_NUMERIC + sp.NOTEBOOK_CATEGORICAL))
            nb = nb.dropna(subset=cols)
            train, test = nb.where(F.col("split") == "train"), nb.where(F.col("split") == "test")
            comp = md.compare(train, test, n_trees=trees, numeric=sp.NOTEBOOK_NUMERIC,
                              categorical=sp.NOTEBOOK_CATEGORICAL, label="delivery_time_log", **NB_PRESETS)
            rows = []
            for name, pipe in comp.pipelines.items():
                s = pipe.transform(test).select(TARGET, F.expm1("prediction").alias("prediction"))
                m = au.metrics(s).first().asDict()
                rows.append({"model": name, **{k: m[k] for k in ("MAE", "RMSE", "R2", "within_2d")}})
                if hasattr(pipe.stages[-1], "release"):
                    pipe.stages[-1].release()
            md.commit_run(spark, path, lambda p: spark.createDataFrame(rows).coalesce(1).write.parquet(f"{p}/results"))
        # ranked in days: the models are fitted on log days
        results = spark.read.parquet(f"{path}/results").orderBy("MAE", "model")
        _RUNS[key] = {"results": results, "n_trees": trees}
    return _RUNS[key]


@query("ml_01")
def ml_01(spark, sf_dir):
    """ML-01: encoded model inputs (median impute, standardise, one-hot) for every split."""
    mf = model_frame(spark, sf_dir)
    enc = md.fit_preprocessing(mf.where(F.col("split") == "train")).transform(mf)
    return enc.select("order_id", "split", vector_to_array("features").alias("features"))


@query("ml_01_scales", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS median, "
    f"round(avg(CAST({c} AS DOUBLE)), 6) AS mean, round(stddev_pop(CAST({c} AS DOUBLE)), 6) AS std "
    "FROM t_model WHERE split = 'train'" for c in NUMERIC_FEATURES) + ")", SPLIT_CTES)
def ml_01_scales(spark, sf_dir):
    """ML-01: the train medians, means and deviations that impute and standardise the numerics."""
    train = model_frame(spark, sf_dir).where(F.col("split") == "train")
    return finalize(spark.createDataFrame(md.scales(train), "feature string, median double, mean double, std double"))


# Products summed over rows: a row as (name, value) pairs, joined with itself.
_GRAM_SQL = f"""WITH tr AS (SELECT * FROM t_model WHERE split = 'train'),
 p AS (SELECT order_id, 'one' AS name, 1.0::DOUBLE AS v FROM tr
   UNION ALL SELECT order_id, 'target', {TARGET} FROM tr
   {" ".join(f"UNION ALL SELECT order_id, '{c}', (CAST({c} AS DOUBLE) - (SELECT avg(CAST({c} AS DOUBLE)) FROM tr)) / "
             f"(SELECT CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) = 0 THEN 1 ELSE stddev_pop(CAST({c} AS DOUBLE)) END FROM tr) FROM tr"
             for c in NUMERIC_FEATURES)}
   {" ".join(f"UNION ALL SELECT order_id, '{c}_' || CAST({c} AS VARCHAR), 1.0 FROM tr" for c in CATEGORICAL_FEATURES)}),
 s AS (SELECT a.name AS a, b.name AS b, sum(a.v * b.v) AS total FROM p a JOIN p b USING (order_id) GROUP BY 1, 2),
 n AS (SELECT DISTINCT name FROM p)
 SELECT x.name AS a, y.name AS b, round(coalesce(s.total, 0.0) / (SELECT count(*) FROM tr), 6) AS mean_product
 FROM n x CROSS JOIN n y LEFT JOIN s ON s.a = x.name AND s.b = y.name"""


@query("ml_02_gram", _GRAM_SQL, SPLIT_CTES)
def ml_02_gram(spark, sf_dir):
    """ML-02: the Gram matrix (means of products) from which the linear candidates are solved."""
    train = model_frame(spark, sf_dir).where(F.col("split") == "train")
    pre = md.fit_preprocessing(train)
    names = ["one", *md.feature_names(pre), "target"]
    g = linear.gram(pre.transform(train), TARGET)
    rows = [(a, b, float(g[i, j] / g[0, 0])) for i, a in enumerate(names) for j, b in enumerate(names)]
    return finalize(spark.createDataFrame(rows, "a string, b string, mean_product double"))


@query("ml_02")
def ml_02(spark, sf_dir):
    """ML-02: the seven candidates with their train-split metrics."""
    res = main_run(spark, sf_dir)["comp"].results
    return finalize(res.select("model", *[c for c in res.columns if c.startswith("train_")]))


@query("ml_03")
def ml_03(spark, sf_dir):
    """ML-03: validation results table, best first."""
    res = main_run(spark, sf_dir)["comp"].results
    return finalize(res.select("model", *[c for c in res.columns if c.startswith("val_")]))


@query("tk_01")
def tk_01(spark, sf_dir):
    """TK-01: the model with the lowest validation MAE."""
    res = main_run(spark, sf_dir)["comp"].results
    return finalize(res.orderBy("val_MAE", "model").limit(1).select("model", "val_MAE"))


@query("ml_04")
def ml_04(spark, sf_dir):
    """ML-04: the chosen model scored once on test."""
    r = main_run(spark, sf_dir)
    m = r["test_metrics"]
    return finalize(spark.createDataFrame([{"model": r["comp"].best_name, **m}]))


@query("ml_05")
def ml_05(spark, sf_dir):
    """ML-05: encoded feature names and the chosen model's importances."""
    r = main_run(spark, sf_dir)
    return finalize(md.importance_frame(spark, r["best"], r["comp"].feature_names))


@query("tk_04")
def tk_04(spark, sf_dir):
    """TK-04: top 20 importances."""
    return ml_05(spark, sf_dir).orderBy(F.desc("importance"), "feature").limit(20)


def scored_test(spark, sf_dir) -> DataFrame:
    r = main_run(spark, sf_dir)
    req = r["test"].select("order_id", *sc.REQUEST_FIELDS)
    return sc.score(req, r["best"], r["comp"].feature_names, r["comp"].feature_means)


@query("ml_06")
def ml_06(spark, sf_dir):
    """ML-06: per-order contributions; base + sum of contributions = raw prediction."""
    s = scored_test(spark, sf_dir)
    return finalize(s.select("order_id", "raw_prediction", "base_value", "contribution_sum",
                             (F.abs(F.col("base_value") + F.col("contribution_sum") - F.col("raw_prediction"))
                              < 1e-6).alias("additive")))


@query("ml_07")
def ml_07(spark, sf_dir):
    """ML-07: batch scoring (validate, predict, floor, note, top contributions)."""
    s = scored_test(spark, sf_dir)
    return s.select("order_id", "violations", "predicted_delivery_days", "confidence_note", "top_features")


@query("tk_05")
def tk_05(spark, sf_dir):
    """TK-05: the five largest contributions per order, one row each."""
    s = scored_test(spark, sf_dir)
    return finalize(s.select("order_id", F.posexplode("top_features").alias("rank", "f")).select(
        "order_id", (F.col("rank") + 1).alias("rank"), "f.feature", "f.shap_value", "f.direction"))


@query("ml_08")
def ml_08(spark, sf_dir):
    """ML-08: log-target experiment (extended features, fit on log1p, metrics in days)."""
    return finalize(notebook_run(spark, sf_dir)["results"])


@query("ml_09")
def ml_09(spark, sf_dir):
    """ML-09: the notebook's model presets, with their validation ranking."""
    run = notebook_run(spark, sf_dir)
    return finalize(run["results"].select(
        "model", F.lit(run["n_trees"]).cast("long").alias("n_trees"),
        F.lit(NB_PRESETS["gbt_step"]).alias("gbt_learning_rate"),
        F.lit(NB_PRESETS["gbt_depth"]).cast("long").alias("gbt_depth"), F.col("MAE").alias("val_MAE")))


# --- projections of scoring that need no fitted model: checked against DuckDB -------------------
_NOTE_SQL = (f"CASE WHEN abs(seller_avg_delivery - {sc.NEW_SELLER_AVG}) < {sc.NEW_SELLER_TOLERANCE} THEN '{sc.NOTE_NEW}' "
             f"WHEN distance_km > {sc.LONG_DISTANCE_KM} THEN '{sc.NOTE_FAR}' "
             f"WHEN purchase_month IN ({', '.join(map(str, sc.HOLIDAY_MONTHS))}) THEN '{sc.NOTE_HOLIDAY}' "
             f"ELSE '{sc.NOTE_OK}' END")


@query("prj_17", f"SELECT order_id, {_NOTE_SQL} AS confidence_note FROM a_err", AUDIT_CTES)
def prj_17(spark, sf_dir):
    """PRJ-17: confidence note for every test order."""
    return finalize(fixed_predictions(spark, sf_dir).select("order_id", sc.confidence_note().alias("confidence_note")))


@query("prj_19", """SELECT order_id, round_even(greatest(predicted, 1.0), 1) AS predicted_delivery_days FROM a_err""",
       AUDIT_CTES)
def prj_19(spark, sf_dir):
    """PRJ-19: prediction floored at one day and rounded half-even (fixed predictor)."""
    return finalize(fixed_predictions(spark, sf_dir).select("order_id", sc.final_prediction().alias(
        "predicted_delivery_days")))


def _violation_count_sql() -> str:
    parts = [f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in sc.REQUEST_FIELDS if c not in sc.DEFAULTS]
    parts += [f"CASE WHEN {c} < 0 THEN 1 ELSE 0 END" for c in sc.NON_NEGATIVE]
    parts += [f"CASE WHEN {c} < {lo} OR {c} > {hi} THEN 1 ELSE 0 END" for c, (lo, hi) in sc.RANGES.items()
              if c != "is_weekend"]
    parts += ["CASE WHEN coalesce(n_items, 1) < 1 THEN 1 ELSE 0 END"]
    return " + ".join(parts)


@query("prj_18", f"""SELECT order_id, CAST({_violation_count_sql()} AS BIGINT) AS n_violations,
 ({_violation_count_sql()}) = 0 AS is_valid FROM t_model WHERE split = 'test'""", SPLIT_CTES)
def prj_18(spark, sf_dir):
    """PRJ-18: request validation (defaults, bounds) over the test orders as requests."""
    mf = model_frame(spark, sf_dir).where(F.col("split") == "test")
    v = sc.validate(mf.select("order_id", *sc.REQUEST_FIELDS))
    return finalize(v.select("order_id", F.size("violations").cast("long").alias("n_violations"),
                             (F.size("violations") == 0).alias("is_valid")))


# Requests spoilt by order id: a negative price, a month and an hour out of range, no distance.
SPOILT = {"price": ("order_id % 3 = 0", "-1.0"), "purchase_month": ("order_id % 5 = 0", "13"),
          "purchase_hour": ("order_id % 11 = 0", "24"), "distance_km": ("order_id % 7 = 0", "NULL")}


@query("prj_18_spoilt", f"""WITH s AS (SELECT * REPLACE ({", ".join(
    f"CASE WHEN {cond} THEN {v} ELSE {c} END AS {c}" for c, (cond, v) in SPOILT.items())}) FROM t_model WHERE split = 'test')
 SELECT order_id, CAST({_violation_count_sql()} AS BIGINT) AS n_violations, ({_violation_count_sql()}) = 0 AS is_valid FROM s""",
       SPLIT_CTES)
def prj_18_spoilt(spark, sf_dir):
    """PRJ-18 over requests that break the rules."""
    mf = model_frame(spark, sf_dir).where(F.col("split") == "test").select("order_id", *sc.REQUEST_FIELDS)
    mf = mf.withColumns({c: F.when(F.expr(cond), F.expr(v).cast(mf.schema[c].dataType)).otherwise(F.col(c))
                         for c, (cond, v) in SPOILT.items()})
    v = sc.validate(mf)
    return finalize(v.select("order_id", F.size("violations").cast("long").alias("n_violations"),
                             (F.size("violations") == 0).alias("is_valid")))


# --- sinks and sources ----------------------------------------------------------------------------
def _out(spark, sf_dir, name: str) -> str:
    return scratch_path(spark, f"{folder_tag(sf_dir)}/{name}")


@query("snk_01", f"SELECT {FEATURE_SELECT_SQL} FROM t_feat", FEATURE_CTES)
def snk_01(spark, sf_dir):
    """SNK-01: the feature table written as parquet and read back."""
    path = _out(spark, sf_dir, "features.parquet")
    features(spark, sf_dir).select(*FEATURE_COLUMNS).write.mode("overwrite").parquet(path)
    return finalize(spark.read.parquet(path))


@query("snk_02", f"""SELECT order_id, split, {_model_cols_sql()}, seller_id,
 {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp FROM t_model""", SPLIT_CTES)
def snk_02(spark, sf_dir):
    """SNK-02: the three splits in one parquet dataset partitioned by split (pruned reads)."""
    path = _out(spark, sf_dir, "splits.parquet")
    mf = model_frame(spark, sf_dir)
    cols = ["order_id", *dict.fromkeys(NUMERIC_FEATURES + CATEGORICAL_FEATURES), TARGET, "seller_id",
            "order_purchase_timestamp", "split"]
    mf.select(*cols).write.mode("overwrite").partitionBy("split").parquet(path)
    back = spark.read.parquet(path)
    return finalize(back.select(*cols))


@query("snk_03")
def snk_03(spark, sf_dir):
    """SNK-03 + SRC-03: persist the chosen pipeline, re-load it, score test with both; the
    predictions must be equal."""
    r = main_run(spark, sf_dir)
    path = _out(spark, sf_dir, "models-snk_03")
    meta = md.metadata_frame(spark, r["comp"], r["test_metrics"])
    md.save_run(r["comp"], meta, path)
    loaded, _ = md.load_run(spark, path)
    a = r["best"].transform(r["test"]).select("order_id", F.col("prediction").alias("p_fitted"))
    b = loaded.transform(r["test"]).select("order_id", F.col("prediction").alias("p_loaded"))
    return finalize(a.join(b, "order_id").withColumn("equal", F.abs(F.col("p_fitted") - F.col("p_loaded")) < 1e-9))


@query("snk_04")
def snk_04(spark, sf_dir):
    """SNK-04: run metadata (names, metrics, results) written as JSON and read back."""
    r = main_run(spark, sf_dir)
    path = _out(spark, sf_dir, "metadata")
    md.metadata_frame(spark, r["comp"], r["test_metrics"]).coalesce(1).write.mode("overwrite").json(path)
    back = spark.read.json(path)
    return back.select("best_model", F.size("feature_names").alias("n_features"), "target",
                       F.col("test_metrics.MAE").alias("test_MAE"), F.size("val_results").alias("n_models"))


@query("ml_13_fitted")
def ml_13_fitted(spark, sf_dir):
    """ML-10 / ML-13: the audit of the fitted best model: its error summary on the test split."""
    r = main_run(spark, sf_dir)
    err = au.residual_frame(r["best"].transform(r["test"]))
    path = _out(spark, sf_dir, "fitted-error-summary")
    au.write_summary(au.error_summary(err), path)
    s = au.read_summary(spark, path)
    return finalize(s.withColumn("worst_categories", F.array_join("worst_categories", "|"))
                    .withColumn("notes", F.size("notes")).withColumnRenamed("notes", "n_notes"))


@query("src_03")
def src_03(spark, sf_dir):
    """SRC-03: re-load model, metadata and the written test split; score the test split."""
    path = _out(spark, sf_dir, "models-src_03")
    r = main_run(spark, sf_dir)
    md.save_run(r["comp"], md.metadata_frame(spark, r["comp"], r["test_metrics"]), path)
    model, meta = md.load_run(spark, path)
    splits = _out(spark, sf_dir, "splits.parquet")
    snk_02(spark, sf_dir)
    test = spark.read.parquet(splits).where(F.col("split") == "test")  # partition pruning
    best = meta.select("best_model").first()[0]
    return finalize(model.transform(test).select("order_id", F.lit(best).alias("model"), "prediction"))


@query("st_01")
def st_01(spark, sf_dir):
    """ST-01: online scoring as a stream: the test orders are written as request files,
    scored micro-batch by micro-batch with the batch scoring function, and read back."""
    import uuid

    from ..streaming.scoring_stream import run_to_completion

    r = main_run(spark, sf_dir)
    run = uuid.uuid4().hex[:8]
    req_dir = _out(spark, sf_dir, f"stream-{run}/requests")
    r["test"].select(*[f.name for f in sc.REQUEST_SCHEMA.fields]).write.parquet(req_dir)
    out = run_to_completion(spark, req_dir, _out(spark, sf_dir, f"stream-{run}/scored"),
                            _out(spark, sf_dir, f"stream-{run}/checkpoint"), r["best"],
                            r["comp"].feature_names, r["comp"].feature_means)
    return out.select("order_id", "predicted_delivery_days", "confidence_note", "top_features")
