"""Train-only statistics do not see test targets; models, contributions and streaming."""

import uuid

from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SMALL
from shipcast.operators import split as sp
from shipcast.plans.q_split import labelled


def test_changing_test_targets_leaves_train_statistics(spark):
    lab = labelled(spark, SMALL)
    cols = ["seller_avg_delivery", "seller_std_delivery", "cat_avg_processing", "distance_km"]
    base = sp.with_train_stats(lab).select("order_id", *cols)
    shifted = lab.withColumn("delivery_time_days", F.when(F.col("split") == "test", F.col("delivery_time_days") + 100)
                             .otherwise(F.col("delivery_time_days")))
    other = sp.with_train_stats(shifted).select("order_id", *cols)
    assert base.exceptAll(other).count() == 0


def test_split_sizes_follow_floor_rule(spark):
    lab = labelled(spark, SMALL)
    n = lab.count()
    counts = {r["split"]: r["count"] for r in lab.groupBy("split").count().collect()}
    assert counts["train"] == int(n * 0.70)
    assert counts["train"] + counts["val"] == int(n * (0.70 + 0.15))


def test_contributions_are_additive_and_stream_equals_batch(spark):
    q = E.queries()
    add = q["ml_06"](spark, SMALL)
    assert add.where(~F.col("additive")).count() == 0
    batch = q["ml_07"](spark, SMALL).select("order_id", "predicted_delivery_days", "confidence_note")
    stream = q["st_01"](spark, SMALL).select("order_id", "predicted_delivery_days", "confidence_note")
    assert stream.count() == batch.count()
    assert stream.exceptAll(batch).count() == 0


def test_tree_path_attribution_is_additive(spark):
    from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
    from shipcast.operators import scoring as sc
    from shipcast.plans.q_model import main_run
    r = main_run(spark, SMALL)
    enc = r["comp"].encoded_train
    for est in (GBTRegressor(maxIter=4, maxDepth=3, seed=1), RandomForestRegressor(numTrees=3, maxDepth=4, seed=1)):
        est.setLabelCol("delivery_time_days")
        from pyspark.ml import PipelineModel
        reg = est.fit(enc)
        pm = PipelineModel(stages=[reg])
        out = sc.tree_contributions(reg.transform(enc), pm)
        bad = out.select((F.abs(F.col("base_value") + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
                                - F.col("prediction")) > 1e-6).alias("bad")).where("bad").count()
        assert bad == 0, type(reg).__name__


def test_saved_pipeline_predicts_the_same(spark):
    out = E.queries()["snk_03"](spark, SMALL)
    assert out.count() > 0 and out.where(~F.col("equal")).count() == 0
