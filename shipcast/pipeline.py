"""The whole run from files to files: features, split, training, audit.

usage: spark-submit shipcast/pipeline.py <directory of nine CSV files> <output directory>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.operators import audit, model, split
from shipcast.operators.features import build_features
from shipcast.session import get_spark
from shipcast.sources.market_csv import load_market_csv
from shipcast.sources.tables import Market


def run(market: Market, out_dir: str, n_trees: int = model.DEFAULT_TREES) -> DataFrame:
    """Write ``features``, ``splits`` (by split), ``models`` (the best pipeline and the run's
    metadata), ``error_analysis/orders`` and ``error_analysis/summary`` under ``out_dir``; each
    step reads what the one before wrote. Returns the error summary as read back."""
    out = out_dir.rstrip("/")
    features = build_features(market)
    spark = features.sparkSession
    features.write.mode("overwrite").parquet(f"{out}/features")
    frame = split.temporal_split(spark.read.parquet(f"{out}/features"))
    frame.write.mode("overwrite").partitionBy("split").parquet(f"{out}/splits")
    splits = spark.read.parquet(f"{out}/splits")
    train, val, test = (splits.where(F.col("split") == s) for s in ("train", "val", "test"))
    comparison = model.compare(train, val, n_trees=n_trees)
    scored = comparison.pipelines[comparison.best_name].transform(test)
    model.save_run(comparison, model.metadata_frame(spark, comparison, audit.metrics(scored).first().asDict()),
                   f"{out}/models")
    best, _ = model.load_run(spark, f"{out}/models")
    errors = audit.residual_frame(best.transform(test))
    keep = ["order_id", "predicted", "residual", "abs_error", "over_predict", "error_bucket", "distance_band",
            "seller_tier"]
    errors.select(*keep).write.mode("overwrite").parquet(f"{out}/error_analysis/orders")
    audit.write_summary(audit.error_summary(errors), f"{out}/error_analysis/summary")
    return audit.read_summary(spark, f"{out}/error_analysis/summary")


def main(source: str, out_dir: str) -> None:
    spark = get_spark(app="shipcast-pipeline")
    run(load_market_csv(spark, source), out_dir).show(truncate=False)


if __name__ == "__main__":
    main(*sys.argv[1:3])
