"""CSV files in, features, splits, model and error summary out."""

import json
import os

import pytest

from conftest import SMALL
from shipcast import pipeline
from shipcast.operators.features import build_features
from shipcast.sources.market_csv import CSV_COLUMNS, load_market_csv
from shipcast.sources.tables import load_market


@pytest.fixture(scope="module")
def csv_dir(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("market")
    m = load_market(spark, SMALL)
    for name, cols in CSV_COLUMNS.items():
        frame = getattr(m, name).select(*cols).toPandas()
        frame.insert(0, "unused", "x")
        frame.to_csv(d / f"{name}.csv", index=False)
    return str(d)


def test_features_from_csv_equal_those_from_tables(spark, csv_dir):
    a = build_features(load_market_csv(spark, csv_dir)).toPandas()
    b = build_features(load_market(spark, SMALL)).toPandas()
    for f in (a, b):
        f["order_id"] = f["order_id"].astype(str)
        f.sort_values("order_id", inplace=True, ignore_index=True)
    assert len(a) == len(b) > 1000
    for c in ("delivery_time_days", "price", "distance_km", "product_volume_cm3", "n_items"):
        assert (abs(a[c].fillna(-1) - b[c].fillna(-1)) < 1e-6).all(), c
    assert (a["product_category_name_english"] == b["product_category_name_english"]).all()


def test_missing_file_and_column_are_named(spark, csv_dir):
    with pytest.raises(FileNotFoundError, match="other.csv"):
        load_market_csv(spark, csv_dir, {"orders": "other.csv"})
    with pytest.raises(ValueError, match="order_status"):
        load_market_csv(spark, csv_dir, {"orders": "items.csv"})


def test_multi_line_comments_survive(spark, csv_dir):
    a = load_market_csv(spark, csv_dir).reviews
    b = load_market(spark, SMALL).reviews
    assert a.count() == b.count()
    assert a.where("review_comment_message IS NOT NULL").count() == b.where("review_comment_message IS NOT NULL").count()


def test_files_to_files(spark, csv_dir, tmp_path):
    out = str(tmp_path / "out")
    summary = pipeline.run(load_market_csv(spark, csv_dir), out, n_trees=3).first()
    assert summary["within_2d_pct"] >= summary["within_1d_pct"] and len(summary["worst_categories"]) == 5
    files = os.listdir(f"{out}/error_analysis/summary")
    (part,) = [f for f in files if f.startswith("part-") and f.endswith(".json")]
    with open(f"{out}/error_analysis/summary/{part}") as f:
        assert json.loads(f.read())["bias_days"] == summary["bias_days"]
    test_rows = spark.read.parquet(f"{out}/splits").where("split = 'test'").count()
    assert spark.read.parquet(f"{out}/error_analysis/orders").count() == test_rows > 0
