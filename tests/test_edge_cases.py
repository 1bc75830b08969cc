"""Literal-frame edge cases (FIXTURES section 4) and Appendix A traps."""

import datetime as dt

from pyspark.sql import functions as F

from shipcast.functions import timeops as t
from shipcast.functions.exprs import bucket, clip
from shipcast.operators import audit as au
from shipcast.operators import reports as rp
from shipcast.operators import scoring as sc
from shipcast.operators import split as sp


def test_bin_edges_right_closed(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 1.5, 8.0)], "abs_error double")
    got = [r[0] for r in df.select(bucket("abs_error", au.ERROR_EDGES, au.ERROR_LABELS)).collect()]
    assert got == [None, "≤1d", "≤1d", "1–2d", ">7d"]


def test_floor_days_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1, 12), dt.datetime(2020, 1, 2))], "a timestamp, b timestamp")
    assert df.select(t.floor_days("a", "b")).first()[0] == -1


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (45.0,), (-3.0,)], "x double")
    assert [r[0] for r in df.select(clip("x", 0, 30)).collect()] == [None, 30.0, 0.0]


def test_null_delivery_is_not_late(spark):
    df = spark.createDataFrame(
        [(1, "delivered", None, dt.datetime(2020, 1, 5))],
        "order_id long, order_status string, order_delivered_customer_date timestamp, "
        "order_estimated_delivery_date timestamp")
    r = rp.delivered_status_orders(df).first()
    assert r["delay_days"] is None and r["is_late"] is False


def test_sum_of_nulls_is_zero_and_mode_tie_is_smallest(spark):
    from shipcast.operators.features import order_rollup
    rows = [(1, i, None, "b" if i < 2 else "a") for i in range(4)]
    oi = spark.createDataFrame(rows, "order_id long, order_item_id int, product_weight_kg double, "
                                     "product_category_name_english string")
    oi = oi.select("*", F.lit(dt.datetime(2020, 1, 1)).alias("order_purchase_timestamp"),
                   *[F.lit(None).cast("double").alias(c) for c in (
                       "delivery_time_days", "processing_days", "transit_days", "distance_km",
                       "product_volume_cm3", "price", "freight_value", "freight_ratio")],
                   *[F.lit(None).cast("long").alias(c) for c in (
                       "customer_zip_code_prefix", "product_id", "seller_id", "seller_zip_code_prefix")],
                   *[F.lit(None).cast("string").alias(c) for c in ("customer_state", "seller_state")])
    r = order_rollup(oi).first()
    assert r["product_weight_kg"] == 0.0 and r["price"] == 0.0 and r["n_items"] == 0
    assert r["product_category_name_english"] == "a"


def _split_frame(spark, rows):
    return spark.createDataFrame(rows, "order_id long, split string, seller_id long, "
                                       "product_category_name_english string, processing_days double, "
                                       "transit_days double, delivery_time_days double, distance_km double")


def test_singleton_std_falls_back_to_zero(spark):
    df = _split_frame(spark, [(1, "train", 7, "a", 1.0, 2.0, 3.0, 10.0),
                              (2, "train", 8, "a", 2.0, 3.0, 5.0, None),
                              (3, "test", 9, "z", 1.0, 1.0, 1.0, None)])
    out = {r["order_id"]: r for r in sp.with_train_stats(df).collect()}
    assert out[1]["seller_std_delivery"] == 0.0
    assert out[3]["seller_avg_delivery"] == 4.0  # unseen seller: global train mean
    assert out[3]["distance_km"] == 10.0          # train median
    assert out[3]["cat_avg_processing"] == 1.5    # unseen category: global


def test_rolling_window_matches_definition(spark):
    rows = [(i, 5, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), float(i)) for i in range(60)]
    df = spark.createDataFrame(rows, "order_id long, seller_id long, order_purchase_timestamp timestamp, "
                                     "delivery_time_days double")
    r = {x["order_id"]: x for x in sp.rolling_seller_stats(df).collect()}
    assert all(r[i]["seller_roll_avg_delivery"] is None for i in range(5))
    assert r[5]["seller_roll_avg_delivery"] == 2.0
    assert r[59]["seller_roll_avg_delivery"] == 33.5


def test_note_order_new_seller_wins(spark):
    df = spark.createDataFrame([(12.5, 3000.0, 12)], "seller_avg_delivery double, distance_km double, "
                                                     "purchase_month long")
    assert df.select(sc.confidence_note()).first()[0] == sc.NOTE_NEW


def test_prediction_floor_and_half_even(spark):
    df = spark.createDataFrame([(0.3,), (12.25,), (12.35,)], "prediction double")
    assert [r[0] for r in df.select(sc.final_prediction()).collect()] == [1.0, 12.2, 12.4]


def test_validation_flags_bounds_and_defaults(spark):
    from shipcast.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES
    row = {c: 1.0 for c in NUMERIC_FEATURES}
    row.update(purchase_hour=25, n_items=None, purchase_month=1, purchase_day_of_week=0,
               purchase_quarter=1, is_weekend=3, product_category_name_english=None,
               seller_avg_delivery=None, distance_km=-1.0)
    df = spark.createDataFrame([row], sc.REQUEST_SCHEMA.simpleString().replace(",order_id:bigint", ""))
    r = sc.validate(df).first()
    assert r["n_items"] == 1 and r["seller_avg_delivery"] == 12.5 and r["is_weekend"] == 1
    assert r["product_category_name_english"] == "unknown"
    assert sorted(r["violations"]) == ["distance_km: must be >= 0", "purchase_hour: must be in 0..23"]
