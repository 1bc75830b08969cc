"""Order-level features (ML-11): targets, p99 cap, item-grain joins, order roll-up.

Plan shape: volumes, weights and category names are made at product grain; the items then meet
products and sellers (shuffle joins that AQE may turn into broadcasts once their runtime size
is known) and, dealt by order again, the delivered orders with their customer. The two bounded
lookups (zip prefixes, category names) are explicitly broadcast; left to the planner, a larger
product table would have sent all items to the few tasks that the categories name. The roll-up
groups by order_id on the partitioning the order join already produced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timeops as t
from ..functions.exprs import clip, haversine_km
from ..functions.quantile import quantiles
from ..sources.tables import Market

P99 = 0.99
RATIO_EPS = 1e-5

# feature contract (fixed values of the reference's model inputs)
NUMERIC_FEATURES = [
    "distance_km", "product_weight_kg", "product_volume_cm3", "price", "freight_value",
    "freight_ratio", "purchase_hour", "n_items", "seller_avg_delivery", "seller_std_delivery",
    "seller_avg_processing", "seller_std_processing", "seller_avg_transit", "seller_std_transit",
    "cat_avg_processing", "cat_avg_transit",
]
CATEGORICAL_FEATURES = [
    "purchase_month", "purchase_day_of_week", "purchase_quarter", "is_weekend",
    "product_category_name_english",
]
TARGET = "delivery_time_days"

FEATURE_COLUMNS = [
    "order_id", "distance_km", "product_weight_kg", "product_volume_cm3", "price",
    "freight_value", "freight_ratio", "purchase_month", "purchase_day_of_week", "purchase_hour",
    "is_weekend", "purchase_quarter", "n_items", "product_category_name_english", "seller_id",
    "delivery_time_days", "processing_days", "transit_days", "order_purchase_timestamp",
]
GEO_COLUMNS = ["seller_zip_code_prefix", "customer_zip_code_prefix", "seller_state",
               "customer_state"]


def durations(orders: DataFrame) -> DataFrame:
    """PRJ-01: fractional delivery, processing and transit days (unclipped)."""
    return orders.select(
        "order_id", "customer_id", "order_status", "order_purchase_timestamp",
        t.frac_days("order_delivered_customer_date", "order_purchase_timestamp")
        .alias("delivery_time_days"),
        t.frac_days("order_delivered_carrier_date", "order_approved_at").alias("processing_days"),
        t.frac_days("order_delivered_customer_date", "order_delivered_carrier_date")
        .alias("transit_days"),
    )


def clipped_durations(orders: DataFrame) -> DataFrame:
    """PRJ-02: processing clipped to 0..30, transit to 0..60, NULL kept."""
    d = durations(orders)
    return d.withColumn("processing_days", clip("processing_days", 0, 30)) \
            .withColumn("transit_days", clip("transit_days", 0, 60))


def with_delivery(orders: DataFrame) -> DataFrame:
    """FLT-01: orders that have a delivery time."""
    return clipped_durations(orders).where(F.col("delivery_time_days").isNotNull())


def delivery_cap(delivered: DataFrame, p: float = P99):
    """Scalar-subquery column with the exact interpolated p-th quantile of delivery time."""
    return quantiles(delivered, "delivery_time_days", {"q": p}).select("q").scalar()


def delivered_targets(orders: DataFrame, p: float = P99) -> DataFrame:
    """FLT-02: delivered orders at or under the exact p99 of delivery time."""
    d = with_delivery(orders)
    return d.where(F.col("delivery_time_days") <= delivery_cap(d, p))


def geo_lookup(geo: DataFrame) -> DataFrame:
    """AG-01: mean coordinates per zip prefix (a bounded domain: broadcastable)."""
    return geo.groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix")).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng"))


def order_items_enriched(m: Market, targets: DataFrame) -> DataFrame:
    """JN-01..JN-06 plus PRJ-06/07/08/14: one row per (delivered order, item); orders with
    no item keep one row with NULL item columns. Items meet products and sellers first and
    orders last, so orders without items never pile up on NULL product or seller keys, and
    the roll-up to orders reuses the partitioning of the last join."""
    cust = m.by_order(targets.join(m.customers, "customer_id", "left").select(
        "order_id", "order_purchase_timestamp", "delivery_time_days", "processing_days",
        "transit_days", "customer_zip_code_prefix", "customer_state"))
    items = m.lines.select("order_id", "order_item_id", "product_id", "seller_id", "price",
                           "freight_value")
    # lines of other orders would be left out by the last join: they don't travel
    items = items.join(m.by_order(targets.select("order_id")).distinct(), "order_id")
    # a category list and zip prefixes are bounded; what only depends on the product travels as one value
    prods = m.products.join(F.broadcast(m.translation), "product_category_name", "left").select(
        "product_id", "product_category_name", "product_category_name_english",
        (F.col("product_weight_g") / 1000).alias("product_weight_kg"),
        (F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
        .alias("product_volume_cm3"))
    oi = items.join(prods, "product_id", "left")
    oi = m.by_order(oi.join(m.sellers.select("seller_id", "seller_zip_code_prefix", "seller_state"),
                            "seller_id", "left"))
    geo = geo_lookup(m.geo)
    sg = geo.select(F.col("zip_code_prefix").alias("s_zip"), F.col("lat").alias("seller_lat"),
                    F.col("lng").alias("seller_lng"))
    cg = geo.select(F.col("zip_code_prefix").alias("c_zip"), F.col("lat").alias("cust_lat"),
                    F.col("lng").alias("cust_lng"))
    oi = oi.join(F.broadcast(sg), F.col("seller_zip_code_prefix") == F.col("s_zip"), "left")
    cust = cust.join(F.broadcast(cg), F.col("customer_zip_code_prefix") == F.col("c_zip"), "left")
    oi = cust.join(oi, "order_id", "left")
    ts = F.col("order_purchase_timestamp")
    return oi.select(
        "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value",
        "order_purchase_timestamp", "delivery_time_days", "processing_days", "transit_days",
        "seller_zip_code_prefix", "customer_zip_code_prefix",
        "seller_state", "customer_state", "product_category_name",
        haversine_km("seller_lat", "seller_lng", "cust_lat", "cust_lng").alias("distance_km"),
        t.month(ts).alias("purchase_month"), t.weekday(ts).alias("purchase_day_of_week"),
        t.hour(ts).alias("purchase_hour"), t.is_weekend(ts).alias("is_weekend"),
        t.quarter(ts).alias("purchase_quarter"),
        F.coalesce("product_volume_cm3", F.lit(0.0)).alias("product_volume_cm3"), "product_weight_kg",
        (F.col("freight_value") / (F.col("price") + RATIO_EPS)).alias("freight_ratio"),
        F.coalesce(F.col("product_category_name_english"), F.lit("unknown"))
        .alias("product_category_name_english"),
    )


def first_non_null(c: str, order: str = "order_item_id"):
    """W-02: the first non-NULL value of ``c`` in item order."""
    col = F.col(c)
    return F.min_by(F.when(col.isNotNull(), col), F.when(col.isNotNull(), F.col(order)))


def order_rollup(oi: DataFrame) -> DataFrame:
    """AG-02 / AG-03 and JN-07: one row per order. The order-level columns (targets,
    timestamp, customer zip) are functionally dependent on order_id, so they ride along as
    grouping keys instead of a second join; calendar fields are derived from the timestamp
    key, which equals taking them from the first item."""
    ts = F.col("order_purchase_timestamp")
    out = oi.groupBy("order_id", "order_purchase_timestamp", "delivery_time_days",
                       "processing_days", "transit_days", "customer_zip_code_prefix",
                       "customer_state").agg(
        F.avg("distance_km").alias("distance_km"),
        F.coalesce(F.sum("product_weight_kg"), F.lit(0.0)).alias("product_weight_kg"),
        F.coalesce(F.sum("product_volume_cm3"), F.lit(0.0)).alias("product_volume_cm3"),
        F.coalesce(F.sum("price"), F.lit(0.0)).alias("price"),
        F.coalesce(F.sum("freight_value"), F.lit(0.0)).alias("freight_value"),
        F.avg("freight_ratio").alias("freight_ratio"),
        F.count("product_id").alias("n_items"),
        F.mode("product_category_name_english", True).alias("product_category_name_english"),
        first_non_null("seller_id").alias("seller_id"),
        first_non_null("seller_zip_code_prefix").alias("seller_zip_code_prefix"),
        first_non_null("seller_state").alias("seller_state"),
    )
    return out.select(
        "*", t.month(ts).alias("purchase_month"), t.weekday(ts).alias("purchase_day_of_week"),
        t.hour(ts).alias("purchase_hour"), t.is_weekend(ts).alias("is_weekend"),
        t.quarter(ts).alias("purchase_quarter"))


def build_features(m: Market, with_geo: bool = False) -> DataFrame:
    """ML-11: the order-level feature table."""
    targets = delivered_targets(m.orders)
    oi = order_items_enriched(m, targets)
    out = order_rollup(oi)
    cols = FEATURE_COLUMNS + (GEO_COLUMNS if with_geo else [])
    return out.select(*cols)
