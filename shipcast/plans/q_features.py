"""Queries: sources, projections, filters, joins and roll-up of the feature pipeline
(SRC-01/02/04, PRJ-01/02/06/07/08/14, FLT-01/02, JN-01..07, AG-01..03, ML-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import features as fe
from ..session import scratch_path
from ..sources.market_csv import load_market_csv
from ..sources.tables import ROLE_TABLES
from ..functions import timeops as t
from .catalog import days_sql, finalize, folder_tag, market, query, shared, ts_sql


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The persisted feature table with zips and states (shared by later stages)."""
    return shared(spark, sf_dir, "features",
                  lambda: fe.build_features(market(spark, sf_dir), with_geo=True))


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "targets",
                  lambda: fe.delivered_targets(market(spark, sf_dir).orders))


def enriched_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fe.order_items_enriched(market(spark, sf_dir), targets(spark, sf_dir))


# --- DuckDB twin of the feature pipeline, as CTEs -------------------------------------------
def _clip_sql(x: str, lo: int, hi: int) -> str:
    return f"CASE WHEN {x} IS NULL THEN NULL ELSE greatest(least({x}, {hi}), {lo}) END"


FEATURE_CTES = f"""
t_dur AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp,
  {days_sql('order_delivered_customer_date', 'order_purchase_timestamp')} AS delivery_time_days,
  {days_sql('order_delivered_carrier_date', 'order_approved_at')} AS processing_raw,
  {days_sql('order_delivered_customer_date', 'order_delivered_carrier_date')} AS transit_raw
  FROM v_orders),
t_clip AS (SELECT order_id, customer_id, order_status, order_purchase_timestamp, delivery_time_days,
  {_clip_sql('processing_raw', 0, 30)} AS processing_days, {_clip_sql('transit_raw', 0, 60)} AS transit_days
  FROM t_dur),
t_deliv AS (SELECT * FROM t_clip WHERE delivery_time_days IS NOT NULL),
t_targets AS (SELECT * FROM t_deliv
  WHERE delivery_time_days <= (SELECT quantile_cont(delivery_time_days, 0.99) FROM t_deliv)),
t_geo AS (SELECT geolocation_zip_code_prefix AS zip, avg(geolocation_lat) AS lat,
  avg(geolocation_lng) AS lng FROM v_geo GROUP BY 1),
t_oi AS (SELECT t.order_id, i.order_item_id, i.product_id, i.seller_id, i.price, i.freight_value,
  t.order_purchase_timestamp, t.delivery_time_days, t.processing_days, t.transit_days,
  s.seller_zip_code_prefix, c.customer_zip_code_prefix, s.seller_state, c.customer_state,
  p.product_category_name,
  6371 * 2 * asin(sqrt(pow(sin((radians(gc.lat) - radians(gs.lat)) / 2), 2)
     + cos(radians(gs.lat)) * cos(radians(gc.lat)) * pow(sin((radians(gc.lng) - radians(gs.lng)) / 2), 2))) AS distance_km,
  month(t.order_purchase_timestamp) AS purchase_month,
  isodow(t.order_purchase_timestamp) - 1 AS purchase_day_of_week,
  hour(t.order_purchase_timestamp) AS purchase_hour,
  CASE WHEN isodow(t.order_purchase_timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  quarter(t.order_purchase_timestamp) AS purchase_quarter,
  coalesce(p.product_length_cm * p.product_height_cm * p.product_width_cm, 0.0) AS product_volume_cm3,
  p.product_weight_g / 1000 AS product_weight_kg,
  i.freight_value / (i.price + 1e-5) AS freight_ratio,
  coalesce(tr.product_category_name_english, 'unknown') AS product_category_name_english
  FROM t_targets t
  LEFT JOIN v_customers c ON t.customer_id = c.customer_id
  LEFT JOIN v_items i ON t.order_id = i.order_id
  LEFT JOIN v_products p ON i.product_id = p.product_id
  LEFT JOIN v_sellers s ON i.seller_id = s.seller_id
  LEFT JOIN t_geo gs ON s.seller_zip_code_prefix = gs.zip
  LEFT JOIN t_geo gc ON c.customer_zip_code_prefix = gc.zip
  LEFT JOIN v_translation tr ON p.product_category_name = tr.product_category_name),
t_mode AS (SELECT order_id, product_category_name_english FROM (
  SELECT order_id, product_category_name_english,
   row_number() OVER (PARTITION BY order_id ORDER BY count(*) DESC, product_category_name_english) AS rn
  FROM t_oi GROUP BY order_id, product_category_name_english) WHERE rn = 1),
t_roll AS (SELECT order_id,
  any_value(order_purchase_timestamp) AS order_purchase_timestamp,
  any_value(delivery_time_days) AS delivery_time_days, any_value(processing_days) AS processing_days,
  any_value(transit_days) AS transit_days,
  avg(distance_km) AS distance_km,
  coalesce(sum(product_weight_kg), 0.0) AS product_weight_kg,
  coalesce(sum(product_volume_cm3), 0.0) AS product_volume_cm3,
  coalesce(sum(price), 0.0) AS price, coalesce(sum(freight_value), 0.0) AS freight_value,
  avg(freight_ratio) AS freight_ratio,
  any_value(purchase_month) AS purchase_month, any_value(purchase_day_of_week) AS purchase_day_of_week,
  any_value(purchase_hour) AS purchase_hour, any_value(is_weekend) AS is_weekend,
  any_value(purchase_quarter) AS purchase_quarter,
  count(product_id) AS n_items,
  arg_min(seller_id, order_item_id) FILTER (WHERE seller_id IS NOT NULL) AS seller_id,
  arg_min(seller_zip_code_prefix, order_item_id) FILTER (WHERE seller_zip_code_prefix IS NOT NULL) AS seller_zip_code_prefix,
  any_value(customer_zip_code_prefix) AS customer_zip_code_prefix,
  arg_min(seller_state, order_item_id) FILTER (WHERE seller_state IS NOT NULL) AS seller_state,
  any_value(customer_state) AS customer_state
  FROM t_oi GROUP BY order_id),
t_feat AS (SELECT r.*, m.product_category_name_english FROM t_roll r JOIN t_mode m USING (order_id))
"""

FEATURE_SELECT_SQL = f"""order_id, round(distance_km, 6) AS distance_km, round(product_weight_kg, 6) AS product_weight_kg,
 round(product_volume_cm3, 6) AS product_volume_cm3, round(price, 6) AS price,
 round(freight_value, 6) AS freight_value, round(freight_ratio, 6) AS freight_ratio,
 CAST(purchase_month AS BIGINT) AS purchase_month, CAST(purchase_day_of_week AS BIGINT) AS purchase_day_of_week,
 CAST(purchase_hour AS BIGINT) AS purchase_hour, CAST(is_weekend AS BIGINT) AS is_weekend,
 CAST(purchase_quarter AS BIGINT) AS purchase_quarter, CAST(n_items AS BIGINT) AS n_items,
 product_category_name_english, seller_id, round(delivery_time_days, 6) AS delivery_time_days,
 round(processing_days, 6) AS processing_days, round(transit_days, 6) AS transit_days,
 {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp"""


# --- sources -----------------------------------------------------------------------------
def _profile(m) -> DataFrame:
    frames = [getattr(m, n).agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("table_name"), "n_rows",
                      F.lit(len(getattr(m, n).columns)).alias("n_columns"))
              for n in ROLE_TABLES]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


@query("src_01", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows FROM v_{n}" for n in ROLE_TABLES))
def src_01(spark, sf_dir):
    """SRC-01: load the nine tables (declared schemas, missing file is an error); row counts."""
    return finalize(_profile(market(spark, sf_dir)).drop("n_columns"))


@query("src_01_csv", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, " + (
        "count(review_comment_message) AS n_texts, CAST(sum(length(review_comment_message)) AS BIGINT) AS text_chars"
        if n == "reviews" else "CAST(0 AS BIGINT) AS n_texts, CAST(0 AS BIGINT) AS text_chars") + f" FROM v_{n}"
    for n in ROLE_TABLES))
def src_01_csv(spark, sf_dir):
    """SRC-01: the nine tables written as CSV files (comments with their line breaks and quotes) and
    loaded again; row counts, and the comments' number and characters."""
    folder = scratch_path(spark, f"{folder_tag(sf_dir)}/csv")
    m = market(spark, sf_dir)
    for n in ROLE_TABLES:
        table = getattr(m, n)
        table = table.select(*[F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if k.startswith("timestamp") else F.col(c)
                               for c, k in table.dtypes])
        table.write.mode("overwrite").csv(f"{folder}/{n}", header=True, escape='"', ignoreLeadingWhiteSpace=False,
                                          ignoreTrailingWhiteSpace=False)
    back = load_market_csv(spark, folder, {n: n for n in ROLE_TABLES})
    zero = F.lit(0).cast("long")
    frames = []
    for n in ROLE_TABLES:
        text = "review_comment_message" if n == "reviews" else None
        frames.append(getattr(back, n).agg(
            F.count(F.lit(1)).alias("n_rows"), (F.count(text) if text else F.max(zero)).alias("n_texts"),
            (F.sum(F.length(text)) if text else F.max(zero)).alias("text_chars")).select(F.lit(n).alias("table_name"), "*"))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return finalize(out)


@query("src_04", " UNION ALL ".join(
    f"SELECT '{n}' AS table_name, count(*) AS n_rows, CAST({c} AS BIGINT) AS n_columns FROM v_{n}"
    for n, c in zip(ROLE_TABLES, (8, 7, 6, 2, 3, 3, 3, 5, 7))))
def src_04(spark, sf_dir):
    """SRC-04: shape of every table."""
    return finalize(_profile(market(spark, sf_dir)))


@query("src_02", f"""SELECT order_id, {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp,
 {ts_sql('order_approved_at')} AS order_approved_at, {ts_sql('order_delivered_carrier_date')} AS order_delivered_carrier_date,
 {ts_sql('order_delivered_customer_date')} AS order_delivered_customer_date,
 {ts_sql('order_estimated_delivery_date')} AS order_estimated_delivery_date FROM v_orders""")
def src_02(spark, sf_dir):
    """SRC-02: the order date columns as timestamps."""
    o = market(spark, sf_dir).orders
    return finalize(o.select("order_id", "order_purchase_timestamp", "order_approved_at",
                             "order_delivered_carrier_date", "order_delivered_customer_date",
                             "order_estimated_delivery_date"))


@query("src_02_items", f"SELECT order_id, CAST(order_item_id AS BIGINT) AS order_item_id, {ts_sql('shipping_limit_date')} AS shipping_limit_date FROM v_items")
def src_02_items(spark, sf_dir):
    """SRC-02: the items' shipping limit as a timestamp."""
    return finalize(market(spark, sf_dir).items.select("order_id", "order_item_id", "shipping_limit_date"))


@query("src_02_reviews", f"""SELECT review_id, {ts_sql('review_creation_date')} AS review_creation_date,
 {ts_sql('review_answer_timestamp')} AS review_answer_timestamp FROM v_reviews""")
def src_02_reviews(spark, sf_dir):
    """SRC-02: the reviews' creation and answer times."""
    return finalize(market(spark, sf_dir).review_scores.select(
        "review_id", "review_creation_date", "review_answer_timestamp"))


PREVIEW = {"orders": ("order_id", "order_status"), "customers": ("customer_id", "customer_state"),
           "sellers": ("seller_id", "seller_state"), "products": ("product_id", "product_category_name")}


@query("src_04_preview", " UNION ALL ".join(
    f"(SELECT '{n}' AS table_name, CAST({k} AS BIGINT) AS key, {v} AS value FROM v_{n} ORDER BY {k} LIMIT 5)"
    for n, (k, v) in PREVIEW.items()))
def src_04_preview(spark, sf_dir):
    """SRC-04: the first five rows, by key, of the tables that have one."""
    m = market(spark, sf_dir)
    frames = [getattr(m, n).select(F.lit(n).alias("table_name"), F.col(k).alias("key"), F.col(v).alias("value"))
              .orderBy("key").limit(5) for n, (k, v) in PREVIEW.items()]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return finalize(out)


# --- projections and filters --------------------------------------------------------------
@query("prj_01", """SELECT order_id, round(delivery_time_days, 6) AS delivery_time_days,
 round(processing_raw, 6) AS processing_days, round(transit_raw, 6) AS transit_days FROM t_dur""",
       FEATURE_CTES)
def prj_01(spark, sf_dir):
    d = fe.durations(market(spark, sf_dir).orders)
    return finalize(d.select("order_id", "delivery_time_days", "processing_days", "transit_days"))


@query("prj_02", """SELECT order_id, round(processing_days, 6) AS processing_days,
 round(transit_days, 6) AS transit_days FROM t_clip""", FEATURE_CTES)
def prj_02(spark, sf_dir):
    d = fe.clipped_durations(market(spark, sf_dir).orders)
    return finalize(d.select("order_id", "processing_days", "transit_days"))


@query("flt_01", "SELECT order_id, round(delivery_time_days, 6) AS delivery_time_days FROM t_deliv",
       FEATURE_CTES)
def flt_01(spark, sf_dir):
    d = fe.with_delivery(market(spark, sf_dir).orders)
    return finalize(d.select("order_id", "delivery_time_days"))


@query("flt_02", """SELECT order_id, round(delivery_time_days, 6) AS delivery_time_days,
 round(processing_days, 6) AS processing_days, round(transit_days, 6) AS transit_days FROM t_targets""",
       FEATURE_CTES)
def flt_02(spark, sf_dir):
    d = targets(spark, sf_dir)
    return finalize(d.select("order_id", "delivery_time_days", "processing_days", "transit_days"))


@query("prj_06", """SELECT order_id, month(order_purchase_timestamp) AS purchase_month,
 isodow(order_purchase_timestamp) - 1 AS purchase_day_of_week, hour(order_purchase_timestamp) AS purchase_hour,
 CASE WHEN isodow(order_purchase_timestamp) >= 6 THEN 1 ELSE 0 END AS is_weekend,
 quarter(order_purchase_timestamp) AS purchase_quarter FROM v_orders""")
def prj_06(spark, sf_dir):
    o = market(spark, sf_dir).orders
    ts = F.col("order_purchase_timestamp")
    return finalize(o.select("order_id", t.month(ts).alias("purchase_month"),
                             t.weekday(ts).alias("purchase_day_of_week"),
                             t.hour(ts).alias("purchase_hour"), t.is_weekend(ts).alias("is_weekend"),
                             t.quarter(ts).alias("purchase_quarter")))


_ITEM_KEY = "order_id, CAST(order_item_id AS BIGINT) AS order_item_id"


@query("prj_07", f"""SELECT {_ITEM_KEY}, round(product_volume_cm3, 6) AS product_volume_cm3,
 round(product_weight_kg, 6) AS product_weight_kg, round(freight_ratio, 6) AS freight_ratio FROM t_oi""",
       FEATURE_CTES)
def prj_07(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "product_volume_cm3",
                              "product_weight_kg", "freight_ratio"))


@query("prj_08", f"SELECT {_ITEM_KEY}, round(distance_km, 6) AS distance_km FROM t_oi", FEATURE_CTES)
def prj_08(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "distance_km"))


@query("prj_14", f"SELECT {_ITEM_KEY}, product_category_name_english FROM t_oi", FEATURE_CTES)
def prj_14(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "product_category_name_english"))


# --- joins ----------------------------------------------------------------------------------
@query("jn_01", f"""SELECT {_ITEM_KEY}, product_id, seller_id, round(price, 6) AS price,
 round(freight_value, 6) AS freight_value FROM t_oi""", FEATURE_CTES)
def jn_01(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "product_id", "seller_id", "price",
                              "freight_value"))


@query("jn_02", f"""SELECT {_ITEM_KEY}, i.product_id, p.product_category_name, p.product_weight_g, p.product_length_cm,
 p.product_height_cm, p.product_width_cm FROM t_oi i LEFT JOIN v_products p ON i.product_id = p.product_id""",
       FEATURE_CTES)
def jn_02(spark, sf_dir):
    m = market(spark, sf_dir)
    oi = enriched_items(spark, sf_dir).select("order_id", "order_item_id", "product_id")
    prods = m.products.drop("product_category_name_english")
    return finalize(oi.join(prods, "product_id", "left").select(
        "order_id", "order_item_id", "product_id", "product_category_name", "product_weight_g",
        "product_length_cm", "product_height_cm", "product_width_cm"))


@query("jn_03", f"SELECT {_ITEM_KEY}, seller_id, seller_zip_code_prefix, seller_state FROM t_oi",
       FEATURE_CTES)
def jn_03(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "seller_id", "seller_zip_code_prefix",
                              "seller_state"))


@query("jn_04", """SELECT t.order_id, c.customer_zip_code_prefix, c.customer_state
 FROM t_targets t LEFT JOIN v_customers c ON t.customer_id = c.customer_id""", FEATURE_CTES)
def jn_04(spark, sf_dir):
    m = market(spark, sf_dir)
    return finalize(targets(spark, sf_dir).join(m.customers, "customer_id", "left")
                    .select("order_id", "customer_zip_code_prefix", "customer_state"))


@query("jn_05", f"""SELECT {_ITEM_KEY}, round(gs.lat, 6) AS seller_lat, round(gs.lng, 6) AS seller_lng,
 round(gc.lat, 6) AS cust_lat, round(gc.lng, 6) AS cust_lng FROM t_oi
 LEFT JOIN t_geo gs ON seller_zip_code_prefix = gs.zip LEFT JOIN t_geo gc ON customer_zip_code_prefix = gc.zip""",
       FEATURE_CTES)
def jn_05(spark, sf_dir):
    m = market(spark, sf_dir)
    geo = fe.geo_lookup(m.geo)
    oi = enriched_items(spark, sf_dir).select("order_id", "order_item_id",
                                               "seller_zip_code_prefix", "customer_zip_code_prefix")
    sg = geo.select(F.col("zip_code_prefix").alias("s_zip"), F.col("lat").alias("seller_lat"),
                    F.col("lng").alias("seller_lng"))
    cg = geo.select(F.col("zip_code_prefix").alias("c_zip"), F.col("lat").alias("cust_lat"),
                    F.col("lng").alias("cust_lng"))
    out = (oi.join(sg, F.col("seller_zip_code_prefix") == F.col("s_zip"), "left")
           .join(cg, F.col("customer_zip_code_prefix") == F.col("c_zip"), "left"))
    return finalize(out.select("order_id", "order_item_id", "seller_lat", "seller_lng",
                               "cust_lat", "cust_lng"))


@query("jn_06", f"""SELECT {_ITEM_KEY}, product_category_name, product_category_name_english FROM t_oi""",
       FEATURE_CTES)
def jn_06(spark, sf_dir):
    oi = enriched_items(spark, sf_dir)
    return finalize(oi.select("order_id", "order_item_id", "product_category_name",
                              "product_category_name_english"))


@query("jn_07", """SELECT order_id, CAST(n_items AS BIGINT) AS n_items, round(price, 6) AS price,
 round(delivery_time_days, 6) AS delivery_time_days, round(processing_days, 6) AS processing_days,
 round(transit_days, 6) AS transit_days FROM t_feat""", FEATURE_CTES)
def jn_07(spark, sf_dir):
    f = features(spark, sf_dir)
    return finalize(f.select("order_id", "n_items", "price", "delivery_time_days",
                             "processing_days", "transit_days"))


# --- aggregations ---------------------------------------------------------------------------
@query("ag_01", """SELECT zip AS zip_code_prefix, round(lat, 6) AS lat, round(lng, 6) AS lng FROM t_geo""",
       FEATURE_CTES)
def ag_01(spark, sf_dir):
    return finalize(fe.geo_lookup(market(spark, sf_dir).geo))


@query("ag_02", f"""SELECT order_id, round(distance_km, 6) AS distance_km, round(product_weight_kg, 6) AS product_weight_kg,
 round(product_volume_cm3, 6) AS product_volume_cm3, round(price, 6) AS price,
 round(freight_value, 6) AS freight_value, round(freight_ratio, 6) AS freight_ratio,
 CAST(purchase_month AS BIGINT) AS purchase_month, CAST(purchase_day_of_week AS BIGINT) AS purchase_day_of_week,
 CAST(purchase_hour AS BIGINT) AS purchase_hour, CAST(is_weekend AS BIGINT) AS is_weekend,
 CAST(purchase_quarter AS BIGINT) AS purchase_quarter, CAST(n_items AS BIGINT) AS n_items,
 product_category_name_english, seller_id FROM t_feat""", FEATURE_CTES)
def ag_02(spark, sf_dir):
    cols = [c for c in fe.FEATURE_COLUMNS
            if c not in ("delivery_time_days", "processing_days", "transit_days",
                         "order_purchase_timestamp")]
    return finalize(features(spark, sf_dir).select(*cols))


@query("ag_03", """SELECT order_id, CAST(n_items AS BIGINT) AS n_items, seller_id, seller_zip_code_prefix,
 customer_zip_code_prefix, seller_state, customer_state, product_category_name_english FROM t_feat""",
       FEATURE_CTES)
def ag_03(spark, sf_dir):
    return finalize(features(spark, sf_dir).select(
        "order_id", "n_items", "seller_id", "seller_zip_code_prefix", "customer_zip_code_prefix",
        "seller_state", "customer_state", "product_category_name_english"))


@query("ml_11", f"SELECT {FEATURE_SELECT_SQL} FROM t_feat", FEATURE_CTES)
def ml_11(spark, sf_dir):
    """ML-11: feature engineering end to end."""
    return finalize(features(spark, sf_dir).select(*fe.FEATURE_COLUMNS))
