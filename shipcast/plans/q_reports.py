"""Queries: exploratory reports (AG-12..AG-45, W-01, W-09, PRJ-03/04/05/09/15/20, JN-09..17,
SET-01/02, FLT-03)."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import reports as rp
from ..functions.exprs import sql_bucket
from ..sources.tables import ROLE_TABLES
from .catalog import finalize, floor_days_sql, hist_sql, market, query, shared, ts_sql


def sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "seller_table", lambda: rp.seller_table(market(spark, sf_dir)))


EDA_CTES = f"""
e_deliv AS (SELECT o.*, {floor_days_sql('order_delivered_customer_date', 'order_estimated_delivery_date')} AS delay_days
  FROM v_orders o WHERE order_status = 'delivered'),
e_del AS (SELECT *, coalesce(delay_days > 0, false) AS is_late FROM e_deliv),
e_rev AS (SELECT order_id, avg(review_score) AS review_score FROM v_reviews GROUP BY order_id),
e_items AS (SELECT order_id, sum(price) AS total_price, sum(freight_value) AS total_freight,
  count(product_id) AS n_items FROM v_items GROUP BY order_id),
e_pay AS (SELECT order_id, sum(payment_value) AS payment_value, max(payment_installments) AS payment_installments
  FROM v_payments GROUP BY order_id),
e_ip AS (SELECT i.order_id, i.order_item_id,
  coalesce(t.product_category_name_english, p.product_category_name) AS category, p.product_weight_g
  FROM v_items i LEFT JOIN v_products p ON i.product_id = p.product_id
  LEFT JOIN v_translation t ON p.product_category_name = t.product_category_name),
e_cat AS (SELECT order_id,
  arg_min(category, order_item_id) FILTER (WHERE category IS NOT NULL) AS category,
  arg_min(product_weight_g, order_item_id) FILTER (WHERE product_weight_g IS NOT NULL) AS product_weight_g
  FROM e_ip GROUP BY order_id),
e_first AS (SELECT order_id, seller_id FROM v_items WHERE order_item_id = 1),
e_states AS (SELECT d.*, f.seller_id, s.seller_state, c.customer_state FROM e_del d
  LEFT JOIN e_first f ON d.order_id = f.order_id LEFT JOIN v_sellers s ON f.seller_id = s.seller_id
  LEFT JOIN v_customers c ON d.customer_id = c.customer_id),
e_rwo AS (SELECT r.*, o.order_purchase_timestamp, o.order_delivered_customer_date, o.order_estimated_delivery_date,
  o.customer_id, {floor_days_sql('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} AS delivery_delay_days,
  CASE WHEN o.order_delivered_customer_date IS NULL THEN 'Not Delivered'
   WHEN {floor_days_sql('o.order_delivered_customer_date', 'o.order_estimated_delivery_date')} > 0 THEN 'Late'
   ELSE 'On Time' END AS delivery_status,
  {floor_days_sql('r.review_answer_timestamp', 'o.order_purchase_timestamp')} AS days_to_review
  FROM v_reviews r LEFT JOIN v_orders o ON r.order_id = o.order_id),
e_drev AS (SELECT d.*, r.review_score FROM e_del d LEFT JOIN e_rev r ON d.order_id = r.order_id),
e_feat AS (SELECT d.*, i.total_price, i.total_freight, i.n_items, c.product_weight_g,
  {floor_days_sql('d.order_delivered_carrier_date', 'd.order_approved_at')} AS processing_days,
  {floor_days_sql('d.order_estimated_delivery_date', 'd.order_purchase_timestamp')} AS estimated_window
  FROM e_del d LEFT JOIN e_items i ON d.order_id = i.order_id LEFT JOIN e_cat c ON d.order_id = c.order_id),
e_sstat AS (SELECT i.seller_id, count(DISTINCT i.order_id) AS total_orders, sum(i.price) AS total_revenue,
  avg(i.price) AS avg_order_value, min(o.order_purchase_timestamp) AS first_order, max(o.order_purchase_timestamp) AS last_order
  FROM v_items i JOIN v_orders o ON i.order_id = o.order_id GROUP BY i.seller_id),
e_srev AS (SELECT i.seller_id, avg(r.review_score) AS avg_review_score, count(r.review_score) AS review_count
  FROM v_items i LEFT JOIN e_rev r ON i.order_id = r.order_id GROUP BY i.seller_id),
e_slate AS (SELECT seller_id, avg(CAST(is_late AS DOUBLE)) AS late_rate, count(order_id) AS delivered_count
  FROM e_states WHERE seller_id IS NOT NULL GROUP BY seller_id),
e_seller AS (SELECT s.*, r.avg_review_score, r.review_count, l.late_rate, l.delivered_count,
  {floor_days_sql('s.last_order', 's.first_order')} AS tenure_days
  FROM e_sstat s LEFT JOIN e_srev r ON s.seller_id = r.seller_id LEFT JOIN e_slate l ON s.seller_id = l.seller_id)
"""

_ROLE_COLUMNS = {
    "orders": ["order_id", "customer_id", "order_status", "order_purchase_timestamp", "order_approved_at",
               "order_delivered_carrier_date", "order_delivered_customer_date",
               "order_estimated_delivery_date"],
    "items": ["order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "shipping_limit_date"],
    "products": ["product_id", "product_category_name", "product_weight_g", "product_length_cm",
                 "product_height_cm", "product_width_cm"],
    "translation": ["product_category_name", "product_category_name_english"],
    "sellers": ["seller_id", "seller_zip_code_prefix", "seller_state"],
    "customers": ["customer_id", "customer_zip_code_prefix", "customer_state"],
    "geo": ["geolocation_zip_code_prefix", "geolocation_lat", "geolocation_lng"],
    "payments": ["order_id", "payment_sequential", "payment_type", "payment_installments", "payment_value"],
    "reviews": ["review_id", "order_id", "review_score", "review_comment_message", "review_comment_title",
                "review_answer_timestamp", "review_creation_date"],
}


def _missing_sql() -> str:
    parts = []
    for t in ROLE_TABLES:
        for c in _ROLE_COLUMNS[t]:
            parts.append(f"SELECT '{t}' AS table_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS missing_count, "
                         f"round_even(count(*) FILTER (WHERE {c} IS NULL) / count(*) * 100, 1) AS missing_pct FROM v_{t}")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE missing_count > 0"


@query("ag_15", _missing_sql())
def ag_15(spark, sf_dir):
    """AG-15: missing-value report over the nine tables."""
    m = market(spark, sf_dir)
    out = None
    for t in ROLE_TABLES:
        part = rp.missing_report(getattr(m, t), t)
        out = part if out is None else out.unionByName(part)
    return finalize(out.orderBy(F.desc("missing_pct")))


@query("ag_12", """SELECT order_id, round(total_price, 6) AS total_price, round(total_freight, 6) AS total_freight,
 n_items FROM e_items""", EDA_CTES)
def ag_12(spark, sf_dir):
    return finalize(rp.items_per_order(market(spark, sf_dir).items))


@query("ag_13", """SELECT order_id, round(payment_value, 6) AS payment_value,
 CAST(payment_installments AS BIGINT) AS payment_installments FROM e_pay""", EDA_CTES)
def ag_13(spark, sf_dir):
    return finalize(rp.payments_per_order(market(spark, sf_dir).payments))


@query("ag_14", "SELECT order_id, round(review_score, 6) AS review_score FROM e_rev", EDA_CTES)
def ag_14(spark, sf_dir):
    return finalize(rp.reviews_per_order(market(spark, sf_dir).review_scores))


@query("ag_16", """SELECT (SELECT count(DISTINCT order_id) FROM v_orders) AS orders_distinct,
 (SELECT count(DISTINCT order_id) FROM v_items) AS items_distinct,
 (SELECT count(DISTINCT order_id) FROM v_orders) - (SELECT count(DISTINCT order_id) FROM v_items) AS difference""")
def ag_16(spark, sf_dir):
    return finalize(rp.order_id_coverage(market(spark, sf_dir)))


@query("jn_10", """SELECT order_status, count(*) AS n_orders FROM v_orders o
 WHERE NOT EXISTS (SELECT 1 FROM v_items i WHERE i.order_id = o.order_id) GROUP BY order_status""")
def jn_10(spark, sf_dir):
    """JN-10: orders with no item (anti join), counted by status."""
    return finalize(rp.orders_without_items(market(spark, sf_dir)))


@query("ag_17", """SELECT order_status, count(*) AS n_orders FROM v_orders o ANTI JOIN v_items i ON o.order_id = i.order_id
 GROUP BY order_status""")
def ag_17(spark, sf_dir):
    return finalize(rp.orders_without_items(market(spark, sf_dir)))


def _orphans_sql(orders="v_orders"):
    return f"""SELECT i.order_id, CAST(i.order_item_id AS BIGINT) AS order_item_id, i.product_id, i.seller_id,
 round(i.price, 6) AS price, round(i.freight_value, 6) AS freight_value, {ts_sql('i.shipping_limit_date')} AS shipping_limit_date,
 count(*) AS n_rows FROM v_items i ANTI JOIN {orders} o ON i.order_id = o.order_id GROUP BY ALL"""


@query("ag_18", _orphans_sql())
def ag_18(spark, sf_dir):
    return finalize(rp.items_without_orders(market(spark, sf_dir)))


@query("ag_18_found", _orphans_sql("(SELECT * FROM v_orders WHERE order_status = 'delivered')"))
def ag_18_found(spark, sf_dir):
    """AG-18 against the delivered orders alone, where items without an order occur."""
    m = market(spark, sf_dir)
    return finalize(rp.items_without_orders(replace(m, orders=m.orders.where(F.col("order_status") == "delivered"))))


@query("ag_19", """SELECT 'all' AS subset, CAST(review_score AS BIGINT) AS review_score, count(*) AS n_reviews,
 round_even(count(*) / (SELECT count(*) FROM v_reviews) * 100, 1) AS pct FROM v_reviews GROUP BY review_score
 UNION ALL SELECT 'commented', CAST(review_score AS BIGINT), count(*),
 round_even(count(*) / (SELECT count(*) FROM v_reviews WHERE review_comment_message IS NOT NULL) * 100, 1)
 FROM v_reviews WHERE review_comment_message IS NOT NULL GROUP BY review_score""")
def ag_19(spark, sf_dir):
    return finalize(rp.score_distribution(market(spark, sf_dir).reviews))


@query("ag_20", """SELECT count(*) AS n_reviews, count(review_comment_title) AS has_title,
 count(*) - count(review_comment_title) AS no_title, round(count(review_comment_title) / count(*) * 100, 6) AS title_pct,
 count(review_comment_message) AS has_comment, count(*) - count(review_comment_message) AS no_comment,
 round(count(review_comment_message) / count(*) * 100, 6) AS comment_pct FROM v_reviews""")
def ag_20(spark, sf_dir):
    return finalize(rp.presence(market(spark, sf_dir).reviews))


_RWO_COLS = "review_id, order_id, CAST(delivery_delay_days AS BIGINT) AS delivery_delay_days, delivery_status, CAST(days_to_review AS BIGINT) AS days_to_review"


@query("jn_09", f"""SELECT review_id, order_id, {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp,
 {ts_sql('order_delivered_customer_date')} AS order_delivered_customer_date,
 {ts_sql('order_estimated_delivery_date')} AS order_estimated_delivery_date, customer_id FROM e_rwo""", EDA_CTES)
def jn_09(spark, sf_dir):
    r = rp.reviews_with_orders(market(spark, sf_dir))
    return finalize(r.select("review_id", "order_id", "order_purchase_timestamp",
                             "order_delivered_customer_date", "order_estimated_delivery_date",
                             "customer_id"))


@query("prj_04", f"SELECT {_RWO_COLS} FROM e_rwo", EDA_CTES)
def prj_04(spark, sf_dir):
    """PRJ-04: delivery status On Time / Late / Not Delivered (with the floored delay)."""
    r = rp.reviews_with_orders(market(spark, sf_dir))
    return finalize(r.select("review_id", "order_id", "delivery_delay_days", "delivery_status",
                             "days_to_review"))


@query("prj_05", "SELECT review_id, CAST(days_to_review AS BIGINT) AS days_to_review FROM e_rwo", EDA_CTES)
def prj_05(spark, sf_dir):
    r = rp.reviews_with_orders(market(spark, sf_dir))
    return finalize(r.select("review_id", "days_to_review"))


@query("ag_21", """SELECT delivery_status, count(*) AS n_reviews, round(avg(review_score), 6) AS avg_score
 FROM e_rwo GROUP BY delivery_status""", EDA_CTES)
def ag_21(spark, sf_dir):
    return finalize(rp.delivery_status_scores(rp.reviews_with_orders(market(spark, sf_dir))))


_LATE_BUCKET = sql_bucket("delivery_delay_days", rp.LATE_EDGES, rp.LATE_LABELS)
_LABELS_SQL = " UNION ALL ".join(f"SELECT {i} AS bucket_order, '{lab}' AS delay_bucket"
                                 for i, lab in enumerate(rp.LATE_LABELS))


@query("ag_22", f"""WITH b AS (SELECT {_LATE_BUCKET} AS delay_bucket, review_score FROM e_rwo WHERE delivery_status = 'Late'),
 a AS (SELECT delay_bucket, avg(review_score) AS avg_score, count(review_score) AS n_reviews FROM b
  WHERE delay_bucket IS NOT NULL GROUP BY delay_bucket),
 l AS ({_LABELS_SQL})
 SELECT CAST(l.bucket_order AS BIGINT) AS bucket_order, l.delay_bucket, round(a.avg_score, 6) AS avg_score,
 coalesce(a.n_reviews, 0) AS n_reviews FROM l LEFT JOIN a ON l.delay_bucket = a.delay_bucket""", EDA_CTES)
def ag_22(spark, sf_dir):
    return finalize(rp.late_bucket_scores(rp.reviews_with_orders(market(spark, sf_dir))))


@query("ag_23", """SELECT order_status, count(*) AS n_orders, round(count(*) / (SELECT count(*) FROM v_orders) * 100, 6) AS pct
 FROM v_orders GROUP BY order_status""")
def ag_23(spark, sf_dir):
    return finalize(rp.status_counts(market(spark, sf_dir).orders))


@query("ag_24", """SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month, count(*) AS n_orders,
 (SELECT count(*) FROM v_orders) AS total_orders,
 strftime((SELECT min(order_purchase_timestamp) FROM v_orders), '%Y-%m-%d') AS first_date,
 strftime((SELECT max(order_purchase_timestamp) FROM v_orders), '%Y-%m-%d') AS last_date
 FROM v_orders GROUP BY 1""")
def ag_24(spark, sf_dir):
    return finalize(rp.monthly_volume(market(spark, sf_dir).orders))


_PIVOT_SQL = """SELECT strftime(order_purchase_timestamp, '%Y-%m') AS year_month,
 count(*) FILTER (WHERE order_status = 'canceled') AS canceled,
 count(*) FILTER (WHERE order_status = 'delivered') AS delivered,
 count(*) FILTER (WHERE order_status = 'shipped') AS shipped FROM v_orders GROUP BY 1"""


@query("ag_25", _PIVOT_SQL)
def ag_25(spark, sf_dir):
    return finalize(rp.month_status_pivot(market(spark, sf_dir).orders))


@query("ag_26", f"""WITH p AS ({_PIVOT_SQL}) SELECT year_month,
 round(canceled / (0 + canceled + delivered + shipped) * 100, 6) AS canceled,
 round(delivered / (0 + canceled + delivered + shipped) * 100, 6) AS delivered,
 round(shipped / (0 + canceled + delivered + shipped) * 100, 6) AS shipped FROM p""")
def ag_26(spark, sf_dir):
    return finalize(rp.month_status_share(rp.month_status_pivot(market(spark, sf_dir).orders)))


@query("flt_03", "SELECT order_id FROM v_orders WHERE order_status = 'delivered'")
def flt_03(spark, sf_dir):
    return finalize(rp.delivered_status_orders(market(spark, sf_dir).orders).select("order_id"))


@query("prj_03", "SELECT order_id, CAST(delay_days AS BIGINT) AS delay_days, is_late FROM e_del", EDA_CTES)
def prj_03(spark, sf_dir):
    d = rp.delivered_status_orders(market(spark, sf_dir).orders)
    return finalize(d.select("order_id", "delay_days", "is_late"))


@query("prj_09", """SELECT order_id, CAST(estimated_window AS BIGINT) AS estimated_window,
 CAST(processing_days AS BIGINT) AS processing_days FROM e_feat""", EDA_CTES)
def prj_09(spark, sf_dir):
    """PRJ-09: promised window (estimate - purchase) and processing, floored days."""
    d = rp.delivered_features(market(spark, sf_dir))
    return finalize(d.select("order_id", "estimated_window", "processing_days"))


@query("ag_27", """SELECT round(avg(CAST(is_late AS INT)) * 100, 6) AS late_rate_pct, count(*) FILTER (WHERE is_late) AS n_late,
 count(*) AS n_delivered, count(delay_days) AS delay_count, round(avg(delay_days), 6) AS delay_mean,
 round(stddev_samp(delay_days), 6) AS delay_std, round(CAST(min(delay_days) AS DOUBLE), 6) AS delay_min,
 round(quantile_cont(delay_days, 0.25), 6) AS delay_p25, round(quantile_cont(delay_days, 0.5), 6) AS delay_p50,
 round(quantile_cont(delay_days, 0.75), 6) AS delay_p75, round(CAST(max(delay_days) AS DOUBLE), 6) AS delay_max FROM e_del""", EDA_CTES)
def ag_27(spark, sf_dir):
    d = rp.delivered_status_orders(market(spark, sf_dir).orders)
    out = rp.late_summary(d)
    return finalize(out.withColumns({"delay_min": F.col("delay_min").cast("double"),
                                     "delay_max": F.col("delay_max").cast("double")}))


@query("jn_11", "SELECT order_id, is_late, round(review_score, 6) AS review_score FROM e_drev", EDA_CTES)
def jn_11(spark, sf_dir):
    return finalize(rp.delivered_with_reviews(market(spark, sf_dir)).select("order_id", "is_late", "review_score"))


@query("ag_28", """SELECT is_late, round(avg(review_score), 6) AS mean, count(review_score) AS count,
 round(quantile_cont(review_score, 0.5), 6) AS median FROM e_drev GROUP BY is_late""", EDA_CTES)
def ag_28(spark, sf_dir):
    return finalize(rp.score_by_lateness(rp.delivered_with_reviews(market(spark, sf_dir))))


@query("ag_29", """SELECT is_late, round(review_score, 6) AS review_score, count(*) AS n_orders,
 round(count(*) / sum(count(*)) OVER (PARTITION BY is_late), 6) AS share
 FROM e_drev WHERE review_score IS NOT NULL GROUP BY is_late, review_score""", EDA_CTES)
def ag_29(spark, sf_dir):
    return finalize(rp.score_shares_by_lateness(rp.delivered_with_reviews(market(spark, sf_dir))))


@query("ag_29_box", """WITH q AS (SELECT is_late, quantile_cont(review_score, 0.25) AS q1, quantile_cont(review_score, 0.5) AS median,
 quantile_cont(review_score, 0.75) AS q3 FROM e_drev GROUP BY is_late),
 j AS (SELECT d.is_late, d.review_score, q.q1, q.q3, q.q3 - q.q1 AS iqr FROM e_drev d JOIN q ON d.is_late = q.is_late
  WHERE d.review_score IS NOT NULL)
 SELECT q.is_late, round(q.q1, 6) AS q1, round(q.median, 6) AS median, round(q.q3, 6) AS q3, round(q.q3 - q.q1, 6) AS iqr,
 round(min(review_score) FILTER (WHERE review_score >= j.q1 - 1.5 * j.iqr), 6) AS whisker_low,
 round(max(review_score) FILTER (WHERE review_score <= j.q3 + 1.5 * j.iqr), 6) AS whisker_high,
 count(*) FILTER (WHERE review_score < j.q1 - 1.5 * j.iqr OR review_score > j.q3 + 1.5 * j.iqr) AS n_outliers
 FROM q LEFT JOIN j ON q.is_late = j.is_late GROUP BY q.is_late, q.q1, q.median, q.q3""", EDA_CTES)
def ag_29_box(spark, sf_dir):
    """AG-29 (box statistics): quartiles and 1.5 IQR whiskers of review score by lateness."""
    return finalize(rp.box_stats(rp.delivered_with_reviews(market(spark, sf_dir)), "review_score", ["is_late"]))


_DELAY_BUCKET = sql_bucket("delay_days", rp.DELAY_EDGES, rp.DELAY_LABELS)
_DELAY_ORDER = "CASE " + " ".join(
    f"WHEN delay_bucket = '{lab}' THEN {i}" for i, lab in enumerate(rp.DELAY_LABELS)) + " END"


@query("ag_30", f"""WITH b AS (SELECT {_DELAY_BUCKET} AS delay_bucket, review_score FROM e_drev)
 SELECT CAST({_DELAY_ORDER} AS BIGINT) AS bucket_order, delay_bucket, round(avg(review_score), 6) AS avg_score
 FROM b WHERE delay_bucket IS NOT NULL GROUP BY delay_bucket""", EDA_CTES)
def ag_30(spark, sf_dir):
    return finalize(rp.delay_bucket_scores(rp.delivered_with_reviews(market(spark, sf_dir))))


@query("prj_15", "SELECT order_id, category, round(product_weight_g, 6) AS product_weight_g FROM e_cat", EDA_CTES)
def prj_15(spark, sf_dir):
    """PRJ-15 + W-02: first translated-or-native category and first weight per order."""
    return finalize(rp.order_first_category(market(spark, sf_dir)))


@query("w_02", "SELECT order_id, category FROM e_cat", EDA_CTES)
def w_02(spark, sf_dir):
    """W-02: first non-NULL value per column per order, in item order."""
    return finalize(rp.order_first_category(market(spark, sf_dir)).select("order_id", "category"))


@query("jn_12", """SELECT d.order_id, c.category, round(c.product_weight_g, 6) AS product_weight_g
 FROM e_del d LEFT JOIN e_cat c ON d.order_id = c.order_id""", EDA_CTES)
def jn_12(spark, sf_dir):
    m = market(spark, sf_dir)
    d = rp.delivered_status_orders(m.orders).join(rp.order_first_category(m), "order_id", "left")
    return finalize(d.select("order_id", "category", "product_weight_g"))


@query("ag_31", """SELECT category, count(order_id) AS order_count, round(avg(CAST(is_late AS DOUBLE)), 6) AS late_rate
 FROM e_del d LEFT JOIN e_cat c USING (order_id) WHERE category IS NOT NULL GROUP BY category
 HAVING count(order_id) >= 200 ORDER BY avg(CAST(is_late AS DOUBLE)) DESC, category DESC LIMIT 20""", EDA_CTES)
def ag_31(spark, sf_dir):
    return finalize(rp.worst_categories(market(spark, sf_dir)))


@query("ag_31_all", """SELECT category, count(order_id) AS order_count, round(avg(CAST(is_late AS DOUBLE)), 6) AS late_rate
 FROM e_del d LEFT JOIN e_cat c USING (order_id) WHERE category IS NOT NULL GROUP BY category""", EDA_CTES)
def ag_31_all(spark, sf_dir):
    """AG-31 without the 200-order floor and the top-20 limit (every category's late rate)."""
    m = market(spark, sf_dir)
    df_cat = rp.delivered_status_orders(m.orders).join(rp.order_first_category(m), "order_id", "left")
    return finalize(rp.late_rate_by(df_cat, "category", 1))


@query("w_01", "SELECT order_id, seller_id FROM e_first", EDA_CTES)
def w_01(spark, sf_dir):
    """W-01 / SET-02: first item row per order."""
    return finalize(rp.first_item_seller(market(spark, sf_dir).items))


@query("set_02", "SELECT order_id, seller_id FROM e_first", EDA_CTES)
def set_02(spark, sf_dir):
    return finalize(rp.first_item_seller(market(spark, sf_dir).items))


@query("jn_13", "SELECT order_id, seller_id, seller_state, customer_state FROM e_states", EDA_CTES)
def jn_13(spark, sf_dir):
    d = rp.delivered_with_states(market(spark, sf_dir))
    return finalize(d.select("order_id", "seller_id", "seller_state", "customer_state"))


@query("ag_32", """SELECT seller_state, count(order_id) AS order_count, round(avg(CAST(is_late AS DOUBLE)), 6) AS late_rate
 FROM e_states WHERE seller_state IS NOT NULL GROUP BY seller_state HAVING count(order_id) >= 50""", EDA_CTES)
def ag_32(spark, sf_dir):
    d = rp.delivered_with_states(market(spark, sf_dir))
    return finalize(rp.late_rate_by(d, "seller_state", rp.STATE_MIN_ORDERS).orderBy(F.desc("late_rate")))


@query("ag_33", """SELECT customer_state, count(order_id) AS order_count, round(avg(CAST(is_late AS DOUBLE)), 6) AS late_rate,
 avg(CAST(is_late AS DOUBLE)) > (SELECT avg(CAST(is_late AS DOUBLE)) FROM e_states) AS above_average
 FROM e_states WHERE customer_state IS NOT NULL GROUP BY customer_state HAVING count(order_id) >= 50""", EDA_CTES)
def ag_33(spark, sf_dir):
    return finalize(rp.customer_state_lateness(market(spark, sf_dir)))


@query("jn_16", """SELECT order_id, round(total_freight, 6) AS total_freight, round(total_price, 6) AS total_price,
 n_items, round(product_weight_g, 6) AS product_weight_g FROM e_feat""", EDA_CTES)
def jn_16(spark, sf_dir):
    d = rp.delivered_features(market(spark, sf_dir))
    return finalize(d.select("order_id", "total_freight", "total_price", "n_items", "product_weight_g"))


@query("ag_34", """SELECT is_late, round(avg(total_freight), 6) AS total_freight, round(avg(product_weight_g), 6) AS product_weight_g,
 round(avg(processing_days), 6) AS processing_days, round(avg(estimated_window), 6) AS estimated_window
 FROM e_feat GROUP BY is_late""", EDA_CTES)
def ag_34(spark, sf_dir):
    return finalize(rp.means_by_lateness(rp.delivered_features(market(spark, sf_dir))))


def _clip_sql(col: str) -> str:
    return f"""q AS (SELECT is_late, quantile_cont({col}, 0.01) AS lo, quantile_cont({col}, 0.99) AS hi
 FROM e_feat GROUP BY is_late),
 v AS (SELECT f.is_late, f.order_id, greatest(least(f.{col}, q.hi), q.lo) AS x FROM e_feat f JOIN q ON f.is_late = q.is_late
  WHERE f.{col} IS NOT NULL)"""


# the three columns shown by lateness: query suffix -> column
CLIPPED = {"": "total_freight", "_weight": "product_weight_g", "_processing": "processing_days"}


def _register_clipped(suffix: str, col: str) -> None:
    @query(f"prj_20{suffix}", f"WITH {_clip_sql(col)} SELECT is_late, order_id, round(x, 6) AS {col} FROM v", EDA_CTES)
    def prj_20(spark, sf_dir):
        """PRJ-20: a column clipped to its own group's 1st / 99th percentile (on time vs late)."""
        d = rp.delivered_features(market(spark, sf_dir))
        return finalize(rp.clip_to_own_percentiles(d, col, ["is_late"]))

    @query(f"ag_44{suffix or '_freight'}", f"""WITH {_clip_sql(col)},
 r AS (SELECT is_late, count(*) AS n, CASE WHEN max(x) = min(x) THEN min(x) - 0.5 ELSE min(x) END AS lo,
   CASE WHEN max(x) = min(x) THEN max(x) + 0.5 ELSE max(x) END AS hi FROM v GROUP BY is_late),
 c AS (SELECT v.is_late, CAST(least(floor((x - lo) / (hi - lo) * 50), 49) AS BIGINT) AS bin, count(*) AS cnt
  FROM v JOIN r ON v.is_late = r.is_late GROUP BY 1, 2),
 g AS (SELECT range AS bin FROM range(50))
 SELECT r.is_late, g.bin, round(lo + g.bin * ((hi - lo) / 50), 6) AS bin_low, round(lo + (g.bin + 1) * ((hi - lo) / 50), 6) AS bin_high,
 coalesce(c.cnt, 0) AS count, round(coalesce(c.cnt, 0) / (n * ((hi - lo) / 50)), 6) AS density
 FROM r CROSS JOIN g LEFT JOIN c ON c.is_late = r.is_late AND c.bin = g.bin""", EDA_CTES)
    def ag_44(spark, sf_dir):
        """AG-44 + PRJ-20: density histograms per lateness group, values clipped to the group's
        own 1st / 99th percentile, 50 bins."""
        d = rp.delivered_features(market(spark, sf_dir))
        clipped = rp.clip_to_own_percentiles(d, col, ["is_late"])
        return finalize(rp.histogram(clipped, col, 50, keys=["is_late"], density=True))


for _suffix, _col in CLIPPED.items():
    _register_clipped(_suffix, _col)


_DOW = "CASE isodow(order_purchase_timestamp) " + " ".join(
    f"WHEN {i + 1} THEN '{n}'" for i, n in enumerate(rp.WEEKDAY_NAMES)) + " END"


@query("ag_35", f"""SELECT 'month' AS dimension, month(order_purchase_timestamp) AS key, CAST(month(order_purchase_timestamp) AS VARCHAR) AS label,
 round(avg(CAST(is_late AS DOUBLE)) * 100, 6) AS late_rate_pct FROM e_del GROUP BY 2
 UNION ALL SELECT 'weekday', isodow(order_purchase_timestamp) - 1, {_DOW}, round(avg(CAST(is_late AS DOUBLE)) * 100, 6) FROM e_del GROUP BY 2, 3
 UNION ALL SELECT 'hour', hour(order_purchase_timestamp), CAST(hour(order_purchase_timestamp) AS VARCHAR),
 round(avg(CAST(is_late AS DOUBLE)) * 100, 6) FROM e_del GROUP BY 2""", EDA_CTES)
def ag_35(spark, sf_dir):
    d = rp.delivered_status_orders(market(spark, sf_dir).orders)
    return finalize(rp.seasonality(d))


_SELLER_COLS = f"""seller_id, total_orders, round(total_revenue, 6) AS total_revenue, round(avg_order_value, 6) AS avg_order_value,
 {ts_sql('first_order')} AS first_order, {ts_sql('last_order')} AS last_order, round(avg_review_score, 6) AS avg_review_score,
 review_count, round(late_rate, 6) AS late_rate, delivered_count, CAST(tenure_days AS BIGINT) AS tenure_days"""


@query("ag_36", f"""SELECT seller_id, total_orders, round(total_revenue, 6) AS total_revenue,
 round(avg_order_value, 6) AS avg_order_value, {ts_sql('first_order')} AS first_order, {ts_sql('last_order')} AS last_order
 FROM e_sstat""", EDA_CTES)
def ag_36(spark, sf_dir):
    s = sellers(spark, sf_dir)
    return finalize(s.select("seller_id", "total_orders", "total_revenue", "avg_order_value",
                             "first_order", "last_order"))


@query("ag_37", "SELECT seller_id, round(avg_review_score, 6) AS avg_review_score, review_count FROM e_srev", EDA_CTES)
def ag_37(spark, sf_dir):
    s = sellers(spark, sf_dir)
    return finalize(s.select("seller_id", "avg_review_score", "review_count"))


@query("ag_38", """SELECT s.seller_id, round(l.late_rate, 6) AS late_rate, l.delivered_count, CAST(s.tenure_days AS BIGINT) AS tenure_days
 FROM e_seller s LEFT JOIN e_slate l ON s.seller_id = l.seller_id""", EDA_CTES)
def ag_38(spark, sf_dir):
    s = sellers(spark, sf_dir)
    return finalize(s.select("seller_id", "late_rate", "delivered_count", "tenure_days"))


@query("jn_15", f"SELECT {_SELLER_COLS} FROM e_seller", EDA_CTES)
def jn_15(spark, sf_dir):
    """JN-15: seller stats LEFT reviews LEFT lateness."""
    return finalize(sellers(spark, sf_dir))


def _describe_sql(col: str) -> str:
    v = f"CAST({col} AS DOUBLE)"
    return (f"SELECT '{col}' AS column_name, count({v}) AS count, round(avg({v}), 6) AS mean, round(stddev_samp({v}), 6) AS std, "
            f"round(min({v}), 6) AS min, round(max({v}), 6) AS max, round(quantile_cont({v}, 0.25), 6) AS p25, "
            f"round(quantile_cont({v}, 0.5), 6) AS p50, round(quantile_cont({v}, 0.75), 6) AS p75 FROM e_seller")


@query("ag_39", " UNION ALL ".join(_describe_sql(c) for c in rp.SELLER_DESCRIBE), EDA_CTES)
def ag_39(spark, sf_dir):
    return finalize(rp.describe_columns(sellers(spark, sf_dir), rp.SELLER_DESCRIBE))


_PARETO_SQL = """SELECT seller_id, round(total_revenue, 6) AS total_revenue,
 row_number() OVER (ORDER BY round_even(total_revenue, 2) DESC, seller_id) AS seller_rank,
 round(sum(total_revenue) OVER (ORDER BY round_even(total_revenue, 2) DESC, seller_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
   / sum(total_revenue) OVER () * 100, 6) AS cum_revenue_pct,
 round(row_number() OVER (ORDER BY round_even(total_revenue, 2) DESC, seller_id) / count(*) OVER () * 100, 6) AS seller_pct FROM e_seller"""


@query("w_09", _PARETO_SQL, EDA_CTES)
def w_09(spark, sf_dir):
    """W-09: Pareto of seller revenue."""
    return finalize(rp.revenue_pareto(sellers(spark, sf_dir)))


@query("w_09_top", f"""WITH p AS ({_PARETO_SQL}) SELECT max(cum_revenue_pct) AS top_share_pct FROM p
 WHERE seller_rank <= floor((SELECT count(*) FROM e_seller) * CAST(0.2 AS DOUBLE))""", EDA_CTES)
def w_09_top(spark, sf_dir):
    """W-09: revenue share of the top 20 % of sellers."""
    return finalize(rp.top_share(rp.revenue_pareto(sellers(spark, sf_dir))))


@query("ag_40", """WITH s AS (SELECT * FROM e_seller WHERE review_count >= 5 AND delivered_count >= 5),
 m AS (SELECT quantile_cont(late_rate, 0.5) AS ml, quantile_cont(avg_review_score, 0.5) AS ms FROM s)
 SELECT seller_id, round(late_rate, 6) AS late_rate, round(avg_review_score, 6) AS avg_review_score,
 CASE WHEN late_rate <= ml AND avg_review_score > ms THEN 'Stars' WHEN late_rate <= ml AND avg_review_score <= ms THEN 'At Risk'
  WHEN late_rate > ml AND avg_review_score > ms THEN 'Fulfillment Problem' ELSE 'Churn Risk' END AS quadrant,
 round(ml, 6) AS median_late_rate, round(ms, 6) AS median_score FROM s CROSS JOIN m""", EDA_CTES)
def ag_40(spark, sf_dir):
    return finalize(rp.seller_quadrants(sellers(spark, sf_dir)))


_CHURN_SQL = f"""SELECT *, {floor_days_sql('(SELECT max(last_order) FROM e_seller)', 'last_order')} AS days_since_last_order
 FROM e_seller"""


@query("ag_41", f"""WITH c AS ({_CHURN_SQL}) SELECT days_since_last_order > 90 AS likely_churned, count(*) AS n_sellers,
 round(avg(avg_review_score), 6) AS avg_review_score, round(avg(late_rate), 6) AS late_rate FROM c GROUP BY 1""", EDA_CTES)
def ag_41(spark, sf_dir):
    return finalize(rp.churn_summary(rp.seller_churn(sellers(spark, sf_dir))))


@query("ag_41_sellers", f"""WITH c AS ({_CHURN_SQL}) SELECT seller_id, CAST(days_since_last_order AS BIGINT) AS days_since_last_order,
 days_since_last_order > 90 AS likely_churned FROM c""", EDA_CTES)
def ag_41_sellers(spark, sf_dir):
    """AG-41 per seller: idle days and churn flag."""
    c = rp.seller_churn(sellers(spark, sf_dir))
    return finalize(c.select("seller_id", "days_since_last_order", "likely_churned"))


@query("ag_42", """SELECT payment_type, round(sum(payment_value), 6) AS sum, round(avg(payment_value), 6) AS mean,
 count(payment_value) AS count FROM v_payments GROUP BY payment_type""")
def ag_42(spark, sf_dir):
    return finalize(rp.payment_types(market(spark, sf_dir).payments))


_CORR_FRAME = f"""SELECT d.order_id, CAST(d.is_late AS INT) AS is_late_int, r.review_score, d.delay_days, p.payment_value,
 p.payment_installments, i.n_items, i.total_freight, i.total_price, c.product_weight_g,
 {floor_days_sql('d.order_delivered_carrier_date', 'd.order_approved_at')} AS processing_days,
 {floor_days_sql('d.order_estimated_delivery_date', 'd.order_purchase_timestamp')} AS estimated_window,
 month(d.order_purchase_timestamp) AS month
 FROM e_del d LEFT JOIN e_pay p ON d.order_id = p.order_id LEFT JOIN e_items i ON d.order_id = i.order_id
 LEFT JOIN e_cat c ON d.order_id = c.order_id LEFT JOIN e_rev r ON d.order_id = r.order_id"""


@query("jn_17", f"""WITH f AS ({_CORR_FRAME}) SELECT order_id, CAST(is_late_int AS BIGINT) AS is_late_int,
 round(review_score, 6) AS review_score, delay_days, round(payment_value, 6) AS payment_value,
 CAST(payment_installments AS BIGINT) AS payment_installments, n_items, round(total_freight, 6) AS total_freight,
 round(total_price, 6) AS total_price, round(product_weight_g, 6) AS product_weight_g, processing_days, estimated_window,
 month FROM f""", EDA_CTES)
def jn_17(spark, sf_dir):
    return finalize(rp.correlation_frame(market(spark, sf_dir)))


def _corr_sql() -> str:
    cols = rp.CORR_COLUMNS
    parts = []
    for a in cols:
        for b in cols:
            if a == b:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST(1.0 AS DOUBLE) AS corr")
            else:
                parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, "
                             f"round(corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)), 6) AS corr FROM f")
    return f"WITH f AS ({_CORR_FRAME}) " + " UNION ALL ".join(parts)


@query("ag_43", _corr_sql(), EDA_CTES)
def ag_43(spark, sf_dir):
    """AG-43: 12-column pairwise-complete Pearson matrix (long form)."""
    return finalize(rp.correlation_matrix(rp.correlation_frame(market(spark, sf_dir))))


@query("ag_43_rank", f"""WITH f AS ({_CORR_FRAME}), c AS ({" UNION ALL ".join(
    f"SELECT '{b}' AS feature, corr(CAST(is_late_int AS DOUBLE), CAST({b} AS DOUBLE)) AS corr FROM f"
    for b in rp.CORR_COLUMNS[1:])})
 SELECT feature, round(corr, 6) AS corr, row_number() OVER (ORDER BY abs(corr) DESC, feature) AS rank FROM c""", EDA_CTES)
def ag_43_rank(spark, sf_dir):
    """AG-43: features ranked by absolute correlation with lateness."""
    mat = rp.correlation_matrix(rp.correlation_frame(market(spark, sf_dir)))
    c = mat.where((F.col("col_a") == "is_late_int") & (F.col("col_b") != "is_late_int")).select(
        F.col("col_b").alias("feature"), "corr")
    from pyspark.sql.window import Window
    w = Window.orderBy(F.desc(F.abs("corr")), "feature")  # 11 rows
    return finalize(c.select("feature", "corr", F.row_number().over(w).alias("rank")))


@query("ag_44", hist_sql("e_del", "delay_days", 80, -30, 60), EDA_CTES)
def ag_44(spark, sf_dir):
    """AG-44: histogram of delay days clipped to [-30, 60], 80 bins."""
    d = rp.delivered_status_orders(market(spark, sf_dir).orders)
    return finalize(rp.histogram(d, "delay_days", 80, lo_clip=-30, hi_clip=60))


@query("ag_44_payments", hist_sql("v_payments", "payment_value", 80, 0, 1000))
def ag_44_payments(spark, sf_dir):
    """AG-44: histogram of payment values clipped to [0, 1000], 80 bins."""
    return finalize(rp.histogram(market(spark, sf_dir).payments, "payment_value", 80, lo_clip=0, hi_clip=1000))


@query("ag_44_sellers", hist_sql("e_seller", "total_orders", 50, 0, 100), EDA_CTES)
def ag_44_sellers(spark, sf_dir):
    """AG-44: histogram of orders per seller clipped to [0, 100], 50 bins."""
    return finalize(rp.histogram(sellers(spark, sf_dir), "total_orders", 50, lo_clip=0, hi_clip=100))


@query("ag_45", f"""WITH c AS ({_CHURN_SQL})
 SELECT round((SELECT avg(CAST(is_late AS DOUBLE)) * 100 FROM e_del), 6) AS late_rate_pct,
 (SELECT count(*) FROM e_del) AS n_delivered,
 round((SELECT avg(review_score) FROM e_drev WHERE is_late), 6) AS late_avg_score,
 round((SELECT avg(review_score) FROM e_drev WHERE NOT is_late), 6) AS ontime_avg_score,
 round((SELECT avg(CAST(days_since_last_order > 90 AS DOUBLE)) * 100 FROM c), 6) AS churn_rate_pct,
 (SELECT count(*) FROM c) AS n_sellers""", EDA_CTES)
def ag_45(spark, sf_dir):
    return finalize(rp.readiness_summary(market(spark, sf_dir)))


@query("jn_14", f"""SELECT i.order_id, CAST(i.order_item_id AS BIGINT) AS order_item_id, i.seller_id, round(i.price, 6) AS price,
 round(i.freight_value, 6) AS freight_value, {ts_sql('o.order_purchase_timestamp')} AS order_purchase_timestamp, o.order_status
 FROM v_items i JOIN v_orders o ON i.order_id = o.order_id""")
def jn_14(spark, sf_dir):
    """JN-14: items INNER order time and status (seller-level base)."""
    m = market(spark, sf_dir)
    j = m.items.select("order_id", "order_item_id", "seller_id", "price", "freight_value").join(
        m.orders.select("order_id", "order_purchase_timestamp", "order_status"), "order_id")
    return finalize(j)


@query("set_01", f"SELECT DISTINCT order_id, {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp FROM v_orders")
def set_01(spark, sf_dir):
    """SET-01: distinct (order, purchase time) pairs."""
    o = market(spark, sf_dir).orders
    return finalize(o.select("order_id", "order_purchase_timestamp").dropDuplicates())
