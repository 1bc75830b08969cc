"""The role views as DuckDB SQL, prepended as a WITH clause to every oracle query.

Same derivation as ``shipcast.sources.tables`` (FIXTURES.md section 3)."""

VIEWS = {
    "v_orders": """SELECT o_orderkey AS order_id, o_custkey AS customer_id,
 CASE WHEN o_orderkey % 20 = 0 THEN 'canceled' WHEN o_orderkey % 20 = 1 THEN 'shipped' ELSE 'delivered' END AS order_status,
 o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400) AS order_purchase_timestamp,
 CASE WHEN o_orderkey % 50 = 7 THEN NULL ELSE o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400 + (o_orderkey % 97) * 600) END AS order_approved_at,
 CASE WHEN o_orderkey % 20 = 0 THEN NULL ELSE o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400 + (o_orderkey * 31 % 4000) * 180) END AS order_delivered_carrier_date,
 CASE WHEN o_orderkey % 20 IN (0, 1, 2) THEN NULL ELSE o_orderdate + INTERVAL '1' SECOND * ((o_orderkey * 7919) % 86400 + (o_orderkey * 31 % 4000) * 180 + (o_orderkey * o_orderkey % 2500) * 900) END AS order_delivered_customer_date,
 o_orderdate + INTERVAL '1' DAY * (8 + o_orderkey % 23) AS order_estimated_delivery_date
 FROM orders""",
    "v_items": """SELECT l_orderkey AS order_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity, l_extendedprice) AS order_item_id,
 l_partkey AS product_id, l_suppkey * 100 + l_partkey % 20 AS seller_id, l_extendedprice AS price, round(l_quantity * (1 + l_tax), 2) AS freight_value, l_shipdate AS shipping_limit_date FROM lineitem""",
    "v_products": """SELECT p_partkey AS product_id, CASE WHEN p_partkey % 50 = 0 THEN NULL ELSE p_type END AS product_category_name,
 CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE CAST(p_size * 100 AS DOUBLE) END AS product_weight_g,
 CASE WHEN p_partkey % 45 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS product_length_cm, CAST(p_partkey % 30 + 1 AS DOUBLE) AS product_height_cm, CAST(p_partkey % 17 + 1 AS DOUBLE) AS product_width_cm FROM part""",
    "v_translation": """SELECT DISTINCT p_type AS product_category_name, lower(p_type) AS product_category_name_english FROM part WHERE p_type <> 'PROMO'""",
    "v_sellers": """SELECT s_suppkey * 100 + k AS seller_id, s_nationkey * 4 + s_suppkey % 4 AS seller_zip_code_prefix, n_name AS seller_state
 FROM supplier JOIN nation ON s_nationkey = n_nationkey CROSS JOIN (SELECT DISTINCT p_partkey % 20 AS k FROM part) ks""",
    "v_customers": """SELECT c_custkey AS customer_id, c_nationkey * 4 + c_custkey % 4 AS customer_zip_code_prefix, n_name AS customer_state FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "v_geo": """SELECT n_nationkey * 4 + k AS geolocation_zip_code_prefix, CAST(n_nationkey * 2 - 30 + k AS DOUBLE) + j * 0.01 AS geolocation_lat, CAST(n_nationkey * 3 - 70 - k AS DOUBLE) - j * 0.02 AS geolocation_lng
 FROM nation CROSS JOIN (SELECT DISTINCT p_partkey % 4 AS k FROM part) ks CROSS JOIN (SELECT DISTINCT p_partkey % 3 AS j FROM part) js WHERE n_nationkey % 9 <> 8""",
    "v_payments": """SELECT o_orderkey AS order_id, 1 AS payment_sequential, o_orderpriority AS payment_type, CAST(o_orderkey % 10 + 1 AS INT) AS payment_installments, o_totalprice AS payment_value FROM orders WHERE o_orderkey % 100 <> 99
 UNION ALL SELECT o_orderkey, 2, 'voucher', 1, CAST(round(CAST(o_totalprice AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2)), 2) AS DOUBLE) FROM orders WHERE o_orderkey % 13 = 0""",
    "v_reviews": """SELECT o_orderkey AS review_id, o_orderkey AS order_id, CAST(1 + (o_orderkey * 17 + o_orderkey % 7) % 5 AS INT) AS review_score, CASE WHEN o_orderkey % 3 = 0 THEN text END AS review_comment_message,
 CASE WHEN o_orderkey % 9 = 0 THEN source END AS review_comment_title, o_orderdate + INTERVAL '1' DAY * (10 + o_orderkey % 40) AS review_answer_timestamp,
 o_orderdate + INTERVAL '1' DAY * (9 + o_orderkey % 40) AS review_creation_date
 FROM orders LEFT JOIN documents ON doc_id = o_orderkey % (SELECT max(doc_id) + 1 FROM documents) WHERE o_orderkey % 30 <> 29""",
}


def with_views(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` with all role views as CTEs (DuckDB ignores unreferenced ones)."""
    ctes = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in VIEWS.items())
    if extra_ctes:
        ctes = ctes + ",\n" + extra_ctes
    stripped = body.lstrip()
    if stripped[:5].upper() == "WITH ":  # merge the body's own CTE list into ours
        return f"WITH {ctes},\n{stripped[5:]}"
    return f"WITH {ctes}\n{body}"
