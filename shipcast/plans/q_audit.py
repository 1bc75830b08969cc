"""Queries: the error audit on a fixed, SQL-reproducible predictor
(prediction = seller_avg_delivery on the test split): AG-46..AG-50, ML-10, ML-13, PRJ-12/13,
TK-02, SNK-05. The same plans audit a fitted model in ``q_model``."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.exprs import sql_bucket
from ..operators import audit as au
from ..operators import reports as rp
from ..session import scratch_path
from .catalog import finalize, folder_tag, hist_sql, query, shared
from .q_split import SPLIT_CTES, model_frame


def fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Test rows scored by the seller's train mean delivery time."""
    mf = model_frame(spark, sf_dir)
    return mf.where(F.col("split") == "test").withColumn("prediction", F.col("seller_avg_delivery"))


def fixed_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "fixed_errors", lambda: au.residual_frame(fixed_predictions(spark, sf_dir)))


# value and edges snapped to 9 places, the twin of ``audit.quantile_tier``
_TIER_IDX = ("1 + CAST(x > round(e1, 9) AS INT)"
             " + CASE WHEN round(e2, 9) > round(e1, 9) THEN CAST(x > round(e2, 9) AS INT) ELSE 0 END"
             " + CASE WHEN round(e3, 9) > round(e2, 9) THEN CAST(x > round(e3, 9) AS INT) ELSE 0 END")
_TIER_LIST = "[" + ", ".join(f"'{t}'" for t in au.TIER_LABELS) + "]"

AUDIT_CTES = SPLIT_CTES + f""",
a_base AS (SELECT m.*, seller_avg_delivery AS predicted, delivery_time_days - seller_avg_delivery AS residual,
  abs(delivery_time_days - seller_avg_delivery) AS abs_error, (delivery_time_days - seller_avg_delivery) < 0 AS over_predict
  FROM t_model m WHERE split = 'test'),
a_edges AS (SELECT quantile_cont(seller_avg_delivery, 0.25) AS e1, quantile_cont(seller_avg_delivery, 0.5) AS e2,
  quantile_cont(seller_avg_delivery, 0.75) AS e3 FROM a_base),
a_err AS (SELECT a.*, {sql_bucket('abs_error', au.ERROR_EDGES, au.ERROR_LABELS)} AS error_bucket,
  {sql_bucket('distance_km', au.DISTANCE_EDGES, au.DISTANCE_LABELS)} AS distance_band,
  CASE WHEN seller_avg_delivery IS NULL THEN NULL ELSE {_TIER_LIST}[{_TIER_IDX.replace('x', 'round(seller_avg_delivery, 9)')}] END AS seller_tier
  FROM a_base a CROSS JOIN a_edges)"""


def _seg_sql(col: str, labels=None) -> str:
    seg = f"""SELECT {col}, count(abs_error) AS n_orders, avg(abs_error) AS MAE, quantile_cont(abs_error, 0.5) AS Median_AE,
 quantile_cont(abs_error, 0.9) AS P90_AE FROM a_err WHERE {col} IS NOT NULL GROUP BY {col}"""
    if labels is None:
        return f"""SELECT {col if col != 'purchase_month' else 'CAST(purchase_month AS BIGINT) AS purchase_month'}, n_orders,
 round(MAE, 6) AS MAE, round(Median_AE, 6) AS Median_AE, round(P90_AE, 6) AS P90_AE FROM ({seg})"""
    lab = " UNION ALL ".join(f"SELECT '{x}' AS {col}" for x in labels)
    return f"""WITH s AS ({seg}), l AS ({lab}) SELECT l.{col}, coalesce(s.n_orders, 0) AS n_orders, round(s.MAE, 6) AS MAE,
 round(s.Median_AE, 6) AS Median_AE, round(s.P90_AE, 6) AS P90_AE FROM l LEFT JOIN s ON l.{col} = s.{col}"""


@query("ag_46", """SELECT round(avg(abs(delivery_time_days - predicted)), 6) AS MAE,
 round(sqrt(avg((delivery_time_days - predicted) * (delivery_time_days - predicted))), 6) AS RMSE,
 round(1 - sum((delivery_time_days - predicted) * (delivery_time_days - predicted)) / (count(*) * var_pop(delivery_time_days)), 6) AS R2,
 round(avg(CAST(round(abs(delivery_time_days - predicted), 9) <= 2 AS DOUBLE)) * 100, 6) AS within_2d,
 round(avg(CAST(round(abs(delivery_time_days - predicted), 9) <= 1 AS DOUBLE)) * 100, 6) AS within_1d, count(*) AS n FROM a_err""",
       AUDIT_CTES)
def ag_46(spark, sf_dir):
    """AG-46: MAE, RMSE, R2, within 2 d / 1 d on the test split."""
    return finalize(au.metrics(fixed_predictions(spark, sf_dir)))


@query("ml_10", """SELECT order_id, round(predicted, 6) AS predicted, round(residual, 6) AS residual,
 round(abs_error, 6) AS abs_error, over_predict FROM a_err""", AUDIT_CTES)
def ml_10(spark, sf_dir):
    """ML-10: residual frame."""
    e = fixed_errors(spark, sf_dir)
    return finalize(e.select("order_id", "predicted", "residual", "abs_error", "over_predict"))


@query("prj_12", "SELECT order_id, error_bucket, distance_band FROM a_err", AUDIT_CTES)
def prj_12(spark, sf_dir):
    """PRJ-12: right-closed error and distance bins."""
    return finalize(fixed_errors(spark, sf_dir).select("order_id", "error_bucket", "distance_band"))


@query("prj_13", "SELECT order_id, round(seller_avg_delivery, 6) AS seller_avg_delivery, seller_tier FROM a_err", AUDIT_CTES)
def prj_13(spark, sf_dir):
    """PRJ-13: quartile tiers of the seller's mean delivery time."""
    return finalize(fixed_errors(spark, sf_dir).select("order_id", "seller_avg_delivery", "seller_tier"))


@query("ag_47", _seg_sql("product_category_name_english"), AUDIT_CTES)
def ag_47(spark, sf_dir):
    """AG-47: error by product category, worst first."""
    seg = au.segment_error(fixed_errors(spark, sf_dir), "product_category_name_english")
    return finalize(seg.orderBy(F.desc("MAE")))


@query("ag_47_band", _seg_sql("distance_band", au.DISTANCE_LABELS), AUDIT_CTES)
def ag_47_band(spark, sf_dir):
    """AG-47: error by distance band (every band kept)."""
    return finalize(au.segment_error(fixed_errors(spark, sf_dir), "distance_band", au.DISTANCE_LABELS))


@query("ag_47_month", _seg_sql("purchase_month"), AUDIT_CTES)
def ag_47_month(spark, sf_dir):
    """AG-47: error by purchase month."""
    return finalize(au.segment_error(fixed_errors(spark, sf_dir), "purchase_month"))


@query("ag_47_tier", _seg_sql("seller_tier", au.TIER_LABELS), AUDIT_CTES)
def ag_47_tier(spark, sf_dir):
    """AG-47: error by seller tier (every tier kept)."""
    return finalize(au.segment_error(fixed_errors(spark, sf_dir), "seller_tier", au.TIER_LABELS))


@query("ag_48", """SELECT count(residual) AS count, round(avg(residual), 6) AS mean, round(stddev_samp(residual), 6) AS std,
 round(min(residual), 6) AS min, round(max(residual), 6) AS max, round(quantile_cont(residual, 0.25), 6) AS p25,
 round(quantile_cont(residual, 0.5), 6) AS p50, round(quantile_cont(residual, 0.75), 6) AS p75,
 round(avg(residual), 6) AS bias_days,
 CASE WHEN avg(residual) < 0 THEN 'model over-estimates' ELSE 'model under-estimates' END AS direction FROM a_err""", AUDIT_CTES)
def ag_48(spark, sf_dir):
    """AG-48: residual describe and bias with direction."""
    return finalize(au.residual_summary(fixed_errors(spark, sf_dir)))


@query("ag_49", "WITH c AS (SELECT error_bucket, count(*) AS n FROM a_err WHERE error_bucket IS NOT NULL GROUP BY 1), l AS ("
       + " UNION ALL ".join(f"SELECT {i} AS label_order, '{x}' AS error_bucket" for i, x in enumerate(au.ERROR_LABELS))
       + """) SELECT CAST(l.label_order AS BIGINT) AS label_order, l.error_bucket, coalesce(c.n, 0) AS n_orders,
 round(coalesce(c.n, 0) / (SELECT count(*) FROM a_err) * 100, 6) AS pct FROM l LEFT JOIN c ON l.error_bucket = c.error_bucket""",
       AUDIT_CTES)
def ag_49(spark, sf_dir):
    """AG-49: error-size distribution with percent."""
    return finalize(au.error_distribution(fixed_errors(spark, sf_dir)))


@query("ag_50", """WITH md AS (SELECT seller_avg_delivery AS v FROM a_err WHERE seller_avg_delivery IS NOT NULL
 GROUP BY 1 ORDER BY count(*) DESC, v LIMIT 1)
 SELECT round(avg(abs_error) FILTER (WHERE delivery_time_days <= 5), 6) AS short_mae,
 count(*) FILTER (WHERE delivery_time_days <= 5) AS short_n,
 round(avg(abs_error) FILTER (WHERE NOT (delivery_time_days <= 5)), 6) AS long_mae,
 count(*) FILTER (WHERE NOT (delivery_time_days <= 5)) AS long_n,
 round(avg(abs_error) FILTER (WHERE seller_avg_delivery = (SELECT v FROM md)), 6) AS new_seller_mae,
 count(*) FILTER (WHERE seller_avg_delivery = (SELECT v FROM md)) AS new_seller_n,
 round(avg(abs_error) FILTER (WHERE NOT (seller_avg_delivery = (SELECT v FROM md))), 6) AS established_mae,
 count(*) FILTER (WHERE NOT (seller_avg_delivery = (SELECT v FROM md))) AS established_n FROM a_err""", AUDIT_CTES)
def ag_50(spark, sf_dir):
    """AG-50: trust boundaries (short vs long deliveries, fallback vs established sellers)."""
    return finalize(au.trust_boundaries(fixed_errors(spark, sf_dir)))


_WORST_SQL = f"""WITH c AS ({_seg_sql('product_category_name_english')}),
 w AS (SELECT string_agg(product_category_name_english, '|' ORDER BY MAE DESC, product_category_name_english) AS worst_categories
  FROM (SELECT * FROM (SELECT product_category_name_english, avg(abs_error) AS MAE FROM a_err
   WHERE product_category_name_english IS NOT NULL GROUP BY 1) ORDER BY MAE DESC, product_category_name_english LIMIT 5)),
 b AS (SELECT distance_band FROM (SELECT distance_band, avg(abs_error) AS MAE FROM a_err WHERE distance_band IS NOT NULL GROUP BY 1)
  ORDER BY MAE DESC, distance_band LIMIT 1)"""


@query("tk_02", _WORST_SQL + " SELECT w.worst_categories, (SELECT distance_band FROM b) AS worst_distance_band FROM w",
       AUDIT_CTES)
def tk_02(spark, sf_dir):
    """TK-02: worst 5 categories and worst distance band."""
    return finalize(au.worst_segments(fixed_errors(spark, sf_dir)))


@query("snk_05", _WORST_SQL + """ SELECT round_even(avg(residual), 3) AS bias_days,
 round_even(avg(CAST(round(abs_error, 9) <= 1 AS DOUBLE)) * 100, 1) AS within_1d_pct,
 round_even(avg(CAST(round(abs_error, 9) <= 2 AS DOUBLE)) * 100, 1) AS within_2d_pct,
 (SELECT worst_categories FROM w) AS worst_categories, (SELECT distance_band FROM b) AS worst_distance_band,
 CAST(""" + str(len(au.SUMMARY_NOTES)) + """ AS BIGINT) AS n_notes FROM a_err""", AUDIT_CTES)
def snk_05(spark, sf_dir):
    """SNK-05: the error summary, written as JSON and read back."""
    path = scratch_path(spark, f"error-summary-{folder_tag(sf_dir)}")
    au.write_summary(au.error_summary(fixed_errors(spark, sf_dir)), path)
    s = au.read_summary(spark, path)
    return finalize(s.select("bias_days", "within_1d_pct", "within_2d_pct",
                             F.array_join("worst_categories", "|").alias("worst_categories"),
                             "worst_distance_band", F.size("notes").cast("long").alias("n_notes")))


@query("ag_44_residual", hist_sql("a_err", "residual", 60), AUDIT_CTES)
def ag_44_residual(spark, sf_dir):
    """AG-44: histogram of residuals, 60 bins."""
    return finalize(rp.histogram(fixed_errors(spark, sf_dir), "residual", 60))


@query("ml_13", """SELECT order_id, product_category_name_english, CAST(purchase_month AS BIGINT) AS purchase_month,
 round(predicted, 6) AS predicted, round(residual, 6) AS residual, round(abs_error, 6) AS abs_error, over_predict,
 error_bucket, distance_band, seller_tier FROM a_err""", AUDIT_CTES)
def ml_13(spark, sf_dir):
    """ML-13: error analysis end to end (per test order)."""
    e = fixed_errors(spark, sf_dir)
    return finalize(e.select("order_id", "product_category_name_english", "purchase_month", "predicted",
                             "residual", "abs_error", "over_predict", "error_bucket", "distance_band",
                             "seller_tier"))
