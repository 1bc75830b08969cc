"""Queries: split and encodings (W-03..W-08, AG-04..AG-11, JN-08, FLT-04, PRJ-10/11/16, ML-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import split as sp
from ..operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES, TARGET
from .catalog import derived, finalize, floor_days_sql, query, shared, ts_sql
from .q_features import FEATURE_CTES, features

# fixed split fractions of the reference (train 70 %, validation 15 %, test the rest)
TRAIN_FRAC, VAL_FRAC = 0.70, 0.15
NB_TRAIN_FRAC = 0.8


def labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    # not stored: a column beside the stored features
    return derived(spark, sf_dir, "labelled", lambda: sp.assign_split(
        features(spark, sf_dir), sp.cut_fractions(TRAIN_FRAC, VAL_FRAC)))


def with_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "with_stats", lambda: sp.with_train_stats(labelled(spark, sf_dir)))


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three splits with their train-only encodings, complete rows only (ML-12)."""
    # not stored: a filter on the stored statistics
    return derived(spark, sf_dir, "model_frame", lambda: sp.drop_incomplete(with_stats(spark, sf_dir)))


def notebook_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shared(spark, sf_dir, "notebook_frame", lambda: sp.notebook_split(features(spark, sf_dir)))


_CUT1 = repr(TRAIN_FRAC)
_CUT2 = repr(TRAIN_FRAC + VAL_FRAC)
_ALL_FEATURES = list(dict.fromkeys(NUMERIC_FEATURES + CATEGORICAL_FEATURES))
_NOT_NULL = " AND ".join(f"{c} IS NOT NULL" for c in _ALL_FEATURES)

SPLIT_CTES = FEATURE_CTES + f""",
t_rank AS (SELECT f.*, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS rn,
  count(*) OVER () AS n_all FROM t_feat f),
t_split AS (SELECT *, CASE WHEN rn < floor(n_all * CAST({_CUT1} AS DOUBLE)) THEN 'train'
  WHEN rn < floor(n_all * CAST({_CUT2} AS DOUBLE)) THEN 'val' ELSE 'test' END AS split FROM t_rank),
t_g AS (SELECT avg(processing_days) AS g_proc, avg(transit_days) AS g_tran, avg(delivery_time_days) AS g_del,
  quantile_cont(distance_km, 0.5) AS dist_median FROM t_split WHERE split = 'train'),
t_ss AS (SELECT seller_id, avg(processing_days) AS seller_avg_processing, stddev_samp(processing_days) AS seller_std_processing,
  avg(transit_days) AS seller_avg_transit, stddev_samp(transit_days) AS seller_std_transit,
  avg(delivery_time_days) AS seller_avg_delivery, stddev_samp(delivery_time_days) AS seller_std_delivery
  FROM t_split WHERE split = 'train' AND seller_id IS NOT NULL GROUP BY seller_id),
t_cs AS (SELECT product_category_name_english, avg(processing_days) AS cat_avg_processing,
  avg(transit_days) AS cat_avg_transit FROM t_split WHERE split = 'train' GROUP BY 1),
t_stats AS (SELECT s.* EXCLUDE (distance_km), coalesce(s.distance_km, g.dist_median) AS distance_km,
  coalesce(ss.seller_avg_processing, g.g_proc) AS seller_avg_processing, coalesce(ss.seller_std_processing, 0.0) AS seller_std_processing,
  coalesce(ss.seller_avg_transit, g.g_tran) AS seller_avg_transit, coalesce(ss.seller_std_transit, 0.0) AS seller_std_transit,
  coalesce(ss.seller_avg_delivery, g.g_del) AS seller_avg_delivery, coalesce(ss.seller_std_delivery, 0.0) AS seller_std_delivery,
  coalesce(cs.cat_avg_processing, g.g_proc) AS cat_avg_processing, coalesce(cs.cat_avg_transit, g.g_tran) AS cat_avg_transit
  FROM t_split s CROSS JOIN t_g g LEFT JOIN t_ss ss ON s.seller_id = ss.seller_id
  LEFT JOIN t_cs cs ON s.product_category_name_english = cs.product_category_name_english),
t_model AS (SELECT * FROM t_stats WHERE {_NOT_NULL})"""


def _model_cols_sql(prefix: str = "") -> str:
    ints = {"purchase_hour", "n_items", "purchase_month", "purchase_day_of_week", "purchase_quarter",
            "is_weekend"}
    parts = []
    for c in _ALL_FEATURES + [TARGET]:
        if c in ints:
            parts.append(f"CAST({prefix}{c} AS BIGINT) AS {c}")
        elif c == "product_category_name_english":
            parts.append(f"{prefix}{c}")
        else:
            parts.append(f"round({prefix}{c}, 6) AS {c}")
    return ", ".join(parts)


@query("w_06", "SELECT order_id, split FROM t_split", SPLIT_CTES)
def w_06(spark, sf_dir):
    """W-06: ordinal 70/15/15 split by (purchase time, order_id)."""
    return finalize(labelled(spark, sf_dir).select("order_id", "split"))


@query("w_08", f"""SELECT split, count(*) AS n_orders, {ts_sql('min(order_purchase_timestamp)')} AS period_start,
 {ts_sql('max(order_purchase_timestamp)')} AS period_end FROM t_split GROUP BY split""", SPLIT_CTES)
def w_08(spark, sf_dir):
    return finalize(sp.split_periods(labelled(spark, sf_dir)))


@query("ag_06", """SELECT round(g_proc, 6) AS g_proc, round(g_tran, 6) AS g_tran, round(g_del, 6) AS g_del,
 round(dist_median, 6) AS dist_median FROM t_g""", SPLIT_CTES)
def ag_06(spark, sf_dir):
    return finalize(sp.global_train_stats(labelled(spark, sf_dir)))


@query("ag_04", """SELECT seller_id, round(seller_avg_processing, 6) AS seller_avg_processing,
 round(seller_std_processing, 6) AS seller_std_processing, round(seller_avg_transit, 6) AS seller_avg_transit,
 round(seller_std_transit, 6) AS seller_std_transit, round(seller_avg_delivery, 6) AS seller_avg_delivery,
 round(seller_std_delivery, 6) AS seller_std_delivery FROM t_ss""", SPLIT_CTES)
def ag_04(spark, sf_dir):
    train = labelled(spark, sf_dir).where(F.col("split") == "train")
    return finalize(sp.seller_stats(train))


@query("ag_05", """SELECT product_category_name_english, round(cat_avg_processing, 6) AS cat_avg_processing,
 round(cat_avg_transit, 6) AS cat_avg_transit FROM t_cs""", SPLIT_CTES)
def ag_05(spark, sf_dir):
    train = labelled(spark, sf_dir).where(F.col("split") == "train")
    return finalize(sp.category_stats(train))


@query("jn_08", f"SELECT order_id, split, {_model_cols_sql()} FROM t_stats", SPLIT_CTES)
def jn_08(spark, sf_dir):
    """JN-08: train statistics joined onto every split with fallbacks (before the NULL drop)."""
    return finalize(sp.model_inputs(with_stats(spark, sf_dir)))


@query("flt_04", f"""SELECT split, count(*) AS n_before, count(*) FILTER (WHERE {_NOT_NULL}) AS n_after,
 count(*) - count(*) FILTER (WHERE {_NOT_NULL}) AS n_dropped FROM t_stats GROUP BY split""", SPLIT_CTES)
def flt_04(spark, sf_dir):
    """FLT-04: rows dropped for a missing model input, by split."""
    ws = with_stats(spark, sf_dir)
    complete = F.lit(True)
    for c in _ALL_FEATURES:
        complete = complete & F.col(c).isNotNull()
    out = ws.groupBy("split").agg(F.count(F.lit(1)).alias("n_before"),
                                  F.count_if(complete).alias("n_after"))
    return finalize(out.withColumn("n_dropped", F.col("n_before") - F.col("n_after")))


@query("prj_16", f"SELECT order_id, split, {_model_cols_sql()} FROM t_model", SPLIT_CTES)
def prj_16(spark, sf_dir):
    """PRJ-16: model input selection (unique names checked)."""
    return finalize(sp.model_inputs(model_frame(spark, sf_dir)))


@query("ml_12", f"""SELECT order_id, split, {_model_cols_sql()}, seller_id,
 {ts_sql('order_purchase_timestamp')} AS order_purchase_timestamp FROM t_model""", SPLIT_CTES)
def ml_12(spark, sf_dir):
    """ML-12: split + encodings end to end."""
    mf = model_frame(spark, sf_dir)
    cols = dict.fromkeys([*sp.model_inputs(mf).columns, "seller_id", "order_purchase_timestamp"])
    return finalize(mf.select(*cols))


# --- notebook extensions -----------------------------------------------------------------------
NB_CTES = FEATURE_CTES + f""",
t_nrank AS (SELECT f.*, row_number() OVER (ORDER BY order_purchase_timestamp, order_id) - 1 AS rn,
  count(*) OVER () AS n_all FROM t_feat f),
t_nsplit AS (SELECT *, CASE WHEN rn < floor(n_all * CAST({NB_TRAIN_FRAC!r} AS DOUBLE)) THEN 'train' ELSE 'test' END AS split,
  CAST(seller_zip_code_prefix AS VARCHAR) || '_' || CAST(customer_zip_code_prefix AS VARCHAR) AS route,
  seller_state || '_' || customer_state AS state_pair FROM t_nrank),
t_ntrain AS (SELECT * FROM t_nsplit WHERE split = 'train'),
t_sc AS (SELECT seller_id, count(*) AS seller_total_orders, min(order_purchase_timestamp) AS seller_first_order_date
  FROM t_ntrain WHERE seller_id IS NOT NULL GROUP BY seller_id),
t_route AS (SELECT route, avg(delivery_time_days) AS route_avg_delivery, stddev_samp(delivery_time_days) AS route_std_delivery
  FROM t_ntrain WHERE route IS NOT NULL GROUP BY route),
t_sp AS (SELECT state_pair, avg(delivery_time_days) AS state_pair_avg_delivery,
  stddev_samp(delivery_time_days) AS state_pair_std_delivery FROM t_ntrain WHERE state_pair IS NOT NULL GROUP BY state_pair),
t_roll0 AS (SELECT order_id, seller_id, order_purchase_timestamp,
  CASE WHEN seller_id IS NOT NULL AND count(delivery_time_days) OVER w >= 5 THEN avg(delivery_time_days) OVER w END AS r_avg,
  CASE WHEN seller_id IS NOT NULL AND count(delivery_time_days) OVER w >= 5 THEN stddev_samp(delivery_time_days) OVER w END AS r_std
  FROM t_ntrain WINDOW w AS (PARTITION BY seller_id ORDER BY order_purchase_timestamp, order_id
  ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)),
t_rg AS (SELECT (SELECT avg(delivery_time_days) FROM t_ntrain) AS g_del, quantile_cont(r_std, 0.5) AS r_med FROM t_roll0),
t_rollf AS (SELECT r.order_id, r.seller_id, r.order_purchase_timestamp, coalesce(r.r_avg, g.g_del) AS seller_roll_avg_delivery,
  coalesce(r.r_std, g.r_med) AS seller_roll_std_delivery FROM t_roll0 r CROSS JOIN t_rg g),
t_last AS (SELECT seller_id, arg_max(seller_roll_avg_delivery, (epoch_us(order_purchase_timestamp), order_id)) AS l_avg,
  arg_max(seller_roll_std_delivery, (epoch_us(order_purchase_timestamp), order_id)) AS l_std
  FROM t_rollf WHERE seller_id IS NOT NULL GROUP BY seller_id),
t_nroll AS (SELECT order_id, split, seller_roll_avg_delivery, seller_roll_std_delivery FROM t_rollf JOIN t_nsplit USING (order_id)
  UNION ALL SELECT s.order_id, s.split, coalesce(l.l_avg, g.g_del), coalesce(l.l_std, g.r_med)
  FROM t_nsplit s LEFT JOIN t_last l ON s.seller_id = l.seller_id CROSS JOIN t_rg g WHERE s.split = 'test')"""


@query("w_07", "SELECT order_id, split FROM t_nsplit", NB_CTES)
def w_07(spark, sf_dir):
    """W-07: ordinal 80/20 split (notebook)."""
    return finalize(notebook_frame(spark, sf_dir).select("order_id", "split"))


@query("prj_11", "SELECT order_id, route, state_pair FROM t_nsplit", NB_CTES)
def prj_11(spark, sf_dir):
    return finalize(notebook_frame(spark, sf_dir).select("order_id", "route", "state_pair"))


@query("ag_07", "SELECT seller_id, seller_total_orders FROM t_sc", NB_CTES)
def ag_07(spark, sf_dir):
    train = notebook_frame(spark, sf_dir).where(F.col("split") == "train")
    return finalize(sp.seller_order_counts(train))


@query("ag_08", f"""SELECT s.order_id, {floor_days_sql('s.order_purchase_timestamp', 'c.seller_first_order_date')} AS seller_tenure_days
 FROM t_nsplit s LEFT JOIN t_sc c ON s.seller_id = c.seller_id""", NB_CTES)
def ag_08(spark, sf_dir):
    """AG-08: days since the seller's first train order."""
    return finalize(notebook_frame(spark, sf_dir).select("order_id", "seller_tenure_days"))


@query("ag_09", """SELECT route, round(route_avg_delivery, 6) AS route_avg_delivery,
 round(route_std_delivery, 6) AS route_std_delivery FROM t_route""", NB_CTES)
def ag_09(spark, sf_dir):
    train = notebook_frame(spark, sf_dir).where(F.col("split") == "train")
    return finalize(sp.keyed_delivery_stats(train, "route", "route"))


@query("ag_10", """SELECT state_pair, round(state_pair_avg_delivery, 6) AS state_pair_avg_delivery,
 round(state_pair_std_delivery, 6) AS state_pair_std_delivery FROM t_sp""", NB_CTES)
def ag_10(spark, sf_dir):
    train = notebook_frame(spark, sf_dir).where(F.col("split") == "train")
    return finalize(sp.keyed_delivery_stats(train, "state_pair", "state_pair"))


@query("ag_11", "SELECT order_id, count(*) OVER (PARTITION BY order_id) AS num_items_in_order FROM t_nsplit", NB_CTES)
def ag_11(spark, sf_dir):
    """AG-11: order complexity as the notebook computes it (rows per order after roll-up)."""
    return finalize(notebook_frame(spark, sf_dir).select("order_id", "num_items_in_order"))


@query("w_03", "SELECT order_id, round(r_avg, 6) AS seller_roll_avg_delivery FROM t_roll0", NB_CTES)
def w_03(spark, sf_dir):
    """W-03: rolling mean of the previous 50 train orders of the seller (>= 5)."""
    train = notebook_frame(spark, sf_dir).where(F.col("split") == "train")
    raw = sp.rolling_seller_stats(train.select("order_id", "seller_id", sp.TS, "delivery_time_days"))
    return finalize(raw.select("order_id", "seller_roll_avg_delivery"))


@query("w_04", "SELECT order_id, round(r_std, 6) AS seller_roll_std_delivery FROM t_roll0", NB_CTES)
def w_04(spark, sf_dir):
    train = notebook_frame(spark, sf_dir).where(F.col("split") == "train")
    raw = sp.rolling_seller_stats(train.select("order_id", "seller_id", sp.TS, "delivery_time_days"))
    return finalize(raw.select("order_id", "seller_roll_std_delivery"))


@query("w_05", """SELECT order_id, split, round(seller_roll_avg_delivery, 6) AS seller_roll_avg_delivery,
 round(seller_roll_std_delivery, 6) AS seller_roll_std_delivery FROM t_nroll""", NB_CTES)
def w_05(spark, sf_dir):
    """W-05: rolling features with fallbacks; test rows carry the seller's last train value."""
    return finalize(notebook_frame(spark, sf_dir).select(
        "order_id", "split", "seller_roll_avg_delivery", "seller_roll_std_delivery"))


@query("prj_10", """SELECT order_id, round(ln(1 + delivery_time_days), 6) AS delivery_time_log,
 round(exp(ln(1 + delivery_time_days)) - 1, 6) AS delivery_time_back FROM t_nsplit""", NB_CTES)
def prj_10(spark, sf_dir):
    """PRJ-10: log1p target and its inverse."""
    nb = notebook_frame(spark, sf_dir)
    return finalize(nb.select("order_id", "delivery_time_log",
                              F.expm1("delivery_time_log").alias("delivery_time_back")))
