"""Exploratory reports: data quality, reviews, orders, lateness, geography, sellers, payments,
correlation and histograms (AG-12..AG-45, W-01, W-09, PRJ-03/04/05/09/15/20, JN-09..17,
SET-01/02).

Every report is a keyed aggregation over the full tables. Per-order pre-aggregates are
built before they are joined (payments, reviews, items), small global values (rates,
medians, min/max) enter as scalar subqueries, and no report collects rows to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions import timeops as t
from ..functions.comoments import pair_correlations
from ..functions.exprs import bucket, bucket_order, clip_between, half_even
from ..functions.ordinal import global_running_sum
from ..functions.quantile import quantiles
from ..functions.scalars import scalars
from ..sources.tables import Market

# fixed values of the reference: bins, labels, thresholds
LATE_EDGES = [0, 1, 3, 7, 15, 100]
LATE_LABELS = ["1 day", "2-3 days", "4-7 days", "8-15 days", "16+ days"]
DELAY_EDGES = [float("-inf"), -7, -3, 0, 7, 14, float("inf")]
DELAY_LABELS = ["<-7d early", "-7 to -3d", "-3 to 0d", "0 to 7d late", "7 to 14d late", ">14d late"]
WEEKDAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
CATEGORY_MIN_ORDERS = 200
STATE_MIN_ORDERS = 50
QUADRANT_MIN = 5
CHURN_IDLE_DAYS = 90
TOP_CATEGORIES = 20
CORR_COLUMNS = ["is_late_int", "review_score", "delay_days", "payment_value",
                "payment_installments", "n_items", "total_freight", "total_price",
                "product_weight_g", "processing_days", "estimated_window", "month"]


# --- per-order pre-aggregates ------------------------------------------------------------
def items_per_order(items: DataFrame) -> DataFrame:
    """AG-12: price, freight and item count per order."""
    return items.groupBy("order_id").agg(F.sum("price").alias("total_price"),
                                         F.sum("freight_value").alias("total_freight"),
                                         F.count("product_id").alias("n_items"))


def payments_per_order(payments: DataFrame) -> DataFrame:
    """AG-13: total paid and maximum installments per order."""
    return payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_value"),
                                            F.max("payment_installments").alias("payment_installments"))


def reviews_per_order(reviews: DataFrame) -> DataFrame:
    """AG-14: mean review score per order."""
    return reviews.groupBy("order_id").agg(F.avg("review_score").alias("review_score"))


# --- data quality ------------------------------------------------------------------------
def missing_report(df: DataFrame, table: str) -> DataFrame:
    """AG-15: NULL count and share (1 dp, half-even) per column, only columns with gaps, worst
    first. One pass computes every count; ``stack`` turns the row into rows."""
    cols = df.columns
    counts = df.agg(F.count(F.lit(1)).alias("__n"),
                    *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(cols)])
    pairs = ", ".join(f"'{c}', m{i}" for i, c in enumerate(cols))
    long = counts.selectExpr("__n", f"stack({len(cols)}, {pairs}) AS (column_name, missing_count)")
    return (long.where(F.col("missing_count") > 0)
            .select(F.lit(table).alias("table_name"), "column_name", "missing_count",
                    half_even(F.col("missing_count") / F.col("__n") * 100, 1).alias("missing_pct")))


def order_id_coverage(m: Market) -> DataFrame:
    """AG-16: distinct order ids in orders and in items, and the difference."""
    a = m.orders.agg(F.count_distinct("order_id").alias("orders_distinct"))
    b = m.items.agg(F.count_distinct("order_id").alias("items_distinct")).select("items_distinct").scalar()
    return a.select("orders_distinct", b.alias("items_distinct"),
                    (F.col("orders_distinct") - b).alias("difference"))


def orders_without_items(m: Market) -> DataFrame:
    """JN-10 / AG-17: status counts of orders that have no item."""
    return (m.orders.join(m.items.select("order_id"), "order_id", "left_anti")
            .groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders")))


def items_without_orders(m: Market) -> DataFrame:
    """JN-10 / AG-18: distinct-row counts of items whose order is unknown."""
    orphans = m.items.join(m.orders.select("order_id"), "order_id", "left_anti")
    return orphans.groupBy(*m.items.columns).agg(F.count(F.lit(1)).alias("n_rows"))


# --- reviews -----------------------------------------------------------------------------
def score_distribution(reviews: DataFrame) -> DataFrame:
    """AG-19: review score counts and shares, for all reviews and for commented ones."""
    def dist(df: DataFrame, subset: str) -> DataFrame:
        total = df.agg(F.count(F.lit(1))).scalar()
        return df.groupBy("review_score").agg(F.count(F.lit(1)).alias("n_reviews")).select(
            F.lit(subset).alias("subset"), "review_score", "n_reviews",
            half_even(F.col("n_reviews") / total * 100, 1).alias("pct"))
    commented = reviews.where(F.col("review_comment_message").isNotNull())
    return dist(reviews, "all").unionByName(dist(commented, "commented"))


def presence(reviews: DataFrame) -> DataFrame:
    """AG-20: title and comment presence counts and shares."""
    n = F.count(F.lit(1))
    out = reviews.agg(n.alias("n_reviews"), F.count("review_comment_title").alias("has_title"),
                      F.count("review_comment_message").alias("has_comment"))
    return out.select(
        "n_reviews", "has_title", (F.col("n_reviews") - F.col("has_title")).alias("no_title"),
        (F.col("has_title") / F.col("n_reviews") * 100).alias("title_pct"),
        "has_comment", (F.col("n_reviews") - F.col("has_comment")).alias("no_comment"),
        (F.col("has_comment") / F.col("n_reviews") * 100).alias("comment_pct"))


def reviews_with_orders(m: Market) -> DataFrame:
    """JN-09 + PRJ-04/05: reviews (without their texts) with their order's timestamps, floored delay,
    status and days to review."""
    o = m.orders.select("order_id", "order_purchase_timestamp", "order_delivered_customer_date",
                        "order_estimated_delivery_date", "customer_id")
    r = m.review_scores.join(o, "order_id", "left")
    delay = t.floor_days("order_delivered_customer_date", "order_estimated_delivery_date")
    status = (F.when(F.col("order_delivered_customer_date").isNull(), "Not Delivered")
              .when(delay > 0, "Late").otherwise("On Time"))
    return r.select("*", delay.alias("delivery_delay_days"), status.alias("delivery_status"),
                    t.floor_days("review_answer_timestamp", "order_purchase_timestamp")
                    .alias("days_to_review"))


def delivery_status_scores(rwo: DataFrame) -> DataFrame:
    """AG-21: review count and mean score per delivery status."""
    return rwo.groupBy("delivery_status").agg(F.count(F.lit(1)).alias("n_reviews"),
                                              F.avg("review_score").alias("avg_score"))


def _label_frame(df: DataFrame, labels: Sequence[str], name: str) -> DataFrame:
    """The bin labels as a tiny frame (ordered), used to keep empty bins."""
    arr = F.array(*[F.struct(F.lit(i).alias("bucket_order"), F.lit(lab).alias(name))
                    for i, lab in enumerate(labels)])
    return df.sparkSession.range(1).select(F.inline(arr))


def late_bucket_scores(rwo: DataFrame) -> DataFrame:
    """AG-22: mean score of late reviews by delay bucket (1,3,7,15,100], every label kept."""
    late = rwo.where(F.col("delivery_status") == "Late")
    b = late.select(bucket("delivery_delay_days", LATE_EDGES, LATE_LABELS).alias("delay_bucket"),
                    "review_score")
    agg = b.where(F.col("delay_bucket").isNotNull()).groupBy("delay_bucket").agg(
        F.avg("review_score").alias("avg_score"), F.count("review_score").alias("n_reviews"))
    labels = _label_frame(rwo, LATE_LABELS, "delay_bucket")
    return labels.join(agg, "delay_bucket", "left").select(
        "bucket_order", "delay_bucket", "avg_score",
        F.coalesce("n_reviews", F.lit(0)).alias("n_reviews"))


# --- orders ------------------------------------------------------------------------------
def status_counts(orders: DataFrame) -> DataFrame:
    """AG-23: order status counts and percent."""
    total = orders.agg(F.count(F.lit(1))).scalar()
    return orders.groupBy("order_status").agg(F.count(F.lit(1)).alias("n_orders")).select(
        "order_status", "n_orders", (F.col("n_orders") / total * 100).alias("pct"))


def monthly_volume(orders: DataFrame) -> DataFrame:
    """AG-24: orders per purchase month, with the total and the date range."""
    ts = F.col("order_purchase_timestamp")
    g = scalars(orders.agg(F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi")))
    return orders.groupBy(t.year_month(ts).alias("year_month")).agg(
        F.count(F.lit(1)).alias("n_orders")).select(
        "year_month", "n_orders", g["n"].alias("total_orders"),
        F.to_date(g["lo"]).alias("first_date"), F.to_date(g["hi"]).alias("last_date"))


def month_status_pivot(orders: DataFrame, statuses: Sequence[str] | None = None) -> DataFrame:
    """AG-25: month x status counts, zero-filled. Without ``statuses`` Spark finds the
    (bounded) set of status values itself."""
    g = orders.groupBy(t.year_month("order_purchase_timestamp").alias("year_month"))
    p = g.pivot("order_status", list(statuses) if statuses else None).count()
    return p.fillna(0)


def month_status_share(pivot: DataFrame) -> DataFrame:
    """AG-26: row percent of the month x status pivot."""
    cols = [c for c in pivot.columns if c != "year_month"]
    total = sum((F.col(c) for c in cols), F.lit(0))
    return pivot.select("year_month", *[(F.col(c) / total * 100).alias(c) for c in cols])


# --- lateness ------------------------------------------------------------------------------
def delivered_status_orders(orders: DataFrame) -> DataFrame:
    """FLT-03 + PRJ-03: status 'delivered', floored delay, is_late (NULL delay is not late)."""
    d = orders.where(F.col("order_status") == "delivered")
    delay = t.floor_days("order_delivered_customer_date", "order_estimated_delivery_date")
    return d.select("*", delay.alias("delay_days"),
                    F.coalesce(delay > 0, F.lit(False)).alias("is_late"))


def describe(df: DataFrame, col: str, keys: Sequence[str] = ()) -> DataFrame:
    """count, mean, sample std, min, exact quartiles, max (pandas ``describe``)."""
    keys = list(keys)
    base = df.groupBy(*keys).agg(F.count(col).alias("count"), F.avg(col).alias("mean"),
                                 F.stddev_samp(col).alias("std"), F.min(col).alias("min"),
                                 F.max(col).alias("max"))
    q = quantiles(df, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75}, keys)
    if keys:
        return base.join(q, keys, "left")
    qs = scalars(q)
    return base.select("*", *[qs[c].alias(c) for c in ("p25", "p50", "p75")])


def late_summary(delivered: DataFrame) -> DataFrame:
    """AG-27: late rate (percent) and count, and the describe of delay days."""
    rate = delivered.agg((F.avg(F.col("is_late").cast("int")) * 100).alias("late_rate_pct"),
                         F.count_if("is_late").alias("n_late"),
                         F.count(F.lit(1)).alias("n_delivered"))
    d = scalars(describe(delivered, "delay_days"))
    return rate.select("*", *[d[c].alias(f"delay_{c}")
                             for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")])


def delivered_with_reviews(m: Market) -> DataFrame:
    """JN-11: delivered orders with their mean review score."""
    return delivered_status_orders(m.orders).join(reviews_per_order(m.review_scores), "order_id", "left")


def score_by_lateness(df_rev: DataFrame) -> DataFrame:
    """AG-28: mean, median and count of review score, on time vs late."""
    base = df_rev.groupBy("is_late").agg(F.avg("review_score").alias("mean"),
                                         F.count("review_score").alias("count"))
    med = quantiles(df_rev, "review_score", {"median": 0.5}, ["is_late"])
    return base.join(med, "is_late", "left")


def score_shares_by_lateness(df_rev: DataFrame) -> DataFrame:
    """AG-29: share of each (mean) review score within on-time and late orders."""
    scored = df_rev.where(F.col("review_score").isNotNull())
    n = scored.groupBy("is_late").agg(F.count(F.lit(1)).alias("__n"))
    c = scored.groupBy("is_late", "review_score").agg(F.count(F.lit(1)).alias("n_orders"))
    return c.join(n, "is_late").select("is_late", "review_score", "n_orders",
                                       (F.col("n_orders") / F.col("__n")).alias("share"))


def per_flag(groups: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A grouped side for a join on ``keys``: broadcast when all keys are booleans, which bounds
    it to three rows per key, so the big side is not shuffled onto a few keys."""
    flags = all(groups.schema[k].dataType == T.BooleanType() for k in keys)
    return F.broadcast(groups) if flags else groups


def box_stats(df: DataFrame, col: str, keys: Sequence[str]) -> DataFrame:
    """AG-29: quartiles and 1.5 IQR whiskers (most extreme values inside the fences)."""
    keys = list(keys)
    q = quantiles(df, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, keys)
    q = q.withColumn("iqr", F.col("q3") - F.col("q1"))
    j = df.select(*keys, col).where(F.col(col).isNotNull()).join(per_flag(q, keys), keys)
    lo_f = F.col("q1") - 1.5 * F.col("iqr")
    hi_f = F.col("q3") + 1.5 * F.col("iqr")
    w = j.groupBy(*keys).agg(F.min(F.when(F.col(col) >= lo_f, F.col(col))).alias("whisker_low"),
                             F.max(F.when(F.col(col) <= hi_f, F.col(col))).alias("whisker_high"),
                             F.count_if((F.col(col) < lo_f) | (F.col(col) > hi_f)).alias("n_outliers"))
    return q.join(w, keys, "left")


def delay_bucket_scores(df_rev: DataFrame) -> DataFrame:
    """AG-30: mean score by delay bucket, observed buckets only."""
    b = df_rev.select(bucket("delay_days", DELAY_EDGES, DELAY_LABELS).alias("delay_bucket"),
                      bucket_order("delay_days", DELAY_EDGES).alias("bucket_order"), "review_score")
    return (b.where(F.col("delay_bucket").isNotNull()).groupBy("bucket_order", "delay_bucket")
            .agg(F.avg("review_score").alias("avg_score")))


def order_first_category(m: Market) -> DataFrame:
    """PRJ-15 + W-02: per order the first non-NULL category (English name, native name if
    untranslated) and the first non-NULL product weight, in item order."""
    # a category list is bounded
    prods = m.products.join(F.broadcast(m.translation), "product_category_name", "left").select(
        "product_id", F.coalesce("product_category_name_english", "product_category_name")
        .alias("category"), "product_weight_g")
    ip = m.by_order(m.lines.join(prods, "product_id", "left").select(
        "order_id", "order_item_id", "category", "product_weight_g"))

    def first(c: str) -> Column:
        return F.min_by(F.when(F.col(c).isNotNull(), F.col(c)),
                        F.when(F.col(c).isNotNull(), F.col("order_item_id")))
    return ip.groupBy("order_id").agg(first("category").alias("category"),
                                      first("product_weight_g").alias("product_weight_g"))


def late_rate_by(df: DataFrame, key: str, min_orders: int) -> DataFrame:
    """AG-31/32/33: order count and late rate per key, keys with at least ``min_orders``."""
    return (df.where(F.col(key).isNotNull()).groupBy(key)
            .agg(F.count("order_id").alias("order_count"),
                 F.avg(F.col("is_late").cast("double")).alias("late_rate"))
            .where(F.col("order_count") >= min_orders))


def worst_categories(m: Market, min_orders: int = CATEGORY_MIN_ORDERS, top: int = TOP_CATEGORIES) -> DataFrame:
    """JN-12 + AG-31: the ``top`` categories with the highest late rate among those with at
    least ``min_orders`` delivered orders (a top-k report)."""
    df_cat = delivered_status_orders(m.orders).join(order_first_category(m), "order_id", "left")
    stats = late_rate_by(df_cat, "category", min_orders)
    return stats.orderBy(F.desc("late_rate"), F.desc("category")).limit(top)


def first_item_seller(items: DataFrame) -> DataFrame:
    """W-01 / SET-02: the first item row of every order (by item order), as a ``min_by``
    aggregate: partial aggregation on the map side, so a huge order is combined per task
    instead of being sorted in one."""
    return items.groupBy("order_id").agg(F.min_by("seller_id", "order_item_id").alias("seller_id"))


def delivered_with_states(m: Market) -> DataFrame:
    """JN-13: delivered orders with the first item's seller, seller state, customer state."""
    d = m.by_order(delivered_status_orders(m.orders)).join(first_item_seller(m.lines), "order_id", "left")
    d = d.join(m.sellers.select("seller_id", "seller_state"), "seller_id", "left")
    return d.join(m.customers.select("customer_id", "customer_state"), "customer_id", "left")


def customer_state_lateness(m: Market, min_orders: int = STATE_MIN_ORDERS) -> DataFrame:
    """AG-33: late rate per customer state and whether it is above the overall rate."""
    d = delivered_with_states(m)
    overall = d.agg(F.avg(F.col("is_late").cast("double"))).scalar()
    return late_rate_by(d, "customer_state", min_orders).withColumn(
        "above_average", F.col("late_rate") > overall)


def delivered_features(m: Market) -> DataFrame:
    """JN-16 + PRJ-09: delivered orders with item totals, first-item weight, floored
    processing days and the promised window."""
    d = delivered_status_orders(m.orders).join(items_per_order(m.items), "order_id", "left")
    d = d.join(order_first_category(m).select("order_id", "product_weight_g"), "order_id", "left")
    return d.select("*",
                    t.floor_days("order_delivered_carrier_date", "order_approved_at").alias("processing_days"),
                    t.floor_days("order_estimated_delivery_date", "order_purchase_timestamp")
                    .alias("estimated_window"))


def means_by_lateness(df_feat: DataFrame) -> DataFrame:
    """AG-34."""
    return df_feat.groupBy("is_late").agg(
        *[F.avg(c).alias(c) for c in ("total_freight", "product_weight_g", "processing_days",
                                      "estimated_window")])


def clip_to_own_percentiles(df: DataFrame, col: str, keys: Sequence[str], lo: float = 0.01,
                            hi: float = 0.99) -> DataFrame:
    """PRJ-20: clip each value to its group's exact 1st / 99th percentile (NULLs dropped)."""
    keys = list(keys)
    # checkpointed: every pass of the quantiles and the result would run the joins of ``df`` again
    v = df.select(*keys, "order_id", col).where(F.col(col).isNotNull()).checkpoint(eager=True)
    q = quantiles(v, col, {"__lo": lo, "__hi": hi}, keys)
    v = v.join(per_flag(q, keys), keys)
    return v.select(*keys, "order_id",
                    clip_between(col, F.col("__lo"), F.col("__hi")).alias(col))


def seasonality(delivered: DataFrame) -> DataFrame:
    """AG-35: late rate (percent) by month, by weekday (named) and by hour, in one pass with
    grouping sets."""
    ts = F.col("order_purchase_timestamp")
    d = delivered.select(t.month(ts).alias("month"), t.weekday(ts).alias("dow"),
                         t.hour(ts).alias("hour"), F.col("is_late").cast("double").alias("late"))
    g = d.groupingSets([["month"], ["dow"], ["hour"]], "month", "dow", "hour").agg(
        (F.avg("late") * 100).alias("late_rate_pct"), F.grouping_id().alias("__gid"))
    names = F.array(*[F.lit(n) for n in WEEKDAY_NAMES])
    dim = F.when(F.col("month").isNotNull(), "month").when(F.col("dow").isNotNull(), "weekday") \
        .otherwise("hour")
    key = F.coalesce("month", "dow", "hour")
    label = F.when(F.col("dow").isNotNull(), F.element_at(names, F.col("dow") + 1)) \
        .otherwise(key.cast("string"))
    return g.select(dim.alias("dimension"), key.alias("key"), label.alias("label"), "late_rate_pct")


# --- sellers -------------------------------------------------------------------------------
def seller_table(m: Market) -> DataFrame:
    """AG-36/37/38 + JN-15: seller orders, revenue, price, first/last order, review mean and
    count (item grain), late rate and delivered count, tenure."""
    # a row per order and seller, so that orders are counted instead of kept in a distinct set; the lines
    # are dealt by order before anything is grouped, no task groups what a file happens to hold
    pairs = m.lines.groupBy("order_id", "seller_id").agg(
        F.sum("price").alias("__price"), F.count("price").alias("__prices"), F.count(F.lit(1)).alias("__items"))
    orders = m.by_order(m.orders.select("order_id", "order_purchase_timestamp")).groupBy("order_id").agg(
        F.count(F.lit(1)).alias("__orders"), F.min("order_purchase_timestamp").alias("__first"),
        F.max("order_purchase_timestamp").alias("__last"))
    scores = reviews_per_order(m.by_order(m.review_scores.select("order_id", "review_score")))
    p = pairs.join(orders, "order_id", "left").join(scores, "order_id", "left")
    # an item counts once for every row of its order; a review score once for every item
    known, scored = F.col("__orders").isNotNull(), F.col("review_score").isNotNull() & F.col("seller_id").isNotNull()
    stats = p.groupBy("seller_id").agg(
        F.count_if(known).alias("total_orders"), F.sum(F.col("__price") * F.col("__orders")).alias("total_revenue"),
        F.sum(F.col("__prices") * F.col("__orders")).alias("__prices"),
        F.min("__first").alias("first_order"), F.max("__last").alias("last_order"),
        F.sum(F.when(scored, F.col("review_score") * F.col("__items"))).alias("__score"),
        F.sum(F.when(scored, F.col("__items"))).alias("__scores")).where(F.col("total_orders") > 0)
    stats = stats.select(
        "seller_id", "total_orders", "total_revenue",
        F.when(F.col("__prices") > 0, F.col("total_revenue") / F.col("__prices")).alias("avg_order_value"),
        "first_order", "last_order", (F.col("__score") / F.col("__scores")).alias("avg_review_score"),
        F.when(F.col("seller_id").isNotNull(), F.coalesce("__scores", F.lit(0))).alias("review_count"))
    late = (delivered_with_states(m).where(F.col("seller_id").isNotNull()).groupBy("seller_id")
            .agg(F.avg(F.col("is_late").cast("double")).alias("late_rate"),
                 F.count("order_id").alias("delivered_count")))
    out = stats.join(late, "seller_id", "left")
    return out.withColumn("tenure_days", t.floor_days("last_order", "first_order"))


SELLER_DESCRIBE = ["total_orders", "total_revenue", "avg_review_score", "late_rate", "tenure_days"]


def describe_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """AG-39: describe of several columns as long rows (one row per column)."""
    parts = ", ".join(f"'{c}', CAST(`{c}` AS DOUBLE)" for c in cols)
    long = df.selectExpr(f"stack({len(cols)}, {parts}) AS (column_name, value)")
    return describe(long, "value", ["column_name"])


def revenue_pareto(sellers: DataFrame) -> DataFrame:
    """W-09: cumulative revenue share by seller rank (revenue descending, seller id), and the
    seller share. The running sum is computed over range partitions, not one partition."""
    # revenue is a sum of cent amounts: ranked on its exact cent value, so sums that differ
    # only in summation order (last-bit noise) tie and the seller id decides
    cents = half_even("total_revenue", 2).alias("__cents")
    ranked = global_running_sum(sellers.select("seller_id", "total_revenue", cents),
                                [F.desc("__cents"), F.asc("seller_id")], "total_revenue")
    g = scalars(sellers.agg(F.sum("total_revenue").alias("total"), F.count(F.lit(1)).alias("n")))
    total, n = g["total"], g["n"]
    return ranked.select("seller_id", "total_revenue", F.col("__rank").alias("seller_rank"),
                         (F.col("__cum") / total * 100).alias("cum_revenue_pct"),
                         (F.col("__rank") / n * 100).alias("seller_pct"))


def top_share(pareto: DataFrame, frac: float = 0.2) -> DataFrame:
    """W-09: share of revenue of the top ``frac`` of sellers (rank <= floor(n * frac))."""
    n = pareto.agg(F.count(F.lit(1)).alias("n"))
    cut = F.floor(n.select("n").scalar() * F.lit(frac))
    return pareto.where(F.col("seller_rank") <= cut).agg(
        F.max("cum_revenue_pct").alias("top_share_pct"))


def seller_quadrants(sellers: DataFrame, min_n: int = QUADRANT_MIN) -> DataFrame:
    """AG-40: sellers with enough reviews and deliveries placed against the medians of late
    rate and review score (above the median is high)."""
    sel = sellers.where((F.col("review_count") >= min_n) & (F.col("delivered_count") >= min_n))
    med = quantiles(sel, "late_rate", {"m": 0.5}).select("m").scalar()
    mes = quantiles(sel, "avg_review_score", {"m": 0.5}).select("m").scalar()
    high_late = F.col("late_rate") > med
    high_score = F.col("avg_review_score") > mes
    quad = (F.when(~high_late & high_score, "Stars").when(~high_late & ~high_score, "At Risk")
            .when(high_late & high_score, "Fulfillment Problem").otherwise("Churn Risk"))
    return sel.select("seller_id", "late_rate", "avg_review_score", quad.alias("quadrant"),
                      med.alias("median_late_rate"), mes.alias("median_score"))


def seller_churn(sellers: DataFrame, idle_days: int = CHURN_IDLE_DAYS) -> DataFrame:
    """AG-41: a seller is likely churned when idle for more than ``idle_days`` before the
    last order overall."""
    last = sellers.agg(F.max("last_order")).scalar()
    return sellers.select("*", t.floor_days(last, "last_order").alias("days_since_last_order")) \
        .withColumn("likely_churned", F.col("days_since_last_order") > idle_days)


def churn_summary(churn: DataFrame) -> DataFrame:
    return churn.groupBy("likely_churned").agg(
        F.count(F.lit(1)).alias("n_sellers"), F.avg("avg_review_score").alias("avg_review_score"),
        F.avg("late_rate").alias("late_rate"))


# --- payments, correlation, histograms --------------------------------------------------------
def payment_types(payments: DataFrame) -> DataFrame:
    """AG-42."""
    return payments.groupBy("payment_type").agg(F.sum("payment_value").alias("sum"),
                                                F.avg("payment_value").alias("mean"),
                                                F.count("payment_value").alias("count"))


def correlation_frame(m: Market) -> DataFrame:
    """JN-17: delivered orders with payments, items, first category, reviews; every
    dimension is pre-aggregated to one row per order before the joins on order_id."""
    d = delivered_status_orders(m.orders)
    d = (d.join(payments_per_order(m.payments), "order_id", "left")
          .join(items_per_order(m.items), "order_id", "left")
          .join(order_first_category(m), "order_id", "left")
          .join(reviews_per_order(m.review_scores), "order_id", "left"))
    return d.select(
        "order_id", F.col("is_late").cast("int").alias("is_late_int"), "review_score", "delay_days",
        "payment_value", "payment_installments", "n_items", "total_freight", "total_price",
        "product_weight_g",
        t.floor_days("order_delivered_carrier_date", "order_approved_at").alias("processing_days"),
        t.floor_days("order_estimated_delivery_date", "order_purchase_timestamp").alias("estimated_window"),
        t.month("order_purchase_timestamp").alias("month"))


def correlation_matrix(df: DataFrame, cols: Sequence[str] = CORR_COLUMNS) -> DataFrame:
    """AG-43: pairwise-complete Pearson correlation of every pair from masked co-moments: a row
    is read once, and one row per pair and task is shuffled. Both orders of each pair and the
    unit diagonal are then emitted; a pair that no row holds is null."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    every = df.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("pair"))
    per_pair = every.join(pair_correlations(df, cols), "pair", "left")
    first = F.array(*[F.lit(a) for a, _ in pairs])[F.col("pair")]
    second = F.array(*[F.lit(b) for _, b in pairs])[F.col("pair")]
    both = per_pair.select(F.inline(F.array(
        F.struct(first.alias("col_a"), second.alias("col_b"), F.col("corr").alias("corr")),
        F.struct(second.alias("col_a"), first.alias("col_b"), F.col("corr").alias("corr")))))
    diag = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols],
                                           "col_a string, col_b string, corr double")
    return both.unionByName(diag)


def histogram(df: DataFrame, col: str, bins: int, keys: Sequence[str] = (),
              lo_clip: float | None = None, hi_clip: float | None = None,
              density: bool = False) -> DataFrame:
    """AG-44: equal-width histogram over [min, max] of the (optionally clipped) values, the
    right edge in the last bin, all bins reported (zeros included), optionally per group
    and as a density."""
    keys = list(keys)
    x = F.col(col).cast("double")
    if lo_clip is not None or hi_clip is not None:
        x = F.when(x.isNotNull(), F.greatest(F.least(x, F.lit(hi_clip)), F.lit(lo_clip)))
    v = df.select(*keys, x.alias("__x")).where(F.col("__x").isNotNull())
    stats = [F.min("__x").alias("__mn"), F.max("__x").alias("__mx"), F.count(F.lit(1)).alias("__n")]
    if keys:
        rng = v.groupBy(*keys).agg(*stats)
    else:  # one global range: min / max / n enter as scalar subqueries
        one = scalars(v.agg(*stats))
        rng = df.sparkSession.range(1).select(*[one[c].alias(c) for c in ("__mn", "__mx", "__n")])
    same = F.col("__mx") == F.col("__mn")
    rng = rng.select(*keys, "__n", F.when(same, F.col("__mn") - 0.5).otherwise(F.col("__mn")).alias("__lo"),
                     F.when(same, F.col("__mx") + 0.5).otherwise(F.col("__mx")).alias("__hi"))
    if keys:
        j = v.join(per_flag(rng, keys), keys)
    else:
        r1 = scalars(rng.select("__lo", "__hi"))
        j = v.select("__x", r1["__lo"].alias("__lo"), r1["__hi"].alias("__hi"))
    idx = F.least(F.floor((F.col("__x") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * bins),
                  F.lit(bins - 1))
    counts = j.groupBy(*keys, idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    grid = rng.select(*keys, "__n", "__lo", "__hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*keys, "bin"], "left")
    width = (F.col("__hi") - F.col("__lo")) / bins
    cnt = F.coalesce(F.col("count"), F.lit(0))
    cols = [*keys, "bin", (F.col("__lo") + F.col("bin") * width).alias("bin_low"),
            (F.col("__lo") + (F.col("bin") + 1) * width).alias("bin_high"), cnt.alias("count")]
    if density:
        cols.append((cnt / (F.col("__n") * width)).alias("density"))
    return out.select(*cols)


def readiness_summary(m: Market) -> DataFrame:
    """AG-45: late-delivery and churn problem summary in one row."""
    d = delivered_status_orders(m.orders)
    df_rev = d.join(reviews_per_order(m.review_scores), "order_id", "left")
    sellers = seller_churn(seller_table(m))
    a = d.agg((F.avg(F.col("is_late").cast("double")) * 100).alias("late_rate_pct"),
              F.count(F.lit(1)).alias("n_delivered"))
    sc = scalars(df_rev.agg(F.avg(F.when(F.col("is_late"), F.col("review_score"))).alias("late"),
                            F.avg(F.when(~F.col("is_late"), F.col("review_score"))).alias("ontime")))
    late_score, ontime_score = sc["late"], sc["ontime"]
    ch = scalars(sellers.agg((F.avg(F.col("likely_churned").cast("double")) * 100).alias("churn"),
                             F.count(F.lit(1)).alias("n")))
    churn, n_sellers = ch["churn"], ch["n"]
    return a.select("*", late_score.alias("late_avg_score"), ontime_score.alias("ontime_avg_score"),
                    churn.alias("churn_rate_pct"), n_sellers.alias("n_sellers"))
