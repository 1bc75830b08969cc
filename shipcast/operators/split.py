"""Time-based split and train-only statistics (ML-12, W-03..W-08, AG-04..AG-11, JN-08).

One frame carries a ``split`` column instead of three frames. Every statistic is computed
from the train rows only and joined back onto all rows with a fallback; the aggregates
are keyed group-bys (partial aggregation on the map side, so a hot seller or category is
combined per task before the shuffle) and the left joins are left to AQE, which
broadcasts a side only once its runtime size is known and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import timeops as t
from ..functions.grouped import grouped_rolling
from ..functions.ordinal import keys_at
from ..functions.quantile import quantiles
from ..functions.scalars import scalars
from ..session import stored
from .features import CATEGORICAL_FEATURES, NUMERIC_FEATURES

TS = "order_purchase_timestamp"
TIE = "order_id"


def cut_fractions(train_frac: float = 0.70, val_frac: float = 0.15) -> list[float]:
    """Cumulative cut fractions, computed the way the reference does (train + val)."""
    return [train_frac, train_frac + val_frac]


def assign_split(df: DataFrame, fractions: Sequence[float] = (0.70, 0.85),
                 labels: Sequence[str] = ("train", "val", "test")) -> DataFrame:
    """W-06/W-07: label rows by their ordinal position in (timestamp, order_id) order;
    the i-th cut is at rank floor(n * fractions[i]), all cuts from one range exchange."""
    if TS not in df.columns:
        raise ValueError(f"DataFrame must contain '{TS}'")
    key_cols = [F.unix_micros(F.col(TS)), F.col(TIE)]
    cuts = keys_at(df, key_cols, lambda n: [int(n * f) for f in fractions])
    label = None
    for cut, lab in zip(cuts, labels):
        if cut is None:     # the cut lies behind the last row
            cond = F.lit(True)
        else:
            ts_cut, id_cut = cut
            k_ts = F.unix_micros(F.col(TS))
            cond = (k_ts < F.lit(ts_cut)) | ((k_ts == F.lit(ts_cut)) & (F.col(TIE) < F.lit(id_cut)))
        label = F.when(cond, lab) if label is None else label.when(cond, lab)
    label = label.otherwise(labels[len(fractions)])
    return df.withColumn("split", label)


def split_periods(df: DataFrame) -> DataFrame:
    """W-08: size and period of each split."""
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_orders"),
                                   F.min(TS).alias("period_start"), F.max(TS).alias("period_end"))


def global_train_stats(df: DataFrame) -> DataFrame:
    """AG-06: one-row frame with the train means and the exact train median distance (the
    median enters as a scalar subquery)."""
    train = df.where(F.col("split") == "train")
    med = quantiles(train, "distance_km", {"dist_median": 0.5}).select("dist_median").scalar()
    return train.agg(F.avg("processing_days").alias("g_proc"),
                     F.avg("transit_days").alias("g_tran"),
                     F.avg("delivery_time_days").alias("g_del")).select("*", med.alias("dist_median"))


def seller_stats(train: DataFrame) -> DataFrame:
    """AG-04: per-seller mean and sample std of the three durations, one group-by."""
    return (train.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.avg("processing_days").alias("seller_avg_processing"),
        F.stddev_samp("processing_days").alias("seller_std_processing"),
        F.avg("transit_days").alias("seller_avg_transit"),
        F.stddev_samp("transit_days").alias("seller_std_transit"),
        F.avg("delivery_time_days").alias("seller_avg_delivery"),
        F.stddev_samp("delivery_time_days").alias("seller_std_delivery")))


def category_stats(train: DataFrame) -> DataFrame:
    """AG-05: per-category mean processing and transit, one group-by."""
    return (train.where(F.col("product_category_name_english").isNotNull())
            .groupBy("product_category_name_english").agg(
                F.avg("processing_days").alias("cat_avg_processing"),
                F.avg("transit_days").alias("cat_avg_transit")))


# Statistics of up to this many keys are broadcast (a few MB); beyond it the join shuffles.
MAX_BROADCAST_KEYS = 50_000


def join_stats(df: DataFrame, stats: DataFrame, key: str) -> DataFrame:
    """``df`` with the columns of ``stats`` (a row a key). A count tells whether they are few enough to be
    broadcast: AQE would find out only when all rows of ``df`` have been shuffled."""
    stats = stats.checkpoint(eager=True)
    few = stats.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    return df.join(F.broadcast(stats) if few else stats, key, "left")


def with_train_stats(df: DataFrame) -> DataFrame:
    """JN-08 and ML-12: distance filled with the train median, seller and category statistics
    joined with fallbacks, rows with a missing model input dropped. The global values are
    scalar subqueries (one-row aggregates evaluated once, inlined as literals)."""
    train = df.where(F.col("split") == "train")
    g = scalars(global_train_stats(df))
    g_proc, g_tran, g_del, dist_med = (g[c] for c in ("g_proc", "g_tran", "g_del", "dist_median"))
    out = df.withColumn("distance_km", F.coalesce(F.col("distance_km"), dist_med))
    out = join_stats(out, seller_stats(train), "seller_id")
    out = join_stats(out, category_stats(train), "product_category_name_english")
    fills = {
        "seller_avg_processing": g_proc, "seller_std_processing": F.lit(0.0),
        "seller_avg_transit": g_tran, "seller_std_transit": F.lit(0.0),
        "seller_avg_delivery": g_del, "seller_std_delivery": F.lit(0.0),
        "cat_avg_processing": g_proc, "cat_avg_transit": g_tran,
    }
    out = out.withColumns({c: F.coalesce(F.col(c), v) for c, v in fills.items()})
    return out


def drop_incomplete(df: DataFrame, features: Sequence[str] = tuple(NUMERIC_FEATURES + CATEGORICAL_FEATURES)) -> DataFrame:
    """FLT-04: drop rows with any required model input NULL."""
    return df.dropna(subset=list(dict.fromkeys(features)))


def temporal_split(features: DataFrame, train_frac: float = 0.70, val_frac: float = 0.15) -> DataFrame:
    """ML-12 end to end: split, train-only encodings, complete rows only."""
    split = assign_split(features, cut_fractions(train_frac, val_frac))
    return drop_incomplete(with_train_stats(split))


def model_inputs(df: DataFrame, numeric: Sequence[str] = NUMERIC_FEATURES,
                 categorical: Sequence[str] = CATEGORICAL_FEATURES,
                 target: str = "delivery_time_days") -> DataFrame:
    """PRJ-16: the model input columns; duplicate names are dropped (first kept) and every
    requested column must exist."""
    cols = list(dict.fromkeys([*numeric, *categorical, target]))
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing model inputs: {missing}")
    extra = [c for c in ("order_id", "split") if c in df.columns]
    out = df.select(*extra, *cols)
    if len(set(out.columns)) != len(out.columns):
        raise ValueError("duplicate column names in model inputs")
    return out


# --- notebook extensions (80/20 split, extra train-only features) -------------------------
def seller_order_counts(train: DataFrame) -> DataFrame:
    """AG-07."""
    return train.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.count(F.lit(1)).alias("seller_total_orders"))


def seller_first_order(train: DataFrame) -> DataFrame:
    """AG-08 (first half): first train order per seller."""
    return train.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.min(TS).alias("seller_first_order_date"))


def route_key(df: DataFrame) -> Column:
    """PRJ-11: seller zip _ customer zip; NULL when either side is unknown."""
    return F.concat(F.col("seller_zip_code_prefix").cast("string"), F.lit("_"),
                    F.col("customer_zip_code_prefix").cast("string"))


def state_pair_key(df: DataFrame) -> Column:
    return F.concat(F.col("seller_state"), F.lit("_"), F.col("customer_state"))


def keyed_delivery_stats(train: DataFrame, key: str, prefix: str) -> DataFrame:
    """AG-09 / AG-10: mean and sample std of delivery time per key."""
    return train.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.avg("delivery_time_days").alias(f"{prefix}_avg_delivery"),
        F.stddev_samp("delivery_time_days").alias(f"{prefix}_std_delivery"))


ROLL_WINDOW = 50
ROLL_MIN = 5


def rolling_seller_stats(train: DataFrame) -> DataFrame:
    """W-03/W-04: mean and sample std of the previous 50 train orders of the seller (the
    current order excluded), NULL below 5 observations. Computed over range partitions of
    (seller, time, order) so a seller holding a third of all orders is spread over many
    tasks (see ``functions.grouped``)."""
    order = [F.unix_micros(F.col(TS)), F.col(TIE)]
    out = grouped_rolling(train, ["seller_id"], order, "delivery_time_days", ROLL_WINDOW,
                          {"__n": F.count, "__avg": F.avg, "__sd": F.stddev_samp})
    ok = F.col("seller_id").isNotNull() & (F.col("__n") >= ROLL_MIN)  # NULL sellers form no group
    return out.select(*train.columns,
                      F.when(ok, F.col("__avg")).alias("seller_roll_avg_delivery"),
                      F.when(ok, F.col("__sd")).alias("seller_roll_std_delivery"))


def with_order_rows(df: DataFrame) -> DataFrame:
    """AG-11: the rows of each order, counted after the roll-up to orders as the notebook does. Only orders of
    several rows are joined, so that the rows themselves are not shuffled where these are few."""
    several = (df.groupBy(F.col("order_id").alias("__order")).agg(F.count(F.lit(1)).alias("__n"))
               .where("__n > 1").checkpoint(eager=True))
    few = several.limit(MAX_BROADCAST_KEYS + 1).count() <= MAX_BROADCAST_KEYS
    out = df.join(F.broadcast(several) if few else several, F.col("order_id").eqNullSafe(F.col("__order")), "left")
    return out.withColumn("num_items_in_order", F.coalesce("__n", F.lit(1).cast("long"))).drop("__order", "__n")


def notebook_split(features_geo: DataFrame) -> DataFrame:
    """ML-08 inputs: 80/20 split plus the notebook's extra train-only features (AG-07..AG-11,
    W-03..W-05, PRJ-10/11), with the notebook's own fallback policy."""
    df = assign_split(features_geo, [0.8], ("train", "test"))
    df = df.withColumn("route", route_key(df)).withColumn("state_pair", state_pair_key(df))
    df = with_order_rows(df).withColumn("delivery_time_log", F.log1p("delivery_time_days"))      # AG-11, PRJ-10
    # stored, with a number of its own for every row: the train and the test rows are read apart, and rolling
    # statistics find their rows again
    df = stored(df.withColumn("__row", F.monotonically_increasing_id()))
    train = df.where(F.col("split") == "train")
    g = train.agg(F.avg("delivery_time_days").alias("g_del"),
                  F.avg("processing_days").alias("g_proc"),
                  F.avg("transit_days").alias("g_tran"))
    gs = scalars(g)
    g_del, g_proc, g_tran = gs["g_del"], gs["g_proc"], gs["g_tran"]
    # rolling features: train rows from their own past, test rows get the seller's last value; taken
    # on the columns they need, as the rows are dealt by range here
    # stored: the median, the last values and the result all read the rolling frame
    roll = stored(rolling_seller_stats(train.select("__row", "seller_id", TS, TIE, "delivery_time_days"))
                  .drop("delivery_time_days"))
    roll_med = quantiles(roll, "seller_roll_std_delivery", {"m": 0.5}).select("m").scalar()
    roll = roll.withColumns({
        "seller_roll_avg_delivery": F.coalesce("seller_roll_avg_delivery", g_del),
        "seller_roll_std_delivery": F.coalesce("seller_roll_std_delivery", roll_med)})
    last = roll.where(F.col("seller_id").isNotNull()).groupBy("seller_id").agg(
        F.max_by(F.struct("seller_roll_avg_delivery", "seller_roll_std_delivery"),
                 F.struct(F.unix_micros(F.col(TS)), F.col(TIE))).alias("__last"))
    test = df.where(F.col("split") == "test").join(last, "seller_id", "left").select(
        "*", F.coalesce(F.col("__last.seller_roll_avg_delivery"), g_del).alias("seller_roll_avg_delivery"),
        F.coalesce(F.col("__last.seller_roll_std_delivery"), roll_med).alias("seller_roll_std_delivery"),
    ).drop("__last")
    rolled = train.join(roll.select("__row", "seller_roll_avg_delivery", "seller_roll_std_delivery"), "__row")
    # all statistics of a seller meet before the rows do: one join of the rows
    sellers = (seller_stats(train).join(seller_order_counts(train), "seller_id", "left")
               .join(seller_first_order(train), "seller_id", "left"))
    out = join_stats(rolled.unionByName(test).drop("__row"), sellers, "seller_id")
    out = out.withColumns({
        "seller_avg_processing": F.coalesce("seller_avg_processing", g_proc),
        "seller_std_processing": F.coalesce("seller_std_processing", F.lit(0.0)),
        "seller_avg_transit": F.coalesce("seller_avg_transit", g_tran),
        "seller_std_transit": F.coalesce("seller_std_transit", F.lit(0.0)),
        "seller_avg_delivery": F.coalesce("seller_avg_delivery", g_del),
        "seller_std_delivery": F.coalesce("seller_std_delivery", F.lit(0.0)),
    })
    out = out.withColumn("seller_tenure_days", t.floor_days(TS, "seller_first_order_date"))
    out = join_stats(out, category_stats(train), "product_category_name_english").withColumns({
        "cat_avg_processing": F.coalesce("cat_avg_processing", g_proc),
        "cat_avg_transit": F.coalesce("cat_avg_transit", g_tran)})
    out = join_stats(out, keyed_delivery_stats(train, "route", "route"), "route")
    out = join_stats(out, keyed_delivery_stats(train, "state_pair", "state_pair"), "state_pair")
    dist_med = quantiles(train, "distance_km", {"m": 0.5}).select("m").scalar()
    return out.withColumn("distance_km", F.coalesce(F.col("distance_km"), dist_med))


# fixed values of the reference: the notebook's model inputs
NOTEBOOK_NUMERIC = [
    "distance_km", "product_weight_kg", "product_volume_cm3", "price", "freight_value",
    "freight_ratio", "purchase_hour", "seller_avg_delivery", "seller_std_delivery",
    "seller_avg_processing", "seller_std_processing", "seller_avg_transit", "seller_std_transit",
    "cat_avg_processing", "cat_avg_transit", "seller_total_orders", "seller_tenure_days",
    "route_avg_delivery", "route_std_delivery", "seller_roll_avg_delivery",
    "seller_roll_std_delivery", "state_pair_avg_delivery", "state_pair_std_delivery",
    "num_items_in_order",
]
NOTEBOOK_CATEGORICAL = ["purchase_month", "purchase_day_of_week", "is_weekend",
                        "product_category_name_english"]
