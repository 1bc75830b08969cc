"""Driver tables (declared schemas) and the nine marketplace role tables derived from them.

The role tables follow the deterministic derivation in FIXTURES.md section 3. They are
written with the DataFrame API so that every join is an equi-join: the two bounded
"key expansions" (20 seller slots per supplier, 4 x 3 geolocation points per nation) are
``explode(sequence(..))`` followed by a semi-join on the keys that really occur in
``part``, never a cross join.
"""

from __future__ import annotations

import math
import os
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.scalars import scalars


_L, _I, _D, _S, _TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _schema(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Declared schemas of the driver tables: never inferred.
DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": _schema(("r_regionkey", _I), ("r_name", _S)),
    "nation": _schema(("n_nationkey", _I), ("n_name", _S), ("n_regionkey", _I)),
    "customer": _schema(("c_custkey", _L), ("c_name", _S), ("c_nationkey", _I),
                        ("c_acctbal", _D), ("c_mktsegment", _S)),
    "supplier": _schema(("s_suppkey", _L), ("s_name", _S), ("s_nationkey", _I), ("s_acctbal", _D)),
    "part": _schema(("p_partkey", _L), ("p_name", _S), ("p_brand", _S), ("p_type", _S),
                    ("p_size", _I), ("p_retailprice", _D)),
    "orders": _schema(("o_orderkey", _L), ("o_custkey", _L), ("o_orderstatus", _S),
                      ("o_totalprice", _D), ("o_orderdate", _TS), ("o_orderpriority", _S)),
    "lineitem": _schema(("l_orderkey", _L), ("l_partkey", _L), ("l_suppkey", _L),
                        ("l_linenumber", _I), ("l_quantity", _D), ("l_extendedprice", _D),
                        ("l_discount", _D), ("l_tax", _D), ("l_returnflag", _S),
                        ("l_linestatus", _S), ("l_shipdate", _TS)),
    "documents": _schema(("doc_id", _L), ("text", _S), ("lang", _S), ("source", _S),
                         ("n_chars", _L)),
}

ROLE_TABLES = ("orders", "items", "products", "translation", "sellers", "customers", "geo",
               "payments", "reviews")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path of any file system that Spark reads exists."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """SRC-01: read one driver table with its declared schema; a missing file is an error
    that names the file."""
    path = table_path(sf_dir, name)
    if not path_exists(spark, path):
        raise FileNotFoundError(f"Missing dataset: {path}")
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(path)


def _ts(c: Column) -> Column:
    """timestamp_ntz as loaded -> session-zone timestamp (UTC), SRC-02."""
    return c.cast("timestamp")


def _plus_seconds(day: Column, seconds: Column) -> Column:
    return F.timestamp_seconds(F.unix_seconds(_ts(day)) + seconds)


def orders_role(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    purchase_s = (k * 7919) % 86400
    carrier_s = purchase_s + (k * 31 % 4000) * 180
    return orders.select(
        k.alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(k % 20 == 0, "canceled").when(k % 20 == 1, "shipped").otherwise("delivered")
        .alias("order_status"),
        _plus_seconds(F.col("o_orderdate"), purchase_s).alias("order_purchase_timestamp"),
        F.when(k % 50 == 7, F.lit(None).cast("timestamp"))
        .otherwise(_plus_seconds(F.col("o_orderdate"), purchase_s + (k % 97) * 600))
        .alias("order_approved_at"),
        F.when(k % 20 == 0, F.lit(None).cast("timestamp"))
        .otherwise(_plus_seconds(F.col("o_orderdate"), carrier_s))
        .alias("order_delivered_carrier_date"),
        F.when((k % 20).isin(0, 1, 2), F.lit(None).cast("timestamp"))
        .otherwise(_plus_seconds(F.col("o_orderdate"), carrier_s + (k * k % 2500) * 900))
        .alias("order_delivered_customer_date"),
        _plus_seconds(F.col("o_orderdate"), (8 + k % 23) * 86400)
        .alias("order_estimated_delivery_date"),
    )


def items_role(lineitem: DataFrame) -> DataFrame:
    # order_item_id needs a full tie-break: (l_orderkey, l_linenumber) is not a key. Lines are
    # numbered inside their order after one hash exchange on the order key, which a join on
    # order_id can reuse; a query that does not read the number pays nothing.
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_quantity", "l_extendedprice"]
    numbered = lineitem.select("l_orderkey", *order, "l_tax").withColumn(
        "order_item_id", F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*order)))
    return numbered.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("order_item_id").cast("int").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        (F.col("l_suppkey") * 100 + F.col("l_partkey") % 20).alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        F.round(F.col("l_quantity") * (1 + F.col("l_tax")), 2).alias("freight_value"),
        _ts(F.col("l_shipdate")).alias("shipping_limit_date"),
    )


def products_role(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    return part.select(
        k.alias("product_id"),
        F.when(k % 50 == 0, F.lit(None).cast("string")).otherwise(F.col("p_type"))
        .alias("product_category_name"),
        F.when(k % 40 == 0, F.lit(None).cast("double"))
        .otherwise((F.col("p_size") * 100).cast("double")).alias("product_weight_g"),
        F.when(k % 45 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("p_size").cast("double")).alias("product_length_cm"),
        (k % 30 + 1).cast("double").alias("product_height_cm"),
        (k % 17 + 1).cast("double").alias("product_width_cm"),
    )


def translation_role(part: DataFrame) -> DataFrame:
    return (part.where(F.col("p_type") != "PROMO")
            .select(F.col("p_type").alias("product_category_name"),
                    F.lower("p_type").alias("product_category_name_english"))
            .distinct())


def _present_keys(part: DataFrame, modulus: int) -> DataFrame:
    return part.select((F.col("p_partkey") % modulus).alias("k")).distinct()


def sellers_role(supplier: DataFrame, nation: DataFrame, part: DataFrame) -> DataFrame:
    # 20 seller slots per supplier: a bounded expansion, then keep only slots that occur.
    base = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    expanded = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k"))
    # at most 20 rows (a key modulo 20): broadcast by construction
    expanded = expanded.join(F.broadcast(_present_keys(part, 20)), "k", "left_semi")
    return expanded.select(
        (F.col("s_suppkey") * 100 + F.col("k")).alias("seller_id"),
        (F.col("s_nationkey") * 4 + F.col("s_suppkey") % 4).alias("seller_zip_code_prefix"),
        F.col("n_name").alias("seller_state"),
    )


def customers_role(customer: DataFrame, nation: DataFrame) -> DataFrame:
    return customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_custkey").alias("customer_id"),
        (F.col("c_nationkey") * 4 + F.col("c_custkey") % 4).alias("customer_zip_code_prefix"),
        F.col("n_name").alias("customer_state"),
    )


def geo_role(nation: DataFrame, part: DataFrame) -> DataFrame:
    g = nation.where(F.col("n_nationkey") % 9 != 8).select(
        "n_nationkey", F.explode(F.sequence(F.lit(0), F.lit(3))).alias("k"))
    g = g.join(F.broadcast(_present_keys(part, 4)), "k", "left_semi")
    g = g.select("n_nationkey", "k", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("j"))
    js = _present_keys(part, 3).withColumnRenamed("k", "j")
    g = g.join(F.broadcast(js), "j", "left_semi")
    return g.select(
        (F.col("n_nationkey") * 4 + F.col("k")).alias("geolocation_zip_code_prefix"),
        ((F.col("n_nationkey") * 2 - 30 + F.col("k")).cast("double") + F.col("j") * 0.01)
        .alias("geolocation_lat"),
        ((F.col("n_nationkey") * 3 - 70 - F.col("k")).cast("double") - F.col("j") * 0.02)
        .alias("geolocation_lng"),
    )


def payments_role(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    first = orders.where(k % 100 != 99).select(
        k.alias("order_id"), F.lit(1).alias("payment_sequential"),
        F.col("o_orderpriority").alias("payment_type"),
        (k % 10 + 1).cast("int").alias("payment_installments"),
        F.col("o_totalprice").alias("payment_value"))
    voucher = orders.where(k % 13 == 0).select(
        k.alias("order_id"), F.lit(2).alias("payment_sequential"),
        F.lit("voucher").alias("payment_type"), F.lit(1).alias("payment_installments"),
        # a money amount: 5 % of the order total rounded to the cent in exact decimal
        # arithmetic (on doubles, 61.715 would round down in one engine and up in another)
        F.round(F.col("o_totalprice").cast("decimal(18,2)") * F.lit(0.05).cast("decimal(3,2)"), 2)
        .cast("double").alias("payment_value"))
    return first.unionByName(voucher)


def review_scores_role(orders: DataFrame) -> DataFrame:
    """Reviews without their texts: no join with the documents."""
    k = F.col("o_orderkey")
    return orders.where(k % 30 != 29).select(
        k.alias("review_id"), k.alias("order_id"),
        (1 + (k * 17 + k % 7) % 5).cast("int").alias("review_score"),
        _plus_seconds(F.col("o_orderdate"), (10 + k % 40) * 86400).alias("review_answer_timestamp"),
        _plus_seconds(F.col("o_orderdate"), (9 + k % 40) * 86400).alias("review_creation_date"),
    )


def reviews_role(orders: DataFrame, documents: DataFrame) -> DataFrame:
    """Every third review carries the text of a document, every ninth its source as a title. The
    key runs over all documents, whatever their number. Reviews without a text do not enter
    the join, so they do not pile up on a null key."""
    scores = review_scores_role(orders)
    k = F.col("review_id")
    n_docs = scalars(documents.agg((F.max("doc_id") + 1).alias("n")))["n"]
    commented = scores.where(k % 3 == 0).withColumn("doc_key", k % n_docs)
    # both sides are dealt by the key: the work on the texts grows with the reviews, and a few files of
    # documents joined to broadcast reviews would leave it to a few tasks
    spark = orders.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    docs = documents.select("doc_id", "text", "source").repartition(n, "doc_id")
    joined = commented.repartition(n, "doc_key").join(
        docs.hint("merge"), F.col("doc_key") == F.col("doc_id"), "left").select(
        *scores.columns, F.col("text").alias("review_comment_message"),
        F.when(k % 9 == 0, F.col("source")).alias("review_comment_title"))
    silent = scores.where(k % 3 != 0).select(
        *scores.columns, F.lit(None).cast("string").alias("review_comment_message"),
        F.lit(None).cast("string").alias("review_comment_title"))
    return joined.unionByName(silent)


@dataclass(frozen=True)
class Market:
    """Handle on the nine marketplace tables (one lazy DataFrame each)."""

    orders: DataFrame
    items: DataFrame
    products: DataFrame
    translation: DataFrame
    sellers: DataFrame
    customers: DataFrame
    geo: DataFrame
    payments: DataFrame
    reviews: DataFrame
    review_scores: DataFrame    # the reviews without text and title
    lines: DataFrame            # the items, dealt by order where they have to be numbered
    parts: int = 0              # tasks for work by order; 0: the session's number

    def by_order(self, rows: DataFrame) -> DataFrame:
        """``rows`` dealt by order like ``lines``, which they then join without another shuffle."""
        return rows.repartition(self.parts, "order_id") if self.parts else rows.repartition("order_id")


# Lines of orders that one task numbers, joins and groups: its memory does not grow with the input.
LINES_PER_TASK = 250_000


def load_market(spark: SparkSession, sf_dir: str) -> Market:
    t = {n: read_table(spark, sf_dir, n)
         for n in ("orders", "lineitem", "part", "supplier", "customer", "nation", "documents")}
    # the number of rows stands in the files' footers
    parts = max(spark.sparkContext.defaultParallelism, math.ceil(t["lineitem"].count() / LINES_PER_TASK))
    return Market(
        orders=orders_role(t["orders"]),
        items=items_role(t["lineitem"]),
        products=products_role(t["part"]),
        translation=translation_role(t["part"]),
        sellers=sellers_role(t["supplier"], t["nation"], t["part"]),
        customers=customers_role(t["customer"], t["nation"]),
        geo=geo_role(t["nation"], t["part"]),
        payments=payments_role(t["orders"]),
        reviews=reviews_role(t["orders"], t["documents"]),
        review_scores=review_scores_role(t["orders"]),
        lines=items_role(t["lineitem"].repartition(parts, "l_orderkey")),
        parts=parts,
    )
