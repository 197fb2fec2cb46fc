"""Domain views over the driver's TPC-H-style tables (FIXTURES.md §2).

The reference reads five e-commerce tables (orders, payments, items, products,
reviews) plus its own scored output. The driver ships TPC-H-style Parquet instead, so
these functions derive the same shapes from it with plain DataFrame code. Each scan
selects only the columns it needs, so Parquet column pruning reaches the reader.

Holdout assignment: an order belongs to the holdout when ``order_id % 5 = 0``
(FIXTURES.md §2). Both halves are always the whole of their side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture mapping (FIXTURES.md §2).
HOLDOUT_MODULUS = 5
TIMESTAMP_COLS = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
PAYMENT_TYPES = ["credit_card", "debit_card", "mobile", "not_defined", "voucher"]


def table(spark: SparkSession, sf_dir: str, name: str, cols: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def _days(n: int) -> Column:
    return F.expr(f"INTERVAL {n} DAYS")


def is_holdout(order_id: str | Column = "order_id") -> Column:
    c = F.col(order_id) if isinstance(order_id, str) else order_id
    return c % HOLDOUT_MODULUS == 0


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders",
              ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"])
    ships = (table(spark, sf_dir, "lineitem", ["l_orderkey", "l_shipdate"])
             .groupBy("l_orderkey")
             .agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")))
    key = F.col("o_orderkey")
    kept = key % 97 != 0
    status = (F.when(F.col("o_orderstatus") == "F", "delivered")
              .when(F.col("o_orderstatus") == "P", "shipped")
              .when(F.col("o_orderpriority") == "1-URGENT", "canceled")
              .when(F.col("o_orderpriority") == "2-HIGH", "unavailable")
              .when(F.col("o_orderpriority") == "3-MEDIUM", "invoiced")
              .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", "approved")
              .otherwise("created"))
    day = F.col("o_orderdate")
    return (o.join(ships, key == F.col("l_orderkey"), "left")
            .select(key.alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    status.alias("order_status"),
                    F.when(kept, day).alias("order_purchase_timestamp"),
                    F.when(kept & (key % 20 != 0), day + _days(1)).alias("order_approved_at"),
                    F.when(kept, F.col("first_ship")).alias("order_delivered_carrier_date"),
                    F.when(kept, F.col("last_ship")).alias("order_delivered_customer_date"),
                    F.when(kept, day + _days(30)).alias("order_estimated_delivery_date")))


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem",
               ["l_orderkey", "l_returnflag", "l_linestatus", "l_linenumber", "l_extendedprice"])
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    ptype = (F.when((rf == "R") & (ls == "O"), "not_defined")
             .when((rf == "N") & (ls == "F"), "mobile")
             .when(rf == "N", "voucher")
             .when((rf == "A") & (ls == "O"), "debit_card")
             .otherwise("credit_card"))
    return li.select(F.col("l_orderkey").alias("order_id"), ptype.alias("payment_type"),
                     F.col("l_linenumber").alias("payment_installments"),
                     F.col("l_extendedprice").alias("payment_value"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", ["l_orderkey", "l_partkey", "l_extendedprice", "l_tax"])
    return li.select(F.col("l_orderkey").alias("order_id"), F.col("l_partkey").alias("product_id"),
                     F.col("l_extendedprice").alias("price"),
                     (F.col("l_extendedprice") * F.col("l_tax")).alias("shipping_cost"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size"])
    key, size = F.col("p_partkey"), F.col("p_size")
    known = lambda c: F.when(key % 89 != 0, c)  # noqa: E731 - the others are products without any attribute
    return p.select(key.alias("product_id"),
                    known(F.when(key % 50 != 0, F.col("p_brand"))).alias("product_category_name"),
                    known(F.length("p_name")).alias("product_name_length"),
                    known(F.length("p_name") + F.length("p_type")).alias("product_description_length"),
                    known(size % 7).alias("product_photos_qty"),
                    known(F.when(size % 10 == 0, F.lit(0)).otherwise(size * 100)).alias("product_weight_g"),
                    known(size % 20 + 1).alias("product_length_cm"),
                    known(size % 15 + 1).alias("product_height_cm"),
                    known(size % 10 + 1).alias("product_width_cm"))


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    key, cust, day = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderdate")
    given = lambda c: F.when(key % 7 != 0, c)  # noqa: E731 - the other orders have an empty review
    first = o.select(key.alias("order_id"),
                     given(1 + (key * 7 + cust) % 5).alias("review_score"),
                     given((day + _days(40)).cast("date")).alias("review_creation_date"),
                     given(day + _days(50)).alias("review_answer_timestamp"))
    # an additional review of some orders, not a subset of them
    second = (o.where((key % 7 != 0) & (key % 11 == 0))
              .select(key.alias("order_id"),
                      (1 + (key + cust) % 5).alias("review_score"),
                      (day + _days(45)).cast("date").alias("review_creation_date"),
                      (day + _days(55)).alias("review_answer_timestamp")))
    return first.unionByName(second)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic binary scores with labels: the reference's scored output."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice"])
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    return o.select(key.alias("id"),
                    (F.floor(price / 1000) / 1000).alias("score"),
                    F.when(price + ((key * 7919) % 1000) * 300 > 300000, 1).otherwise(0).alias("label"),
                    F.when(key % 3 == 0, "train").otherwise("validate").alias("split"))


def multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deterministic 5-class labels and predictions: the reference's multiclass output."""
    o = table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    label = 1 + (key * 7 + cust) % 5
    return o.select(key.alias("id"), label.alias("label"),
                    F.when(key % 3 == 0, label).otherwise(1 + key % 5).alias("prediction"))
