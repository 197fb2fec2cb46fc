"""Order-grain feature rollups.

Each source table is reduced to one row per ``order_id`` by a single aggregate, so the
exchange on ``order_id`` it plans is the same hash partitioning the basetable joins
need: the joins that follow reuse it instead of shuffling again.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import functions as X
from orderlens.operators import aggregate as A
from orderlens.operators import clean as C
from orderlens.operators import pareto as P

# Fixed values of the reference's recodes.
STATUS_MAP = {"delivered": "delivered", "unavailable": "unavailable", "canceled": "canceled"}
STATUS_DEFAULT = "processing"
STATUS_VALUES = ["canceled", "delivered", "processing", "unavailable"]
PAYMENT_NORMALIZE = {"not_defined": "credit_card"}
NORMALIZED_PAYMENT_TYPES = ["credit_card", "debit_card", "mobile", "voucher"]
DURATIONS = {
    "delivery_duration_days": ("order_delivered_customer_date", "order_purchase_timestamp"),
    "delivery_delay_days": ("order_delivered_customer_date", "order_estimated_delivery_date"),
}
FLAGS = {"duration_flag": "delivery_duration_days", "delays_flag": "delivery_delay_days"}
ITEM_MEANS = {
    "avg_price": "price",
    "avg_ship_cost": "shipping_cost",
    "avg_prod_name_length": "product_name_length",
    "avg_prod_desc_length": "product_description_length",
    "avg_photos_qty": "product_photos_qty",
    "avg_prod_weight_g": "product_weight_g",
    "avg_prod_volume_cm3": "prod_volume_cm3",
    "avg_ship_cost_per_g": "shipping_cost_per_g",
}


def orders_enriched(orders: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Durations, 4-way status, repeat-customer flag, presence flags.

    The repeat flag is a per-customer aggregate (partial aggregation absorbs a hot
    customer) joined back on ``customer_id``; adaptive skew-join splitting handles a
    customer holding a large share of the orders. ``by`` adds grouping columns (e.g.
    the train/holdout side, whose customers the reference counted separately).
    """
    df = C.datediff_features(orders, DURATIONS)
    df = df.withColumn("status", X.recode("order_status", STATUS_MAP, STATUS_DEFAULT))
    keys = [*by, "customer_id"]
    repeat = A.multi_flag(orders, keys, "order_id", "repeat_customer")
    df = df.join(repeat, keys, "left")
    return C.presence_flags(df, FLAGS)


def normalize_payment_types(payments: DataFrame) -> DataFrame:
    return C.recode(payments, "payment_type", "payment_type", PAYMENT_NORMALIZE)


def payments_by_order(payments: DataFrame, types: Sequence[str]) -> DataFrame:
    """``(order_id, payment_methods, <type>_installments, <type>_amount ...)``; types that
    are not listed add up under ``other_*``.

    Two hash aggregates and no join (the reference runs a distinct count and a pivot
    as two aggregates and joins them): first per (order, type), which pre-sums the
    payment rows; then per order, where "several types" is ``count(type) > 1`` over
    the per-type rows and the pivot sums the per-type sums.
    """
    per_type = payments.groupBy("order_id", "payment_type").agg(
        F.sum("payment_installments").alias("payment_installments"),
        F.sum("payment_value").alias("payment_value"))
    methods = X.binary_recode(F.count("payment_type") > 1, "multiple", "single").alias("payment_methods")
    pivot = A.pivot_exprs("payment_type", types,
                          {"installments": ("sum", "payment_installments"), "amount": ("sum", "payment_value")},
                          fill=0)
    return per_type.groupBy("order_id").agg(methods, *pivot)


def items_products_join(items: DataFrame, products: DataFrame) -> DataFrame:
    """Fact-to-dimension left join on ``product_id``. No hint: adaptive execution
    broadcasts the product side when it is measured small, else sort-merge."""
    return items.join(products, ["product_id"], "left")


def items_features(df: DataFrame) -> DataFrame:
    """Volume and shipping cost per gram (NULL for a zero or missing weight)."""
    return (df.withColumn("prod_volume_cm3",
                          F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm"))
            .drop("product_length_cm", "product_height_cm", "product_width_cm")
            .withColumn("shipping_cost_per_g", X.safe_divide("shipping_cost", "product_weight_g")))


def fit_categories(items: DataFrame, products: DataFrame, share: float = 0.8) -> DataFrame:
    """Pareto categories fitted on (training) items joined to products.

    Items are counted per product first (partial aggregation: a hot product is one row),
    so the join to products and the per-category sum move one row per product, not per
    item. Same counts as counting joined item rows per category.
    """
    per_product = items.groupBy("product_id").agg(F.count("product_id").alias("n"))
    cats = per_product.join(products.select("product_id", "product_category_name"), ["product_id"], "left")
    counts = cats.groupBy("product_category_name").agg(F.sum("n").alias("present_in"))
    return P.pareto_fit_counts(counts, "product_category_name", share)


def flagged_items(items: DataFrame, products: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    """Items with their product's features, the category replaced by the in/out label.

    The label is put on the product dimension, so item rows are joined on ``product_id``
    only and never on the few category names.
    """
    if fitted is None:
        fitted = fit_categories(items, products)
    flagged = P.pareto_apply(products, fitted, "product_category_name")
    return items_features(items_products_join(items, flagged)).withColumn(
        "product_category_name", F.coalesce(F.col("product_category_name"), F.lit(P.NOT_IN_TOP)))


def items_by_order(items: DataFrame, products: DataFrame, fitted: DataFrame | None = None) -> DataFrame:
    """Per order: item counts inside/outside the Pareto categories and 8 item means.

    ``fitted`` is the category list from :func:`pareto_fit` on the training items; it is
    fitted here from ``items`` when not given. The in/out label is put on the product
    dimension first, so the item fact table is joined once (to flagged products), not
    twice; an item without a product is out of the cut, like a NULL category. Counts
    and means are one aggregate.
    """
    flagged = flagged_items(items, products, fitted)
    counts = A.pivot_exprs("product_category_name", [P.IN_TOP, P.NOT_IN_TOP],
                           {"n": ("count", "product_id")}, fill=0, name="{value}", other=None)
    means = [F.coalesce(F.avg(c), F.lit(0)).alias(o) for o, c in ITEM_MEANS.items()]
    return flagged.groupBy("order_id").agg(*counts, *means)


def reviews_by_order(reviews: DataFrame) -> DataFrame:
    """``floor(mean score)`` and first/last review date per order."""
    return reviews.groupBy("order_id").agg(
        F.floor(F.avg("review_score")).alias("review_score"),
        F.min("review_creation_date").alias("first_review_date"),
        F.max("review_creation_date").alias("last_review_date"))
