"""Loader of the order tables from CSV files with declared schemas.

``load`` reads the train files, or the holdout copies (``test_`` prefix, no reviews), and
corrects the two column names that the files misspell. ``infer=True`` lets Spark infer the
types instead of declaring them. Ids are text; ``id_type`` changes that.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources.csv import read_csv, write_csv

# File names, columns and types of the order tables.
SCHEMAS = {
    "orders": "order_id {id}, customer_id {id}, order_status string, order_purchase_timestamp {ts}, order_approved_at {ts}, "
              "order_delivered_carrier_date {ts}, order_delivered_customer_date {ts}, order_estimated_delivery_date {ts}",
    "order_payments": "order_id {id}, payment_type string, payment_installments int, payment_value double",
    "order_items": "order_id {id}, product_id {id}, price double, shipping_cost double",
    "products": "product_id {id}, product_category_name string, product_name_lenght int, product_description_lenght int, "
                "product_photos_qty int, product_weight_g int, product_length_cm int, product_height_cm int, product_width_cm int",
    "order_reviews": "order_id {id}, review_score int, review_creation_date date, review_answer_timestamp {ts}",
}
MISSPELT = {"product_name_lenght": "product_name_length", "product_description_lenght": "product_description_length"}
HOLDOUT_PREFIX = "test_"


def schema(name: str, id_type: str = "string") -> str:
    return SCHEMAS[name].format(id=id_type, ts="timestamp_ntz")


def load(spark: SparkSession, folder: str, holdout: bool = False, infer: bool = False, id_type: str = "string",
         timestamps: str | None = None) -> dict[str, DataFrame]:
    """``{table: DataFrame}`` from ``<folder>/<table>.csv`` (or ``test_<table>.csv``)."""
    out = {}
    for name in SCHEMAS:
        if holdout and name == "order_reviews":
            continue
        path = f"{folder.rstrip('/')}/{HOLDOUT_PREFIX if holdout else ''}{name}.csv"
        df = read_csv(spark, path, None if infer else schema(name, id_type), header=True, timestamps=timestamps)
        out[name] = df.withColumnsRenamed(MISSPELT)
    return out


def save(tables: dict[str, DataFrame], folder: str, holdout: bool = False) -> str:
    """Writes tables as the files that ``load`` reads."""
    back = {v: k for k, v in MISSPELT.items()}
    for name, df in tables.items():
        columns = [c.split(" ")[0] for c in SCHEMAS[name].split(", ")]
        write_csv(df.withColumnsRenamed(back).select(*columns),
                  f"{folder.rstrip('/')}/{HOLDOUT_PREFIX if holdout else ''}{name}.csv", header=True)
    return folder
