"""Insight queries on the basetable: one grouped aggregate each.

Every query filters, then aggregates with partial aggregation and one exchange on the
(low-cardinality) grouping key; with the basetable in Parquet, only the referenced
columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens import functions as X
from orderlens.operators import aggregate as A
from orderlens.plans import features as FE

# The reference's prediction labels and the repeat-customer levels.
PREDICTION_LABELS = {0.0: "Negative", 1.0: "Positive"}
REPEAT_VALUES = ["no", "yes"]
MISSING_DAYS = 999


def sentiment_distribution(bt: DataFrame) -> DataFrame:
    return A.value_counts(bt, "review_sentiment")


def prediction_recode(preds: DataFrame, col: str = "prediction", out: str = "review_sentiment") -> DataFrame:
    """0.0 -> Negative, 1.0 -> Positive; other values keep their text (the reference's
    ``regexp_replace`` on the number's text, without its wildcard-dot accident)."""
    return preds.withColumn(out, X.recode(col, PREDICTION_LABELS, X.KEEP).cast("string"))


def predicted_sentiment_distribution(holdout: DataFrame, preds: DataFrame, pred_id: str = "id",
                                     pred_col: str = "prediction") -> DataFrame:
    """Holdout orders joined (left) to predicted labels, counted per recoded label."""
    p = prediction_recode(preds.select(F.col(pred_id).alias("_pid"), pred_col), pred_col)
    joined = holdout.join(p, holdout["order_id"] == p["_pid"], "left")
    return A.value_counts(joined, "review_sentiment")


def prediction_distribution(preds: DataFrame, col: str = "prediction") -> DataFrame:
    return A.value_counts(preds, col, share=True)


def sentiment_by_repeat(bt: DataFrame) -> DataFrame:
    return A.crosstab(bt, "review_sentiment", "repeat_customer", REPEAT_VALUES)


def sentiment_by_status(bt: DataFrame) -> DataFrame:
    return A.crosstab(bt, "review_sentiment", "status", FE.STATUS_VALUES)


def mean_duration_by_score(bt: DataFrame, sentinel: int | None = None) -> DataFrame:
    return A.mean_by_score(bt, "delivery_duration_days", sentinel=sentinel)


def mean_delay_by_score(bt: DataFrame, sentinel: int | None = None) -> DataFrame:
    return A.mean_by_score(bt, "delivery_delay_days", positive_only=True, sentinel=sentinel)


def mean_ship_cost_by_score(bt: DataFrame) -> DataFrame:
    return A.mean_by_score(bt, "avg_ship_cost")


def mean_weight_by_score(bt: DataFrame) -> DataFrame:
    return A.mean_by_score(bt, "avg_prod_weight_g", positive_only=True)


def top_categories_by_score(bt: DataFrame) -> DataFrame:
    return A.sum_by_score(bt, ["in_top_20", "not_in_top_20"])


def payment_method_counts(bt: DataFrame) -> DataFrame:
    return A.non_null_counts(bt, "payment_methods")


def payment_totals(bt: DataFrame) -> DataFrame:
    return A.column_totals(bt, [f"{t}_amount" for t in [*FE.NORMALIZED_PAYMENT_TYPES, A.OTHER]])


def mean_photos_by_score(bt: DataFrame) -> DataFrame:
    """Unreviewed orders are excluded (the reference meant to, but compared against a
    differently cased label, so its filter excluded nothing)."""
    return A.mean_by_score(bt, "avg_photos_qty", positive_only=True)


def mean_name_length_by_score(bt: DataFrame) -> DataFrame:
    return A.mean_by_score(bt, "avg_prod_name_length", positive_only=True)


def mean_desc_length_by_score(bt: DataFrame) -> DataFrame:
    return A.mean_by_score(bt, "avg_prod_desc_length", positive_only=True)
