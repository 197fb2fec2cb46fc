"""Registered queries: key -> Spark callable ``(spark, sf_dir) -> DataFrame`` and its
DuckDB SQL twin. ``__spark_entry__.py`` re-exports these.

Every query reads the driver tables (or the basetable Spark derives from them) in
full. Only the double columns a key lists (sums, means and ratios of them, whose last
bits depend on the order of addition) are rounded, to ``ROUND`` digits on both sides; the
operators themselves return raw values.
"""

from __future__ import annotations

from typing import Callable

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators import aggregate as A
from orderlens.operators import clean as C
from orderlens.operators import importance as IM
from orderlens.operators import metrics as MT
from orderlens.operators import models as MO
from orderlens.operators import pareto as P
from orderlens.operators import prep as PR
from orderlens.operators import split as SP
from orderlens.plans import basetable as B
from orderlens.plans import features as FE
from orderlens.plans import insights as I
from orderlens.plans import modeling as ML
from orderlens.plans import oracle as O
from orderlens.session import materialize, scratch_path
from orderlens.sources import csv as CSV
from orderlens.sources import tables as TB
from orderlens.sources import views as V

ROUND = 6
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def register(key: str, sql: str | None = None, digits: int | None = None, sql_doubles: list[str] = ()):
    def deco(fn):
        if digits is None:
            QUERIES[key] = fn
        else:
            QUERIES[key] = lambda spark, sf_dir: C.round_doubles(fn(spark, sf_dir), digits, sql_doubles)
        QUERIES[key].__name__ = key
        QUERIES[key].__doc__ = fn.__doc__
        if sql is not None:
            SQL[key] = O.rounded(sql, list(sql_doubles), digits) if digits is not None else sql
        return fn
    return deco


def _bt(spark, sf_dir, holdout=False):
    return B.materialized_basetable(spark, sf_dir, holdout)


TS = V.TIMESTAMP_COLS
DUR = list(FE.DURATIONS)

# ---------------------------------------------------------------- sources (A1-A5)


@register("csv_roundtrip", O.with_views("SELECT * FROM v_items", "v_items"))
def q_csv_roundtrip(spark, sf_dir):
    """Header CSV sink + explicit-schema CSV scan of the items view."""
    return CSV.csv_roundtrip(V.items(spark, sf_dir))


@register("csv_headerless_roundtrip",
          O.with_views("SELECT id AS order_id, score, label, split FROM v_scored", "v_scored"))
def q_csv_headerless(spark, sf_dir):
    """Headerless score file: positional scan renamed (reference's final_scores.csv)."""
    return CSV.csv_headerless_roundtrip(V.scored(spark, sf_dir), ["order_id", "score", "label", "split"])


@register("preview_topn", O.with_views(
    "SELECT * FROM v_orders ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id LIMIT 10", "v_orders"))
def q_preview_topn(spark, sf_dir):
    """First 10 orders by purchase time (a top-n report; total order via order_id)."""
    return C.preview_topn(V.orders(spark, sf_dir), 10,
                          [F.col("order_purchase_timestamp").asc_nulls_last(), F.col("order_id")])


# ---------------------------------------------------------------- projections (B*)

_fmt = "'%Y-%m-%d %H:%M:%S'"


@register("cast_timestamps", O.with_views(
    "SELECT order_id, customer_id, order_status, "
    + ", ".join(f"strptime(strftime({c}, {_fmt}), {_fmt}) AS {c}" for c in O.TS_COLS)
    + " FROM v_orders", "v_orders"))
def q_cast_timestamps(spark, sf_dir):
    """Timestamps rendered as text, then parsed back with the fixed pattern."""
    as_text = C.format_timestamps(V.orders(spark, sf_dir), TS)
    return C.cast_timestamps(as_text, TS)


_DATEDIFF_SQL = ("SELECT *, CAST(date_diff('day', order_purchase_timestamp, order_delivered_customer_date) AS INTEGER)"
                 " AS delivery_duration_days, CAST(date_diff('day', order_estimated_delivery_date,"
                 " order_delivered_customer_date) AS INTEGER) AS delivery_delay_days FROM v_orders")


@register("datediff_features", O.with_views(_DATEDIFF_SQL, "v_orders"))
def q_datediff(spark, sf_dir):
    return C.datediff_features(V.orders(spark, sf_dir), FE.DURATIONS)


@register("status_recode", O.with_views(
    "SELECT *, CASE WHEN order_status = 'delivered' THEN 'delivered' WHEN order_status = 'unavailable' "
    "THEN 'unavailable' WHEN order_status = 'canceled' THEN 'canceled' ELSE 'processing' END AS status "
    "FROM v_orders", "v_orders"))
def q_status_recode(spark, sf_dir):
    return C.recode(V.orders(spark, sf_dir), "order_status", "status", FE.STATUS_MAP, FE.STATUS_DEFAULT)


@register("presence_flags", O.with_views(
    "SELECT *, CASE WHEN delivery_duration_days IS NOT NULL THEN 1 ELSE 0 END AS duration_flag, "
    "CASE WHEN delivery_delay_days IS NOT NULL THEN 1 ELSE 0 END AS delays_flag "
    f"FROM ({_DATEDIFF_SQL}) d", "v_orders"))
def q_presence_flags(spark, sf_dir):
    return C.presence_flags(C.datediff_features(V.orders(spark, sf_dir), FE.DURATIONS), FE.FLAGS)


@register("repeat_customer", O.with_views(
    "SELECT customer_id, CASE WHEN count(DISTINCT order_id) > 1 THEN 'yes' ELSE 'no' END AS repeat_customer "
    "FROM v_orders GROUP BY customer_id", "v_orders"))
def q_repeat_customer(spark, sf_dir):
    return A.multi_flag(V.orders(spark, sf_dir), "customer_id", "order_id", "repeat_customer")


@register("orders_enriched", O.with_views(O.orders_enriched_sql("v_orders"), "v_orders"))
def q_orders_enriched(spark, sf_dir):
    return FE.orders_enriched(V.orders(spark, sf_dir))


@register("dropna_all", O.with_views(f"SELECT * FROM v_orders WHERE NOT ({O.all_ts_null()})", "v_orders"))
def q_dropna_all(spark, sf_dir):
    return C.dropna_all(V.orders(spark, sf_dir), TS)


def _sentinel_sql(src: str) -> str:
    ts = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '2080-01-01 01:00:00') AS {c}" for c in O.TS_COLS)
    return (f"SELECT * REPLACE ({ts}, coalesce(delivery_duration_days, 999) AS delivery_duration_days, "
            f"coalesce(delivery_delay_days, 999) AS delivery_delay_days) FROM {src}")


@register("sentinel_fill", O.with_views(_sentinel_sql(f"({_DATEDIFF_SQL}) d"), "v_orders"))
def q_sentinel_fill(spark, sf_dir):
    """999 for missing day counts; timestamps as text with the 2080 stand-in."""
    df = C.datediff_features(V.orders(spark, sf_dir), FE.DURATIONS)
    return C.sentinel_fill(df, {c: C.MISSING_DAYS for c in DUR}, to_string=TS)


@register("clean_orders", O.with_views(
    _sentinel_sql(f"({O.orders_enriched_sql('v_orders')}) e WHERE NOT ({O.all_ts_null('e')})"), "v_orders"))
def q_clean_orders(spark, sf_dir):
    return C.clean_orders(FE.orders_enriched(V.orders(spark, sf_dir)), TS, DUR, sentinel=True)


_ORDER_COLS = ["order_id", "customer_id", "order_status"] + O.TS_COLS


@register("null_profile", O.with_views(
    "SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in _ORDER_COLS) + " FROM v_orders",
    "v_orders"))
def q_null_profile(spark, sf_dir):
    return C.null_profile(V.orders(spark, sf_dir))


@register("row_count", O.with_views("SELECT count(*) AS row_count FROM v_orders", "v_orders"))
def q_row_count(spark, sf_dir):
    return C.row_count(V.orders(spark, sf_dir))


@register("array_expand", "SELECT vec_id, label, " + ", ".join(f"embedding[{i + 1}] AS embedding_{i}" for i in range(64))
          + " FROM embeddings")
def q_array_expand(spark, sf_dir):
    """The 64-float embedding opened into scalar columns (reference: probability vector)."""
    return C.array_expand(V.table(spark, sf_dir, "embeddings"), "embedding", 64, keep=["vec_id", "label"])


# ---------------------------------------------------------------- payments


@register("payment_type_normalize", O.with_views(
    "SELECT * REPLACE (CASE WHEN payment_type = 'not_defined' THEN 'credit_card' ELSE payment_type END "
    "AS payment_type) FROM v_payments", "v_payments"))
def q_payment_type_normalize(spark, sf_dir):
    return FE.normalize_payment_types(V.payments(spark, sf_dir))


@register("payment_multiplicity", O.with_views(
    "SELECT order_id, CASE WHEN count(DISTINCT payment_type) > 1 THEN 'multiple' ELSE 'single' END "
    "AS payment_methods FROM v_payments GROUP BY order_id", "v_payments"))
def q_payment_multiplicity(spark, sf_dir):
    return A.multi_flag(V.payments(spark, sf_dir), "order_id", "payment_type", "payment_methods",
                        "multiple", "single")


_PIVOT_SQL = O.payments_by_order_sql("v_payments", O.PAY_TYPES_ALL)
_PIVOT_ONLY = "SELECT * EXCLUDE (payment_methods) FROM (" + _PIVOT_SQL + ") p"
_AMOUNTS_ALL = [f"{t}_amount" for t in [*O.PAY_TYPES_ALL, "other"]]


@register("payment_pivot", O.with_views(_PIVOT_ONLY, "v_payments"), ROUND, _AMOUNTS_ALL)
def q_payment_pivot(spark, sf_dir):
    return A.pivot_agg(V.payments(spark, sf_dir), "order_id", "payment_type", V.PAYMENT_TYPES,
                       {"installments": ("sum", "payment_installments"), "amount": ("sum", "payment_value")})


@register("payments_by_order", O.with_views(_PIVOT_SQL, "v_payments"), ROUND, _AMOUNTS_ALL)
def q_payments_by_order(spark, sf_dir):
    return FE.payments_by_order(V.payments(spark, sf_dir), V.PAYMENT_TYPES)


# ---------------------------------------------------------------- items

_IP = O.items_products_sql("v_items")
_IP_VIEWS = ("v_items", "v_products")


@register("items_products_join", O.with_views(
    "SELECT i.*, p.* EXCLUDE (product_id) FROM v_items i LEFT JOIN v_products p ON i.product_id = p.product_id",
    *_IP_VIEWS))
def q_items_products_join(spark, sf_dir):
    return FE.items_products_join(V.items(spark, sf_dir), V.products(spark, sf_dir))


def _items_features(spark, sf_dir):
    return FE.items_features(FE.items_products_join(V.items(spark, sf_dir), V.products(spark, sf_dir)))


@register("items_features", O.with_views(_IP, *_IP_VIEWS))
def q_items_features(spark, sf_dir):
    return _items_features(spark, sf_dir)


@register("category_cumulative", O.with_views(
    "SELECT * EXCLUDE (total) FROM (" + O.category_cum_sql(f"({_IP})") + ") c", *_IP_VIEWS))
def q_category_cumulative(spark, sf_dir):
    return P.cumulative_counts(_items_features(spark, sf_dir), "product_category_name")


_FIT_CTES = [f"ip AS ({_IP})", f"cum AS ({O.category_cum_sql('ip')})", f"fit AS ({O.fitted_sql('cum')})"]


@register("pareto_categories", O.with_views("SELECT * FROM fit", *_IP_VIEWS, extra=_FIT_CTES))
def q_pareto_categories(spark, sf_dir):
    """Categories inside the 80 % cut, fitted from per-product item counts."""
    return FE.fit_categories(V.items(spark, sf_dir), V.products(spark, sf_dir))


@register("pareto_flag", O.with_views(O.flagged_sql("ip", "fit"), *_IP_VIEWS, extra=_FIT_CTES))
def q_pareto_flag(spark, sf_dir):
    return FE.flagged_items(V.items(spark, sf_dir), V.products(spark, sf_dir))


@register("pareto_flag_pivot", O.with_views(
    "SELECT order_id, count(CASE WHEN product_category_name = 'in_top_20' THEN product_id END) AS in_top_20, "
    "count(CASE WHEN product_category_name = 'not_in_top_20' THEN product_id END) AS not_in_top_20 "
    f"FROM ({O.flagged_sql('ip', 'fit')}) f GROUP BY order_id", *_IP_VIEWS, extra=_FIT_CTES))
def q_pareto_flag_pivot(spark, sf_dir):
    flagged = FE.flagged_items(V.items(spark, sf_dir), V.products(spark, sf_dir))
    return A.pivot_agg(flagged, "order_id", "product_category_name", [P.IN_TOP, P.NOT_IN_TOP],
                       {"n": ("count", "product_id")}, other=None)


_MEAN_COLS = [o for o, _ in O.ITEM_MEANS]


@register("items_means", O.with_views(
    "SELECT order_id, " + ", ".join(f"coalesce(avg({c}), 0) AS {o}" for o, c in O.ITEM_MEANS)
    + f" FROM ({_IP}) ip GROUP BY order_id", *_IP_VIEWS), ROUND, _MEAN_COLS)
def q_items_means(spark, sf_dir):
    return A.group_means(_items_features(spark, sf_dir), "order_id", FE.ITEM_MEANS)


@register("items_by_order", O.with_views(
    O.items_by_order_sql(f"({O.flagged_sql('ip', 'fit')})"), *_IP_VIEWS, extra=_FIT_CTES), ROUND, _MEAN_COLS)
def q_items_by_order(spark, sf_dir):
    return FE.items_by_order(V.items(spark, sf_dir), V.products(spark, sf_dir))


@register("reviews_by_order", O.with_views(O.reviews_by_order_sql("v_reviews"), "v_reviews"))
def q_reviews_by_order(spark, sf_dir):
    return FE.reviews_by_order(V.reviews(spark, sf_dir))


# ---------------------------------------------------------------- basetables

_BT_DOUBLES = [f"{t}_amount" for t in [*O.PAY_TYPES, "other"]] + _MEAN_COLS


@register("basetable_train", O.on_basetable("SELECT * FROM bt_train"), ROUND, _BT_DOUBLES)
def q_basetable_train(spark, sf_dir):
    """Train basetable: one row per order with sentiment (written once per session)."""
    return _bt(spark, sf_dir)


@register("basetable_holdout", O.on_basetable("SELECT * FROM bt_holdout"), ROUND, _BT_DOUBLES)
def q_basetable_holdout(spark, sf_dir):
    return _bt(spark, sf_dir, holdout=True)


@register("basetable_bucketed", O.on_basetable("SELECT * FROM bt_train"), ROUND, _BT_DOUBLES)
def q_basetable_bucketed(spark, sf_dir):
    """The train basetable joined from order-grain tables that are bucketed by order."""
    return B.sides(B.joined(B.bucketed(B.both_sides_grain(spark, sf_dir))))[0]


@register("review_sentiment", O.on_basetable(
    "SELECT order_id, review_score, CASE WHEN review_score > 3 THEN 'Positive' WHEN review_score = 0 "
    "THEN 'No Review' ELSE 'Negative' END AS review_sentiment FROM bt_train"))
def q_review_sentiment(spark, sf_dir):
    return B.review_sentiment(_bt(spark, sf_dir).select("order_id", "review_score"))


@register("binary_label", O.on_basetable(
    "SELECT order_id, CASE WHEN review_score IN (4, 5) THEN 1 ELSE 0 END AS label FROM bt_train "
    "WHERE review_score <> 0"))
def q_binary_label(spark, sf_dir):
    bt = _bt(spark, sf_dir).select("order_id", F.col("review_score").alias("label"))
    return B.binary_label(bt, "label")


_TYPED_KEEP = ["order_id", "review_score", "status", "repeat_customer", "payment_methods"]


@register("typed_column_select", O.on_basetable(
    "SELECT * EXCLUDE (order_status, first_review_date, last_review_date, review_sentiment) FROM bt_train"),
    ROUND, _BT_DOUBLES)
def q_typed_column_select(spark, sf_dir):
    """Columns kept by type (not date, not string) or by name, as the reference."""
    return C.typed_column_select(_bt(spark, sf_dir), keep_names=_TYPED_KEEP)


# ---------------------------------------------------------------- insights


@register("sentiment_distribution", O.on_basetable(
    "SELECT review_sentiment, count(*) AS count FROM bt_train GROUP BY review_sentiment"))
def q_sentiment_distribution(spark, sf_dir):
    return I.sentiment_distribution(_bt(spark, sf_dir))


@register("sentiment_by_repeat", O.on_basetable(
    "SELECT review_sentiment, count(CASE WHEN repeat_customer = 'no' THEN 1 END) AS no, "
    "count(CASE WHEN repeat_customer = 'yes' THEN 1 END) AS yes, "
    "count(CASE WHEN coalesce(repeat_customer, '') NOT IN ('no', 'yes') THEN 1 END) AS other FROM bt_train GROUP BY review_sentiment"))
def q_sentiment_by_repeat(spark, sf_dir):
    return I.sentiment_by_repeat(_bt(spark, sf_dir))


@register("sentiment_by_status", O.on_basetable(
    "SELECT review_sentiment, " + ", ".join(f"count(CASE WHEN status = '{s}' THEN 1 END) AS {s}"
                                            for s in FE.STATUS_VALUES)
    + f", count(CASE WHEN coalesce(status, '') NOT IN ({', '.join(map(repr, FE.STATUS_VALUES))}) THEN 1 END) AS other"
    + " FROM bt_train GROUP BY review_sentiment"))
def q_sentiment_by_status(spark, sf_dir):
    return I.sentiment_by_status(_bt(spark, sf_dir))


def _mean_sql(value: str, positive: bool, sentinel: int | None = None) -> str:
    v = f"coalesce({value}, {sentinel})" if sentinel is not None else value
    cond = "review_score <> 0" + (f" AND {v} > 0" if positive else "")
    return O.on_basetable(f"SELECT review_score, avg({v}) AS mean_{value} FROM bt_train WHERE {cond} "
                          "GROUP BY review_score")


def _register_mean(key, fn, value, positive, sentinel=None):
    register(key, _mean_sql(value, positive, sentinel), ROUND, [f"mean_{value}"])(
        lambda spark, sf_dir: fn(_bt(spark, sf_dir)) if sentinel is None
        else fn(_bt(spark, sf_dir), sentinel=sentinel))


_register_mean("mean_duration_by_score", I.mean_duration_by_score, "delivery_duration_days", False)
_register_mean("mean_duration_by_score_sentinel", I.mean_duration_by_score, "delivery_duration_days", False,
               I.MISSING_DAYS)
_register_mean("mean_delay_by_score", I.mean_delay_by_score, "delivery_delay_days", True)
_register_mean("mean_delay_by_score_sentinel", I.mean_delay_by_score, "delivery_delay_days", True, I.MISSING_DAYS)
_register_mean("mean_ship_cost_by_score", I.mean_ship_cost_by_score, "avg_ship_cost", False)
_register_mean("mean_weight_by_score", I.mean_weight_by_score, "avg_prod_weight_g", True)
_register_mean("mean_photos_by_score", I.mean_photos_by_score, "avg_photos_qty", True)
_register_mean("mean_name_length_by_score", I.mean_name_length_by_score, "avg_prod_name_length", True)
_register_mean("mean_desc_length_by_score", I.mean_desc_length_by_score, "avg_prod_desc_length", True)


@register("top_categories_by_score", O.on_basetable(
    "SELECT review_score, CAST(sum(in_top_20) AS BIGINT) AS sum_in_top_20, "
    "CAST(sum(not_in_top_20) AS BIGINT) AS sum_not_in_top_20 FROM bt_train WHERE review_score <> 0 "
    "GROUP BY review_score"))
def q_top_categories_by_score(spark, sf_dir):
    return I.top_categories_by_score(_bt(spark, sf_dir))


@register("payment_method_counts", O.on_basetable(
    "SELECT payment_methods, count(payment_methods) AS count_payment_methods FROM bt_train "
    "GROUP BY payment_methods"))
def q_payment_method_counts(spark, sf_dir):
    return I.payment_method_counts(_bt(spark, sf_dir))


@register("payment_totals", O.on_basetable(
    "SELECT " + ", ".join(f"CAST(sum(CAST({t}_amount AS DECIMAL(28,2))) AS DOUBLE) AS sum_{t}_amount"
                          for t in [*O.PAY_TYPES, "other"]) + " FROM bt_train"))
def q_payment_totals(spark, sf_dir):
    return I.payment_totals(_bt(spark, sf_dir))


_PRED = "(SELECT id, CAST(label AS DOUBLE) AS prediction FROM v_scored)"


@register("prediction_recode", O.with_views(
    "SELECT id, CAST(label AS DOUBLE) AS prediction, CASE WHEN label = 0 THEN 'Negative' WHEN label = 1 "
    "THEN 'Positive' ELSE CAST(CAST(label AS DOUBLE) AS VARCHAR) END AS review_sentiment FROM v_scored",
    "v_scored"))
def q_prediction_recode(spark, sf_dir):
    """Scored labels read as a double prediction and recoded to sentiment text."""
    preds = V.scored(spark, sf_dir).select("id", F.col("label").cast("double").alias("prediction"))
    return I.prediction_recode(preds)


@register("predicted_sentiment_distribution", O.on_basetable(
    "SELECT CASE WHEN p.prediction = 0 THEN 'Negative' WHEN p.prediction = 1 THEN 'Positive' "
    "ELSE CAST(p.prediction AS VARCHAR) END AS review_sentiment, count(*) AS count "
    f"FROM bt_holdout h LEFT JOIN {_PRED} p ON h.order_id = p.id GROUP BY 1",
    extra=[O.V_SCORED]))
def q_predicted_sentiment_distribution(spark, sf_dir):
    preds = V.scored(spark, sf_dir).select("id", F.col("label").cast("double").alias("prediction"))
    return I.predicted_sentiment_distribution(_bt(spark, sf_dir, holdout=True), preds)


@register("prediction_distribution", O.with_views(
    "SELECT prediction, count(*) AS count, count(*) / sum(count(*)) OVER () AS share FROM v_multi "
    "GROUP BY prediction", "v_multi"), ROUND, ["share"])
def q_prediction_distribution(spark, sf_dir):
    return I.prediction_distribution(V.multi(spark, sf_dir))


# ---------------------------------------------------------------- splits and set operations (H*, G*)

_TS_ORDER = "ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id"
_RANKED = (f"SELECT *, row_number() OVER ({_TS_ORDER}) AS rn, "
           "floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS k FROM v_orders")


@register("split_time_prefix", O.with_views(f"SELECT * EXCLUDE (rn, k) FROM ({_RANKED}) r WHERE rn <= k",
                                            "v_orders"))
def q_split_time_prefix(spark, sf_dir):
    """First 70 % of orders in (purchase time, id) order, as a pushed-down predicate."""
    first, _ = SP.split_time_prefix(V.orders(spark, sf_dir), "order_purchase_timestamp", "order_id")
    return first


@register("split_complement", O.with_views(f"SELECT * EXCLUDE (rn, k) FROM ({_RANKED}) r WHERE rn > k",
                                           "v_orders"))
def q_split_complement(spark, sf_dir):
    """Orders not in the time prefix: the complementary filter, without a join."""
    _, rest = SP.split_time_prefix(V.orders(spark, sf_dir), "order_purchase_timestamp", "order_id")
    return rest


_STRATA = {1: 0.7, 2: 0.7, 3: 0.7, 4: 0.7, 5: 0.7}


@register("stratified_sample", O.with_views(
    "SELECT * FROM v_multi WHERE ('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8))::BIGINT "
    "< CASE label " + " ".join(f"WHEN {k} THEN CAST({v} AS DOUBLE)" for k, v in _STRATA.items())
    + " END * 4294967296", "v_multi"))
def q_stratified_sample(spark, sf_dir):
    """70 % of every label stratum by id hash (reproducible on any layout)."""
    return SP.stratified_sample(V.multi(spark, sf_dir), "id", "label", _STRATA)


_CUT = "1995-06-17"


def _flags(spark, sf_dir, cols, early):
    li = V.table(spark, sf_dir, "lineitem", [*cols, "l_shipdate"])
    if early:
        li = li.where(F.col("l_shipdate") < F.lit(_CUT).cast("timestamp_ntz"))
    return li.select(*cols)


@register("except_all", f"SELECT l_returnflag, l_linestatus FROM lineitem EXCEPT ALL SELECT l_returnflag, "
          f"l_linestatus FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUT}'")
def q_except_all(spark, sf_dir):
    """Multiset difference of line flags: all lines minus lines shipped before the cut."""
    cols = ["l_returnflag", "l_linestatus"]
    return SP.except_all(_flags(spark, sf_dir, cols, False), _flags(spark, sf_dir, cols, True))


@register("except_distinct", f"SELECT l_partkey, l_returnflag FROM lineitem EXCEPT SELECT l_partkey, "
          f"l_returnflag FROM lineitem WHERE l_shipdate < TIMESTAMP '{_CUT}'")
def q_except_distinct(spark, sf_dir):
    cols = ["l_partkey", "l_returnflag"]
    return SP.except_distinct(_flags(spark, sf_dir, cols, False), _flags(spark, sf_dir, cols, True))


# ---------------------------------------------------------------- metrics (K*, D15, D16)

METRIC_DIGITS = 9
_ROWS = "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _score_cum_sql(split: bool) -> list[str]:
    part = "PARTITION BY split " if split else ""
    key = "split, " if split else ""
    return [
        f"g AS (SELECT {key}score, count(CASE WHEN label = 1 THEN 1 END) AS pos, "
        f"count(CASE WHEN label = 0 THEN 1 END) AS neg FROM v_scored GROUP BY {key}score)",
        f"c AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC {_ROWS}) AS cum_pos, "
        f"sum(neg) OVER ({part}ORDER BY score DESC {_ROWS}) AS cum_neg FROM g)",
        f"t AS (SELECT {key}sum(pos) AS P, sum(neg) AS N FROM g {'GROUP BY split' if split else ''})",
    ]


def _scored(spark, sf_dir):
    return V.scored(spark, sf_dir)


@register("auc_roc", O.with_views(
    "SELECT CAST(sum(CAST(neg AS HUGEINT) * (2 * cum_pos - pos)) AS DOUBLE) / (CAST(2.0 AS DOUBLE) * "
    "CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc_roc FROM c", "v_scored",
    extra=_score_cum_sql(False)), METRIC_DIGITS, ["auc_roc"])
def q_auc_roc(spark, sf_dir):
    """Exact ROC AUC (ties by trapezoid) over all scored orders."""
    return MT.auc_roc(_scored(spark, sf_dir))


@register("auc_pr", O.with_views(
    "SELECT sum(CAST(pos AS DOUBLE) * (prec + prev) / CAST(2.0 AS DOUBLE)) / CAST(sum(pos) AS DOUBLE) AS auc_pr "
    "FROM (SELECT pos, CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE) AS prec, "
    "CASE WHEN cum_pos + cum_neg - pos - neg = 0 THEN CAST(cum_pos AS DOUBLE) / CAST(cum_pos + cum_neg AS DOUBLE) "
    "ELSE CAST(cum_pos - pos AS DOUBLE) / CAST(cum_pos + cum_neg - pos - neg AS DOUBLE) END AS prev FROM c) x",
    "v_scored", extra=_score_cum_sql(False)), METRIC_DIGITS, ["auc_pr"])
def q_auc_pr(spark, sf_dir):
    return MT.auc_pr(_scored(spark, sf_dir))


@register("roc_points", O.with_views(
    "SELECT c.split, c.score AS threshold, CAST(cum_neg AS DOUBLE) / CAST(N AS DOUBLE) AS fpr, "
    "CAST(cum_pos AS DOUBLE) / CAST(P AS DOUBLE) AS tpr FROM c JOIN t ON c.split = t.split", "v_scored",
    extra=_score_cum_sql(True)), METRIC_DIGITS, ["threshold", "fpr", "tpr"])
def q_roc_points(spark, sf_dir):
    """ROC points per split (train / validate), one per distinct score."""
    return MT.roc_points(_scored(spark, sf_dir), split_col="split")


@register("lift_points", O.with_views(
    "SELECT split, CAST(k AS INTEGER) AS point, CAST(cum_pos + cum_neg AS DOUBLE) / CAST(P + N AS DOUBLE) AS population, "
    "(CAST(cum_pos AS DOUBLE) / CAST(P AS DOUBLE)) / (CAST(cum_pos + cum_neg AS DOUBLE) / CAST(P + N AS DOUBLE)) AS lift "
    "FROM (SELECT c.*, t.P, t.N, unnest(generate_series(CAST((10 * (cum_pos - pos)) // P + 1 AS BIGINT), CAST((10 * cum_pos) // P AS BIGINT))) AS k "
    "FROM c JOIN t ON c.split = t.split WHERE (10 * (cum_pos - pos)) // P + 1 <= (10 * cum_pos) // P) x",
    "v_scored", extra=_score_cum_sql(True)), METRIC_DIGITS, ["population", "lift"])
def q_lift_points(spark, sf_dir):
    """Cumulative lift at each 10 % of positives, per split (two curves)."""
    return MT.lift_points(_scored(spark, sf_dir), split_col="split")


@register("accuracy", O.with_views(
    "SELECT avg(CASE WHEN label = prediction THEN 1.0 ELSE 0.0 END) AS accuracy FROM v_multi", "v_multi"),
    METRIC_DIGITS, ["accuracy"])
def q_accuracy(spark, sf_dir):
    return MT.accuracy(V.multi(spark, sf_dir))


@register("f1_weighted", O.with_views(
    "SELECT sum(support * CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END) / sum(support) AS f1_weighted "
    "FROM (SELECT support, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0 END AS p, "
    "CASE WHEN support > 0 THEN tp / support ELSE 0 END AS r FROM cls) m", "v_multi",
    extra=["pairs AS (SELECT label, prediction, count(*) AS n FROM v_multi GROUP BY label, prediction)",
           "cls AS (SELECT c, sum(support) AS support, sum(tp) AS tp, sum(predicted) AS predicted FROM ("
           "SELECT CAST(label AS DOUBLE) AS c, n AS support, CASE WHEN label = prediction THEN n ELSE 0 END AS tp, "
           "0 AS predicted FROM pairs UNION ALL SELECT CAST(prediction AS DOUBLE), 0, 0, n FROM pairs) u GROUP BY c)"]),
    METRIC_DIGITS, ["f1_weighted"])
def q_f1_weighted(spark, sf_dir):
    return MT.f1_weighted(V.multi(spark, sf_dir))


_CLASSES = [1, 2, 3, 4, 5]


@register("confusion_matrix", O.with_views(
    "SELECT label, " + ", ".join(f"count(CASE WHEN prediction = {c} THEN 1 END) AS prediction_{c}" for c in _CLASSES)
    + f", count(CASE WHEN prediction NOT IN ({', '.join(map(str, _CLASSES))}) THEN 1 END) AS prediction_other"
    + " FROM v_multi GROUP BY label", "v_multi"))
def q_confusion_matrix(spark, sf_dir):
    return MT.confusion_matrix(V.multi(spark, sf_dir), classes=_CLASSES)


# The columns that are correlated, and those imputed first.
CORR_COLS = ["review_score", "delivery_delay_days", "delivery_duration_days", "avg_prod_desc_length",
             "avg_prod_weight_g", "avg_prod_name_length", "in_top_20", "avg_ship_cost"]
CORR_IMPUTE = ["in_top_20", "avg_prod_desc_length", "avg_prod_weight_g", "avg_prod_name_length", "avg_ship_cost"]
_BIGINT_COLS = {"in_top_20", "not_in_top_20"}


def _median_ctes(cols, src="bt_train"):
    return [f"med AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in cols)} FROM {src})"]


def _impute_expr(c):
    m = f"CAST(trunc(med.m_{c}) AS BIGINT)" if c in _BIGINT_COLS else f"med.m_{c}"
    return f"coalesce(b.{c}, {m}) AS {c}"


def _corr_sql(sentinel: bool) -> str:
    def src(c):
        if c in CORR_IMPUTE:
            return _impute_expr(c)
        if sentinel and c.startswith("delivery_"):
            return f"coalesce(b.{c}, 999) AS {c}"
        return f"b.{c}"
    pairs = [(a, b) for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]]
    ctes = _median_ctes(CORR_IMPUTE) + [
        f"imp AS (SELECT {', '.join(src(c) for c in CORR_COLS)} FROM bt_train b, med)",
        "agg AS (SELECT " + ", ".join(f"corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS {a}__{b}" for a, b in pairs)
        + " FROM imp)"]
    rows = []
    for a in CORR_COLS:
        for b in CORR_COLS:
            r = "CAST(1.0 AS DOUBLE)" if a == b else (f"{a}__{b}" if (a, b) in pairs else f"{b}__{a}")
            rows.append(f"SELECT '{a}' AS row, '{b}' AS col, {r} AS r FROM agg")
    return O.on_basetable(" UNION ALL ".join(rows), extra=ctes)


@register("corr_matrix", _corr_sql(False), METRIC_DIGITS, ["r"])
def q_corr_matrix(spark, sf_dir):
    """Pearson matrix of 8 basetable columns, 5 median-imputed; NULL durations drop
    out pairwise."""
    return MT.corr_matrix(_bt(spark, sf_dir), CORR_COLS, impute=CORR_IMPUTE)


@register("corr_matrix_sentinel", _corr_sql(True), METRIC_DIGITS, ["r"])
def q_corr_matrix_sentinel(spark, sf_dir):
    """As the reference: missing durations read as 999."""
    return MT.corr_matrix(_bt(spark, sf_dir), CORR_COLS, impute=CORR_IMPUTE,
                          sentinel={"delivery_delay_days": I.MISSING_DAYS, "delivery_duration_days": I.MISSING_DAYS})


@register("corr_matrix_blocked", _corr_sql(False), METRIC_DIGITS, ["r"])
def q_corr_matrix_blocked(spark, sf_dir):
    """The same matrix from pair sums in blocks of three columns."""
    return MT.corr_wide(_bt(spark, sf_dir), CORR_COLS, impute=CORR_IMPUTE, block=3)


@register("corr_embedding",
          "WITH v AS (SELECT row_number() OVER () AS k, embedding FROM embeddings), "
          "l AS (SELECT k, unnest(range(64)) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM v) "
          "SELECT 'embedding_' || a.i AS row, 'embedding_' || b.i AS col, "
          "CASE WHEN a.i = b.i THEN CAST(1.0 AS DOUBLE) ELSE corr(a.x, b.x) END AS r "
          "FROM l a JOIN l b USING (k) GROUP BY a.i, b.i", METRIC_DIGITS, ["r"])
def q_corr_embedding(spark, sf_dir):
    """Correlations of all 64 embedding entries (2,016 pairs)."""
    wide = C.array_expand(V.table(spark, sf_dir, "embeddings"), "embedding", 64)
    return MT.corr_wide(wide, wide.columns)


# ---------------------------------------------------------------- feature preparation

# The imputed item columns.
IMPUTE_COLS = ["in_top_20", "not_in_top_20", "avg_price", "avg_ship_cost", "avg_prod_name_length",
               "avg_prod_desc_length", "avg_photos_qty", "avg_prod_weight_g", "avg_prod_volume_cm3",
               "avg_ship_cost_per_g"]


@register("median_impute", O.on_basetable(
    "SELECT b.order_id, " + ", ".join(_impute_expr(c) for c in IMPUTE_COLS) + " FROM bt_train b, med",
    extra=_median_ctes(IMPUTE_COLS)), ROUND, [c for c in IMPUTE_COLS if c not in _BIGINT_COLS])
def q_median_impute(spark, sf_dir):
    """Exact-median imputation of the 10 item columns (orders without items)."""
    return PR.median_impute(_bt(spark, sf_dir).select("order_id", *IMPUTE_COLS), IMPUTE_COLS)


_ONEHOT = ["status", "repeat_customer", "payment_methods"]


def _onehot_sql() -> str:
    ctes = [f"lv_{c} AS (SELECT {c} AS level, row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS idx, "
            f"count(*) OVER () AS n FROM bt_train GROUP BY {c})" for c in _ONEHOT]
    cols = ", ".join(f"CAST(l_{c}.idx AS INTEGER) AS {c}_index, "
                     f"CAST(CASE WHEN l_{c}.idx < l_{c}.n - 1 THEN l_{c}.idx END AS INTEGER) AS {c}_active"
                     for c in _ONEHOT)
    joins = " ".join(f"JOIN lv_{c} l_{c} ON b.{c} = l_{c}.level" for c in _ONEHOT)
    return O.on_basetable(f"SELECT b.order_id, {cols} FROM bt_train b {joins}", extra=ctes)


@register("onehot_encode", _onehot_sql())
def q_onehot_encode(spark, sf_dir):
    """Levels by frequency (ties by name), last level dropped: index and hot position."""
    enc = PR.onehot_encode(_bt(spark, sf_dir).select("order_id", *_ONEHOT), _ONEHOT)
    out = [F.col("order_id")]
    for c in _ONEHOT:
        pos = F.array_position(vector_to_array(F.col(f"{c}_vec")), 1.0)
        out += [F.col(f"{c}_index").cast("int").alias(f"{c}_index"),
                F.when(pos > 0, pos - 1).cast("int").alias(f"{c}_active")]
    return enc.select(*out)


SCALE_COLS = ["avg_price", "avg_ship_cost", "avg_prod_weight_g", "delivery_duration_days", "delivery_delay_days"]


@register("maxabs_scale", O.on_basetable(
    "SELECT b.order_id, " + ", ".join(
        f"CAST(b.{c} AS DOUBLE) / CASE WHEN coalesce(m.{c}, 0) = 0 THEN CAST(1.0 AS DOUBLE) "
        f"ELSE CAST(m.{c} AS DOUBLE) END AS {c}" for c in SCALE_COLS) + " FROM bt_train b, m",
    extra=["m AS (SELECT " + ", ".join(f"max(abs({c})) AS {c}" for c in SCALE_COLS) + " FROM bt_train)"]),
    ROUND, SCALE_COLS)
def q_maxabs_scale(spark, sf_dir):
    return PR.maxabs_scale(_bt(spark, sf_dir).select("order_id", *SCALE_COLS), SCALE_COLS)


# ---------------------------------------------------------------- models (J5-J12): rows-only checks


def _holdout_features_sql() -> str:
    """Medians, maxima and levels of the first 70 % of the train orders, applied to the holdout.
    The driver tables hold all levels: 21 numeric features and 3 + 1 + 1 level columns."""
    x = lambda t, c: f"coalesce(CAST({t}.{c} AS DOUBLE), med.{c})"
    ctes = ["tr AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id) AS rn, "
            "floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS k FROM bt_train) r WHERE rn <= k)",
            "med AS (SELECT " + ", ".join(f"median(CAST({c} AS DOUBLE)) AS {c}" for c in ML.NUMERIC) + " FROM tr)",
            "mx AS (SELECT " + ", ".join(f"max(abs({x('tr', c)})) AS {c}" for c in ML.NUMERIC) + " FROM tr, med)"]
    ctes += [f"lv_{c} AS (SELECT {c} AS level, row_number() OVER (ORDER BY count(*) DESC, {c} ASC) - 1 AS idx FROM tr GROUP BY {c})"
             for c in ML.CATEGORICAL]
    cols = [f"{x('h', c)} / CASE WHEN mx.{c} = 0 THEN CAST(1.0 AS DOUBLE) ELSE mx.{c} END" for c in ML.NUMERIC]
    cols += [f"CAST(CASE WHEN l_{c}.idx = {i} THEN 1.0 ELSE 0.0 END AS DOUBLE)"
             for c, n in zip(ML.CATEGORICAL, (3, 1, 1)) for i in range(n)]
    joins = " ".join(f"JOIN lv_{c} l_{c} ON h.{c} = l_{c}.level" for c in ML.CATEGORICAL)
    return O.on_basetable("SELECT h.order_id, " + ", ".join(f"{e} AS f_{i}" for i, e in enumerate(cols))
                          + f" FROM bt_holdout h CROSS JOIN med CROSS JOIN mx {joins}", extra=ctes)


@register("holdout_features", _holdout_features_sql(), METRIC_DIGITS, [f"f_{i}" for i in range(len(ML.NUMERIC))])
def q_holdout_features(spark, sf_dir):
    """Holdout orders through the pipeline fitted on the train split only, one column per feature."""
    p = ML.prepared(spark, sf_dir)
    arrays = p.holdout.select("order_id", vector_to_array("features").alias("f"))
    return C.array_expand(arrays, "f", p.n_features, keep=["order_id"])


@register("model_select_table", O.with_views(
    "SELECT split AS model, m AS \"areaUnderPR\" FROM (SELECT split, avg(score) AS m FROM v_scored GROUP BY split) q "
    "ORDER BY m DESC LIMIT 1", "v_scored"), METRIC_DIGITS, ["areaUnderPR"])
def q_model_select_table(spark, sf_dir):
    """Model selection on a fixed table: the split with the greatest mean score."""
    board = V.scored(spark, sf_dir).groupBy("split").agg(F.avg("score").alias("areaUnderPR")).withColumnRenamed("split", "model")
    return MO.model_select(board)


@register("feature_topk_table",
          "SELECT feature, importance FROM (SELECT p_brand AS feature, CAST(count(*) AS DOUBLE) / CAST((SELECT count(*) FROM part) AS DOUBLE) "
          "AS importance FROM part GROUP BY p_brand) q WHERE importance > CAST(0.04 AS DOUBLE) ORDER BY importance DESC, feature LIMIT 10")
def q_feature_topk_table(spark, sf_dir):
    """Top-k selection on a fixed table: brands by their share of the parts."""
    shares = A.value_counts(V.table(spark, sf_dir, "part", ["p_brand"]), "p_brand", name="feature", share=True)
    return MO.feature_select_topk(shares.select("feature", F.col("share").alias("importance")), min_value=0.04)


@register("model_leaderboard")
def q_model_leaderboard(spark, sf_dir):
    """Six binary classifiers fitted on the first 70 % (time order), PR/ROC on the rest."""
    return ML.binary_board(ML.prepared(spark, sf_dir))[0]


@register("model_select")
def q_model_select(spark, sf_dir):
    return MO.model_select(ML.binary_board(ML.prepared(spark, sf_dir))[0], "areaUnderPR")


@register("feature_importance")
def q_feature_importance(spark, sf_dir):
    """Importances of the leaderboard's winner, whatever its kind."""
    return ML.importances(ML.prepared(spark, sf_dir))


@register("feature_select_topk")
def q_feature_select_topk(spark, sf_dir):
    return MO.feature_select_topk(ML.importances(ML.prepared(spark, sf_dir)))


@register("cross_validate")
def q_cross_validate(spark, sf_dir):
    """3-fold CV of the GBT over depths 4-12 on the whole binary train split."""
    p = ML.prepared(spark, sf_dir)
    return MO.cross_validate(p.train_binary, GBTClassifier(seed=MO.GBT_SEED_FINAL), "maxDepth", MO.CV_DEPTHS)


@register("ovr_leaderboard")
def q_ovr_leaderboard(spark, sf_dir):
    """Four one-vs-rest classifiers on the 5-class score: weighted F1 and accuracy."""
    p = ML.prepared(spark, sf_dir)
    return MO.leaderboard(MO.zero_based(p.train_multi), MO.zero_based(p.valid_multi), MO.ovr_estimators(p.n_features),
                          MO.MULTI_METRICS)[0]


@register("ovr_predict")
def q_ovr_predict(spark, sf_dir):
    """One-vs-rest GBT (depth 10) predictions for the validation orders."""
    p = ML.prepared(spark, sf_dir)
    return MO.ovr_scores(ML.validation_ovr(p), p.valid_multi)


@register("score_holdout")
def q_score_holdout(spark, sf_dir):
    """Final binary GBT fitted on all reviewed train orders, scored on the holdout."""
    p = ML.prepared(spark, sf_dir)
    return MO.predictions(ML.final_binary(p), p.holdout, keep_label=False)


@register("final_scores")
def q_final_scores(spark, sf_dir):
    """Binary and multiclass holdout predictions merged per order."""
    return ML.final_scores(ML.prepared(spark, sf_dir))


@register("final_scores_unreviewed")
def q_final_scores_unreviewed(spark, sf_dir):
    """The same of models that also learn the orders without a review: negatives, and a sixth class 0."""
    return ML.final_scores(ML.prepared(spark, sf_dir), unreviewed=True)


@register("scored_file_sentiment")
def q_scored_file_sentiment(spark, sf_dir):
    """Final scores written as a headerless file, read back, joined to the holdout and counted
    by predicted sentiment."""
    scores = ML.final_scores(ML.prepared(spark, sf_dir)).select("order_id", "prediction_binary")
    return I.predicted_sentiment_distribution(
        _bt(spark, sf_dir, holdout=True), CSV.csv_headerless_roundtrip(scores, ["id", "prediction"]))


@register("ovr_confusion")
def q_ovr_confusion(spark, sf_dir):
    """Confusion matrix of the one-vs-rest predictions on the validation orders."""
    p = ML.prepared(spark, sf_dir)
    return MT.confusion_matrix(MO.ovr_scores(ML.validation_ovr(p), p.valid_multi), classes=_CLASSES)


@register("ovr_metrics")
def q_ovr_metrics(spark, sf_dir):
    """Weighted F1 and accuracy of the same predictions."""
    p = ML.prepared(spark, sf_dir)
    scored = materialize(MO.ovr_scores(ML.validation_ovr(p), p.valid_multi), "ovr-scores")
    return MT.f1_weighted(scored).withColumn("accuracy", MT.accuracy(scored).scalar())


def _areas(scored):
    return MT.auc_roc(scored, "p_1").withColumn("auc_pr", MT.auc_pr(scored, "p_1").scalar())


@register("selected_refit")
def q_selected_refit(spark, sf_dir):
    """Exact ROC and PR areas of the GBT refitted on the selected features (validation orders)."""
    return _areas(ML.selected_refit(ML.prepared(spark, sf_dir))[0])


@register("selected_scores")
def q_selected_scores(spark, sf_dir):
    """Holdout predictions of the GBT refitted on the selected features."""
    return ML.selected_refit(ML.prepared(spark, sf_dir))[1]


@register("stratified_refit")
def q_stratified_refit(spark, sf_dir):
    """Exact ROC and PR areas, on the complement of a stratified 70 % sample, of the GBT fitted on the sample's
    selected features."""
    return _areas(ML.stratified_refit(ML.prepared(spark, sf_dir))[0])


@register("multi_refit_confusion")
def q_multi_refit_confusion(spark, sf_dir):
    """Confusion matrix, on the same complement, of the one-vs-rest GBT fitted on the sample's selected features."""
    return MT.confusion_matrix(ML.multi_refit(ML.prepared(spark, sf_dir))[0], classes=_CLASSES)


@register("multi_refit_metrics")
def q_multi_refit_metrics(spark, sf_dir):
    """Weighted F1 and accuracy of the same predictions."""
    scored = ML.multi_refit(ML.prepared(spark, sf_dir))[0]
    return MT.f1_weighted(scored).withColumn("accuracy", MT.accuracy(scored).scalar())


@register("refit_scores")
def q_refit_scores(spark, sf_dir):
    """Binary and multiclass holdout predictions of the refitted models, merged per order."""
    return ML.refit_scores(ML.prepared(spark, sf_dir))


# ---------------------------------------------------------------- scored-output joins


@register("score_merge", O.with_views(
    "SELECT s.id AS order_id, CAST(s.label AS DOUBLE) AS prediction_binary, m.prediction AS prediction_multiclass "
    "FROM v_scored s JOIN v_multi m ON s.id = m.id", "v_scored", "v_multi"))
def q_score_merge(spark, sf_dir):
    binary = V.scored(spark, sf_dir).select(F.col("id").alias("order_id"),
                                            F.col("label").cast("double").alias("prediction"))
    multi = V.multi(spark, sf_dir).select(F.col("id").alias("order_id"), "prediction")
    return MO.score_merge(binary, multi)


@register("prediction_join", O.with_views(
    "SELECT o.*, m.label, m.prediction FROM v_orders o LEFT JOIN v_multi m ON o.order_id = m.id",
    "v_orders", "v_multi"))
def q_prediction_join(spark, sf_dir):
    return MO.prediction_join(V.orders(spark, sf_dir), V.multi(spark, sf_dir), "order_id", "id")


@register("row_max_score", O.with_views(
    "SELECT id, label, 1 - score AS p_0, score AS p_1, greatest(1 - score, score) AS max_score FROM v_scored",
    "v_scored"), ROUND, ["p_0", "p_1", "max_score"])
def q_row_max_score(spark, sf_dir):
    """Probability pair (1 - score, score) and its row maximum (the reference's lift score)."""
    s = V.scored(spark, sf_dir).select("id", "label", (F.lit(1) - F.col("score")).alias("p_0"),
                                       F.col("score").alias("p_1"))
    return MO.row_max_score(s, ["p_0", "p_1"], "max_score")


# ---------------------------------------------------------------- sorted counts (F2), Bernoulli sample (H1)


@register("sentiment_repeat_counts", O.on_basetable(
    "SELECT review_sentiment, repeat_customer, count(*) AS count FROM bt_train "
    "GROUP BY review_sentiment, repeat_customer ORDER BY review_sentiment ASC, count DESC"))
def q_sentiment_repeat_counts(spark, sf_dir):
    """The pre-aggregate under the repeat-customer crosstab, sorted sentiment ascending
    and count descending (ties by the flag, for a total order)."""
    counts = _bt(spark, sf_dir).groupBy("review_sentiment", "repeat_customer").agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("review_sentiment").asc(), F.col("count").desc(), F.col("repeat_customer"))


@register("stratified_sample_bernoulli")
def q_stratified_sample_bernoulli(spark, sf_dir):
    """``sampleBy``-style Bernoulli sample (seed 123) per label; rows-only check, since
    which rows a seeded random draw keeps depends on the partition layout."""
    return SP.stratified_sample(V.multi(spark, sf_dir), "id", "label", _STRATA, method="bernoulli", seed=123)


# ---------------------------------------------------------------- curves on model output (K5-K7)


@register("model_roc_points")
def q_model_roc_points(spark, sf_dir):
    """ROC points of a depth-10 GBT (seed 132) on its train and validation splits,
    scored by P(positive): the reference's overfit check."""
    s = ML.scored_splits(ML.prepared(spark, sf_dir), MO.GBT_SEED_FINAL)
    return MT.roc_points(s, "p_1", "label", split_col="split")


@register("model_lift_points")
def q_model_lift_points(spark, sf_dir):
    """Lift curves of a depth-10 GBT (seed 134) on train and validation, scored by the
    row maximum of the two class probabilities as in the reference."""
    s = ML.scored_splits(ML.prepared(spark, sf_dir), MO.GBT_SEED_COMPARE)
    return MT.lift_points(s, "max_score", "label", split_col="split")


@register("svc_roc_points")
def q_svc_roc_points(spark, sf_dir):
    """ROC points of the LinearSVC on its train and validation splits, by its margin."""
    return MT.roc_points(ML.svc_splits(ML.prepared(spark, sf_dir)), "score", "label", split_col="split")


@register("svc_lift_points")
def q_svc_lift_points(spark, sf_dir):
    """Lift curves of the LinearSVC by its margin."""
    return MT.lift_points(ML.svc_splits(ML.prepared(spark, sf_dir)), "score", "label", split_col="split")


@register("ovr_class_areas")
def q_ovr_class_areas(spark, sf_dir):
    """Exact ROC area of each score against the rest, by the margins of the one-vs-rest models."""
    return MT.auc_roc(ML.class_margins(ML.prepared(spark, sf_dir)), "score", "label", split_col="class")


@register("ovr_roc_points")
def q_ovr_roc_points(spark, sf_dir):
    """One ROC curve per score."""
    return MT.roc_points(ML.class_margins(ML.prepared(spark, sf_dir)), "score", "label", split_col="class")


@register("ovr_lift_points")
def q_ovr_lift_points(spark, sf_dir):
    """One lift curve per score."""
    return MT.lift_points(ML.class_margins(ML.prepared(spark, sf_dir)), "score", "label", split_col="class")


@register("permutation_importance")
def q_permutation_importance(spark, sf_dir):
    """Permutation importances of the compared LinearSVC, which has none of its own."""
    p = ML.prepared(spark, sf_dir)
    return ML.permuted_importances(p, ML.binary_board(p)[1]["LinearSVC"])


# ---------------------------------------------------------------- the same operators on fixed models, with SQL twins

_FIXED_WEIGHTS = {"delivery_duration_days": -2, "delivery_delay_days": -5, "in_top_20": 3, "not_in_top_20": 1}


def _auc_ctes(src: str) -> list[str]:
    """``areas``: exact area per ``part`` of rows (part, score, label)."""
    return [f"ag AS (SELECT part, score, count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label = 0 THEN 1 END) AS neg "
            f"FROM {src} GROUP BY part, score)",
            f"ac AS (SELECT *, sum(pos) OVER (PARTITION BY part ORDER BY score DESC {_ROWS}) AS cum_pos FROM ag)",
            "areas AS (SELECT part, CAST(sum(CAST(neg AS HUGEINT) * (2 * cum_pos - pos)) AS DOUBLE) / (CAST(2.0 AS DOUBLE) * "
            "CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE)) AS auc FROM ac GROUP BY part)"]


def _permuted_sql() -> str:
    cols = list(_FIXED_WEIGHTS)
    score = lambda part: " + ".join(f"({w}) * {'o' if c == part else 'r'}.{c}" for c, w in _FIXED_WEIGHTS.items())
    rank = lambda salt: f"row_number() OVER (ORDER BY substr(md5('{salt}|' || CAST(order_id AS VARCHAR)), 1, 13), order_id)"
    ctes = ["r AS (SELECT order_id, CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS label, "
            + ", ".join(f"coalesce({c}, 0) AS {c}" for c in cols) + f", {rank('a')} AS a, {rank('b')} AS b FROM bt_train WHERE review_score <> 0)",
            "s AS (" + " UNION ALL ".join(
                f"SELECT '{c}' AS part, r.label, {score(c)} AS score FROM r JOIN r AS o ON r.a = o.b" for c in ["", *cols]) + ")"]
    return O.on_basetable("SELECT part AS feature, (SELECT auc FROM areas WHERE part = '') - auc AS importance FROM areas WHERE part <> ''",
                          extra=ctes + _auc_ctes("s"))


@register("permutation_importance_fixed", _permuted_sql(), METRIC_DIGITS, ["importance"])
def q_permutation_importance_fixed(spark, sf_dir):
    """Permutation importances of a fixed linear score on the reviewed train orders."""
    rows = B.binary_label(_bt(spark, sf_dir).select("order_id", F.col("review_score").alias("label"), *_FIXED_WEIGHTS))
    rows = rows.select("order_id", "label", F.array(*[F.coalesce(F.col(c), F.lit(0)).cast("double") for c in _FIXED_WEIGHTS]).alias("values"))
    weights = F.array(*[F.lit(float(w)) for w in _FIXED_WEIGHTS.values()])
    total = F.aggregate(F.zip_with("values", weights, lambda x, w: x * w), F.lit(0.0), lambda a, x: a + x)
    return IM.permutation_importance(rows, list(_FIXED_WEIGHTS), lambda d: d.withColumn("score", total))


@register("class_areas_fixed", O.with_views(
    "SELECT part AS \"class\", auc AS auc_roc FROM areas", "v_multi",
    extra=["cls AS (SELECT unnest([1, 2, 3, 4, 5]) AS part)",
           "s AS (SELECT part, -abs(prediction - part) AS score, CASE WHEN label = part THEN 1 ELSE 0 END AS label FROM v_multi, cls)",
           *_auc_ctes("s")]), METRIC_DIGITS, ["auc_roc"])
def q_class_areas_fixed(spark, sf_dir):
    """One-vs-rest areas of fixed margins: the nearer a prediction is to a class, the greater."""
    margins = F.array(*[-F.abs(F.col("prediction").cast("double") - c) for c in _CLASSES])
    scored = V.multi(spark, sf_dir).withColumn("rawPrediction", margins)
    return MT.auc_roc(MT.class_margins(scored, _CLASSES), "score", "label", split_col="class")


@register("binned_auc_roc", O.with_views(
    "SELECT split, (sure + half / 2) / pairs AS auc_roc, sure / pairs AS auc_low, (sure + half) / pairs AS auc_high FROM ("
    "SELECT split, CAST(sum(CAST(neg AS HUGEINT) * above) AS DOUBLE) AS sure, CAST(sum(CAST(neg AS HUGEINT) * pos) AS DOUBLE) AS half, "
    "CAST(sum(pos) AS DOUBLE) * CAST(sum(neg) AS DOUBLE) AS pairs FROM (SELECT *, coalesce(sum(pos) OVER (PARTITION BY split ORDER BY bin DESC "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS above FROM bins) x GROUP BY split) y", "v_scored",
    extra=["bins AS (SELECT split, greatest(0, least(63, CAST(floor(score / CAST(0.015625 AS DOUBLE)) AS INTEGER))) AS bin, "
           "count(CASE WHEN label = 1 THEN 1 END) AS pos, count(CASE WHEN label = 0 THEN 1 END) AS neg FROM v_scored GROUP BY 1, 2)"]),
    METRIC_DIGITS, ["auc_roc", "auc_low", "auc_high"])
def q_binned_auc_roc(spark, sf_dir):
    """ROC area per split from a histogram of 64 bins, with the bounds between which the exact one lies."""
    return MT.binned_auc_roc(_scored(spark, sf_dir), split_col="split", bins=64)


@register("fold_sizes", O.with_views(
    "SELECT CAST((CAST(('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8)) AS BIGINT)) % 3 AS INTEGER) AS fold, label, count(*) AS rows "
    "FROM v_scored GROUP BY 1, 2", "v_scored"))
def q_fold_sizes(spark, sf_dir):
    """Rows per cross-validation fold and label: folds by the id's hash."""
    return SP.hash_folds(_scored(spark, sf_dir), "id", MO.CV_FOLDS).groupBy("fold", "label").agg(F.count(F.lit(1)).alias("rows"))


@register("payment_pivot_fitted", O.with_views(
    "SELECT * EXCLUDE (payment_methods) FROM (" + O.payments_by_order_sql("(SELECT * FROM v_payments WHERE order_id % 5 = 0)", V.PAYMENT_TYPES)
    + ") p", "v_payments"), ROUND, [f"{t}_amount" for t in [*V.PAYMENT_TYPES, "other"]])
def q_payment_pivot_fitted(spark, sf_dir):
    """A pivot of the holdout payments on the types seen in the train payments."""
    payments = V.payments(spark, sf_dir)
    types = A.frequent_values(payments.where(~V.is_holdout()), "payment_type")
    return A.pivot_agg(payments.where(V.is_holdout()), "order_id", "payment_type", types,
                       {"installments": ("sum", "payment_installments"), "amount": ("sum", "payment_value")})


_CLEANED = ["order_id", "customer_id", "order_status", *O.TS_COLS, *DUR]


@register("clean_orders_profiled", O.with_views(
    " UNION ALL ".join(f"SELECT '{stage}' AS stage, '{c}' AS \"column\", count(*) - count({c}) AS nulls, count(*) AS rows FROM {src}"
                       for stage, src in (("before", "raw"), ("after", "clean")) for c in _CLEANED),
    "v_orders", extra=[f"raw AS (SELECT * FROM ({_DATEDIFF_SQL}) d)",
                       "clean AS (" + _sentinel_sql(f"raw WHERE NOT ({O.all_ts_null('raw')})") + ")"]))
def q_clean_orders_profiled(spark, sf_dir):
    """NULLs and rows before and after the cleaning of the orders, observed in one pass."""
    orders = C.datediff_features(V.orders(spark, sf_dir), FE.DURATIONS).select(*_CLEANED)
    return C.clean_orders_profiled(orders, TS, DUR)[1]


# ---------------------------------------------------------------- unlisted values, text ids, more profiles, CSV tables

_SOME_TYPES = ["credit_card", "voucher"]
_SOME_CLASSES = [1, 2, 3]


@register("payment_pivot_unlisted", O.with_views(
    "SELECT * EXCLUDE (payment_methods) FROM (" + O.payments_by_order_sql("v_payments", _SOME_TYPES) + ") p", "v_payments"),
    ROUND, [f"{t}_amount" for t in [*_SOME_TYPES, "other"]])
def q_payment_pivot_unlisted(spark, sf_dir):
    """A pivot on two listed payment types: the other three add up under ``other``."""
    return A.pivot_agg(V.payments(spark, sf_dir), "order_id", "payment_type", _SOME_TYPES,
                       {"installments": ("sum", "payment_installments"), "amount": ("sum", "payment_value")})


@register("confusion_matrix_unlisted", O.with_views(
    "SELECT label, " + ", ".join(f"count(CASE WHEN prediction = {c} THEN 1 END) AS prediction_{c}" for c in _SOME_CLASSES)
    + ", count(CASE WHEN prediction NOT IN (1, 2, 3) THEN 1 END) AS prediction_other FROM v_multi GROUP BY label", "v_multi"))
def q_confusion_matrix_unlisted(spark, sf_dir):
    return MT.confusion_matrix(V.multi(spark, sf_dir), classes=_SOME_CLASSES)


@register("split_time_prefix_text", O.with_views(
    "SELECT * EXCLUDE (rn, k) FROM (SELECT *, row_number() OVER (ORDER BY order_purchase_timestamp ASC NULLS LAST, order_id) AS rn, "
    "floor(CAST(count(*) OVER () AS DOUBLE) * CAST(0.7 AS DOUBLE)) AS k FROM (SELECT * REPLACE (md5(CAST(order_id AS VARCHAR)) "
    "AS order_id, CAST(order_purchase_timestamp AS VARCHAR) AS order_purchase_timestamp) FROM v_orders) t) r WHERE rn <= k", "v_orders"))
def q_split_time_prefix_text(spark, sf_dir):
    """The time split on hexadecimal text ids and timestamps held as text."""
    orders = V.orders(spark, sf_dir).withColumns({
        "order_id": F.md5(F.col("order_id").cast("string")),
        "order_purchase_timestamp": F.col("order_purchase_timestamp").cast("string")})
    return SP.split_time_prefix(orders, "order_purchase_timestamp", "order_id")[0]


def _profile_sql(cols: list[str], src: str) -> str:
    return "SELECT " + ", ".join(f"CAST(count(*) - count({c}) AS BIGINT) AS {c}" for c in cols) + f" FROM {src}"


_PROFILED = {
    "payments": ["order_id", "payment_type", "payment_installments", "payment_value"],
    "items": ["order_id", "product_id", "price", "shipping_cost"],
    "products": ["product_id", "product_category_name", "product_name_length", "product_description_length", "product_photos_qty",
                 "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm"],
    "reviews": ["order_id", "review_score", "review_creation_date", "review_answer_timestamp"],
}
for _name, _cols in _PROFILED.items():
    register(f"null_profile_{_name}", O.with_views(_profile_sql(_cols, f"v_{_name}"), f"v_{_name}"))(
        lambda spark, sf_dir, _name=_name, _cols=_cols: C.null_profile(getattr(V, _name)(spark, sf_dir).select(*_cols)))
_BT_PROFILED = [*O.TS_COLS, *DUR, "status", "repeat_customer", "payment_methods", *_MEAN_COLS, "in_top_20", "not_in_top_20"]
register("null_profile_basetable_train", O.on_basetable(
    _profile_sql([*_BT_PROFILED, "review_score", "first_review_date", "last_review_date"], "bt_train")))(
    lambda spark, sf_dir: C.null_profile(_bt(spark, sf_dir).select(*_BT_PROFILED, "review_score", "first_review_date", "last_review_date")))
register("null_profile_basetable_holdout", O.on_basetable(_profile_sql(_BT_PROFILED, "bt_holdout")))(
    lambda spark, sf_dir: C.null_profile(_bt(spark, sf_dir, holdout=True).select(*_BT_PROFILED)))


@register("basetable_train_sentinel", O.on_basetable(_sentinel_sql("bt_train")), ROUND, _BT_DOUBLES)
def q_basetable_train_sentinel(spark, sf_dir):
    """The train basetable with the 999-day and 2080 stand-ins."""
    return B.basetables(spark, sf_dir, sentinel=True)[0]


@register("basetable_from_csv", O.on_basetable("SELECT * FROM bt_train"), ROUND, _BT_DOUBLES)
def q_basetable_from_csv(spark, sf_dir):
    """The train tables written as CSV files, loaded by their declared schemas and built into
    the basetable: equal to the one built from Parquet."""
    train = {n: getattr(V, v)(spark, sf_dir) for n, v in (("orders", "orders"), ("order_payments", "payments"),
                                                          ("order_items", "items"), ("order_reviews", "reviews"))}
    train = {n: d.where(~V.is_holdout()) for n, d in train.items()} | {"products": V.products(spark, sf_dir)}
    folder = TB.save(train, scratch_path(spark, "order-tables"))
    t = TB.load(spark, folder, id_type="bigint", timestamps=CSV.STAMP)
    fitted = materialize(FE.fit_categories(t["order_items"], t["products"]), "pareto-categories")
    return B.basetable(t["orders"], t["order_payments"], t["order_items"], t["products"], t["order_reviews"], fitted=fitted)
