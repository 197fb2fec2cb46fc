"""DuckDB SQL twins of the registered queries (the driver's correctness oracle).

Each key's SQL is one statement with the domain views inlined as CTEs (FIXTURES.md
§2). Builders below assemble the shared CTE chain; the SQL is plain ANSI plus a few
DuckDB spellings (``date_diff``, ``* REPLACE``). Types are cast where the engines
differ (DuckDB ``length``/``date_diff`` are BIGINT, ``sum`` of integers is HUGEINT).
"""

from __future__ import annotations

V_ORDERS = """v_orders AS (
SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id,
  CASE WHEN o.o_orderstatus = 'F' THEN 'delivered' WHEN o.o_orderstatus = 'P' THEN 'shipped'
       WHEN o.o_orderpriority = '1-URGENT' THEN 'canceled' WHEN o.o_orderpriority = '2-HIGH' THEN 'unavailable'
       WHEN o.o_orderpriority = '3-MEDIUM' THEN 'invoiced' WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN 'approved'
       ELSE 'created' END AS order_status,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderdate END AS order_purchase_timestamp,
  CASE WHEN o.o_orderkey % 20 = 0 OR o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderdate + INTERVAL '1' DAY END AS order_approved_at,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE l.first_ship END AS order_delivered_carrier_date,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE l.last_ship END AS order_delivered_customer_date,
  CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_orderdate + INTERVAL '30' DAY END AS order_estimated_delivery_date
FROM orders o LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                         FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey)"""

V_PAYMENTS = """v_payments AS (
SELECT l_orderkey AS order_id,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'not_defined' WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 'mobile'
       WHEN l_returnflag = 'N' THEN 'voucher' WHEN l_returnflag = 'A' AND l_linestatus = 'O' THEN 'debit_card'
       ELSE 'credit_card' END AS payment_type,
  l_linenumber AS payment_installments, l_extendedprice AS payment_value
FROM lineitem)"""

V_ITEMS = """v_items AS (
SELECT l_orderkey AS order_id, l_partkey AS product_id, l_extendedprice AS price, l_extendedprice * l_tax AS shipping_cost
FROM lineitem)"""

V_PRODUCTS = """v_products AS (
SELECT p_partkey AS product_id, CASE WHEN known AND p_partkey % 50 <> 0 THEN p_brand END AS product_category_name,
  CASE WHEN known THEN CAST(length(p_name) AS INTEGER) END AS product_name_length,
  CASE WHEN known THEN CAST(length(p_name) + length(p_type) AS INTEGER) END AS product_description_length,
  CASE WHEN known THEN p_size % 7 END AS product_photos_qty,
  CASE WHEN known THEN CASE WHEN p_size % 10 = 0 THEN 0 ELSE p_size * 100 END END AS product_weight_g,
  CASE WHEN known THEN p_size % 20 + 1 END AS product_length_cm, CASE WHEN known THEN p_size % 15 + 1 END AS product_height_cm,
  CASE WHEN known THEN p_size % 10 + 1 END AS product_width_cm
FROM (SELECT *, p_partkey % 89 <> 0 AS known FROM part) p)"""

V_REVIEWS = """v_reviews AS (
SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 <> 0 THEN 1 + (o_orderkey * 7 + o_custkey) % 5 END AS review_score,
  CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_orderdate + INTERVAL '40' DAY AS DATE) END AS review_creation_date,
  CASE WHEN o_orderkey % 7 <> 0 THEN o_orderdate + INTERVAL '50' DAY END AS review_answer_timestamp
FROM orders
UNION ALL
SELECT o_orderkey, 1 + (o_orderkey + o_custkey) % 5, CAST(o_orderdate + INTERVAL '45' DAY AS DATE), o_orderdate + INTERVAL '55' DAY
FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 = 0)"""

V_SCORED = """v_scored AS (
SELECT o_orderkey AS id, floor(o_totalprice / 1000) / 1000 AS score,
  CASE WHEN o_totalprice + ((o_orderkey * 7919) % 1000) * 300 > 300000 THEN 1 ELSE 0 END AS label,
  CASE WHEN o_orderkey % 3 = 0 THEN 'train' ELSE 'validate' END AS split
FROM orders)"""

V_MULTI = """v_multi AS (
SELECT o_orderkey AS id, 1 + (o_orderkey * 7 + o_custkey) % 5 AS label,
  CASE WHEN o_orderkey % 3 = 0 THEN 1 + (o_orderkey * 7 + o_custkey) % 5 ELSE 1 + o_orderkey % 5 END AS prediction
FROM orders)"""

VIEWS = {"v_orders": V_ORDERS, "v_payments": V_PAYMENTS, "v_items": V_ITEMS, "v_products": V_PRODUCTS,
         "v_reviews": V_REVIEWS, "v_scored": V_SCORED, "v_multi": V_MULTI}

TS_COLS = ["order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
           "order_delivered_customer_date", "order_estimated_delivery_date"]
PAY_TYPES_ALL = ["credit_card", "debit_card", "mobile", "not_defined", "voucher"]
PAY_TYPES = ["credit_card", "debit_card", "mobile", "voucher"]


def with_views(body: str, *views: str, extra: list[str] | None = None) -> str:
    ctes = [VIEWS[v] for v in views] + list(extra or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


def rounded(inner: str, cols: list[str], digits: int = 6) -> str:
    """Wrap ``inner`` so the listed double columns are rounded (as the Spark side)."""
    if not cols:
        return inner
    rep = ", ".join(f"CASE WHEN abs({c}) < 1e28 THEN CAST(round(CAST({c} AS DECIMAL(38,9)), {digits}) AS DOUBLE) "
                    f"ELSE {c} END AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM ({inner}) AS q"


def orders_enriched_sql(src: str) -> str:
    dur = "date_diff('day', o.order_purchase_timestamp, o.order_delivered_customer_date)"
    dly = "date_diff('day', o.order_estimated_delivery_date, o.order_delivered_customer_date)"
    return f"""SELECT o.*, CAST({dur} AS INTEGER) AS delivery_duration_days,
  CAST({dly} AS INTEGER) AS delivery_delay_days,
  CASE WHEN o.order_status = 'delivered' THEN 'delivered' WHEN o.order_status = 'unavailable' THEN 'unavailable'
       WHEN o.order_status = 'canceled' THEN 'canceled' ELSE 'processing' END AS status,
  CASE WHEN c.n > 1 THEN 'yes' ELSE 'no' END AS repeat_customer,
  CASE WHEN {dur} IS NOT NULL THEN 1 ELSE 0 END AS duration_flag,
  CASE WHEN {dly} IS NOT NULL THEN 1 ELSE 0 END AS delays_flag
FROM {src} o LEFT JOIN (SELECT customer_id, count(DISTINCT order_id) AS n FROM {src} GROUP BY customer_id) c
  ON o.customer_id = c.customer_id"""


def all_ts_null(alias: str = "") -> str:
    p = f"{alias}." if alias else ""
    return " AND ".join(f"{p}{c} IS NULL" for c in TS_COLS)


def payments_by_order_sql(src: str, types: list[str]) -> str:
    cols = []
    for t in types:
        cols.append(f"CAST(coalesce(sum(CASE WHEN payment_type = '{t}' THEN payment_installments END), 0) AS BIGINT) "
                    f"AS {t}_installments")
        cols.append(f"coalesce(sum(CASE WHEN payment_type = '{t}' THEN payment_value END), 0) AS {t}_amount")
    rest = f"payment_type IS NULL OR payment_type NOT IN ({', '.join(repr(t) for t in types)})"
    cols.append(f"CAST(coalesce(sum(CASE WHEN {rest} THEN payment_installments END), 0) AS BIGINT) AS other_installments")
    cols.append(f"coalesce(sum(CASE WHEN {rest} THEN payment_value END), 0) AS other_amount")
    return f"""SELECT order_id, CASE WHEN count(DISTINCT payment_type) > 1 THEN 'multiple' ELSE 'single' END AS payment_methods,
  {', '.join(cols)}
FROM {src} GROUP BY order_id"""


def normalized_payments_sql(src: str) -> str:
    return f"""SELECT order_id, CASE WHEN payment_type = 'not_defined' THEN 'credit_card' ELSE payment_type END AS payment_type,
  payment_installments, payment_value FROM {src}"""


def items_products_sql(src: str) -> str:
    return f"""SELECT i.order_id, i.product_id, i.price, i.shipping_cost, p.product_category_name, p.product_name_length,
  p.product_description_length, p.product_photos_qty, p.product_weight_g,
  p.product_length_cm * p.product_height_cm * p.product_width_cm AS prod_volume_cm3,
  i.shipping_cost / NULLIF(p.product_weight_g, 0) AS shipping_cost_per_g
FROM {src} i LEFT JOIN v_products p ON i.product_id = p.product_id"""


def category_cum_sql(src: str) -> str:
    return f"""SELECT product_category_name, present_in,
  CAST(sum(present_in) OVER (ORDER BY present_in DESC, product_category_name ASC NULLS FIRST
                            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS accumulate,
  sum(present_in) OVER () AS total
FROM (SELECT product_category_name, count(product_id) AS present_in FROM {src} GROUP BY product_category_name) c"""


def fitted_sql(cum: str) -> str:
    return f"SELECT product_category_name FROM {cum} WHERE accumulate < total * CAST(0.8 AS DOUBLE)"


def flagged_sql(ip: str, fitted: str) -> str:
    return f"""SELECT ip.* REPLACE (CASE WHEN f.product_category_name IS NOT NULL THEN 'in_top_20' ELSE 'not_in_top_20' END
                             AS product_category_name)
FROM {ip} ip LEFT JOIN {fitted} f ON ip.product_category_name = f.product_category_name"""


ITEM_MEANS = [("avg_price", "price"), ("avg_ship_cost", "shipping_cost"),
              ("avg_prod_name_length", "product_name_length"),
              ("avg_prod_desc_length", "product_description_length"),
              ("avg_photos_qty", "product_photos_qty"), ("avg_prod_weight_g", "product_weight_g"),
              ("avg_prod_volume_cm3", "prod_volume_cm3"), ("avg_ship_cost_per_g", "shipping_cost_per_g")]


def items_by_order_sql(flagged: str) -> str:
    means = ", ".join(f"coalesce(avg({c}), 0) AS {o}" for o, c in ITEM_MEANS)
    return f"""SELECT order_id,
  count(CASE WHEN product_category_name = 'in_top_20' THEN product_id END) AS in_top_20,
  count(CASE WHEN product_category_name = 'not_in_top_20' THEN product_id END) AS not_in_top_20,
  {means}
FROM {flagged} GROUP BY order_id"""


def reviews_by_order_sql(src: str) -> str:
    return f"""SELECT order_id, CAST(floor(avg(review_score)) AS BIGINT) AS review_score,
  min(review_creation_date) AS first_review_date, max(review_creation_date) AS last_review_date
FROM {src} GROUP BY order_id"""


def basetable_ctes() -> list[str]:
    """CTE chain producing ``bt_train`` and ``bt_holdout`` (categories fitted on train)."""
    return [
        "o_train AS (SELECT * FROM v_orders WHERE order_id % 5 <> 0)",
        "o_hold AS (SELECT * FROM v_orders WHERE order_id % 5 = 0)",
        f"oe_train AS ({orders_enriched_sql('o_train')})",
        f"oe_hold AS ({orders_enriched_sql('o_hold')})",
        f"pay_train AS ({payments_by_order_sql('(' + normalized_payments_sql('v_payments') + ') np WHERE order_id % 5 <> 0', PAY_TYPES)})",
        f"pay_hold AS ({payments_by_order_sql('(' + normalized_payments_sql('v_payments') + ') np WHERE order_id % 5 = 0', PAY_TYPES)})",
        f"ip_train AS ({items_products_sql('(SELECT * FROM v_items WHERE order_id % 5 <> 0)')})",
        f"ip_hold AS ({items_products_sql('(SELECT * FROM v_items WHERE order_id % 5 = 0)')})",
        f"cat_cum AS ({category_cum_sql('ip_train')})",
        f"cat_fit AS ({fitted_sql('cat_cum')})",
        f"it_train AS ({items_by_order_sql('(' + flagged_sql('ip_train', 'cat_fit') + ')')})",
        f"it_hold AS ({items_by_order_sql('(' + flagged_sql('ip_hold', 'cat_fit') + ')')})",
        f"rev_train AS ({reviews_by_order_sql('(SELECT * FROM v_reviews WHERE order_id % 5 <> 0)')})",
        f"""bt_train AS (
SELECT oe.*, pay.* EXCLUDE (order_id),
  CAST(coalesce(r.review_score, 0) AS DOUBLE) AS review_score, r.first_review_date, r.last_review_date,
  it.* EXCLUDE (order_id),
  CASE WHEN coalesce(r.review_score, 0) > 3 THEN 'Positive' WHEN coalesce(r.review_score, 0) = 0 THEN 'No Review'
       ELSE 'Negative' END AS review_sentiment
FROM (SELECT * FROM oe_train WHERE NOT ({all_ts_null()})) oe
JOIN pay_train pay ON oe.order_id = pay.order_id
LEFT JOIN rev_train r ON oe.order_id = r.order_id
LEFT JOIN it_train it ON oe.order_id = it.order_id)""",
        f"""bt_holdout AS (
SELECT oe.*, pay.* EXCLUDE (order_id), it.* EXCLUDE (order_id)
FROM (SELECT * FROM oe_hold WHERE NOT ({all_ts_null()})) oe
JOIN pay_hold pay ON oe.order_id = pay.order_id
LEFT JOIN it_hold it ON oe.order_id = it.order_id)""",
    ]


BT_VIEWS = ("v_orders", "v_payments", "v_items", "v_products", "v_reviews")


def on_basetable(body: str, extra: list[str] | None = None) -> str:
    return with_views(body, *BT_VIEWS, extra=basetable_ctes() + list(extra or []))
