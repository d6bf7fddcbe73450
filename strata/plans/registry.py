"""Registered queries over the driver tables and their DuckDB oracle SQL.

Each query reads whole tables through ``adapters`` and runs one operator of
the library; each oracle states the same result in plain SQL.  Column names
and types agree on both sides (sums of money as exact decimals cast to
double, counts as bigint, ratios as double division).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import sources
from strata.operators import audit, checks, clean, dedupe, keys, reconcile, reports
from strata.plans import adapters as ad
from strata.rules import RETAIL_RULES

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle.strip()
        return fn

    return deco


# ----------------------------------------------------------------------------
# Oracle building blocks: the adapters restated as SQL views.
# ----------------------------------------------------------------------------
MONEY = "DECIMAL(20,4)"

SQL_ORDERS = """
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderkey % 89 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
         o_orderstatus AS order_status,
         CASE WHEN o_orderkey % 97 <> 0 THEN o_orderdate END AS order_purchase_timestamp
  FROM orders"""
# Some orders are unpaid, some paid in two parts (see adapters).
SQL_PAID = """
  SELECT o_orderkey, part,
         CASE WHEN o_orderkey % 7 <> 0 THEN o_totalprice
              WHEN part = 1 THEN CAST(cents * 2 // 5 AS DOUBLE) / 100
              ELSE CAST(cents - cents * 2 // 5 AS DOUBLE) / 100 END AS value
  FROM (SELECT *, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
               unnest(CASE WHEN o_orderkey % 7 = 0 THEN [1, 2] ELSE [1] END) AS part
        FROM orders WHERE o_orderkey % 50 <> 0)"""
SQL_PAYMENTS = f"""
  SELECT o_orderkey AS order_id, CAST(part AS BIGINT) AS payment_sequential,
         value AS payment_value
  FROM ({SQL_PAID})"""
SQL_PRODUCT_ID = (
    "CASE WHEN l_orderkey % 61 = 0 AND l_linenumber = 1 THEN l_partkey + 10000000000 ELSE l_partkey END"
)
SQL_SELLER_ID = "CASE WHEN l_orderkey % 53 <> 0 OR l_linenumber <> 2 THEN l_suppkey END"
SQL_ITEMS = f"""
  SELECT l_orderkey AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
         {SQL_PRODUCT_ID} AS product_id, CAST({SQL_SELLER_ID} AS VARCHAR) AS seller_id,
         l_shipdate AS shipping_limit_date, l_extendedprice AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE)
           AS freight_value
  FROM lineitem"""
SQL_REVIEWS = """
  SELECT o_orderkey AS review_id, o_orderkey AS order_id,
         CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS review_score
  FROM orders WHERE o_orderstatus = 'F'"""
SQL_CUSTOMERS = """
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         CAST(c_nationkey AS BIGINT) AS customer_zip_code_prefix,
         c_mktsegment AS customer_city, CAST(c_nationkey AS VARCHAR) AS customer_state
  FROM customer"""
SQL_PRODUCTS = """
  SELECT p_partkey AS product_id, p_type AS product_category_name FROM part"""
SQL_SELLERS = """
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS BIGINT) AS seller_zip_code_prefix,
         s_name AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
  FROM supplier"""


def with_entities(body: str, *names: str) -> str:
    views = {
        "o": SQL_ORDERS,
        "pay": SQL_PAYMENTS,
        "items": SQL_ITEMS,
        "rev": SQL_REVIEWS,
        "cust": SQL_CUSTOMERS,
        "prod": SQL_PRODUCTS,
        "sell": SQL_SELLERS,
    }
    ctes = ",\n".join(f"{n} AS ({views[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


# ----------------------------------------------------------------------------
# B1-B5 reports
# ----------------------------------------------------------------------------


@register(
    "sales_performance",
    with_entities(
        f"""
WITH m AS (SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m') AS month FROM o),
gmv AS (SELECT m.month, CAST(SUM(CAST(pay.payment_value AS {MONEY})) AS DOUBLE) AS gmv
        FROM pay JOIN m USING (order_id) GROUP BY m.month),
cnt AS (SELECT month, COUNT(DISTINCT order_id) AS order_count FROM m GROUP BY month)
SELECT month, gmv, order_count, gmv / order_count AS aov
FROM gmv JOIN cnt USING (month)
""",
        "o",
        "pay",
    ),
)
def q_sales_performance(spark, sf):
    return reports.sales_performance(ad.core_orders(spark, sf), ad.core_payments(spark, sf))


CLV_BODY = f"""
WITH clv AS (SELECT o.customer_id, CAST(SUM(CAST(pay.payment_value AS {MONEY})) AS DOUBLE) AS clv
             FROM pay JOIN o USING (order_id) GROUP BY o.customer_id),
cnt AS (SELECT customer_id, COUNT(DISTINCT order_id) AS order_count FROM o GROUP BY customer_id)
SELECT customer_id, clv, order_count, clv / order_count AS avg_order_value
FROM clv JOIN cnt USING (customer_id)
"""


@register("customer_lifetime_value", with_entities(CLV_BODY, "o", "pay"))
def q_customer_lifetime_value(spark, sf):
    return reports.customer_lifetime_value(
        ad.core_orders(spark, sf), ad.core_payments(spark, sf)
    )


def _item_perf_body(key: str) -> str:
    return f"""
WITH r AS (SELECT {key}, CAST(SUM(CAST(price AS {MONEY})) AS DOUBLE) AS revenue,
                  COUNT(DISTINCT order_id) AS order_count
           FROM items GROUP BY {key}),
pairs AS (SELECT DISTINCT order_id, {key} FROM items),
s AS (SELECT pairs.{key}, CAST(SUM(rev.review_score) AS DOUBLE) / COUNT(rev.review_score)
               AS avg_review_score
      FROM rev JOIN pairs USING (order_id) GROUP BY pairs.{key})
SELECT r.{key}, r.revenue, r.order_count, s.avg_review_score
FROM r LEFT JOIN s USING ({key})
"""


def _item_perf_sql(key: str) -> str:
    return with_entities(_item_perf_body(key), "items", "rev")


@register("seller_performance", _item_perf_sql("seller_id"))
def q_seller_performance(spark, sf):
    return reports.seller_performance(ad.core_order_items(spark, sf), ad.core_reviews(spark, sf))


@register("product_performance", _item_perf_sql("product_id"))
def q_product_performance(spark, sf):
    return reports.product_performance(
        ad.core_order_items(spark, sf), ad.core_reviews(spark, sf)
    )


def _retention_sql(calendar: bool) -> str:
    if calendar:
        months = """months AS (
  SELECT strftime(d, '%Y-%m') AS m FROM (
    SELECT unnest(generate_series(
      CAST(strptime(min(m) || '-01', '%Y-%m-%d') AS DATE),
      CAST(strptime(max(m) || '-01', '%Y-%m-%d') AS DATE),
      INTERVAL 1 MONTH)) AS d FROM om))"""
    else:
        months = "months AS (SELECT DISTINCT m FROM om)"
    return with_entities(
        f"""
WITH om AS (SELECT customer_id, strftime(order_purchase_timestamp, '%Y-%m') AS m
            FROM o WHERE order_purchase_timestamp IS NOT NULL),
fp AS (SELECT customer_id, MIN(m) AS cohort_month FROM om GROUP BY customer_id),
cs AS (SELECT cohort_month, COUNT(DISTINCT customer_id) AS cohort_size FROM fp GROUP BY cohort_month),
{months},
ac AS (SELECT fp.cohort_month, om.m AS activity_month,
              COUNT(DISTINCT om.customer_id) AS active_customers
       FROM om JOIN fp USING (customer_id) GROUP BY fp.cohort_month, om.m),
grid AS (SELECT cs.cohort_month, months.m AS activity_month
         FROM cs JOIN months ON months.m >= cs.cohort_month)
SELECT g.cohort_month, g.activity_month,
       COALESCE(ac.active_customers, 0) AS active_customers, cs.cohort_size,
       CAST(COALESCE(ac.active_customers, 0) AS DOUBLE) / cs.cohort_size AS retention_rate
FROM grid g LEFT JOIN ac USING (cohort_month, activity_month) JOIN cs USING (cohort_month)
""",
        "o",
    )


@register("customer_retention", _retention_sql(False))
def q_customer_retention(spark, sf):
    return reports.customer_retention(ad.core_orders(spark, sf))


@register("customer_retention_calendar", _retention_sql(True))
def q_customer_retention_calendar(spark, sf):
    return reports.customer_retention(ad.core_orders(spark, sf), calendar=True)


# ----------------------------------------------------------------------------
# D1 deduplication
# ----------------------------------------------------------------------------
# The driver's lineitem repeats (l_orderkey, l_linenumber); the latest ship
# date wins, remaining columns break ties (all descending, nulls last).
ITEM_KEY = ["order_id", "order_item_id"]
ITEM_TIEBREAKER = "shipping_limit_date"


@register(
    "dedup_items",
    with_entities(
        """
SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
FROM (SELECT *, ROW_NUMBER() OVER (
        PARTITION BY order_id, order_item_id
        ORDER BY shipping_limit_date DESC NULLS LAST, product_id DESC NULLS LAST,
                 seller_id DESC NULLS LAST, price DESC NULLS LAST,
                 freight_value DESC NULLS LAST) AS rn
      FROM items)
WHERE rn = 1
""",
        "items",
    ),
)
def q_dedup_items(spark, sf):
    items = ad.core_order_items(spark, sf)
    return dedupe.dedup_entity(items, "order_items", ITEM_KEY, ITEM_TIEBREAKER)[0]


# ----------------------------------------------------------------------------
# F1-F3 foreign keys with cascade
# ----------------------------------------------------------------------------
# Parent customers are the accounts in good standing (positive balance), so
# orders of the others are orphans and the cascade has work to do.


def fk_entities(spark, sf):
    ents = ad.core_entities(spark, sf)
    ents["customers"] = ents["customers"].join(
        ad.table(spark, sf, "customer")
        .filter("c_acctbal > 0")
        .select(F.col("c_custkey").cast("string").alias("customer_id")),
        "customer_id",
        "left_semi",
    )
    return ents


SQL_FK = """
WITH c AS (SELECT cust.* FROM cust JOIN customer ON CAST(c_custkey AS VARCHAR) = customer_id WHERE c_acctbal > 0),
o2 AS (SELECT * FROM o WHERE EXISTS (SELECT 1 FROM c WHERE c.customer_id = o.customer_id)),
items2 AS (SELECT * FROM items i
           WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = i.order_id)
             AND EXISTS (SELECT 1 FROM prod WHERE prod.product_id = i.product_id)
             AND EXISTS (SELECT 1 FROM sell WHERE sell.seller_id = i.seller_id)),
pay2 AS (SELECT * FROM pay p WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = p.order_id)),
rev2 AS (SELECT * FROM rev r WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = r.order_id))
"""
FK_VIEWS = ("o", "items", "pay", "rev", "cust", "prod", "sell")


@register(
    "fk_orphans",
    with_entities(
        SQL_FK
        + """
SELECT DISTINCT 'orders' AS entity, 'customer_id' AS "column",
       CAST(customer_id AS VARCHAR) AS missing_value
FROM o WHERE customer_id IS NOT NULL AND customer_id NOT IN (SELECT customer_id FROM c)
UNION ALL
SELECT DISTINCT 'order_items', 'order_id', CAST(order_id AS VARCHAR)
FROM items WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM o2)
UNION ALL
SELECT DISTINCT 'order_items', 'product_id', CAST(product_id AS VARCHAR)
FROM items WHERE product_id IS NOT NULL AND product_id NOT IN (SELECT product_id FROM prod)
UNION ALL
SELECT DISTINCT 'order_items', 'seller_id', CAST(seller_id AS VARCHAR)
FROM items WHERE seller_id IS NOT NULL AND seller_id NOT IN (SELECT seller_id FROM sell)
UNION ALL
SELECT DISTINCT 'payments', 'order_id', CAST(order_id AS VARCHAR)
FROM pay WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM o2)
UNION ALL
SELECT DISTINCT 'reviews', 'order_id', CAST(order_id AS VARCHAR)
FROM rev WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM o2)
""",
        *FK_VIEWS,
    ),
)
def q_fk_orphans(spark, sf):
    return keys.clean_relationships(fk_entities(spark, sf), RETAIL_RULES)[2]


@register(
    "fk_report",
    with_entities(
        SQL_FK
        + """
SELECT 'orders' AS entity, 'customer_id' AS "column", 'customers' AS parent,
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.customer_id = o.customer_id))
         AS removed_count FROM o
UNION ALL
SELECT 'order_items', 'order_id', 'orders',
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = items.order_id))
FROM items
UNION ALL
SELECT 'order_items', 'product_id', 'products',
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM prod WHERE prod.product_id = items.product_id))
FROM items
UNION ALL
SELECT 'order_items', 'seller_id', 'sellers',
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM sell WHERE sell.seller_id = items.seller_id))
FROM items
UNION ALL
SELECT 'payments', 'order_id', 'orders',
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = pay.order_id))
FROM pay
UNION ALL
SELECT 'reviews', 'order_id', 'orders',
       COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = rev.order_id))
FROM rev
""",
        *FK_VIEWS,
    ),
)
def q_fk_report(spark, sf):
    return keys.clean_relationships(fk_entities(spark, sf), RETAIL_RULES)[1]


@register("fk_cascade", with_entities(SQL_FK + "SELECT * FROM items2", *FK_VIEWS))
def q_fk_cascade(spark, sf):
    return keys.clean_relationships(fk_entities(spark, sf), RETAIL_RULES)[0]["order_items"]


@register("fk_orders_clean", with_entities(SQL_FK + "SELECT * FROM o2", *FK_VIEWS))
def q_fk_orders_clean(spark, sf):
    return keys.clean_relationships(fk_entities(spark, sf), RETAIL_RULES)[0]["orders"]


# ----------------------------------------------------------------------------
# R1-R7 reconciliation and quarantine
# ----------------------------------------------------------------------------
# The driver's order totals are not derived from its line items, so the
# registry uses a wide tolerance (currency units) that splits orders into
# both outcomes; the library default stays the reference's 0.01.
RECON_TOLERANCE = 50000.0

SQL_RECON = f"""
WITH e AS (SELECT order_id,
                  COALESCE(SUM(CAST(price AS {MONEY}) + CAST(freight_value AS {MONEY})), 0) AS e
           FROM items GROUP BY order_id),
a AS (SELECT order_id, COALESCE(SUM(CAST(payment_value AS {MONEY})), 0) AS a
      FROM pay GROUP BY order_id),
cmp AS (SELECT order_id, CAST(e AS DOUBLE) AS expected_total,
               CAST(COALESCE(a, 0) AS DOUBLE) AS actual_total,
               CAST(abs(e - COALESCE(a, 0)) AS DOUBLE) AS difference,
               abs(e - COALESCE(a, 0)) <= CAST({RECON_TOLERANCE} AS {MONEY}) AS passed
        FROM e LEFT JOIN a USING (order_id)),
exc AS (SELECT order_id, CAST(a AS DOUBLE) AS actual_total FROM a
        WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM e)),
q AS (SELECT x.*, o.order_status FROM (
        SELECT order_id, expected_total, actual_total, difference,
               'exceeded_tolerance' AS reason FROM cmp WHERE NOT passed
        UNION ALL
        SELECT order_id, CAST(NULL AS DOUBLE), actual_total, CAST(NULL AS DOUBLE),
               'no_order_items' FROM exc) x
      LEFT JOIN o USING (order_id))
"""
RECON_VIEWS = ("items", "pay", "o")


def recon_inputs(spark, sf):
    orders = ad.core_orders(spark, sf)
    items = ad.core_order_items(spark, sf)
    payments = ad.core_payments(spark, sf)
    return orders, items, payments, reconcile.order_totals(items, payments)


@register("reconcile_orders", with_entities(SQL_RECON + "SELECT * FROM cmp", *RECON_VIEWS))
def q_reconcile_orders(spark, sf):
    return reconcile.comparison_of(recon_inputs(spark, sf)[3], RECON_TOLERANCE)


@register("reconcile_excluded", with_entities(SQL_RECON + "SELECT * FROM exc", *RECON_VIEWS))
def q_reconcile_excluded(spark, sf):
    return reconcile.excluded_of(recon_inputs(spark, sf)[3])


@register("quarantine_orders", with_entities(SQL_RECON + "SELECT * FROM q", *RECON_VIEWS))
def q_quarantine_orders(spark, sf):
    orders, _, _, totals = recon_inputs(spark, sf)
    return reconcile.quarantine_of(totals, orders, RECON_TOLERANCE)


def _after_quarantine(spark, sf, which: int):
    orders, items, payments, totals = recon_inputs(spark, sf)
    q = reconcile.quarantine_of(totals, orders, RECON_TOLERANCE)
    return reconcile.remove_quarantined((orders, items, payments)[which], q)


_NOT_Q = "WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM q)"


@register(
    "orders_after_quarantine",
    with_entities(SQL_RECON + f"SELECT * FROM o {_NOT_Q}", *RECON_VIEWS),
)
def q_orders_after_quarantine(spark, sf):
    return _after_quarantine(spark, sf, 0)


@register(
    "items_after_quarantine",
    with_entities(SQL_RECON + f"SELECT * FROM items {_NOT_Q}", *RECON_VIEWS),
)
def q_items_after_quarantine(spark, sf):
    return _after_quarantine(spark, sf, 1)


@register(
    "payments_after_quarantine",
    with_entities(SQL_RECON + f"SELECT * FROM pay {_NOT_Q}", *RECON_VIEWS),
)
def q_payments_after_quarantine(spark, sf):
    return _after_quarantine(spark, sf, 2)


@register(
    "reconciliation_summary",
    with_entities(
        SQL_RECON
        + f"""
SELECT (SELECT COUNT(*) FROM cmp) AS total_orders_checked,
       (SELECT COUNT(*) FROM cmp WHERE passed) AS orders_passed,
       (SELECT COUNT(*) FROM cmp WHERE NOT passed) AS orders_failed,
       (SELECT MAX(difference) FROM cmp) AS max_difference,
       CAST({RECON_TOLERANCE} AS DOUBLE) AS tolerance_used,
       (SELECT COUNT(*) FROM exc) AS excluded_order_count
""",
        *RECON_VIEWS,
    ),
)
def q_reconciliation_summary(spark, sf):
    return reconcile.summary_of(recon_inputs(spark, sf)[3], RECON_TOLERANCE)


@register(
    "excluded_by_status",
    with_entities(
        SQL_RECON
        + """
SELECT o.order_status, COUNT(*) AS count FROM exc LEFT JOIN o USING (order_id)
GROUP BY o.order_status
""",
        *RECON_VIEWS,
    ),
)
def q_excluded_by_status(spark, sf):
    orders, _, _, totals = recon_inputs(spark, sf)
    return reconcile.excluded_by_status(reconcile.excluded_of(totals), orders)


@register(
    "worst_order",
    with_entities(
        SQL_RECON
        + "SELECT order_id, difference FROM cmp WHERE NOT passed "
        "ORDER BY difference DESC, order_id LIMIT 1",
        *RECON_VIEWS,
    ),
)
def q_worst_order(spark, sf):
    return reconcile.worst_order(
        reconcile.comparison_of(recon_inputs(spark, sf)[3], RECON_TOLERANCE)
    )


# ----------------------------------------------------------------------------
# E1-E7 cleansers over the raw (CSV-shaped) entities
# ----------------------------------------------------------------------------
TS_TEXT = "'%Y-%m-%d %H:%M:%S'"
NULL_TEXT = "CAST(NULL AS VARCHAR)"
RAW_SQL = {
    "customers": """
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS customer_unique_id,
         CAST(c_nationkey AS BIGINT) AS customer_zip_code_prefix,
         lower(c_mktsegment) AS customer_city, lower(CAST(c_nationkey AS VARCHAR)) AS customer_state
  FROM customer""",
    "orders": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
         o_orderstatus AS order_status,
         strftime(o_orderdate, {TS_TEXT}) AS order_purchase_timestamp,
         {NULL_TEXT} AS order_approved_at, {NULL_TEXT} AS order_delivered_carrier_date,
         {NULL_TEXT} AS order_delivered_customer_date, {NULL_TEXT} AS order_estimated_delivery_date
  FROM orders""",
    "order_items": f"""
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, CAST(l_linenumber AS BIGINT) AS order_item_id,
         CAST({SQL_PRODUCT_ID} AS VARCHAR) AS product_id, CAST({SQL_SELLER_ID} AS VARCHAR) AS seller_id,
         strftime(l_shipdate, {TS_TEXT}) AS shipping_limit_date, l_extendedprice AS price,
         CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE)
           AS freight_value
  FROM lineitem""",
    "products": """
  SELECT CAST(p_partkey AS VARCHAR) AS product_id,
         CASE WHEN p_partkey % 10 <> 0 THEN p_type END AS product_category_name,
         CAST(length(p_name) AS BIGINT) AS product_name_lenght,
         CAST(length(p_brand) AS BIGINT) AS product_description_lenght,
         CAST(1 AS BIGINT) AS product_photos_qty, CAST(p_size AS BIGINT) AS product_weight_g,
         CAST(p_size AS BIGINT) AS product_length_cm, CAST(p_size AS BIGINT) AS product_height_cm,
         CAST(p_size AS BIGINT) AS product_width_cm
  FROM part""",
    "sellers": """
  SELECT CAST(s_suppkey AS VARCHAR) AS seller_id, CAST(s_nationkey AS BIGINT) AS seller_zip_code_prefix,
         lower(s_name) AS seller_city, CAST(s_nationkey AS VARCHAR) AS seller_state
  FROM supplier""",
    "payments": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(part AS BIGINT) AS payment_sequential,
         'credit_card' AS payment_type, CAST(1 AS BIGINT) AS payment_installments,
         value AS payment_value
  FROM ({SQL_PAID})""",
    "reviews": f"""
  SELECT CAST(o_orderkey AS VARCHAR) AS review_id, CAST(o_orderkey AS VARCHAR) AS order_id,
         CAST(substring(o_orderpriority, 1, 1) AS BIGINT) AS review_score,
         {NULL_TEXT} AS review_comment_title, {NULL_TEXT} AS review_comment_message,
         strftime(o_orderdate, {TS_TEXT}) AS review_creation_date,
         {NULL_TEXT} AS review_answer_timestamp
  FROM orders WHERE o_orderstatus = 'F'""",
}


def _ts(col: str) -> str:
    return f"strptime({col}, {TS_TEXT}) AS {col}"


# Cleansed (staging) entities restated in SQL over the raw views.
STG_SQL = {
    "customers": """SELECT customer_id, customer_unique_id, customer_zip_code_prefix,
       upper(customer_city) AS customer_city, upper(customer_state) AS customer_state
  FROM raw_customers""",
    "orders": "SELECT order_id, customer_id, order_status, "
    + ", ".join(_ts(c) for c in clean.ORDER_DATES)
    + " FROM raw_orders",
    "order_items": "SELECT order_id, order_item_id, product_id, seller_id, "
    + _ts("shipping_limit_date")
    + ", price, freight_value FROM raw_order_items",
    "products": """SELECT product_id, COALESCE(product_category_name, 'unknown') AS product_category_name,
       product_name_lenght AS product_name_length,
       product_description_lenght AS product_description_length,
       product_photos_qty, product_weight_g, product_length_cm, product_height_cm, product_width_cm
  FROM raw_products""",
    "sellers": """SELECT seller_id, seller_zip_code_prefix, upper(seller_city) AS seller_city,
       upper(seller_state) AS seller_state FROM raw_sellers""",
    "payments": "SELECT * FROM raw_payments",
    "reviews": "SELECT review_id, order_id, review_score, review_comment_title, "
    "review_comment_message, "
    + ", ".join(_ts(c) for c in clean.REVIEW_DATES)
    + " FROM raw_reviews",
}


def with_raw(body: str, *entities: str, staged: bool = False) -> str:
    ctes = [f"raw_{e} AS ({RAW_SQL[e]})" for e in entities]
    if staged:
        ctes += [f"stg_{e} AS ({STG_SQL[e]})" for e in entities]
    body = body.strip()
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(ctes) + ",\n" + body[5:]
    return "WITH " + ",\n".join(ctes) + "\n" + body


def staged_entities(spark, sf):
    return {e: clean.clean_entity(e, df) for e, df in ad.raw_entities(spark, sf).items()}


def _register_cleaner(entity: str):
    @register(f"clean_{entity}", with_raw(f"SELECT * FROM stg_{entity}", entity, staged=True))
    def q(spark, sf):
        return clean.clean_entity(entity, ad.RAW[entity](spark, sf))

    q.__name__ = f"q_clean_{entity}"
    return q


for _entity in RETAIL_RULES.entity_order:
    _register_cleaner(_entity)


@register(
    "unparsable_dates",
    with_raw(
        "SELECT "
        + ", ".join(
            f"COUNT(*) FILTER (WHERE {c} IS NOT NULL AND try_strptime({c}, {TS_TEXT}) IS NULL) AS {c}"
            for c in clean.ORDER_DATES
        )
        + " FROM raw_orders",
        "orders",
    ),
)
def q_unparsable_dates(spark, sf):
    from strata.functions.columns import unparsable_dates

    return unparsable_dates(ad.raw_orders(spark, sf), clean.ORDER_DATES)


# ----------------------------------------------------------------------------
# G1-G7 gates as findings tables
# ----------------------------------------------------------------------------


def _payment_findings(table: str) -> str:
    """The four payment rules over ``table``: negative and NaN values fail."""
    rows = []
    for metric, fails in (("negative_count", True), ("zero_count", False), ("null_count", False), ("nan_count", True)):
        limit, passed = ("CAST(0 AS DOUBLE)", f"{metric} = 0") if fails else ("CAST(NULL AS DOUBLE)", "TRUE")
        rows.append(
            f"""SELECT 'payment_value' AS "check", 'payments' AS entity, 'payment_value' AS "column",
       '{metric}' AS metric, CAST({metric} AS DOUBLE) AS value, {limit} AS "limit", {passed} AS passed FROM c"""
        )
    return f"""c AS (SELECT COUNT(*) FILTER (WHERE payment_value < 0) AS negative_count,
                  COUNT(*) FILTER (WHERE payment_value = 0) AS zero_count,
                  COUNT(*) FILTER (WHERE payment_value IS NULL) AS null_count,
                  COUNT(*) FILTER (WHERE isnan(payment_value)) AS nan_count FROM {table})
""" + "\nUNION ALL ".join(rows)


@register("payment_value_checks", with_entities("WITH " + _payment_findings("pay"), "pay"))
def q_payment_value_checks(spark, sf):
    return checks.payment_value_checks(ad.core_payments(spark, sf))


@register(
    "payment_value_failures",
    with_entities(
        """
WITH odd AS (SELECT CASE WHEN order_id % 41 = 0 THEN CAST('nan' AS DOUBLE) WHEN order_id % 43 = 0 THEN -payment_value
                         WHEN order_id % 47 = 0 THEN 0 WHEN order_id % 53 = 0 THEN NULL ELSE payment_value END AS payment_value FROM pay),
"""
        + _payment_findings("odd"),
        "pay",
    ),
)
def q_payment_value_failures(spark, sf):
    """G1 on payments of which some are NaN, negative, zero or missing."""
    value, order = F.col("payment_value"), F.col("order_id")
    odd = F.when(order % 41 == 0, F.lit(float("nan"))).when(order % 43 == 0, -value).when(order % 47 == 0, F.lit(0.0)).when(order % 53 != 0, value)
    return checks.payment_value_checks(ad.core_payments(spark, sf).withColumn("payment_value", odd))


def _schema_oracle() -> str:
    parts = []
    for e, cols in RETAIL_RULES.schemas.items():
        values = ", ".join(f"('{c}', '{t}', {i})" for i, (c, t) in enumerate(cols.items()))
        parts.append(
            f"""SELECT '{e}' AS entity, x.column_name AS "column", x.expected_type,
       CASE d.column_type WHEN 'VARCHAR' THEN 'String' WHEN 'BIGINT' THEN 'Int64'
            WHEN 'DOUBLE' THEN 'Float64' ELSE lower(d.column_type) END AS actual_type
FROM (VALUES {values}) AS x(column_name, expected_type, pos)
LEFT JOIN (DESCRIBE raw_{e}) d USING (column_name)"""
        )
    body = "\nUNION ALL\n".join(parts)
    # As the query writes them: a column missing, one of another type, one more.
    odd = (
        "WITH odd_orders AS (SELECT * EXCLUDE (order_approved_at) FROM raw_orders), "
        "odd_payments AS (SELECT * REPLACE (CAST(payment_value AS VARCHAR) AS payment_value) FROM raw_payments), "
        "odd_sellers AS (SELECT *, 1 AS extra FROM raw_sellers)"
    )
    for e in ("orders", "payments", "sellers"):
        body = body.replace(f"DESCRIBE raw_{e})", f"DESCRIBE odd_{e})")
    return with_raw(
        odd + f"""
SELECT entity, "column", expected_type, actual_type,
       CASE WHEN actual_type IS NULL THEN 'missing_column'
            WHEN actual_type = expected_type THEN 'ok' ELSE 'type_mismatch' END AS status,
       COALESCE(actual_type = expected_type, FALSE) AS passed
FROM ({body}) s
""",
        *RETAIL_RULES.schemas,
    )


@register("schema_findings", _schema_oracle())
def q_schema_findings(spark, sf):
    """Raw written as Parquet, three entities with another schema than the
    rules have, and held against them by the footers of all part files."""
    raw = ad.raw_entities(spark, sf)
    raw["orders"] = raw["orders"].drop("order_approved_at")
    raw["payments"] = raw["payments"].withColumn("payment_value", F.col("payment_value").cast("string"))
    raw["sellers"] = raw["sellers"].withColumn("extra", F.lit(1))
    base = sources.scratch_path(spark, "schemas")
    for e in RETAIL_RULES.schemas:
        sources.write_parquet(raw[e], f"{base}/{e}")
    frames = [
        checks.schema_findings(spark, e, sources.parquet_schema(spark, f"{base}/{e}"), cols)
        for e, cols in RETAIL_RULES.schemas.items()
    ]
    sources.delete_path(spark, base)
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out.drop("_order")


def _pk_oracle() -> str:
    views = {
        "customers": "cust",
        "orders": "o",
        "products": "prod",
        "sellers": "sell",
        "reviews": "rev",
        "payments": "pay",
        "order_items": "items",
    }
    parts = []
    for e, key in RETAIL_RULES.primary_keys.items():
        k = ", ".join(key)
        parts.append(
            f"""SELECT '{e}' AS entity, '{",".join(key)}' AS "key",
       CAST(COALESCE(SUM(n), 0) AS BIGINT) AS "rows", COUNT(*) AS distinct_keys,
       COUNT(*) FILTER (WHERE n > 1) AS duplicated_keys,
       CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS surplus_rows,
       COALESCE(SUM(n - 1), 0) = 0 AS passed
FROM (SELECT {k}, COUNT(*) AS n FROM {views[e]} GROUP BY {k}) g"""
        )
    return with_entities("\nUNION ALL\n".join(parts), *views.values())


@register("pk_uniqueness", _pk_oracle())
def q_pk_uniqueness(spark, sf):
    ents = ad.core_entities(spark, sf)
    frames = [
        checks.primary_key_findings(ents[e], e, key)
        for e, key in RETAIL_RULES.primary_keys.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _null_rate_sql(e: str, c: str, t: float, layer: str = "stg") -> str:
    return f"""SELECT '{e}' AS entity, '{c}' AS "column",
       CASE WHEN COUNT(*) > 0 THEN CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / COUNT(*)
            ELSE 0.0 END AS null_rate,
       CAST({t} AS DOUBLE) AS threshold FROM {layer}_{e}"""


def _null_oracle() -> str:
    parts = [
        _null_rate_sql(e, c, t)
        for e, cols in RETAIL_RULES.null_thresholds.items()
        for c, t in cols.items()
    ]
    return with_raw(
        "SELECT *, null_rate <= threshold AS passed FROM ("
        + "\nUNION ALL\n".join(parts)
        + ") s",
        *RETAIL_RULES.null_thresholds,
        staged=True,
    )


@register("null_rates", _null_oracle())
def q_null_rates(spark, sf):
    ents = staged_entities(spark, sf)
    frames = [
        checks.null_rate_findings(ents[e], e, cols)
        for e, cols in RETAIL_RULES.null_thresholds.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _raw_null_oracle() -> str:
    parts = [
        _null_rate_sql(e, c, t, layer="raw")
        for e, cols in RETAIL_RULES.null_thresholds.items()
        for c, t in cols.items()
    ]
    return with_raw(
        "SELECT *, null_rate <= threshold AS passed FROM ("
        + "\nUNION ALL\n".join(parts)
        + ") s",
        *RETAIL_RULES.null_thresholds,
    )


@register("raw_null_rates", _raw_null_oracle())
def q_raw_null_rates(spark, sf):
    """G4 measured on Raw, before cleaning (``run_staging(raw_null_check=True)``)."""
    from strata.functions.columns import to_snake_case

    frames = [
        checks.null_rate_findings(to_snake_case(ad.RAW[e](spark, sf)), e, cols)
        for e, cols in RETAIL_RULES.null_thresholds.items()
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _quality_oracle() -> str:
    parts = []
    for e, key in RETAIL_RULES.primary_keys.items():
        k = ", ".join(key)
        parts.append(
            f"""SELECT 'primary_key' AS "check", '{e}' AS entity, '{",".join(key)}' AS "column",
       'duplicate_count' AS metric, CAST(COALESCE(SUM(n - 1), 0) AS DOUBLE) AS value,
       CAST(0 AS DOUBLE) AS "limit", COALESCE(SUM(n - 1), 0) = 0 AS passed
FROM (SELECT {k}, COUNT(*) AS n FROM stg_{e} GROUP BY {k}) g"""
        )
        for c, t in RETAIL_RULES.null_thresholds.get(e, {}).items():
            parts.append(
                f"""SELECT 'null_rate', entity, "column", 'null_rate', null_rate, threshold,
       null_rate <= threshold FROM ({_null_rate_sql(e, c, t)}) r"""
            )
    return with_raw("\nUNION ALL\n".join(parts), *RETAIL_RULES.primary_keys, staged=True)


@register("quality_gate", _quality_oracle())
def q_quality_gate(spark, sf):
    return checks.quality_findings(staged_entities(spark, sf), RETAIL_RULES).drop("_order")


SQL_SALES = (
    ORACLE["sales_performance"]
    .replace("\nSELECT month, gmv, order_count", ",\nsales AS (SELECT month, gmv, order_count")
    .replace("FROM gmv JOIN cnt USING (month)", "FROM gmv JOIN cnt USING (month))")
)


@register(
    "gmv_reconciliation",
    SQL_SALES
    + f"""
, t AS (SELECT (SELECT COALESCE(SUM(CAST(gmv AS {MONEY})), 0) FROM sales) AS a,
               (SELECT COALESCE(SUM(CAST(payment_value AS {MONEY})), 0) FROM pay) AS c)
SELECT CAST(a AS DOUBLE) AS analytics_gmv, CAST(c AS DOUBLE) AS core_payments_total,
       CAST(abs(a - c) AS DOUBLE) AS difference,
       abs(a - c) <= CAST({checks.GMV_TOLERANCE} AS {MONEY}) AS passed
FROM t
""",
)
def q_gmv_reconciliation(spark, sf):
    sales = q_sales_performance(spark, sf)
    return checks.gmv_reconciliation(sales, ad.core_payments(spark, sf))


SQL_SALES_CLV = (
    SQL_SALES.replace("cnt AS", "scnt AS").replace("JOIN cnt USING (month)", "JOIN scnt USING (month)")
    + """,
clvs AS (SELECT o.customer_id, CAST(SUM(CAST(pay.payment_value AS DECIMAL(20,4))) AS DOUBLE) AS clv
         FROM pay JOIN o USING (order_id) GROUP BY o.customer_id)
"""
)


@register(
    "key_nulls",
    SQL_SALES_CLV
    + """
SELECT *, null_count = 0 AS passed FROM (
  SELECT 'gmv' AS "column", COUNT(*) FILTER (WHERE gmv IS NULL) AS null_count FROM sales
  UNION ALL SELECT 'aov', COUNT(*) FILTER (WHERE aov IS NULL) FROM sales
  UNION ALL SELECT 'clv', COUNT(*) FILTER (WHERE clv IS NULL) FROM clvs) k
""",
)
def q_key_nulls(spark, sf):
    sales = q_sales_performance(spark, sf)
    clv = q_customer_lifetime_value(spark, sf)
    return checks.key_null_findings(sales, clv)


def _analytics_validation_oracle() -> str:
    return f"""
SELECT 'gmv_reconciliation' AS "check", CAST(NULL AS VARCHAR) AS "column",
       'difference' AS metric, difference AS value,
       CAST({float(checks.GMV_TOLERANCE)!r} AS DOUBLE) AS "limit", passed
FROM ({ORACLE['gmv_reconciliation']}) g
UNION ALL
SELECT 'null_check', "column", 'null_count', CAST(null_count AS DOUBLE), 0.0, passed
FROM ({ORACLE['key_nulls']}) k
"""


@register("analytics_validation", _analytics_validation_oracle())
def q_analytics_validation(spark, sf):
    return checks.analytics_validation_findings(
        q_sales_performance(spark, sf),
        q_customer_lifetime_value(spark, sf),
        ad.core_payments(spark, sf),
    )


# ----------------------------------------------------------------------------
# S1-S10 sources and sinks (scratch data goes under the shared checkpoint dir)
# ----------------------------------------------------------------------------


@register("csv_roundtrip", with_raw("SELECT * FROM raw_order_items", "order_items"))
def q_csv_roundtrip(spark, sf):
    path = sources.scratch_path(spark, "csv-order-items")
    sources.write_csv(ad.raw_order_items(spark, sf), path)
    return sources.read_csv(spark, path, RETAIL_RULES.struct_type("order_items"))


@register("csv_ingest_payments", with_raw("SELECT * FROM raw_payments", "payments"))
def q_csv_ingest_payments(spark, sf):
    base = sources.scratch_path(spark, "ingest")
    src = f"{base}/source/payments.csv"
    sources.write_csv(ad.raw_payments(spark, sf), src)
    info = sources.ingest_file(spark, src, f"{base}/raw", RETAIL_RULES.struct_type("payments"))
    return sources.read_parquet(spark, info["output_file_path"])


@register("parquet_roundtrip", with_entities("SELECT * FROM items", "items"))
def q_parquet_roundtrip(spark, sf):
    path = sources.scratch_path(spark, "parquet-order-items")
    sources.write_parquet(ad.core_order_items(spark, sf), path)
    return sources.read_parquet(spark, path)


@register("csv_separator", with_raw("SELECT * FROM raw_products", "products"))
def q_csv_separator(spark, sf):
    """A source whose separator is a semicolon."""
    path = sources.scratch_path(spark, "csv-products")
    sources.write_csv(ad.raw_products(spark, sf), path, sep=";")
    return sources.read_csv(spark, path, RETAIL_RULES.struct_type("products"), sep=";")


@register(
    "raw_completeness",
    "\nUNION ALL\n".join(
        f"SELECT '{t}.parquet' AS dataset, "
        f"CASE WHEN EXISTS (SELECT 1 FROM {t}) THEN 'ok' ELSE 'empty' END AS status"
        for t in ad.TABLES
    ),
)
def q_raw_completeness(spark, sf):
    return sources.raw_completeness(spark, sf, [f"{t}.parquet" for t in ad.TABLES])


# ----------------------------------------------------------------------------
# A1-A3 audit tables
# ----------------------------------------------------------------------------
_ENTITY_VIEWS = {
    "customers": "cust",
    "orders": "o",
    "order_items": "items",
    "products": "prod",
    "sellers": "sell",
    "payments": "pay",
    "reviews": "rev",
}


@register(
    "layer_metrics",
    with_entities(
        "\nUNION ALL\n".join(
            f"SELECT '{e}' AS entity, COUNT(*) AS row_count FROM {v}"
            for e, v in _ENTITY_VIEWS.items()
        ),
        *_ENTITY_VIEWS.values(),
    ),
)
def q_layer_metrics(spark, sf):
    return audit.entity_row_counts(ad.core_entities(spark, sf))


_RECON_METRICS = [
    "total_orders_checked",
    "orders_passed",
    "orders_failed",
    "max_difference",
    "tolerance_used",
    "excluded_order_count",
]


def _core_quality_oracle() -> str:
    dedup = (
        "SELECT 'deduplication' AS card, entity, CAST(NULL AS VARCHAR) AS \"column\", "
        "'removed_count' AS metric, CAST(surplus_rows AS DOUBLE) AS value "
        f"FROM ({ORACLE['pk_uniqueness']}) d"
    )
    fk = (
        "SELECT 'foreign_key_validation', entity, \"column\", 'removed_count', "
        f"CAST(removed_count AS DOUBLE) FROM ({ORACLE['fk_report']}) f"
    )
    recon = "\nUNION ALL\n".join(
        f"SELECT 'financial_reconciliation', 'orders', CAST(NULL AS VARCHAR), '{m}', "
        f"CAST({m} AS DOUBLE) FROM ({ORACLE['reconciliation_summary']}) r"
        for m in _RECON_METRICS
    )
    return f"{dedup}\nUNION ALL\n{fk}\nUNION ALL\n{recon}"


@register("core_quality", _core_quality_oracle())
def q_core_quality(spark, sf):
    ents = ad.core_entities(spark, sf)
    dedup = audit._union(
        [
            dedupe.duplicate_summary(ents[e], key).select(
                F.lit(e).alias("entity"), F.col("surplus_rows").alias("removed_count")
            )
            for e, key in RETAIL_RULES.primary_keys.items()
        ]
    )
    fk_report = q_fk_report(spark, sf)
    summary = q_reconciliation_summary(spark, sf)
    return audit.core_quality_report(dedup, fk_report, summary)


# The same tables by one aggregate over key unions, without row joins.
@register("fk_report_by_key", ORACLE["fk_report"])
def q_fk_report_by_key(spark, sf):
    return keys.relationship_counts(fk_entities(spark, sf), RETAIL_RULES)


@register("fk_orphans_by_key", ORACLE["fk_orphans"])
def q_fk_orphans_by_key(spark, sf):
    return keys.relationship_missing(fk_entities(spark, sf), RETAIL_RULES)


@register("core_quality_by_key", ORACLE["core_quality"])
def q_core_quality_by_key(spark, sf):
    dedup = dedupe.surplus_by_entity(ad.core_entities(spark, sf), RETAIL_RULES.primary_keys)
    return audit.core_quality_report(dedup, q_fk_report_by_key(spark, sf), q_reconciliation_summary(spark, sf))


def _report_ranges_oracle() -> str:
    parts = []
    for name, cols in audit.REPORT_VALUE_COLUMNS.items():
        for c in cols:
            parts.append(
                f"SELECT '{name}' AS report, '{c}' AS \"column\", COUNT(*) AS row_count, "
                f"CAST(MIN({c}) AS DOUBLE) AS min_value, CAST(MAX({c}) AS DOUBLE) AS max_value "
                f"FROM ({ORACLE[name]}) t"
            )
    return "\nUNION ALL\n".join(parts)


@register("report_ranges", _report_ranges_oracle())
def q_report_ranges(spark, sf):
    return audit.report_ranges(
        {
            name: (QUERIES[name](spark, sf), cols)
            for name, cols in audit.REPORT_VALUE_COLUMNS.items()
        }
    )


# ----------------------------------------------------------------------------
# Incremental ingest (Structured Streaming file source, availableNow)
# ----------------------------------------------------------------------------


@register("stream_ingest_payments", with_raw("SELECT * FROM raw_payments", "payments"))
def q_stream_ingest_payments(spark, sf):
    from strata.streaming import ingest_stream

    base = sources.scratch_path(spark, "stream-ingest")
    sources.write_csv(ad.raw_payments(spark, sf).repartition(4), f"{base}/source")
    ingest_stream(
        spark,
        f"{base}/source",
        f"{base}/raw",
        "payments",
        RETAIL_RULES.struct_type("payments"),
        checkpoint=f"{base}/checkpoint",
        multiline="payments" in RETAIL_RULES.multiline_entities,
    )
    return sources.read_parquet(spark, f"{base}/raw/payments").drop("batch_id")


# ----------------------------------------------------------------------------
# P1-P4 single column functions on whole tables
# ----------------------------------------------------------------------------


@register("snake_case", "SELECT * FROM customer")
def q_snake_case(spark, sf):
    from strata.functions.columns import to_snake_case

    # Display-style names (spaces, hyphens, case, padding) back to snake_case.
    display = ["C CustKey", "C Name", "C-NationKey", " C AcctBal ", "C MktSegment"]
    return to_snake_case(ad.table(spark, sf, "customer").toDF(*display))


@register(
    "uppercase_named",
    "SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, c_acctbal, "
    "upper(lower(c_mktsegment)) AS c_mktsegment FROM customer",
)
def q_uppercase_named(spark, sf):
    from strata.functions.columns import uppercase_columns

    df = ad.table(spark, sf, "customer").withColumn("c_mktsegment", F.lower("c_mktsegment"))
    return uppercase_columns(df, ["c_name", "c_mktsegment"])


@register(
    "parse_dates",
    f"SELECT o_orderkey, strptime(strftime(o_orderdate, {TS_TEXT}), {TS_TEXT}) AS o_orderdate "
    "FROM orders",
)
def q_parse_dates(spark, sf):
    from strata.functions.columns import TIMESTAMP_PATTERN, parse_dates

    text = ad.table(spark, sf, "orders").select(
        "o_orderkey", F.date_format("o_orderdate", TIMESTAMP_PATTERN).alias("o_orderdate")
    )
    return parse_dates(text, ["o_orderdate"])


@register(
    "fill_null",
    with_entities(
        """
SELECT o.order_id, COALESCE(CAST(rev.review_score AS VARCHAR), 'unreviewed') AS review_label
FROM o LEFT JOIN rev USING (order_id)
""",
        "o",
        "rev",
    ),
)
def q_fill_null(spark, sf):
    from strata.functions.columns import fill_null_with

    labels = ad.core_orders(spark, sf).join(ad.core_reviews(spark, sf), "order_id", "left").select(
        "order_id", F.col("review_score").cast("string").alias("review_label")
    )
    return fill_null_with(labels, "review_label", "unreviewed")


# ----------------------------------------------------------------------------
# L1-L4 layer runners end to end over the driver tables
# ----------------------------------------------------------------------------
# The driver tables are written as the seven source CSVs (one folder of part
# files each) and run through Raw, Staging, Core and Analytics.  Two rule
# parameters differ from the library defaults, as in the other registry
# queries: order items (whose keys repeat in the driver tables) keep the
# latest shipping date, and reconciliation uses the registry's tolerance.
LAYER_RULES = RETAIL_RULES.__class__(
    **{
        **RETAIL_RULES.__dict__,
        "tiebreakers": {**RETAIL_RULES.tiebreakers, "order_items": ITEM_TIEBREAKER},
        "tolerance": RECON_TOLERANCE,
    }
)


# The Core tables of a layered run over the staged ones: deduplicated items,
# foreign keys, order totals (cmp), orders without items (exc), and the tables
# without the quarantined orders under the names the report SQL reads.
SQL_LAYERS = f"""
WITH d_items AS (
  SELECT order_id, order_item_id, product_id, seller_id, shipping_limit_date, price, freight_value
  FROM (SELECT *, ROW_NUMBER() OVER (
          PARTITION BY order_id, order_item_id
          ORDER BY shipping_limit_date DESC NULLS LAST, product_id DESC NULLS LAST,
                   seller_id DESC NULLS LAST, price DESC NULLS LAST,
                   freight_value DESC NULLS LAST) AS rn
        FROM stg_order_items) r
  WHERE rn = 1),
o2 AS (SELECT * FROM stg_orders o
       WHERE EXISTS (SELECT 1 FROM stg_customers c WHERE c.customer_id = o.customer_id)),
items2 AS (SELECT * FROM d_items i
           WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = i.order_id)
             AND EXISTS (SELECT 1 FROM stg_products p WHERE p.product_id = i.product_id)
             AND EXISTS (SELECT 1 FROM stg_sellers s WHERE s.seller_id = i.seller_id)),
pay2 AS (SELECT * FROM stg_payments p WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = p.order_id)),
e AS (SELECT order_id, SUM(CAST(price AS {MONEY}) + CAST(freight_value AS {MONEY})) AS e
      FROM items2 GROUP BY order_id),
a AS (SELECT order_id, SUM(CAST(payment_value AS {MONEY})) AS a FROM pay2 GROUP BY order_id),
cmp AS (SELECT order_id, abs(COALESCE(e, 0) - COALESCE(a, 0)) AS d
        FROM e LEFT JOIN a USING (order_id)),
exc AS (SELECT order_id FROM a
        WHERE order_id IS NOT NULL AND order_id NOT IN (SELECT order_id FROM e WHERE order_id IS NOT NULL)),
bad AS (SELECT order_id FROM cmp WHERE d > CAST({RECON_TOLERANCE!r} AS {MONEY})
        UNION ALL SELECT order_id FROM exc),
o AS (SELECT * FROM o2 WHERE order_id NOT IN (SELECT order_id FROM bad)),
items AS (SELECT * FROM items2 WHERE order_id NOT IN (SELECT order_id FROM bad)),
pay AS (SELECT * FROM pay2 WHERE order_id NOT IN (SELECT order_id FROM bad)),
rev AS (SELECT * FROM stg_reviews r WHERE EXISTS (SELECT 1 FROM o2 WHERE o2.order_id = r.order_id))
"""


def _layered_core_quality_oracle() -> str:
    keys_of = LAYER_RULES.primary_keys
    dedup = "\nUNION ALL\n".join(
        f"""SELECT 'deduplication' AS card, '{e}' AS entity, CAST(NULL AS VARCHAR) AS "column",
       'removed_count' AS metric,
       CAST((SELECT COUNT(*) FROM stg_{e})
            - (SELECT COUNT(*) FROM (SELECT DISTINCT {", ".join(k)} FROM stg_{e}) d) AS DOUBLE)
         AS value"""
        for e, k in keys_of.items()
    )
    children = {"orders": "stg_orders", "order_items": "d_items", "payments": "stg_payments",
                "reviews": "stg_reviews"}
    parents = {"customers": "stg_customers", "orders": "o2", "products": "stg_products",
               "sellers": "stg_sellers"}
    fk = "\nUNION ALL\n".join(
        f"""SELECT 'foreign_key_validation', '{e}', '{fk.column}', 'removed_count',
       CAST(COUNT(*) FILTER (WHERE NOT EXISTS (
         SELECT 1 FROM {parents[fk.parent]} p WHERE p.{fk.parent_column} = c.{fk.column})) AS DOUBLE)
FROM {children[e]} c"""
        for e in LAYER_RULES.fk_order()
        for fk in LAYER_RULES.foreign_keys[e]
    )
    metrics = {
        "total_orders_checked": "(SELECT COUNT(*) FROM cmp)",
        "orders_passed": "(SELECT COUNT(*) FROM cmp WHERE d <= CAST(" + repr(RECON_TOLERANCE)
        + f" AS {MONEY}))",
        "orders_failed": "(SELECT COUNT(*) FROM cmp WHERE d > CAST(" + repr(RECON_TOLERANCE)
        + f" AS {MONEY}))",
        "max_difference": "(SELECT MAX(d) FROM cmp)",
        "tolerance_used": repr(RECON_TOLERANCE),
        "excluded_order_count": "(SELECT COUNT(*) FROM exc)",
    }
    recon = "\nUNION ALL\n".join(
        f"SELECT 'financial_reconciliation', 'orders', CAST(NULL AS VARCHAR), '{m}', "
        f"CAST({v} AS DOUBLE)"
        for m, v in metrics.items()
    )
    return with_raw(
        f"{SQL_LAYERS}\n{dedup}\nUNION ALL\n{fk}\nUNION ALL\n{recon}",
        *LAYER_RULES.entity_order, staged=True,
    )


def _layered_report_oracle(body: str) -> str:
    """A report's SQL (``WITH …``) over the Core tables of a layered run."""
    return with_raw(
        f"{SQL_LAYERS.rstrip()},\n{body.strip()[5:]}", *LAYER_RULES.entity_order, staged=True
    )


def _write_sources(spark, sf) -> str:
    """The seven source CSVs under a fresh root."""
    from strata.plans.layers import run_in_order

    root = sources.scratch_path(spark, "layers")
    run_in_order(
        [partial(sources.write_csv, fn(spark, sf), f"{root}/source/{e}.csv") for e, fn in ad.RAW.items()]
    )
    return root


def _layered_root(spark, sf) -> str:
    """A root all four layers have run over."""
    from strata.plans.layers import run_layers

    root = _write_sources(spark, sf)
    run_layers(spark, root, LAYER_RULES, on_quality_failure="warn")
    return root


@register("layered_core_quality", _layered_core_quality_oracle())
def q_layered_core_quality(spark, sf):
    """L3: the report that the last finished Core run wrote."""
    from strata.plans.layers import LayerPaths, current_core

    paths = current_core(spark, LayerPaths(_layered_root(spark, sf)))
    return sources.read_parquet(spark, paths.core_audit("core_quality"))


@register("layered_quality_findings", _quality_oracle())
def q_layered_quality_findings(spark, sf):
    """L2: the findings table that the staging layer wrote."""
    from strata.plans.layers import LayerPaths, run_raw, run_staging

    paths = LayerPaths(_write_sources(spark, sf))
    run_raw(spark, paths, LAYER_RULES)
    run_staging(spark, paths, LAYER_RULES, on_quality_failure="warn")
    return sources.read_parquet(spark, paths.audit("quality_findings")).drop("_order")


@register("layered_customer_lifetime_value", _layered_report_oracle(CLV_BODY))
def q_layered_customer_lifetime_value(spark, sf):
    """L4: B2 as the analytics layer wrote it, from reconciled orders and payments."""
    from strata.plans.layers import LayerPaths

    paths = LayerPaths(_layered_root(spark, sf))
    return sources.read_parquet(spark, paths.analytics("customer_lifetime_value"))


@register("layered_seller_performance", _layered_report_oracle(_item_perf_body("seller_id")))
def q_layered_seller_performance(spark, sf):
    """L4: B3 as the analytics layer wrote it, from reconciled items and the reviews
    that passed their foreign key."""
    from strata.plans.layers import LayerPaths

    paths = LayerPaths(_layered_root(spark, sf))
    return sources.read_parquet(spark, paths.analytics("seller_performance"))
