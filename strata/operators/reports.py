"""Analytics reports B1-B5.

Plan shape shared by all five: aggregate the fact side per order *before* any
join (partial aggregation on the map side, so a hot order, seller or customer
collapses to one row per task), join one-row-per-key frames, then a final
small aggregation.  No report joins two raw fact tables row by row.

Money is summed as decimals (exact, independent of shuffle order) and
returned as double, the reference's type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.columns import MONEY_TYPE, money, month_index, month_label_of


def _zero():
    return F.lit(0).cast(MONEY_TYPE)


def _paid_per_order(payments: DataFrame) -> DataFrame:
    """order_id -> exact paid sum and payment row count (pre-aggregation)."""
    return payments.groupBy("order_id").agg(
        F.sum(money("payment_value")).alias("_paid"),
        F.count(F.lit(1)).alias("_n_pay"),
    )


def _distinct_count(col: str, null_aware: bool):
    """Count of distinct values over rows that are already distinct per value.
    ``null_aware`` counts a null key as one more value, as the reference does."""
    c = F.count(F.col(col))
    if null_aware:
        c = c + F.max(F.col(col).isNull()).cast("long")
    return c


# ------------------------------------------------------------------ B1


def sales_performance(
    orders: DataFrame, payments: DataFrame, null_aware: bool = False
) -> DataFrame:
    """B1: month, gmv, order_count, aov.

    gmv sums the payments of the month's orders; order_count counts the
    month's distinct orders, paid or not; a month with no payment row at all
    is left out (the reference's inner join), and so are orders without a
    purchase time, which have no month (``undated_orders`` counts them).
    """
    per_order = (
        orders.filter(F.col("order_purchase_timestamp").isNotNull())
        .select("order_id", month_index("order_purchase_timestamp").alias("_mi"))
        .join(_paid_per_order(payments), "order_id", "left")
        # one row per (month, order): the distinct count below becomes a count
        .groupBy("_mi", "order_id")
        .agg(F.sum("_paid").alias("_paid"), F.sum("_n_pay").alias("_n_pay"))
    )
    monthly = (
        per_order.groupBy("_mi")
        .agg(
            F.coalesce(F.sum("_paid"), _zero()).cast("double").alias("gmv"),
            _distinct_count("order_id", null_aware).alias("order_count"),
            F.sum("_n_pay").alias("_n_pay"),
        )
        .filter(F.col("_n_pay") > 0)
    )
    return monthly.orderBy("_mi").select(
        month_label_of("_mi").alias("month"),
        "gmv",
        "order_count",
        (F.col("gmv") / F.col("order_count")).alias("aov"),
    )


# ------------------------------------------------------------------ B2


def customer_lifetime_value(
    orders: DataFrame, payments: DataFrame, null_aware: bool = False
) -> DataFrame:
    """B2: customer_id, clv, order_count, avg_order_value.

    Payments of unknown orders are dropped; a customer with orders but no
    payment row is left out; order_count counts all the customer's orders.
    Orders without a customer belong to no row.
    """
    per_order = (
        orders.filter(F.col("customer_id").isNotNull())
        .select("order_id", "customer_id")
        .join(_paid_per_order(payments), "order_id", "left")
        .groupBy("customer_id", "order_id")
        .agg(F.sum("_paid").alias("_paid"), F.sum("_n_pay").alias("_n_pay"))
    )
    per_customer = (
        per_order.groupBy("customer_id")
        .agg(
            F.coalesce(F.sum("_paid"), _zero()).cast("double").alias("clv"),
            _distinct_count("order_id", null_aware).alias("order_count"),
            F.sum("_n_pay").alias("_n_pay"),
        )
        .filter(F.col("_n_pay") > 0)
    )
    return per_customer.select(
        "customer_id",
        "clv",
        "order_count",
        (F.col("clv") / F.col("order_count")).alias("avg_order_value"),
    ).orderBy(F.desc("clv"), "customer_id")


# -------------------------------------------------------------- B3 / B4


def item_performance(
    order_items: DataFrame, reviews: DataFrame, key: str, null_aware: bool = False
) -> DataFrame:
    """Shared body of B3/B4: key, revenue, order_count, avg_review_score.

    revenue = sum of item prices; order_count = distinct orders; the review
    average is over reviews of the key's distinct orders (one review counts
    once per (order, key) pair, never once per item), null when unreviewed.
    Reviews are reduced to (sum, count) per order before the join, so the
    many-to-many join of the reference becomes a one-row-per-order lookup.
    """
    pairs = order_items.groupBy(key, "order_id").agg(F.sum(money("price")).alias("_rev"))
    review_stats = reviews.groupBy("order_id").agg(
        F.sum("review_score").alias("_score_sum"),
        F.count("review_score").alias("_score_n"),
    )
    per_key = (
        pairs.join(review_stats, "order_id", "left")
        .groupBy(key)
        .agg(
            F.coalesce(F.sum("_rev"), _zero()).cast("double").alias("revenue"),
            _distinct_count("order_id", null_aware).alias("order_count"),
            F.sum("_score_sum").alias("_score_sum"),
            F.sum("_score_n").alias("_score_n"),
        )
    )
    return per_key.select(
        key,
        "revenue",
        "order_count",
        # A null key matches no review in the reference's join by key.
        F.when(
            F.col(key).isNotNull(),
            F.try_divide(F.col("_score_sum").cast("double"), F.col("_score_n")),
        ).alias("avg_review_score"),
    ).orderBy(F.desc("revenue"), key)


def seller_performance(order_items: DataFrame, reviews: DataFrame) -> DataFrame:
    """seller_id, revenue, order_count, avg_review_score."""
    return item_performance(order_items, reviews, "seller_id")


def product_performance(order_items: DataFrame, reviews: DataFrame) -> DataFrame:
    """product_id, revenue, order_count, avg_review_score."""
    return item_performance(order_items, reviews, "product_id")


# ------------------------------------------------------------------ B5


def customer_retention(
    orders: DataFrame,
    customer_key: str = "customer_id",
    calendar: bool = False,
) -> DataFrame:
    """cohort_month, activity_month, active_customers, cohort_size,
    retention_rate, with explicit zero rows for every month >= the cohort.

    ``calendar=False`` (the reference): the months are those observed in the
    data.  ``calendar=True``: every calendar month up to the last one.
    Orders without a purchase time or a customer are left out.

    Plan: one linear chain, so the orders are read and shuffled once.
      1. by customer: first month and set of active months (partial
         aggregation; the set is bounded by the months the data spans, not
         by the row count, so a customer holding a third of all orders is
         still one small row);
      2. by (cohort, month): active customers;
      3. by cohort: a map month -> active customers.  From here on there is
         one row per cohort, so at most one row per month of the data;
      4. a window over those few rows gives the last month and the observed
         months (every observed month has an active customer);
      5. each cohort row expands to its months with ``sequence`` and reads
         its counts from its own map: no grid join, no cross join, and the
         cohort size is the count of the cohort's own first month.
    """
    known = F.col("order_purchase_timestamp").isNotNull() & F.col(customer_key).isNotNull()
    dated = orders.filter(known).select(
        F.col(customer_key).alias("_cust"),
        month_index("order_purchase_timestamp").alias("_mi"),
    )
    per_customer = dated.groupBy("_cust").agg(
        F.min("_mi").alias("_cohort"),
        F.collect_set("_mi").alias("_months"),
    )
    activity = (
        per_customer.select("_cohort", F.explode("_months").alias("_active"))
        .groupBy("_cohort", "_active")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    per_cohort = activity.groupBy("_cohort").agg(
        F.map_from_entries(F.collect_list(F.struct("_active", "_n"))).alias("_counts"),
        F.max("_active").alias("_cohort_last"),
        F.collect_list("_active").alias("_seen"),
    )
    # One partition for this window is fine: it holds one row per cohort.
    everything = Window.partitionBy()
    grid = per_cohort.select(
        "_cohort",
        "_counts",
        F.max("_cohort_last").over(everything).alias("_last"),
        F.array_distinct(F.flatten(F.collect_list("_seen").over(everything))).alias("_observed"),
    ).select(
        "_cohort", "_counts", "_observed", F.explode(F.sequence("_cohort", "_last")).alias("_active")
    )
    if not calendar:
        grid = grid.filter(F.array_contains("_observed", F.col("_active")))

    return (
        grid.select(
            "_cohort",
            "_active",
            F.coalesce(F.element_at("_counts", F.col("_active")), F.lit(0).cast("long")).alias(
                "active_customers"
            ),
            F.element_at("_counts", F.col("_cohort")).alias("cohort_size"),
        )
        .orderBy("_cohort", "_active")
        .select(
            month_label_of("_cohort").alias("cohort_month"),
            month_label_of("_active").alias("activity_month"),
            "active_customers",
            "cohort_size",
        )
        .withColumn(
            "retention_rate",
            F.col("active_customers").cast("double") / F.col("cohort_size"),
        )
    )


def undated_orders(orders: DataFrame) -> DataFrame:
    """One row, ``orders_without_purchase_time``: the orders B5 leaves out
    (the reference cannot place them in a month either).  One aggregate over
    the timestamp column."""
    return orders.agg(
        F.count_if(F.col("order_purchase_timestamp").isNull()).alias(
            "orders_without_purchase_time"
        )
    )
