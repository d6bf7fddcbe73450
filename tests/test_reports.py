from datetime import datetime

import pytest

from strata.operators import reports


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


def test_sales_performance_by_month(orders, payments):
    out = reports.sales_performance(orders, payments)
    assert out.columns == ["month", "gmv", "order_count", "aov"]
    assert rows(out, "month", "gmv", "order_count", "aov") == [
        ("2024-01", 100.0, 1, 100.0),
        ("2024-02", 50.0, 1, 50.0),
        ("2024-03", 200.0, 1, 200.0),
    ]


def test_sales_performance_counts_unpaid_orders_and_drops_unpaid_months(spark):
    orders = spark.createDataFrame(
        [
            ("o1", "c1", datetime(2024, 1, 1)),
            ("o2", "c1", datetime(2024, 1, 2)),
            ("o3", "c2", datetime(2024, 2, 1)),
        ],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    payments = spark.createDataFrame(
        [("o1", 30.0), ("o1", 10.0), ("zz", 99.0)], "order_id string, payment_value double"
    )
    out = rows(reports.sales_performance(orders, payments), "month", "gmv", "order_count", "aov")
    # o2 is unpaid but counted; February has no payment row and vanishes;
    # the payment of an unknown order is dropped.
    assert out == [("2024-01", 40.0, 2, 20.0)]


def test_sales_performance_all_null_payments_sum_to_zero(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", datetime(2024, 1, 1))],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    payments = spark.createDataFrame([("o1", None)], "order_id string, payment_value double")
    assert rows(reports.sales_performance(orders, payments), "gmv") == [(0.0,)]


def test_customer_lifetime_value_two_orders(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", datetime(2024, 1, 1)), ("o2", "c1", datetime(2024, 2, 1)),
         ("o3", "c2", datetime(2024, 2, 1))],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    payments = spark.createDataFrame(
        [("o1", 60.0), ("o2", 40.0), ("o3", 10.0)], "order_id string, payment_value double"
    )
    out = reports.customer_lifetime_value(orders, payments)
    assert out.columns == ["customer_id", "clv", "order_count", "avg_order_value"]
    assert rows(out, "customer_id", "clv", "order_count", "avg_order_value") == [
        ("c1", 100.0, 2, 50.0),
        ("c2", 10.0, 1, 10.0),
    ]


def test_product_performance_revenue_and_orders(order_items, reviews):
    out = reports.product_performance(order_items, reviews)
    assert out.columns == ["product_id", "revenue", "order_count", "avg_review_score"]
    got = {r["product_id"]: (r["revenue"], r["order_count"], r["avg_review_score"]) for r in out.collect()}
    # p1: 50 + 50 + 30 over o1, o3; only o1 reviewed (5), counted once.
    assert got["p1"] == (130.0, 2, 5.0)
    assert got["p2"] == (80.0, 1, 3.0)


def test_seller_performance_unreviewed_is_null_not_zero(spark, order_items):
    reviews = spark.createDataFrame([("unknown", 4)], "order_id string, review_score bigint")
    out = {r["seller_id"]: r["avg_review_score"] for r in
           reports.seller_performance(order_items, reviews).collect()}
    assert out == {"s1": None, "s2": None}


def test_seller_performance_sorted_by_revenue(order_items, reviews):
    out = rows(reports.seller_performance(order_items, reviews), "seller_id", "revenue")
    assert out == [("s1", 130.0), ("s2", 80.0)]


def _orders(spark, data):
    return spark.createDataFrame(
        [(f"o{i}", c, ts) for i, (c, ts) in enumerate(data)],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )


def test_retention_cohort_is_first_month(spark):
    out = reports.customer_retention(
        _orders(spark, [("c1", datetime(2024, 1, 15)), ("c1", datetime(2024, 3, 10))])
    )
    cohorts = {r["cohort_month"] for r in out.collect()}
    assert cohorts == {"2024-01"}


def test_retention_zero_months_appear(spark):
    out = reports.customer_retention(
        _orders(spark, [("c1", datetime(2024, 1, 10)), ("c2", datetime(2024, 2, 20))])
    )
    assert out.columns == [
        "cohort_month", "activity_month", "active_customers", "cohort_size", "retention_rate"
    ]
    assert rows(out, "cohort_month", "activity_month", "active_customers", "retention_rate") == [
        ("2024-01", "2024-01", 1, 1.0),
        ("2024-01", "2024-02", 0, 0.0),
        ("2024-02", "2024-02", 1, 1.0),
    ]


def test_retention_rate_one_in_own_month(spark):
    out = reports.customer_retention(
        _orders(spark, [("c1", datetime(2024, 1, 5)), ("c2", datetime(2024, 1, 12)),
                        ("c3", datetime(2024, 1, 20))])
    )
    assert rows(out, "cohort_size", "retention_rate") == [(3, 1.0)]


def test_retention_observed_months_vs_calendar(spark):
    data = [("c1", datetime(2024, 1, 5)), ("c1", datetime(2024, 3, 5))]
    observed = rows(reports.customer_retention(_orders(spark, data)), "activity_month")
    calendar = rows(reports.customer_retention(_orders(spark, data), calendar=True), "activity_month")
    assert observed == [("2024-01",), ("2024-03",)]
    assert calendar == [("2024-01",), ("2024-02",), ("2024-03",)]


def test_retention_hot_customer_single_row(spark):
    # One customer holds most orders: still one cohort row per month.
    data = [("hot", datetime(2024, 1 + i % 3, 1 + i % 28)) for i in range(300)]
    data.append(("cold", datetime(2024, 2, 1)))
    out = rows(reports.customer_retention(_orders(spark, data)),
               "cohort_month", "activity_month", "active_customers", "cohort_size")
    assert out == [
        ("2024-01", "2024-01", 1, 1),
        ("2024-01", "2024-02", 1, 1),
        ("2024-01", "2024-03", 1, 1),
        ("2024-02", "2024-02", 1, 1),
        ("2024-02", "2024-03", 0, 1),
    ]


@pytest.mark.parametrize("null_aware,expected", [(False, 1), (True, 2)])
def test_null_aware_distinct_count(spark, null_aware, expected):
    orders = spark.createDataFrame(
        [("o1", "c1", datetime(2024, 1, 1)), (None, "c1", datetime(2024, 1, 2))],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    payments = spark.createDataFrame([("o1", 5.0)], "order_id string, payment_value double")
    out = reports.sales_performance(orders, payments, null_aware=null_aware)
    assert rows(out, "order_count") == [(expected,)]


def test_undated_orders_are_left_out_and_counted(spark):
    from datetime import datetime

    from strata.operators import reports as R

    orders = spark.createDataFrame(
        [("o1", "c1", "delivered", datetime(2024, 1, 5)), ("o2", "c1", "delivered", None),
         ("o3", "c2", "delivered", None)],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz",
    )
    rows = R.customer_retention(orders).collect()
    assert [(r["cohort_month"], r["cohort_size"]) for r in rows] == [("2024-01", 1)]
    assert R.undated_orders(orders).first()["orders_without_purchase_time"] == 2


def test_orders_without_month_customer_or_key_make_no_rows(spark):
    from datetime import datetime

    from strata.operators import reports

    orders = spark.createDataFrame(
        [("o1", "c1", datetime(2024, 1, 5)), ("o2", None, None)],
        "order_id string, customer_id string, order_purchase_timestamp timestamp_ntz",
    )
    paid = spark.createDataFrame([("o1", 10.0), ("o2", 55.0)], "order_id string, payment_value double")
    assert [r["month"] for r in reports.sales_performance(orders, paid).collect()] == ["2024-01"]
    assert [r["customer_id"] for r in reports.customer_lifetime_value(orders, paid).collect()] == ["c1"]
    items = spark.createDataFrame([("o1", None, 3.0)], "order_id string, seller_id string, price double")
    reviews = spark.createDataFrame([("o1", 5)], "order_id string, review_score int")
    row = reports.item_performance(items, reviews, "seller_id").first()
    assert row["revenue"] == 3.0 and row["avg_review_score"] is None


def test_retention_leaves_out_orders_without_a_customer(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "2017-01-05 00:00:00"), ("o2", None, "2017-01-06 00:00:00")],
        "order_id string, customer_id string, at string",
    ).selectExpr("order_id", "customer_id", "CAST(at AS timestamp_ntz) AS order_purchase_timestamp")
    rows = reports.customer_retention(orders).collect()
    assert [(r["cohort_month"], r["cohort_size"], r["active_customers"]) for r in rows] == [("2017-01", 1, 1)]
