from datetime import datetime

import pytest

from strata.functions import columns as C
from strata.operators import clean


def test_snake_case_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`Customer ID` int, `order-date` int, ` Price ` int")
    assert C.to_snake_case(df).columns == ["customer_id", "order_date", "price"]


def test_snake_case_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], "`a b` int, `a-b` int")
    with pytest.raises(ValueError, match="collide"):
        C.to_snake_case(df)


def test_uppercase_named_columns_only(spark):
    df = spark.createDataFrame([("são paulo", "sp", "delivered")], "city string, state string, status string")
    r = C.uppercase_columns(df, ["city", "state"]).first()
    assert (r["city"], r["state"], r["status"]) == ("SÃO PAULO", "SP", "delivered")


def test_uppercase_missing_column_raises(spark):
    df = spark.createDataFrame([("a",)], "city string")
    with pytest.raises(ValueError, match="not found"):
        C.uppercase_columns(df, ["nope"])


def test_parse_dates_strict_and_null_safe(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00",), (None,)], "ts string")
    out = C.parse_dates(df, ["ts"])
    assert dict(out.dtypes)["ts"] == "timestamp_ntz"
    assert [r["ts"] for r in out.collect()] == [datetime(2024, 1, 15, 10, 30), None]


def test_parse_dates_malformed_raises(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00",), ("NOT A DATE",)], "ts string")
    with pytest.raises(Exception):
        C.parse_dates(df, ["ts"]).collect()


def test_parse_dates_date_only_raises(spark):
    df = spark.createDataFrame([("2024-01-15",)], "ts string")
    with pytest.raises(Exception):
        C.parse_dates(df, ["ts"]).collect()


def test_unparsable_dates_counts_without_raising(spark):
    df = spark.createDataFrame([("2024-01-15 10:30:00",), ("NOT A DATE",), (None,)], "ts string")
    assert C.unparsable_dates(df, ["ts"]).first()["ts"] == 1


def test_fill_null_one_column(spark):
    df = spark.createDataFrame([(None, None), ("x", None)], "cat string, other string")
    out = C.fill_null_with(df, "cat", "unknown").collect()
    assert [(r["cat"], r["other"]) for r in out] == [("unknown", None), ("x", None)]


def test_rename_strict_raises_on_absent_name(spark):
    df = spark.createDataFrame([(1,)], "a int")
    with pytest.raises(ValueError):
        C.rename_strict(df, {"b": "c"})


def test_month_label(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 1, 0, 0),)], "ts timestamp_ntz")
    assert df.select(C.month_label("ts").alias("m")).first()["m"] == "2024-03"


def test_clean_customers_keeps_zip(spark):
    df = spark.createDataFrame(
        [("c1", "u1", 1001, "sao paulo", "sp")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix bigint, "
        "customer_city string, customer_state string",
    )
    r = clean.clean_customers(df).first()
    assert (r["customer_city"], r["customer_state"], r["customer_zip_code_prefix"]) == ("SAO PAULO", "SP", 1001)


def test_clean_orders_parses_five_dates_and_keeps_status(spark):
    cols = ["order_id", "customer_id", "order_status"] + clean.ORDER_DATES
    df = spark.createDataFrame(
        [("o1", "c1", "delivered") + ("2024-01-15 10:00:00",) * 5],
        ", ".join(f"{c} string" for c in cols),
    )
    out = clean.clean_orders(df)
    types = dict(out.dtypes)
    assert all(types[c] == "timestamp_ntz" for c in clean.ORDER_DATES)
    assert out.first()["order_status"] == "delivered"


def test_clean_products_rename_and_fill(spark):
    df = spark.createDataFrame(
        [("p1", None, 10, 20), ("p2", "toys", 1, 2)],
        "product_id string, product_category_name string, product_name_lenght bigint, "
        "product_description_lenght bigint",
    )
    out = clean.clean_products(df)
    assert "product_name_length" in out.columns and "product_description_length" in out.columns
    assert [r["product_category_name"] for r in out.collect()] == ["unknown", "toys"]


def test_clean_reviews_keeps_null_comments(spark):
    df = spark.createDataFrame(
        [("r1", "o1", 5, None, None, "2024-01-01 00:00:00", "2024-01-02 00:00:00")],
        "review_id string, order_id string, review_score bigint, review_comment_title string, "
        "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    )
    out = clean.clean_reviews(df)
    assert out.count() == 1 and out.first()["review_comment_message"] is None


def test_month_index_label_matches_date_format(spark):
    df = spark.createDataFrame(
        [(datetime(1995, 1, 1),), (datetime(2001, 12, 31, 23, 59),), (datetime(987, 7, 4),)],
        "ts timestamp_ntz",
    )
    out = df.select(
        C.month_label("ts").alias("a"), C.month_label_of(C.month_index("ts")).alias("b")
    ).collect()
    assert all(r["a"] == r["b"] for r in out)


def test_money_bounds(spark):
    """Amounts up to 10^14 are exact; a sum of many such amounts widens and
    does not overflow; an amount past the type's twenty digits raises (ANSI)
    instead of wrapping."""
    from pyspark.errors import ArithmeticException

    from strata.functions.columns import money_sum

    near = 99_999_999_999_999.99
    df = spark.createDataFrame([(near,)] * 1000, "v double")
    total = df.agg(money_sum("v").alias("t")).first()["t"]
    assert total == float(near) * 1000
    with pytest.raises(ArithmeticException):
        spark.createDataFrame([(1e21,)], "v double").agg(money_sum("v")).collect()
