"""E1-E7 entity cleansers: one narrow projection per entity.

Each cleanser is ``to_snake_case`` followed by the entity's own steps; a
chain of ``transform`` calls that Catalyst folds into a single Project, so
cleansing adds no pass over the data.  All keep the row count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from strata.functions.columns import (
    fill_null_with,
    parse_dates,
    rename_strict,
    to_snake_case,
    uppercase_columns,
)

# The per-entity cleansing choices of the reference.
CUSTOMER_UPPER = ["customer_city", "customer_state"]
SELLER_UPPER = ["seller_city", "seller_state"]
ORDER_DATES = [
    "order_purchase_timestamp",
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_delivered_customer_date",
    "order_estimated_delivery_date",
]
ORDER_ITEM_DATES = ["shipping_limit_date"]
REVIEW_DATES = ["review_creation_date", "review_answer_timestamp"]
PRODUCT_RENAMES = {
    "product_name_lenght": "product_name_length",
    "product_description_lenght": "product_description_length",
}
PRODUCT_CATEGORY_FILL = ("product_category_name", "unknown")


def clean_customers(df: DataFrame) -> DataFrame:
    """snake_case names, upper-case city and state (zip untouched)."""
    return df.transform(to_snake_case).transform(lambda d: uppercase_columns(d, CUSTOMER_UPPER))


def clean_sellers(df: DataFrame) -> DataFrame:
    """snake_case names, upper-case city and state."""
    return df.transform(to_snake_case).transform(lambda d: uppercase_columns(d, SELLER_UPPER))


def clean_orders(df: DataFrame) -> DataFrame:
    """snake_case names, strict parse of the five timestamps (status as is)."""
    return df.transform(to_snake_case).transform(lambda d: parse_dates(d, ORDER_DATES))


def clean_order_items(df: DataFrame) -> DataFrame:
    """snake_case names, strict parse of the shipping limit."""
    return df.transform(to_snake_case).transform(lambda d: parse_dates(d, ORDER_ITEM_DATES))


def clean_payments(df: DataFrame) -> DataFrame:
    """E5: snake_case names only."""
    return to_snake_case(df)


def clean_products(df: DataFrame) -> DataFrame:
    """snake_case names, fix the source's ``lenght`` spelling, fill a
    missing category with ``unknown``."""
    column, value = PRODUCT_CATEGORY_FILL
    return (
        df.transform(to_snake_case)
        .transform(lambda d: rename_strict(d, PRODUCT_RENAMES))
        .transform(lambda d: fill_null_with(d, column, value))
    )


def clean_reviews(df: DataFrame) -> DataFrame:
    """snake_case names, strict parse of both timestamps (null comments kept)."""
    return df.transform(to_snake_case).transform(lambda d: parse_dates(d, REVIEW_DATES))


CLEANERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "customers": clean_customers,
    "orders": clean_orders,
    "order_items": clean_order_items,
    "products": clean_products,
    "sellers": clean_sellers,
    "payments": clean_payments,
    "reviews": clean_reviews,
}


def clean_entity(entity: str, df: DataFrame) -> DataFrame:
    if entity not in CLEANERS:
        raise ValueError(f"no cleanser for entity {entity!r}")
    return CLEANERS[entity](df)
