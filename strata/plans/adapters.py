"""Map the driver's TPC-H style tables onto the retail entities.

Pure projections (plus one filter for reviews), so Catalyst prunes every
unused column at the Parquet scan and pushes the filters down.  Order and
product keys keep the tables' ``bigint`` type; customer and seller ids, which
some rows lack, are text.

The tables have no null, unpaid or split case, so fixed key remainders make
some: orders without customer, purchase time or payment, orders paid in two
parts, items of unknown products or without seller, products without category.

Two forms per entity:
  * ``core_*``: the cleaned, typed shape the Core and Analytics layers read;
  * ``raw_*``: the shape a CSV source gives (timestamps as text, the source's
    own column spellings), used to drive the cleansers end to end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.columns import TIMESTAMP_PATTERN

TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
]


# The driver tables are read-only: the DataFrame of each (session, path) is
# made once, so file listing and footer reading are not repeated by every
# adapter that projects the same table.  Only the lazy plan is kept, no data.
_TABLES: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _TABLES.get(path)
    if hit is not None and hit[0] is spark and spark._sc._jsc is not None:
        return hit[1]
    df = spark.read.parquet(path)
    _TABLES[path] = (spark, df)
    return df


def _text_ts(col: str):
    return F.date_format(F.col(col), TIMESTAMP_PATTERN)


def _null_text():
    return F.lit(None).cast("string")


# --------------------------------------------------------------------- core


def core_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").cast("bigint").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("c_nationkey").cast("string").alias("customer_state"),
    )


def core_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderkey") % 89 != 0, F.col("o_custkey").cast("string")).alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.when(F.col("o_orderkey") % 97 != 0, F.col("o_orderdate")).alias("order_purchase_timestamp"),
    )


def _paid_parts(orders: DataFrame) -> DataFrame:
    """Payment rows of the orders: every fiftieth order is unpaid, every
    seventh paid in two parts (two fifths of the cents, then the rest)."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    first = F.floor(cents * 2 / 5).cast("bigint")
    part = F.when(F.col("o_orderkey") % 7 == 0, F.array(F.lit(1).cast("bigint"), F.lit(2).cast("bigint")))
    part = part.otherwise(F.array(F.lit(1).cast("bigint")))
    return (
        orders.filter(F.col("o_orderkey") % 50 != 0)
        .select("o_orderkey", "o_totalprice", cents.alias("cents"), first.alias("first"),
                F.explode(part).alias("part"))
        .select(
            "o_orderkey",
            "part",
            F.when(F.col("o_orderkey") % 7 != 0, F.col("o_totalprice"))
            .when(F.col("part") == 1, F.col("first") / 100)
            .otherwise((F.col("cents") - F.col("first")) / 100)
            .alias("value"),
        )
    )


def _product_id():
    """A product that no one knows in the first line of every 61st order."""
    odd = (F.col("l_orderkey") % 61 == 0) & (F.col("l_linenumber") == 1)
    return F.when(odd, F.col("l_partkey") + 10_000_000_000).otherwise(F.col("l_partkey"))


def _seller_id():
    """No seller in the second line of every 53rd order."""
    return F.when(~((F.col("l_orderkey") % 53 == 0) & (F.col("l_linenumber") == 2)), F.col("l_suppkey"))


def core_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order's total price, in one or two payments or none."""
    return _paid_parts(table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("part").alias("payment_sequential"),
        F.col("value").alias("payment_value"),
    )


def freight_value():
    """Freight = price x tax, multiplied as decimals so the double result is
    the exact product's nearest double on every engine."""
    return (
        F.col("l_extendedprice").cast("decimal(18,2)") * F.col("l_tax").cast("decimal(18,2)")
    ).cast("double")


def core_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        _product_id().alias("product_id"),
        _seller_id().cast("string").alias("seller_id"),
        F.col("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        freight_value().alias("freight_value"),
    )


def core_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("product_category_name"),
    )


def core_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_nationkey").cast("bigint").alias("seller_zip_code_prefix"),
        F.col("s_name").alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )


def core_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished orders carry a review; the score is the priority digit."""
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_orderkey").alias("review_id"),
            F.col("o_orderkey").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("review_score"),
        )
    )


CORE = {
    "customers": core_customers,
    "orders": core_orders,
    "order_items": core_order_items,
    "products": core_products,
    "sellers": core_sellers,
    "payments": core_payments,
    "reviews": core_reviews,
}


def core_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in CORE.items()}


# ---------------------------------------------------------------------- raw


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_nationkey").cast("bigint").alias("customer_zip_code_prefix"),
        F.lower("c_mktsegment").alias("customer_city"),
        F.lower(F.col("c_nationkey").cast("string")).alias("customer_state"),
    )


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        _text_ts("o_orderdate").alias("order_purchase_timestamp"),
        _null_text().alias("order_approved_at"),
        _null_text().alias("order_delivered_carrier_date"),
        _null_text().alias("order_delivered_customer_date"),
        _null_text().alias("order_estimated_delivery_date"),
    )


def raw_order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").cast("bigint").alias("order_item_id"),
        _product_id().cast("string").alias("product_id"),
        _seller_id().cast("string").alias("seller_id"),
        _text_ts("l_shipdate").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        freight_value().alias("freight_value"),
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.when(F.col("p_partkey") % 10 != 0, F.col("p_type")).alias("product_category_name"),
        F.length("p_name").cast("bigint").alias("product_name_lenght"),
        F.length("p_brand").cast("bigint").alias("product_description_lenght"),
        F.lit(1).cast("bigint").alias("product_photos_qty"),
        F.col("p_size").cast("bigint").alias("product_weight_g"),
        F.col("p_size").cast("bigint").alias("product_length_cm"),
        F.col("p_size").cast("bigint").alias("product_height_cm"),
        F.col("p_size").cast("bigint").alias("product_width_cm"),
    )


def raw_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("string").alias("seller_id"),
        F.col("s_nationkey").cast("bigint").alias("seller_zip_code_prefix"),
        F.lower("s_name").alias("seller_city"),
        F.col("s_nationkey").cast("string").alias("seller_state"),
    )


def raw_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _paid_parts(table(spark, sf_dir, "orders")).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("part").alias("payment_sequential"),
        F.lit("credit_card").alias("payment_type"),
        F.lit(1).cast("bigint").alias("payment_installments"),
        F.col("value").alias("payment_value"),
    )


def raw_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(
            F.col("o_orderkey").cast("string").alias("review_id"),
            F.col("o_orderkey").cast("string").alias("order_id"),
            F.substring("o_orderpriority", 1, 1).cast("bigint").alias("review_score"),
            _null_text().alias("review_comment_title"),
            _null_text().alias("review_comment_message"),
            _text_ts("o_orderdate").alias("review_creation_date"),
            _null_text().alias("review_answer_timestamp"),
        )
    )


RAW = {
    "customers": raw_customers,
    "orders": raw_orders,
    "order_items": raw_order_items,
    "products": raw_products,
    "sellers": raw_sellers,
    "payments": raw_payments,
    "reviews": raw_reviews,
}


def raw_entities(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {name: fn(spark, sf_dir) for name, fn in RAW.items()}
