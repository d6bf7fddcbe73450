"""Rule set for the layered retail flow, as plain Python values.

The reference keeps these in a YAML file; here they are dataclasses so every
operator takes its rules as arguments and a user can pass their own.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Type names accepted in a rule schema and the Spark type each one means.
# Exactly three names are known; anything else is a configuration error.
TYPE_NAMES: dict[str, T.DataType] = {
    "String": T.StringType(),
    "Int64": T.LongType(),
    "Float64": T.DoubleType(),
}


def resolve_type(name: str) -> T.DataType:
    if name not in TYPE_NAMES:
        known = ", ".join(sorted(TYPE_NAMES))
        raise ValueError(f"Unknown type name '{name}'. Known types: {known}")
    return TYPE_NAMES[name]


@dataclass(frozen=True)
class ForeignKey:
    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Rules:
    schemas: dict[str, dict[str, str]]
    primary_keys: dict[str, list[str]]
    null_thresholds: dict[str, dict[str, float]]
    tiebreakers: dict[str, str | None]
    foreign_keys: dict[str, list[ForeignKey]]
    tolerance: float = 0.01
    on_failure: str = "raise"
    entity_order: list[str] = field(default_factory=list)
    # Sources whose text may hold quoted line breaks.  Such a CSV file must be
    # parsed whole by one task; every other source is read line by line, so a
    # large file splits across many tasks (a stray quoted line break there
    # fails the read instead of being misparsed).
    multiline_entities: tuple[str, ...] = ("reviews",)

    def struct_type(self, entity: str) -> T.StructType:
        """Rule schema of one entity as a Spark ``StructType``."""
        return T.StructType(
            [T.StructField(c, resolve_type(t), True) for c, t in self.schemas[entity].items()]
        )

    def fk_order(self) -> list[str]:
        """Child entities in dependency order: a parent is cleaned before its
        children, so a row dropped from a parent cascades to its children."""
        pending = dict(self.foreign_keys)
        done: list[str] = []
        while pending:
            ready = [
                e
                for e, fks in pending.items()
                if all(fk.parent not in pending or fk.parent == e for fk in fks)
            ]
            if not ready:
                raise ValueError(f"foreign keys form a cycle among {sorted(pending)}")
            for e in ready:
                done.append(e)
                pending.pop(e)
        return done


# ---------------------------------------------------------------------------
# The retail rule set of the reference's validation config
# (schemas, keys, null limits, tiebreakers, foreign keys, tolerance, mode).
# ---------------------------------------------------------------------------
RETAIL_RULES = Rules(
    schemas={
        "customers": {
            "customer_id": "String",
            "customer_unique_id": "String",
            "customer_zip_code_prefix": "Int64",
            "customer_city": "String",
            "customer_state": "String",
        },
        "orders": {
            "order_id": "String",
            "customer_id": "String",
            "order_status": "String",
            "order_purchase_timestamp": "String",
            "order_approved_at": "String",
            "order_delivered_carrier_date": "String",
            "order_delivered_customer_date": "String",
            "order_estimated_delivery_date": "String",
        },
        "order_items": {
            "order_id": "String",
            "order_item_id": "Int64",
            "product_id": "String",
            "seller_id": "String",
            "shipping_limit_date": "String",
            "price": "Float64",
            "freight_value": "Float64",
        },
        "products": {
            "product_id": "String",
            "product_category_name": "String",
            "product_name_lenght": "Int64",
            "product_description_lenght": "Int64",
            "product_photos_qty": "Int64",
            "product_weight_g": "Int64",
            "product_length_cm": "Int64",
            "product_height_cm": "Int64",
            "product_width_cm": "Int64",
        },
        "sellers": {
            "seller_id": "String",
            "seller_zip_code_prefix": "Int64",
            "seller_city": "String",
            "seller_state": "String",
        },
        "payments": {
            "order_id": "String",
            "payment_sequential": "Int64",
            "payment_type": "String",
            "payment_installments": "Int64",
            "payment_value": "Float64",
        },
        "reviews": {
            "review_id": "String",
            "order_id": "String",
            "review_score": "Int64",
            "review_comment_title": "String",
            "review_comment_message": "String",
            "review_creation_date": "String",
            "review_answer_timestamp": "String",
        },
    },
    primary_keys={
        "customers": ["customer_id"],
        "orders": ["order_id"],
        "products": ["product_id"],
        "sellers": ["seller_id"],
        "reviews": ["review_id", "order_id"],
        "payments": ["order_id", "payment_sequential"],
        "order_items": ["order_id", "order_item_id"],
    },
    null_thresholds={
        "customers": {"customer_id": 0.0},
        "orders": {"order_id": 0.0, "customer_id": 0.0},
        "products": {"product_category_name": 0.05},
        "sellers": {"seller_id": 0.0},
        "reviews": {"review_id": 0.0, "review_comment_message": 0.95},
        "payments": {"order_id": 0.0},
        "order_items": {"order_id": 0.0},
    },
    tiebreakers={
        "customers": None,
        "orders": None,
        "products": None,
        "sellers": None,
        "reviews": None,
        "payments": None,
        "order_items": None,
    },
    foreign_keys={
        "orders": [ForeignKey("customer_id", "customers", "customer_id")],
        "order_items": [
            ForeignKey("order_id", "orders", "order_id"),
            ForeignKey("product_id", "products", "product_id"),
            ForeignKey("seller_id", "sellers", "seller_id"),
        ],
        "payments": [ForeignKey("order_id", "orders", "order_id")],
        "reviews": [ForeignKey("order_id", "orders", "order_id")],
    },
    tolerance=0.01,
    on_failure="warn",
    entity_order=[
        "customers",
        "orders",
        "order_items",
        "products",
        "sellers",
        "payments",
        "reviews",
    ],
)

# Source file names the raw layer expects, in discovery order.
SOURCE_FILES = [f"{e}.csv" for e in RETAIL_RULES.entity_order]
