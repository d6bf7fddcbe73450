import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("STRATA_SCRATCH", tempfile.mkdtemp(prefix="strata-tests-"))
    s = build_session("local[4]", app_name="strata-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture
def orders(spark):
    from datetime import datetime

    return spark.createDataFrame(
        [
            ("o1", "c1", "delivered", datetime(2024, 1, 15, 10, 0, 0)),
            ("o2", "c2", "delivered", datetime(2024, 2, 20, 11, 0, 0)),
            ("o3", "c3", "shipped", datetime(2024, 3, 5, 9, 30, 0)),
        ],
        "order_id string, customer_id string, order_status string, "
        "order_purchase_timestamp timestamp_ntz",
    )


@pytest.fixture
def payments(spark):
    return spark.createDataFrame(
        [
            ("o1", 1, "credit_card", 1, 100.0),
            ("o2", 1, "boleto", 1, 50.0),
            ("o3", 1, "credit_card", 3, 200.0),
        ],
        "order_id string, payment_sequential bigint, payment_type string, "
        "payment_installments bigint, payment_value double",
    )


@pytest.fixture
def order_items(spark):
    return spark.createDataFrame(
        [
            ("o1", "p1", "s1", 50.0, 5.0),
            ("o1", "p1", "s1", 50.0, 5.0),
            ("o2", "p2", "s2", 80.0, 8.0),
            ("o3", "p1", "s1", 30.0, 3.0),
        ],
        "order_id string, product_id string, seller_id string, price double, freight_value double",
    )


@pytest.fixture
def reviews(spark):
    return spark.createDataFrame(
        [("o1", 5), ("o2", 3)], "order_id string, review_score bigint"
    )


def scratch(label: str) -> str:
    return tempfile.mkdtemp(prefix=f"{label}-", dir=os.environ.get("STRATA_SCRATCH"))
