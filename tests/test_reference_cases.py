"""Further cases from the reference's unit suite, re-expressed on Spark."""

import pytest

from strata.errors import QualityCheckError
from strata.functions import columns as C
from strata.operators import audit, checks, keys, reconcile
from strata.rules import Rules


def _rules(**kw):
    base = dict(schemas={}, primary_keys={}, null_thresholds={}, tiebreakers={}, foreign_keys={})
    base.update(kw)
    return Rules(**base)


def test_null_threshold_exceeded_fails_and_zero_tolerance_column(spark):
    df = spark.createDataFrame(
        [("a", None, None), ("b", "x", None), (None, "y", None)], "k string, c string, other string"
    )
    found = {
        r["column"]: (r["null_rate"], r["passed"])
        for r in checks.null_rate_findings(df, "e", {"k": 0.0, "c": 0.5}).collect()
    }
    # one null in three rows breaks a zero limit; a third is within one half
    assert found["k"] == (pytest.approx(1 / 3), False)
    assert found["c"] == (pytest.approx(1 / 3), True)
    # only the named columns are checked: the all-null column is not reported
    assert set(found) == {"k", "c"}


def test_quality_gate_names_the_first_failing_entity_in_rule_order(spark):
    customers = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    orders = spark.createDataFrame([("o1",), ("o1",)], "order_id string")
    rules = _rules(primary_keys={"customers": ["customer_id"], "orders": ["order_id"]})
    with pytest.raises(QualityCheckError, match=r"^\[customers\]"):
        checks.run_quality_check({"customers": customers, "orders": orders}, rules)


def test_quality_gate_passes_when_every_entity_passes(spark):
    customers = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    rules = _rules(
        primary_keys={"customers": ["customer_id"]},
        null_thresholds={"customers": {"customer_id": 0.0}},
    )
    findings = checks.run_quality_check({"customers": customers}, rules)
    assert all(r["passed"] for r in findings.collect())


def test_analytics_quality_report_failed_when_validation_failed(spark):
    sales = spark.createDataFrame([(10.0,)], "gmv double")
    ranges = audit.report_ranges({"sales": (sales, ["gmv"])})
    assert audit.analytics_quality_report(ranges, {"passed": False})["overall_status"] == "failed"


def test_reconciliation_without_violations_gives_a_clean_summary(spark):
    orders = spark.createDataFrame([("o1", "delivered")], "order_id string, order_status string")
    items = spark.createDataFrame([("o1", 100.0, 10.0)], "order_id string, price double, freight_value double")
    pay = spark.createDataFrame([("o1", 110.0)], "order_id string, payment_value double")
    for mode in ("raise", "warn"):
        out = reconcile.run_reconciliation(orders, items, pay, 0.01, mode)
        s = out.summary
        assert (s["total_orders_checked"], s["orders_passed"], s["orders_failed"]) == (1, 1, 0)
        assert s["excluded_order_count"] == 0 and s["excluded_order_status_breakdown"] == []
        assert out.orders.count() == 1 and out.order_items.count() == 1
        if mode == "warn":
            assert out.quarantine.count() == 0


def test_foreign_key_without_orphans_has_an_empty_missing_list(spark):
    child = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    parent = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    flagged, missing = keys.check_foreign_key(child, "order_id", parent, "order_id")
    assert missing.count() == 0
    assert all(r["_fk_ok"] for r in flagged.collect())


def test_snake_case_leaves_clean_headers_unchanged(spark):
    df = spark.createDataFrame([(1, 2)], "order_id int, payment_value int")
    assert C.to_snake_case(df).columns == ["order_id", "payment_value"]


def test_fill_null_keeps_existing_values(spark):
    df = spark.createDataFrame([("toys",), (None,)], "product_category_name string")
    out = [r[0] for r in C.fill_null_with(df, "product_category_name", "unknown").collect()]
    assert out == ["toys", "unknown"]
