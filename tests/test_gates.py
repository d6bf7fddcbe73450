import pytest

from strata.errors import (
    AnalyticsValidationError,
    DeduplicationError,
    PaymentValidationError,
    QualityCheckError,
    SchemaValidationError,
)
from strata.operators import checks, dedupe
from strata.rules import RETAIL_RULES, Rules


def test_negative_payments_raise_with_count(spark):
    df = spark.createDataFrame([(-1.0,), (50.0,), (-2.0,)], "payment_value double")
    with pytest.raises(PaymentValidationError, match="Negative payments: 2"):
        checks.validate_payments(df)


def test_zero_payment_is_only_a_warning(spark):
    df = spark.createDataFrame([(0.0,), (100.0,), (None,)], "payment_value double")
    got = checks.validate_payments(df)
    assert got["zero_count"] == 1 and got["negative_count"] == 0 and got["null_count"] == 1


def test_payment_table_and_gate_follow_the_same_rules(spark):
    """A rule that fails the finding raises at the gate, and only such a rule."""
    for value, metric in ((-1.0, "negative_count"), (0.0, "zero_count"), (None, "null_count"), (float("nan"), "nan_count"), (2.0, None)):
        df = spark.createDataFrame([(value,), (5.0,)], "payment_value double")
        rows = {r["metric"]: r for r in checks.payment_value_checks(df).collect()}
        assert {m for m, r in rows.items() if r["value"]} == ({metric} if metric else set())
        failing = [m for m, r in rows.items() if not r["passed"]]
        assert failing == ([metric] if metric in ("negative_count", "nan_count") else [])
        if failing:
            with pytest.raises(PaymentValidationError):
                checks.validate_payments(df)
        else:
            assert checks.validate_payments(df)["nan_count"] == 0


def _schema_rules(schema):
    return Rules(schemas={"customers": schema}, primary_keys={}, null_thresholds={},
                 tiebreakers={}, foreign_keys={})


def test_schema_exact_type_fails(spark):
    df = spark.createDataFrame([("c1", "1001")], "customer_id string, customer_zip_code_prefix string")
    rules = _schema_rules({"customer_id": "String", "customer_zip_code_prefix": "Int64"})
    with pytest.raises(SchemaValidationError, match="has type"):
        checks.validate_all_schemas(spark, {"customers": df.schema}, rules)


def test_schema_int32_is_not_int64(spark):
    df = spark.createDataFrame([(1,)], "zip int")
    f = checks.schema_findings(spark, "x", df.schema, {"zip": "Int64"}).first()
    assert f["status"] == "type_mismatch" and f["actual_type"] == "int"


def test_schema_extra_column_passes(spark):
    df = spark.createDataFrame([("c1", "x")], "customer_id string, unexpected string")
    rules = _schema_rules({"customer_id": "String"})
    checks.validate_all_schemas(spark, {"customers": df.schema}, rules)


def test_schema_missing_column_and_dataset(spark):
    df = spark.createDataFrame([("c1",)], "customer_id string")
    f = checks.schema_findings(spark, "x", df.schema, {"zip": "Int64"}).first()
    assert f["status"] == "missing_column"
    f = checks.schema_findings(spark, "x", None, {"zip": "Int64"}).first()
    assert f["status"] == "dataset_missing" and not f["passed"]


def test_schema_unknown_type_name_raises(spark):
    with pytest.raises(ValueError, match="rules name the type"):
        checks.schema_findings(spark, "x", None, {"a": "Decimal"})


def test_null_rate_within_limit(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("d",)], "c string")
    f = checks.null_rate_findings(df, "e", {"c": 0.5}).first()
    assert f["null_rate"] == 0.25 and f["passed"]


def test_null_rate_empty_frame_is_zero(spark):
    df = spark.createDataFrame([], "c string")
    assert checks.null_rate_findings(df, "e", {"c": 0.0}).first()["null_rate"] == 0.0


def test_composite_key_repeated_review_id_is_fine(spark):
    df = spark.createDataFrame([("r1", "o1"), ("r1", "o2"), ("r2", "o3")], "review_id string, order_id string")
    f = checks.primary_key_findings(df, "reviews", ["review_id", "order_id"]).first()
    assert f["surplus_rows"] == 0 and f["passed"]


def test_quality_gate_raises_on_duplicate_key(spark):
    df = spark.createDataFrame([("c1",), ("c1",)], "customer_id string")
    rules = Rules(schemas={}, primary_keys={"customers": ["customer_id"]},
                  null_thresholds={"customers": {"customer_id": 0.0}}, tiebreakers={}, foreign_keys={})
    with pytest.raises(QualityCheckError, match="customers"):
        checks.run_quality_check({"customers": df}, rules)


def test_dedup_latest_wins(spark):
    df = spark.createDataFrame(
        [("c1", 1, "OLD CITY"), ("c1", 2, "NEW CITY"), ("c2", 1, "OTHER")],
        "customer_id string, processing_timestamp int, city string",
    )
    out, removed = dedupe.dedup_entity(df, "customers", ["customer_id"], "processing_timestamp")
    assert removed == 1
    got = {r["customer_id"]: r["city"] for r in out.collect()}
    assert got == {"c1": "NEW CITY", "c2": "OTHER"}
    assert out.columns == df.columns


def test_dedup_without_tiebreaker_raises(spark):
    df = spark.createDataFrame([("c1",), ("c1",), ("c2",)], "customer_id string")
    with pytest.raises(DeduplicationError):
        dedupe.dedup_entity(df, "customers", ["customer_id"])


def test_dedup_no_duplicates_unchanged(spark):
    df = spark.createDataFrame([("c1",), ("c2",)], "customer_id string")
    out, removed = dedupe.dedup_entity(df, "customers", ["customer_id"])
    assert removed == 0 and out is df


def test_dedup_composite_key(spark):
    df = spark.createDataFrame([("o1", 1, 5), ("o1", 1, 6), ("o2", 1, 7)], "o string, i int, t int")
    out, removed = dedupe.dedup_entity(df, "x", ["o", "i"], "t")
    assert removed == 1 and out.count() == 2


def test_dedup_null_tiebreaker_loses_and_ties_are_deterministic(spark):
    df = spark.createDataFrame(
        [("k", None, "z"), ("k", 3, "a"), ("k", 3, "b")], "k string, t int, v string"
    )
    r = dedupe.keep_latest(df, ["k"], "t").first()
    assert (r["t"], r["v"]) == (3, "b")


def test_dedup_hot_key(spark):
    # A third of the rows on one key: reduced on the map side, one row out.
    data = [("hot", i, f"v{i}") for i in range(3000)] + [(f"k{i}", 0, "x") for i in range(6000)]
    df = spark.createDataFrame(data, "k string, t int, v string")
    out = dedupe.keep_latest(df, ["k"], "t")
    assert out.count() == 6001
    assert out.filter("k = 'hot'").first()["v"] == "v2999"


def test_gmv_gate(spark):
    sales = spark.createDataFrame([(100.0, 100.0)], "gmv double, aov double")
    clv = spark.createDataFrame([(100.0,)], "clv double")
    payments = spark.createDataFrame([(200.0,)], "payment_value double")
    with pytest.raises(AnalyticsValidationError, match="GMV"):
        checks.run_analytics_validation(sales, clv, payments)


def test_gmv_gate_passes_exactly_and_null_check(spark):
    sales = spark.createDataFrame([(0.1, 0.1), (0.2, None)], "gmv double, aov double")
    clv = spark.createDataFrame([(0.3,)], "clv double")
    payments = spark.createDataFrame([(0.3,)], "payment_value double")
    with pytest.raises(AnalyticsValidationError, match="'aov' holds 1 null"):
        checks.run_analytics_validation(sales, clv, payments)
    g = checks.gmv_reconciliation(sales, payments).first()
    assert g["difference"] == 0.0 and g["passed"]


def test_rules_fk_order_parents_first():
    order = RETAIL_RULES.fk_order()
    assert order.index("orders") < order.index("order_items")
    assert order.index("orders") < order.index("payments")


def test_analytics_validation_findings_table(spark):
    sales = spark.createDataFrame([(100.0, None), (50.0, 25.0)], "gmv double, aov double")
    clv = spark.createDataFrame([(150.0,)], "clv double")
    payments = spark.createDataFrame([(100.0,), (49.0,)], "payment_value double")
    rows = [tuple(r) for r in checks.analytics_validation_findings(sales, clv, payments).collect()]
    assert rows == [
        ("gmv_reconciliation", None, "difference", 1.0, checks.GMV_TOLERANCE, False),
        ("null_check", "gmv", "null_count", 0.0, 0.0, True),
        ("null_check", "aov", "null_count", 1.0, 0.0, False),
        ("null_check", "clv", "null_count", 0.0, 0.0, True),
    ]
