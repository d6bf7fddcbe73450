import pytest

from strata.errors import ReconciliationError
from strata.operators import keys, reconcile
from strata.rules import RETAIL_RULES

SF_SMALL = "/root/testdata/sf0.001"


def test_fk_mask_and_missing(spark):
    child = spark.createDataFrame([("o1",), ("o2",), ("o3",), (None,)], "order_id string")
    parent = spark.createDataFrame([("o1",), ("o3",), ("o3",)], "order_id string")
    flagged, missing = keys.check_foreign_key(child, "order_id", parent, "order_id")
    assert flagged.count() == 4  # no fan-out from the duplicated parent key
    got = {r["order_id"]: r["_fk_ok"] for r in flagged.collect()}
    assert got == {"o1": True, "o2": False, "o3": True, None: False}
    assert [r["order_id"] for r in missing.collect()] == ["o2"]


def test_any_failing_rule_drops_row(spark):
    items = spark.createDataFrame(
        [("o1", "p1", "s1"), ("o1", "pX", "s1")], "order_id string, product_id string, seller_id string"
    )
    parents = {
        "orders": spark.createDataFrame([("o1",)], "order_id string"),
        "products": spark.createDataFrame([("p1",)], "product_id string"),
        "sellers": spark.createDataFrame([("s1",)], "seller_id string"),
    }
    fks = RETAIL_RULES.foreign_keys["order_items"]
    clean, report, missing = keys.validate_entity_relationships(items, "order_items", fks, parents)
    assert clean.count() == 1
    counts = {r["column"]: r["removed_count"] for r in report.collect()}
    assert counts == {"order_id": 0, "product_id": 1, "seller_id": 0}
    assert [(r["column"], r["missing_value"]) for r in missing.collect()] == [("product_id", "pX")]


def test_cascade_drops_children_of_dropped_orders(spark):
    ents = {
        "customers": spark.createDataFrame([("c1",)], "customer_id string"),
        "orders": spark.createDataFrame([("o1", "c1"), ("o2", "cX")], "order_id string, customer_id string"),
        "order_items": spark.createDataFrame(
            [("o1", "p1", "s1"), ("o2", "p1", "s1")], "order_id string, product_id string, seller_id string"
        ),
        "products": spark.createDataFrame([("p1",)], "product_id string"),
        "sellers": spark.createDataFrame([("s1",)], "seller_id string"),
        "payments": spark.createDataFrame([("o1",), ("o2",)], "order_id string"),
        "reviews": spark.createDataFrame([("o2",)], "order_id string"),
    }
    out, report, missing = keys.clean_relationships(ents, RETAIL_RULES)
    assert [r["order_id"] for r in out["order_items"].collect()] == ["o1"]
    assert [r["order_id"] for r in out["payments"].collect()] == ["o1"]
    assert out["reviews"].count() == 0
    assert {(r["entity"], r["column"]): r["removed_count"] for r in report.collect()}[("reviews", "order_id")] == 1


def _items(spark, data):
    return spark.createDataFrame(data, "order_id string, price double, freight_value double")


def _pay(spark, data):
    return spark.createDataFrame(data, "order_id string, payment_value double")


def test_within_tolerance_passes(spark):
    cmp, exc = reconcile.reconcile_payments(_items(spark, [("o1", 100.0, 10.0)]), _pay(spark, [("o1", 110.0)]), 0.01)
    r = cmp.first()
    assert r["passed"] and r["difference"] == 0.0 and exc.count() == 0


def test_exactly_at_tolerance_passes(spark):
    cmp, _ = reconcile.reconcile_payments(_items(spark, [("o1", 100.0, 10.0)]), _pay(spark, [("o1", 110.01)]), 0.01)
    assert cmp.first()["passed"]


def test_over_tolerance_fails(spark):
    cmp, _ = reconcile.reconcile_payments(_items(spark, [("o1", 100.0, 10.0)]), _pay(spark, [("o1", 150.0)]), 0.01)
    r = cmp.first()
    assert not r["passed"] and r["difference"] == 40.0


def test_unpaid_order_actual_zero(spark):
    cmp, _ = reconcile.reconcile_payments(_items(spark, [("o1", 5.0, 0.0)]), _pay(spark, []), 0.01)
    assert cmp.first()["actual_total"] == 0.0


def test_paid_without_items_is_excluded(spark):
    cmp, exc = reconcile.reconcile_payments(_items(spark, []), _pay(spark, [("o9", 500.0)]), 0.01)
    assert cmp.count() == 0
    assert [(r["order_id"], r["actual_total"]) for r in exc.collect()] == [("o9", 500.0)]


def _orders(spark, ids):
    return spark.createDataFrame([(i, "delivered") for i in ids], "order_id string, order_status string")


def test_warn_mode_quarantines_and_removes(spark):
    orders = _orders(spark, ["o1", "o2", "o3"])
    items = _items(spark, [("o1", 100.0, 10.0), ("o2", 100.0, 10.0)])
    pays = _pay(spark, [("o1", 110.0), ("o2", 999.0), ("o3", 5.0)])
    out = reconcile.run_reconciliation(orders, items, pays, 0.01, "warn")
    q = {r["order_id"]: r["reason"] for r in out.quarantine.collect()}
    assert q == {"o2": "exceeded_tolerance", "o3": "no_order_items"}
    assert out.quarantine.columns == reconcile.QUARANTINE_COLUMNS
    assert [r["order_id"] for r in out.orders.collect()] == ["o1"]
    assert [r["order_id"] for r in out.order_items.collect()] == ["o1"]
    assert [r["order_id"] for r in out.payments.collect()] == ["o1"]
    assert out.summary["quarantined_order_count"] == 2


def test_raise_mode_raises_on_failure(spark):
    orders = _orders(spark, ["o1"])
    with pytest.raises(ReconciliationError, match="order_id=o1"):
        reconcile.run_reconciliation(orders, _items(spark, [("o1", 1.0, 0.0)]), _pay(spark, [("o1", 9.0)]), 0.01, "raise")


def test_raise_mode_exclusions_alone_do_not_raise(spark):
    orders = _orders(spark, ["o1", "o_excluded"])
    out = reconcile.run_reconciliation(
        orders, _items(spark, [("o1", 100.0, 10.0)]), _pay(spark, [("o1", 110.0), ("o_excluded", 50.0)]), 0.01, "raise"
    )
    assert out.quarantine is None
    assert out.summary["excluded_order_count"] == 1 and out.summary["orders_failed"] == 0
    assert out.summary["excluded_order_status_breakdown"] == [{"order_status": "delivered", "count": 1}]


def test_quarantine_removal_drops_null_order_ids(spark):
    df = spark.createDataFrame([("o1",), (None,)], "order_id string")
    q = spark.createDataFrame([("o2",)], "order_id string")
    assert [r["order_id"] for r in reconcile.remove_quarantined(df, q).collect()] == ["o1"]


def test_fk_many_null_keys_are_spread_and_counted(spark):
    rows = [(None, i) for i in range(3000)] + [(f"o{i % 5}", i) for i in range(6000)]
    child = spark.createDataFrame(rows, "order_id string, n int")
    parent = spark.createDataFrame([("o0",), ("o1",)], "order_id string")
    flagged, missing = keys.check_foreign_key(child, "order_id", parent, "order_id")
    counts = {r["_fk_ok"]: r["count"] for r in flagged.groupBy("_fk_ok").count().collect()}
    assert counts == {True: 2400, False: 6600}
    assert sorted(r["order_id"] for r in missing.collect()) == ["o2", "o3", "o4"]
    # with a shuffle join, the null rows go to many partitions, not one
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        flagged, _ = keys.check_foreign_key(child, "order_id", parent, "order_id")
        nulls = flagged.filter("order_id IS NULL")
        per_part = nulls.rdd.glom().map(len).filter(lambda n: n > 0).count()
        assert per_part > 1
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_cascade_with_checkpointed_parents(spark):
    ents = {
        "customers": spark.createDataFrame([("c1",)], "customer_id string"),
        "orders": spark.createDataFrame([("o1", "c1"), ("o2", "cX")], "order_id string, customer_id string"),
        "order_items": spark.createDataFrame(
            [("o1", "p1", "s1"), ("o2", "p1", "s1")], "order_id string, product_id string, seller_id string"
        ),
        "products": spark.createDataFrame([("p1",)], "product_id string"),
        "sellers": spark.createDataFrame([("s1",)], "seller_id string"),
        "payments": spark.createDataFrame([("o1",), ("o2",)], "order_id string"),
        "reviews": spark.createDataFrame([("o2",)], "order_id string"),
    }
    out, _, _ = keys.clean_relationships(ents, RETAIL_RULES, checkpoint_parents=True)
    assert [r["order_id"] for r in out["order_items"].collect()] == ["o1"]
    assert "ExistingRDD" in out["orders"]._jdf.queryExecution().executedPlan().toString() or \
        "LogicalRDD" in out["orders"]._jdf.queryExecution().optimizedPlan().toString()


def test_materialized_totals_give_the_same_outcome(spark):
    from conftest import scratch

    orders = spark.createDataFrame(
        [("o1", "delivered"), ("o2", "delivered"), ("o3", "canceled")],
        "order_id string, order_status string",
    )
    items = _items(spark, [("o1", 100.0, 10.0), ("o2", 50.0, 5.0), (None, 1.0, 0.0)])
    pay = _pay(spark, [("o1", 110.0), ("o2", 99.0), ("o3", 20.0), (None, 5.0)])
    path = scratch("totals")

    def materialize(df):
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)

    lazy = reconcile.run_reconciliation(orders, items, pay, 0.01, "warn")
    written = reconcile.run_reconciliation(orders, items, pay, 0.01, "warn", materialize=materialize)
    for key in ("total_orders_checked", "orders_passed", "orders_failed", "excluded_order_count"):
        assert lazy.summary[key] == written.summary[key]
    # the null-id item group is checked (unpaid); the null-id payment is never excluded
    assert lazy.summary["total_orders_checked"] == 3
    assert lazy.summary["excluded_order_count"] == 1
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(lazy.quarantine) == rows(written.quarantine)
    assert {r["order_id"]: r["reason"] for r in written.quarantine.collect()} == {
        "o2": "exceeded_tolerance",
        None: "exceeded_tolerance",
        "o3": "no_order_items",
    }


def test_no_foreign_key_rules_cleans_nothing(spark):
    from dataclasses import replace

    ents = {"orders": spark.createDataFrame([("o1", "cX")], "order_id string, customer_id string")}
    out, report, missing = keys.clean_relationships(ents, replace(RETAIL_RULES, foreign_keys={}))
    assert out["orders"] is ents["orders"]
    assert report.count() == 0 and missing.count() == 0
    assert report.columns == keys.REPORT_COLUMNS


def test_checkpointed_totals_give_the_same_summary(spark):
    orders = spark.createDataFrame([("o1", "delivered"), ("o2", "canceled")],
                                   "order_id string, order_status string")
    items = _items(spark, [("o1", 100.0, 10.0)])
    pay = _pay(spark, [("o1", 110.0), ("o2", 5.0)])
    lazy = reconcile.run_reconciliation(orders, items, pay, 0.01, "warn")
    ckpt = reconcile.run_reconciliation(orders, items, pay, 0.01, "warn", materialize="checkpoint")
    for key in ("total_orders_checked", "orders_passed", "orders_failed", "excluded_order_count"):
        assert lazy.summary[key] == ckpt.summary[key]
    assert [r["order_id"] for r in ckpt.quarantine.collect()] == ["o2"]


def test_amounts_and_tolerance_below_a_ten_thousandth(spark):
    items = _items(spark, [("o1", 10.0, 0.0), ("o2", 0.000001, 0.000002)])
    pay = _pay(spark, [("o1", 10.00001), ("o2", 0.000003)])
    got, _ = reconcile.reconcile_payments(items, pay, 0.000001)
    assert {r["order_id"]: r["passed"] for r in got.collect()} == {"o1": False, "o2": True}
    got, _ = reconcile.reconcile_payments(items, pay, 0.00001)
    assert all(r["passed"] for r in got.collect())


def test_nan_amount_fails_its_order(spark):
    import math

    orders = _orders(spark, ["o1", "o2"])
    items = _items(spark, [("o1", 100.0, 10.0), ("o2", 1.0, 0.0)])
    pay = _pay(spark, [("o1", 110.0), ("o1", float("nan")), ("o2", 1.0)])
    out = reconcile.run_reconciliation(orders, items, pay, 0.01, "warn")
    assert out.summary["orders_failed"] == 1
    q = out.quarantine.collect()
    assert [r["order_id"] for r in q] == ["o1"] and math.isnan(q[0]["difference"])
    with pytest.raises(ReconciliationError, match="order_id=o1"):
        reconcile.run_reconciliation(orders, items, pay, 0.01, "raise")


def test_one_pass_forms_equal_the_two_frames(spark):
    orders = _orders(spark, ["o1", "o2", "o3"])
    items = _items(spark, [("o1", 100.0, 10.0), ("o2", 50.0, 5.0), (None, 1.0, 0.0)])
    pay = _pay(spark, [("o1", 110.0), ("o2", 99.0), ("o3", 20.0), (None, 5.0)])
    totals = reconcile.order_totals(items, pay)
    comparison, excluded = reconcile.reconcile_payments(items, pay, 0.01)
    rows = lambda df: sorted((tuple(r) for r in df.collect()), key=repr)
    assert rows(reconcile.quarantine_of(totals, orders, 0.01)) == rows(
        reconcile.build_quarantine_records(comparison, excluded, orders)
    )
    assert rows(reconcile.summary_of(totals, 0.01)) == rows(
        reconcile.reconciliation_summary(comparison, excluded, 0.01)
    )


def test_each_missing_value_once_for_each_rule(spark):
    from strata.rules import ForeignKey

    items = spark.createDataFrame([("oX", "p1"), ("oX", "pX"), (None, "pX"), ("o1", "p1")], "order_id string, product_id string")
    parents = {
        "orders": spark.createDataFrame([("o1",)], "order_id string"),
        "products": spark.createDataFrame([("p1",)], "product_id string"),
    }
    fks = [ForeignKey("order_id", "orders", "order_id"), ForeignKey("product_id", "products", "product_id")]
    _, _, missing = keys.validate_entity_relationships(items, "order_items", fks, parents)
    assert sorted(map(tuple, missing.collect())) == [
        ("order_items", "order_id", "oX"), ("order_items", "product_id", "pX")
    ]


def test_more_rules_than_an_int_has_bits(spark):
    df = spark.createDataFrame([tuple([True] * 40 + [False])], [f"f{i}" for i in range(41)])
    mask = df.select(keys.fail_mask(df.columns).alias("m"))
    assert mask.first()["m"] == 1 << 40
    assert mask.filter(keys.failed_rule("m", 40)).count() == 1
    assert mask.filter(keys.failed_rule("m", 3)).count() == 0


# ------------------------------------------------ counts without row joins


def _same_report(spark, ents, rules):
    rows = lambda df: sorted((r["entity"], r["column"], r["parent"], r["removed_count"]) for r in df.collect())
    got = rows(keys.relationship_counts(ents, rules))
    _, report, missing = keys.clean_relationships(ents, rules)
    assert got == rows(report)
    listed = keys.relationship_missing(ents, rules)
    assert listed.columns == missing.columns
    assert sorted(map(tuple, listed.collect())) == sorted(map(tuple, missing.collect()))
    return got


def test_relationship_counts_equal_the_cascade_report(spark):
    """Null keys, a hot key, parents with repeated and null keys, rows that break
    several rules, orders dropped for their customer, and an empty child."""
    df = spark.createDataFrame
    ents = {
        "customers": df([("c1",), ("c1",), (None,), ("c2",)], "customer_id string"),
        "orders": df([(1, "c1"), (2, "c9"), (3, None), (4, "c2"), (None, "c1")], "order_id bigint, customer_id string"),
        "products": df([(10,), (11,), (11,), (None,)], "product_id int"),
        "sellers": df([("1",), ("s2",)], "seller_id string"),
        "order_items": df(
            [(1, 1, 10, "1")] * 500 + [(2, 1, 99, "s9"), (None, 2, None, None), (4, 3, 11, "s2"), (77, 4, 10, "")],
            "order_id bigint, order_item_id bigint, product_id bigint, seller_id string",
        ),
        "payments": df([], "order_id bigint, payment_sequential bigint"),
        "reviews": df([("r1", 3), ("r2", 1), ("r3", None)], "review_id string, order_id bigint"),
    }
    got = _same_report(spark, ents, RETAIL_RULES)
    assert ("orders", "customer_id", "customers", 2) in got
    assert ("order_items", "order_id", "orders", 3) in got
    assert ("payments", "order_id", "orders", 0) in got
    empty = {e: d.limit(0) for e, d in ents.items()}
    assert {n for *_, n in _same_report(spark, empty, RETAIL_RULES)} == {0}


def test_relationship_counts_with_keys_of_other_types_and_chains(spark):
    """Money keys (joined, not compared as text), an entity that points at
    itself, and a chain of three."""
    from dataclasses import replace
    from strata.rules import ForeignKey

    df = spark.createDataFrame
    ents = {
        "a": df([(1, None), (2, 1), (3, 9)], "id bigint, up bigint"),
        "b": df([(1, 1), (2, 3), (3, None), (4, 2)], "id bigint, a bigint"),
        "c": df([("1", 1), ("4", 4), ("7", 2)], "x string, b bigint").selectExpr("cast(x as decimal(9,1)) x", "b"),
        "d": df([("1.00",), ("4",), ("5",)], "x string").selectExpr("cast(x as decimal(9,2)) x"),
    }
    rules = replace(RETAIL_RULES, primary_keys={}, foreign_keys={
        "a": [ForeignKey("up", "a", "id")],
        "b": [ForeignKey("a", "a", "id")],
        "c": [ForeignKey("b", "b", "id")],
        "d": [ForeignKey("x", "c", "x")],
    })
    assert _same_report(spark, ents, rules) == [("a", "up", "a", 2), ("b", "a", "a", 3), ("c", "b", "b", 2), ("d", "x", "c", 2)]
    assert keys.relationship_counts(ents, replace(rules, foreign_keys={})).collect() == []
    assert keys.relationship_missing(ents, replace(rules, foreign_keys={})).collect() == []
    twice = replace(rules, foreign_keys={"b": [ForeignKey("a", "a", "id"), ForeignKey("a", "a", "up")]})
    assert _same_report(spark, ents, twice) == [("b", "a", "a", 1), ("b", "a", "a", 3)]


def test_surplus_by_entity_equals_the_count_of_each(spark):
    from strata.operators import dedupe

    df = spark.createDataFrame
    ents = {
        "a": df([(1, "x"), (1, "x"), (1, None), (1, None), (None, None)], "k bigint, t string"),
        "b": df([("x",), ("",), (None,), (None,), (None,)], "k string"),
        "c": df([], "k bigint"),
        "d": df([(1.0,), (1.0,), (float("nan"),)], "k double"),
    }
    by = {"a": ["k", "t"], "b": ["k"], "c": ["k"], "d": ["k"]}
    got = {r["entity"]: r["removed_count"] for r in dedupe.surplus_by_entity(ents, by).collect()}
    assert got == {e: dedupe.duplicate_summary(ents[e], k).first()["surplus_rows"] for e, k in by.items()}
    assert got == {"a": 2, "b": 2, "c": 0, "d": 1}


def test_audit_counts_shuffle_little(spark):
    """The plans stay within 12 and 20 exchanges of every kind."""
    import __spark_entry__ as entry

    for name, most in (("fk_report_by_key", 12), ("core_quality_by_key", 20)):
        df = entry.queries()[name](spark, SF_SMALL)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
        assert 0 < plan.count("Exchange ") + plan.count("BroadcastExchange") <= most, name
