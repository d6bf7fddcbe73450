from strata.functions.joins import bounded_broadcast, fits_broadcast
from strata.operators import audit


def test_layer_metrics_counts(spark):
    a = spark.createDataFrame([(1,), (2,)], "x int")
    b = spark.createDataFrame([], "x int")
    rows = {r["entity"]: (r["row_count"], r["layer"], r["run_id"])
            for r in audit.layer_metrics("run1", "core", {"a": a, "b": b}).collect()}
    assert rows == {"a": (2, "core", "run1"), "b": (0, "core", "run1")}


def test_report_ranges(spark):
    sales = spark.createDataFrame([(10.0, 5.0), (30.0, 15.0)], "gmv double, aov double")
    out = {(r["report"], r["column"]): (r["row_count"], r["min_value"], r["max_value"])
           for r in audit.report_ranges({"sales": (sales, ["gmv", "aov"])}).collect()}
    assert out == {("sales", "gmv"): (2, 10.0, 30.0), ("sales", "aov"): (2, 5.0, 15.0)}


def test_core_quality_report_long_rows(spark):
    dedup = spark.createDataFrame([("orders", 0)], "entity string, removed_count bigint")
    fk = spark.createDataFrame([("orders", "customer_id", "customers", 3)],
                               "entity string, column string, parent string, removed_count bigint")
    recon = spark.createDataFrame([(10, 8, 2, 4.5, 0.01, 1)],
                                  "total_orders_checked bigint, orders_passed bigint, orders_failed bigint, "
                                  "max_difference double, tolerance_used double, excluded_order_count bigint")
    rows = {(r["card"], r["metric"], r["column"]): r["value"]
            for r in audit.core_quality_report(dedup, fk, recon).collect()}
    assert rows[("foreign_key_validation", "removed_count", "customer_id")] == 3.0
    assert rows[("financial_reconciliation", "orders_failed", None)] == 2.0
    assert rows[("deduplication", "removed_count", None)] == 0.0


def test_analytics_quality_report_status(spark):
    sales = spark.createDataFrame([(10.0,)], "gmv double")
    ranges = audit.report_ranges({"sales": (sales, ["gmv"])})
    out = audit.analytics_quality_report(ranges, {"passed": True})
    assert out["overall_status"] == "passed"
    assert out["reports"]["sales"]["value_ranges"]["gmv"] == {"min": 10.0, "max": 10.0}


def test_size_checked_broadcast(spark):
    small = spark.range(10)
    assert fits_broadcast(small, 10) and not fits_broadcast(small, 9)
    plan = small.join(bounded_broadcast(spark.range(5), 5), "id")._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" in plan


def test_cluster_settings_bounds():
    from strata.session import cluster_settings

    assert cluster_settings(100 * 2**40, 8000)["spark.sql.shuffle.partitions"] == "100000"
    assert cluster_settings(2**30, 64)["spark.sql.shuffle.partitions"] == "128"
    assert cluster_settings(40 * 2**30, 64)["spark.sql.shuffle.partitions"] == "128"
    assert cluster_settings(400 * 2**30, 64)["spark.sql.shuffle.partitions"] == "400"


def test_size_check_stops_early_on_a_large_input(spark):
    """The bound is checked by an incremental take: with 100 partitions of
    10,000 rows, proving ``more than 10 rows`` must not touch them all."""
    big = spark.range(0, 1_000_000, numPartitions=100)
    sc = spark.sparkContext
    st = sc.statusTracker()
    sc.setJobGroup("size-check", "size-check")
    try:
        assert not fits_broadcast(big, 10)
    finally:
        sc.setJobGroup("after", "after")
    tasks = sum(
        st.getStageInfo(s).numTasks
        for j in st.getJobIdsForGroup("size-check")
        for s in st.getJobInfo(j).stageIds
        if st.getStageInfo(s) is not None
    )
    assert 0 < tasks <= 5
    assert fits_broadcast(big, 1_000_000)
