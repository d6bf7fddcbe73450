import pytest
import os

from pyspark.sql import functions as F

from strata import sources
from strata.plans import adapters as ad
from strata.plans.layers import LayerPaths, current_core, run_layers
from strata.rules import RETAIL_RULES

from conftest import SF_SMALL, scratch

HEADERS = {e: ",".join(cols) for e, cols in RETAIL_RULES.schemas.items()}
TS = "2024-01-15 10:00:00"


def _csv(d, entity, rows):
    with open(os.path.join(d, f"{entity}.csv"), "w", encoding="utf-8") as f:
        f.write(HEADERS[entity] + "\n")
        for r in rows:
            f.write(",".join("" if v is None else str(v) for v in r) + "\n")


def _fixture(root):
    d = os.path.join(root, "source")
    os.makedirs(d)
    _csv(d, "customers", [("c1", "u1", 1001, "sao paulo", "sp"), ("c2", "u2", 1002, "rio", "rj")])
    _csv(d, "orders", [
        ("o1", "c1", "delivered", TS, TS, TS, TS, TS),
        ("o2", "c2", "delivered", "2024-02-01 09:00:00", None, None, None, None),
        ("o3", "cX", "delivered", TS, None, None, None, None),   # unknown customer
        ("o4", "c1", "canceled", "2024-02-03 08:00:00", None, None, None, None),  # paid, no items
    ])
    _csv(d, "order_items", [
        ("o1", 1, "p1", "s1", TS, 100.0, 10.0),
        ("o2", 1, "p1", "s1", TS, 50.0, 5.0),
        ("o3", 1, "p1", "s1", TS, 70.0, 0.0),
    ])
    _csv(d, "products", [("p1", None, 10, 20, 1, 100, 10, 10, 10)])
    _csv(d, "sellers", [("s1", 2000, "curitiba", "pr")])
    _csv(d, "payments", [
        ("o1", 1, "credit_card", 1, 110.0),
        ("o2", 1, "boleto", 1, 99.0),      # over tolerance
        ("o3", 1, "boleto", 1, 70.0),
        ("o4", 1, "boleto", 1, 20.0),
    ])
    _csv(d, "reviews", [("r1", "o1", 5, None, None, TS, TS), ("r2", "o3", 1, None, "bad", TS, TS)])


def test_full_run_warn_mode(spark):
    root = scratch("layers")
    _fixture(root)
    out = run_layers(spark, root)
    paths = current_core(spark, LayerPaths(root))
    core = out["core"]
    fk = {(r["entity"], r["column"]): r["removed_count"] for r in core["foreign_key_validation"]}
    assert fk[("orders", "customer_id")] == 1
    assert fk[("order_items", "order_id")] == 1  # cascade from o3
    assert fk[("payments", "order_id")] == 1 and fk[("reviews", "order_id")] == 1
    recon = core["financial_reconciliation"]
    assert (recon["orders_failed"], recon["excluded_order_count"]) == (1, 1)
    q = {r["order_id"]: r["reason"] for r in spark.read.parquet(paths.quarantine).collect()}
    assert q == {"o2": "exceeded_tolerance", "o4": "no_order_items"}
    orders = [r["order_id"] for r in spark.read.parquet(paths.core("3_reconciled", "orders")).collect()]
    assert orders == ["o1"]
    sales = spark.read.parquet(paths.analytics("sales_performance")).collect()
    assert [(r["month"], r["gmv"], r["order_count"]) for r in sales] == [("2024-01", 110.0, 1)]
    products = spark.read.parquet(paths.core("1_dedup", "products")).first()
    assert products["product_category_name"] == "unknown"
    assert out["analytics"]["overall_status"] == "passed"
    metrics = spark.read.parquet(paths.audit("layer_metrics"))
    assert {r["layer"] for r in metrics.select("layer").distinct().collect()} == {
        "raw", "staging", "core", "analytics"
    }
    # rerun over the same root is idempotent
    again = run_layers(spark, root)
    assert again["core"]["financial_reconciliation"]["orders_failed"] == 1


def test_full_run_on_driver_tables(spark):
    """Whole sf0.001 tables through all layers (order_items deduplicated by
    ship date), analytics checked against the registry's direct queries."""
    root = scratch("layers-sf")
    for e, fn in ad.RAW.items():
        df = fn(spark, SF_SMALL).coalesce(1)
        tmp = f"{root}/tmp_{e}"
        sources.write_csv(df, tmp)
        part = [f for f in os.listdir(tmp) if f.endswith(".csv")][0]
        os.makedirs(f"{root}/source", exist_ok=True)
        os.link(f"{tmp}/{part}", f"{root}/source/{e}.csv")
    rules = RETAIL_RULES.__class__(
        **{**RETAIL_RULES.__dict__,
           "tiebreakers": {**RETAIL_RULES.tiebreakers, "order_items": "shipping_limit_date"},
           "tolerance": 50000.0}
    )
    out = run_layers(spark, root, rules, on_quality_failure="warn")
    assert out["analytics"]["validation"]["passed"]
    removed = {r["entity"]: r["removed_count"] for r in out["core"]["deduplication"]}
    assert removed["order_items"] > 0
    paths = current_core(spark, LayerPaths(root))
    n_items = spark.read.parquet(paths.core("1_dedup", "order_items")).count()
    key_count = ad.core_order_items(spark, SF_SMALL).select("order_id", "order_item_id").distinct().count()
    assert n_items == key_count
    total = spark.read.parquet(paths.analytics("sales_performance")).agg(F.sum("order_count")).first()[0]
    assert total == spark.read.parquet(paths.core("3_reconciled", "orders")).count()


def test_fk_stage_is_one_write_partitioned_by_failure_mask(spark):
    """The flagged child is written once; its mask=0 folder is the clean stage
    with exactly the entity's columns, and the orphan table lists the unknown
    customer."""
    root = scratch("layers-mask")
    _fixture(root)
    out = run_layers(spark, root)
    paths = current_core(spark, LayerPaths(root))
    clean_orders = spark.read.parquet(paths.fk_clean("orders"))
    staged = spark.read.parquet(paths.core("1_dedup", "orders"))
    assert clean_orders.columns == staged.columns
    assert sorted(r["order_id"] for r in clean_orders.collect()) == ["o1", "o2", "o4"]
    flagged = spark.read.parquet(paths.core("2_keys", "orders"))
    masks = {r["order_id"]: r["_fk_fail_mask"] for r in flagged.collect()}
    assert masks == {"o1": 0, "o2": 0, "o3": 1, "o4": 0}
    missing = {
        (r["entity"], r["column"], r["missing_value"])
        for r in spark.read.parquet(paths.core_audit("fk_missing")).collect()
    }
    # o3's items, payment and review cascade as orphans of the dropped order
    assert missing == {
        ("orders", "customer_id", "cX"),
        ("order_items", "order_id", "o3"),
        ("payments", "order_id", "o3"),
        ("reviews", "order_id", "o3"),
    }
    assert out["core"]["stages"]["reviews"] == paths.fk_clean("reviews")


def test_every_order_orphaned_leaves_typed_empty_stages(spark):
    root = scratch("layers-orphans")
    _fixture(root)
    # No known customer: every order, and by cascade every child row, fails.
    _csv(os.path.join(root, "source"), "customers", [("c9", "u9", 1009, "x", "y")])
    out = run_layers(spark, root)
    paths = current_core(spark, LayerPaths(root))
    for e in ("orders", "order_items", "payments", "reviews"):
        df = spark.read.parquet(out["core"]["stages"][e])
        assert df.count() == 0
        assert df.columns == spark.read.parquet(paths.core("1_dedup", e)).columns
    fk = {(r["entity"], r["column"]): r["removed_count"] for r in out["core"]["foreign_key_validation"]}
    assert fk[("orders", "customer_id")] == 4
    assert fk[("order_items", "order_id")] == 3
    assert out["core"]["financial_reconciliation"]["total_orders_checked"] == 0
    assert spark.read.parquet(paths.analytics("sales_performance")).count() == 0


def test_run_in_order_keeps_order_and_raises_the_first_failure():
    import time

    import pytest

    from strata.plans.layers import run_in_order

    def slow(v, delay):
        def f():
            time.sleep(delay)
            return v
        return f

    assert run_in_order([slow(1, 0.2), slow(2, 0.0), slow(3, 0.1)]) == [1, 2, 3]

    done = []

    def fail(msg, delay):
        def f():
            time.sleep(delay)
            done.append(msg)
            raise ValueError(msg)
        return f

    # the later task fails first in time; the first failure in task order wins
    with pytest.raises(ValueError, match="first"):
        run_in_order([slow(0, 0.0), fail("first", 0.2), fail("second", 0.0)])
    assert sorted(done) == ["first", "second"]


def test_staging_quality_findings_written_and_flagged(spark):
    from strata.errors import QualityCheckError
    from strata.plans.layers import run_raw, run_staging

    root = scratch("layers-quality")
    _fixture(root)
    # a duplicated customer key fails the staging primary-key check
    _csv(os.path.join(root, "source"), "customers",
         [("c1", "u1", 1001, "sao paulo", "sp"), ("c1", "u1b", 1001, "sao paulo", "sp"),
          ("c2", "u2", 1002, "rio", "rj")])
    paths = LayerPaths(root)
    run_raw(spark, paths, run_id="r1")
    findings = run_staging(spark, paths, run_id="r1", on_quality_failure="warn")
    failing = [(r["entity"], r["check"]) for r in findings.filter("NOT passed").collect()]
    assert failing == [("customers", "primary_key")]
    flags = {
        r["layer"]: r["validation_passed"]
        for r in spark.read.parquet(paths.audit("layer_metrics")).collect()
    }
    assert flags == {"raw": True, "staging": False}
    with pytest.raises(QualityCheckError, match=r"\[customers\] primary_key"):
        run_staging(spark, paths, run_id="r2", on_quality_failure="raise")


def test_review_comment_with_line_break_survives_raw(spark):
    from strata.plans.layers import run_raw

    root = scratch("layers-multiline")
    _fixture(root)
    with open(os.path.join(root, "source", "reviews.csv"), "w", encoding="utf-8") as f:
        f.write(HEADERS["reviews"] + "\n")
        f.write(f'r1,o1,5,,"good\nthen bad",{TS},{TS}\n')
    run_raw(spark, LayerPaths(root))
    rows = spark.read.parquet(LayerPaths(root).raw("reviews")).collect()
    assert [r["review_comment_message"] for r in rows] == ["good\nthen bad"]


def test_raw_null_check_sees_what_cleaning_fills(spark):
    from strata.errors import QualityCheckError
    from strata.plans.layers import run_raw, run_staging

    root = scratch("layers-rawnull")
    _fixture(root)  # the only product has no category: filled with 'unknown' in staging
    paths = LayerPaths(root)
    run_raw(spark, paths)
    findings = run_staging(spark, paths, on_quality_failure="warn", raw_null_check=True)
    staged = {(r["entity"], r["column"]): r["passed"] for r in findings.collect()
              if r["check"] == "null_rate"}
    assert staged[("products", "product_category_name")] is True
    raw = {(r["entity"], r["column"]): (r["null_rate"], r["passed"])
           for r in spark.read.parquet(paths.audit("raw_null_rates")).collect()}
    assert raw[("products", "product_category_name")] == (1.0, False)
    with pytest.raises(QualityCheckError, match=r"\[products\] null_rate on 'product_category_name' in Raw"):
        run_staging(spark, paths, on_quality_failure="raise", raw_null_check=True)


def test_core_restores_the_writer_setting(spark):
    from strata.plans.layers import run_core, run_raw, run_staging

    root = scratch("layers-writers")
    _fixture(root)
    paths = LayerPaths(root)
    run_raw(spark, paths)
    run_staging(spark, paths)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(key, "0")
    out = run_core(spark, paths)
    assert spark.conf.get(key) == "0"
    assert out["foreign_key_validation"][0]["removed_count"] == 1


def test_core_dedup_reuses_the_staging_count_for_the_same_key_only(spark):
    from dataclasses import replace

    from strata.plans.layers import run_core, run_raw, run_staging
    from strata.rules import RETAIL_RULES

    root = scratch("layers-dedup-count")
    _fixture(root)
    _csv(os.path.join(root, "source"), "customers",
         [("c1", "u1", 1001, "sao paulo", "sp"), ("c1", "u1b", 1001, "sao paulo", "sp"),
          ("c2", "u2", 1002, "rio", "rj")])
    paths = LayerPaths(root)
    run_raw(spark, paths)
    run_staging(spark, paths, on_quality_failure="warn")
    rules = replace(RETAIL_RULES, tiebreakers={**RETAIL_RULES.tiebreakers,
                                               "customers": "customer_unique_id"})
    out = run_core(spark, paths, rules)
    removed = {r["entity"]: r["removed_count"] for r in out["deduplication"]}
    assert removed["customers"] == 1 and removed["orders"] == 0
    kept = spark.read.parquet(current_core(spark, paths).core("1_dedup", "customers")).collect()
    assert sorted((r["customer_id"], r["customer_unique_id"]) for r in kept) == [
        ("c1", "u1b"), ("c2", "u2")]
    # another key than the one staging checked: counted afresh, not reused
    by_unique = replace(rules, primary_keys={**rules.primary_keys,
                                             "customers": ["customer_unique_id"]})
    out = run_core(spark, paths, by_unique)
    removed = {r["entity"]: r["removed_count"] for r in out["deduplication"]}
    assert removed["customers"] == 0


def test_standalone_core_counts_duplicates_itself(spark):
    from strata.errors import DeduplicationError
    from strata.plans.layers import duplicate_counts, run_core, run_raw, run_staging
    from strata.rules import RETAIL_RULES

    root = scratch("layers-stale")
    _fixture(root)
    paths = LayerPaths(root)
    run_raw(spark, paths)
    findings = run_staging(spark, paths)
    assert duplicate_counts(findings, RETAIL_RULES)["customers"] == 0
    # staged customers replaced after the gate ran: Core must not trust it
    staged = spark.read.parquet(paths.staging("customers"))
    dup = staged.unionByName(staged.limit(1))
    dup.write.mode("overwrite").parquet(paths.staging("customers") + "_new")
    spark.read.parquet(paths.staging("customers") + "_new").write.mode("overwrite").parquet(
        paths.staging("customers"))
    with pytest.raises(DeduplicationError, match="customers"):
        run_core(spark, paths)


def test_duplicate_counts_only_for_the_dedup_key(spark):
    from strata.plans.layers import duplicate_counts
    from strata.rules import RETAIL_RULES

    findings = spark.createDataFrame(
        [("primary_key", "customers", "customer_id", "duplicate_count", 2.0),
         ("primary_key", "orders", "order_id,customer_id", "duplicate_count", 5.0),
         ("null_rate", "orders", "order_id", "null_rate", 0.0)],
        "check string, entity string, column string, metric string, value double",
    )
    assert duplicate_counts(findings, RETAIL_RULES) == {"customers": 2}


def test_analytics_keeps_its_findings_and_reads_the_last_finished_core(spark):
    from dataclasses import replace

    from strata.errors import AnalyticsValidationError, ReconciliationError
    from strata.plans.layers import current_stages, run_analytics, run_core

    root = scratch("layers-marker")
    _fixture(root)
    paths = LayerPaths(root)
    rules = replace(RETAIL_RULES, on_failure="warn")
    run_layers(spark, root, rules, on_quality_failure="warn")
    status = spark.read.parquet(paths.audit("analytics_status")).first()
    assert status["overall_status"] == "passed"
    assert spark.read.parquet(paths.audit("analytics_validation")).filter("passed").count() == 4
    mode = spark.read.parquet(current_core(spark, paths).core_audit("reconciliation")).first()
    assert mode["on_failure_mode"] == "warn"
    # Orders without a purchase time: their payments are in no month.
    stages = current_stages(spark, paths)
    undated = f"{root}/undated"
    spark.read.parquet(stages["orders"]).withColumn(
        "order_purchase_timestamp", F.lit(None).cast("timestamp_ntz")
    ).write.parquet(undated)
    with pytest.raises(AnalyticsValidationError):
        run_analytics(spark, paths, stages={**stages, "orders": undated})
    status = spark.read.parquet(paths.audit("analytics_status")).first()
    assert status["overall_status"] == "failed"
    assert spark.read.parquet(paths.audit("analytics_validation")).filter("NOT passed").count() == 1
    # A Core run that fails takes its own files away, and only those.
    good = current_core(spark, paths)
    before = spark.read.parquet(stages["payments"]).collect()
    pay = spark.read.parquet(paths.staging("payments"))
    pay.withColumn("payment_value", F.col("payment_value") + 1000).write.parquet(f"{root}/pay")
    spark.read.parquet(f"{root}/pay").write.mode("overwrite").parquet(paths.staging("payments"))
    with pytest.raises(ReconciliationError):
        run_core(spark, paths, replace(rules, on_failure="raise"))
    assert current_core(spark, paths) == good
    assert os.listdir(f"{root}/core/runs") == [good.snapshot]
    assert current_stages(spark, paths) == stages
    assert spark.read.parquet(stages["payments"]).collect() == before
    assert run_analytics(spark, paths)["overall_status"] == "passed"


def test_no_finished_core_run(spark):
    from strata.plans.layers import run_analytics

    paths = LayerPaths(scratch("layers-none"))
    with pytest.raises(FileNotFoundError, match="no finished Core run"):
        run_analytics(spark, paths)
    with pytest.raises(ValueError, match="snapshot"):
        paths.core("1_dedup", "orders")


def test_finished_core_runs_are_kept_then_pruned(spark):
    from strata.plans.layers import finished_runs, run_core, run_raw, run_staging

    root = scratch("layers-keep")
    _fixture(root)
    paths = LayerPaths(root)
    run_raw(spark, paths)
    run_staging(spark, paths)
    # the same run id twice: two snapshots
    made = [run_core(spark, paths, run_id="r")["snapshot"] for _ in range(3)]
    assert len(set(made)) == 3
    assert [p.split("_", 1)[1] for p in finished_runs(spark, paths)] == [made[2], made[1]]
    assert sorted(os.listdir(f"{root}/core/runs")) == sorted(made[1:])
    assert current_core(spark, paths).snapshot == made[2]
    last = run_core(spark, paths, keep_runs=1)["snapshot"]
    assert os.listdir(f"{root}/core/runs") == [last]


def test_two_core_runs_at_a_time(spark):
    """Both finish whole, each in its own snapshot, a failing third beside them
    disturbs neither, and the writer setting comes back."""
    from concurrent.futures import ThreadPoolExecutor
    from dataclasses import replace

    from strata.errors import ReconciliationError
    from strata.plans.layers import current_stages, finished_runs, run_core, run_raw, run_staging

    root = scratch("layers-two")
    _fixture(root)
    paths = LayerPaths(root)
    run_raw(spark, paths)
    run_staging(spark, paths)
    key = "spark.sql.maxConcurrentOutputFileWriters"
    spark.conf.set(key, "0")
    raising = replace(RETAIL_RULES, on_failure="raise")
    with ThreadPoolExecutor(3) as pool:
        jobs = [pool.submit(run_core, spark, paths, r, f"r{i}")
                for i, r in enumerate([RETAIL_RULES, raising, RETAIL_RULES])]
        first, second = jobs[0].result(), jobs[2].result()
        with pytest.raises(ReconciliationError):
            jobs[1].result()
    assert spark.conf.get(key) == "0"
    snapshots = {first["snapshot"], second["snapshot"]}
    assert {p.split("_", 1)[1] for p in finished_runs(spark, paths)} == snapshots
    assert set(os.listdir(f"{root}/core/runs")) == snapshots
    for out in (first, second):
        kept = {e: spark.read.parquet(p).count() for e, p in out["stages"].items()}
        assert kept == {"customers": 2, "orders": 1, "order_items": 1, "products": 1,
                        "sellers": 1, "payments": 1, "reviews": 1}
        assert all(out["snapshot"] in out["stages"][e] for e in kept)
    assert current_stages(spark, paths) in (first["stages"], second["stages"])
    log = spark.read.parquet(paths.audit("layer_metrics")).filter("layer = 'core'")
    assert sorted(r["run_id"] for r in log.select("run_id").distinct().collect()) == ["r0", "r2"]


@pytest.mark.parametrize("most", [0, 1])
def test_keys_that_large_parents_lack_decide_the_flags(spark, most):
    """With few missing keys (at most 1) those are sent instead of shuffling the
    child; with more (0) the rows are shuffled.  The flags are the same."""
    from strata.plans.layers import run_core, run_raw, run_staging

    root = scratch("layers")
    _fixture(root)
    paths = LayerPaths(root)
    run_raw(spark, paths)
    run_staging(spark, paths, on_quality_failure="warn")

    def flagged():
        now = current_core(spark, paths)
        read = {e: spark.read.parquet(now.core("2_keys", e)) for e in RETAIL_RULES.fk_order()}
        kept = {e: spark.read.parquet(now.core("3_reconciled", e)) for e in ("orders", "order_items", "payments")}
        return now, [{e: sorted(map(str, df.collect())) for e, df in d.items()} for d in (read, kept)]

    plain = run_core(spark, paths)
    _, want = flagged()
    large = run_core(spark, paths, broadcast_max_rows=most)
    now, got = flagged()
    assert got == want
    assert large["foreign_key_validation"] == plain["foreign_key_validation"]
    lost = {(e, i): [r[0] for r in spark.read.parquet(now.core("2_absent", f"{e}-{i}")).collect()]
            for e, i in (("orders", 0), ("order_items", 0), ("payments", 0), ("reviews", 0))}
    assert lost == {("orders", 0): ["cX"], ("order_items", 0): ["o3"], ("payments", 0): ["o3"], ("reviews", 0): ["o3"]}
