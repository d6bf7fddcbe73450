"""L1-L4 layer runners: source CSV -> Raw -> Staging -> Core -> Analytics.

One plain batch driver replaces the reference's four scheduled DAGs.  Every
step reads one stage and writes the next to its *own* path, so no job ever
overwrites the data it reads, a rerun is idempotent, and each written stage
cuts the lineage (a lost executor recomputes from the last stage, not from
the sources):

    raw/{e}  staging/{e}
    core/runs/{snapshot}/1_dedup/{e}
    core/runs/{snapshot}/2_keys/{e}/_fk_fail_mask={m}   (m = 0: clean rows; bit i: rule i failed)
    core/runs/{snapshot}/2_absent/{e}-{i}   (keys that the large parent of rule i lacks)
    core/runs/{snapshot}/order_totals  .../quarantine  .../3_reconciled/{e}
    core/runs/{snapshot}/audit/fk_report  .../fk_missing  .../core_quality
                        .../reconciliation  .../excluded_by_status
    core/finished/{time}_{snapshot}   (entity, path) of a run that finished
    analytics/{report}
    audit/layer_metrics (append, by layer)  audit/report_ranges

A Core run is a snapshot: it writes only folders of its own and is published
last, by moving one small table into ``core/finished``.  A run that fails, or
two at a time, never change what the last finished one left.

Only small results reach the driver: one-row summaries, per-rule counts and
failing findings.  Orphan key lists and the quarantine are written as tables.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass, replace
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strata import sources
from strata.functions.columns import to_snake_case
from strata.functions.joins import absent_keys, fits_broadcast, heavy_keys
from strata.operators import audit, checks, clean, dedupe, keys, reconcile, reports
from strata.errors import QualityCheckError
from strata.rules import RETAIL_RULES, Rules
from strata.session import ensure_defaults


@dataclass(frozen=True)
class LayerPaths:
    """Paths under ``root``; the Core ones belong to one ``snapshot``
    (``current_core`` gives the last finished one)."""

    root: str
    snapshot: str | None = None

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def source(self) -> str:
        return self._p("source")

    def raw(self, e: str) -> str:
        return self._p("raw", e)

    @property
    def raw_dir(self) -> str:
        return self._p("raw")

    def staging(self, e: str) -> str:
        return self._p("staging", e)

    def _run(self, *parts: str) -> str:
        if self.snapshot is None:
            raise ValueError("Core paths need a snapshot: see current_core")
        return self._p("core", "runs", self.snapshot, *parts)

    @property
    def core_run(self) -> str:
        """Everything one Core run wrote."""
        return self._run()

    def core(self, stage: str, e: str) -> str:
        return self._run(stage, e)

    def fk_clean(self, e: str) -> str:
        """Rows of ``e`` that pass every foreign key: the ``mask=0`` folder
        of the flagged stage."""
        return self._run("2_keys", e, f"{keys.FAIL_MASK}=0")

    @property
    def order_totals(self) -> str:
        return self._run("order_totals")

    @property
    def quarantine(self) -> str:
        return self._run("quarantine")

    def core_audit(self, name: str) -> str:
        return self._run("audit", name)

    @property
    def finished(self) -> str:
        """Folder of one (entity, path) table per finished Core run, named by
        the time it finished and its snapshot."""
        return self._p("core", "finished")

    def analytics(self, report: str) -> str:
        return self._p("analytics", report)

    def audit(self, name: str) -> str:
        return self._p("audit", name)


# Finished Core runs that stay: the last one, and the one before it for readers
# that started on it.
KEEP_RUNS = 2


def finished_runs(spark: SparkSession, paths: LayerPaths) -> list[str]:
    """Pointer names of the finished Core runs, the latest first (a listing; ties
    in time go by snapshot name)."""
    return sources.files.child_names(spark, paths.finished)[::-1]


def _snapshot_of(pointer: str) -> str:
    return pointer.split("_", 1)[1]


def current_core(spark: SparkSession, paths: LayerPaths) -> LayerPaths:
    """``paths`` with the snapshot of the last Core run that finished."""
    runs = finished_runs(spark, paths)
    if not runs:
        raise FileNotFoundError(f"no finished Core run under {paths.root}")
    return replace(paths, snapshot=_snapshot_of(runs[0]))


def current_stages(spark: SparkSession, paths: LayerPaths) -> dict[str, str]:
    """entity -> Core stage of the last run that finished, all of one run."""
    runs = finished_runs(spark, paths)
    if not runs:
        raise FileNotFoundError(f"no finished Core run under {paths.root}")
    table = spark.read.parquet(f"{paths.finished}/{runs[0]}")
    return {r["entity"]: r["path"] for r in table.collect()}


def _publish(spark: SparkSession, paths: LayerPaths, stage: dict[str, str],
             keep_runs: int) -> None:
    """Make a Core run the current one: its pointer table is written among its
    own files and moved into ``core/finished`` in one rename.  Of the other
    finished runs the last ``keep_runs - 1`` stay; a pointer goes before the files
    it names.  Runs still under way are not listed there and are left alone."""
    pending = paths.core_audit("stages")
    sources.write_parquet(
        spark.createDataFrame(sorted(stage.items()), "entity string, path string").coalesce(1),
        pending,
    )
    pointer = f"{time.time_ns():020d}_{paths.snapshot}"
    sources.files.move_path(spark, pending, f"{paths.finished}/{pointer}")
    for old in finished_runs(spark, paths)[max(keep_runs, 1):]:
        sources.files.delete_path(spark, f"{paths.finished}/{old}")
        sources.files.delete_path(
            spark, replace(paths, snapshot=_snapshot_of(old)).core_run
        )


# Independent per-entity jobs (ingests, cleanses, dedups, FK children of the
# same depth, reports) are submitted from this many driver threads, so Spark
# runs their tasks side by side instead of leaving the cluster idle between
# small jobs.  The reference's DAGs ran the same steps as parallel tasks.
JOB_THREADS = 4


# Open Parquet writers per task for the FK stage write (each buffers up to a
# row group; values beyond this many in one task are sorted instead).
MAX_MASK_WRITERS = 16


_writers_lock = threading.Lock()
_writers_held: list[str] = []  # the setting before the first holder, once per holder


@contextmanager
def _mask_writers(spark: SparkSession, n: int) -> Iterator[None]:
    """Let a task keep ``n`` Parquet writers open.  The setting is the
    session's: runs at the same time hold it together, and the last one
    puts the value back that was there before the first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    with _writers_lock:
        _writers_held.append(_writers_held[0] if _writers_held else spark.conf.get(key))
        spark.conf.set(key, str(max(n, int(spark.conf.get(key)))))
    try:
        yield
    finally:
        with _writers_lock:
            before = _writers_held.pop()
            if not _writers_held:
                spark.conf.set(key, before)


def run_in_order(tasks: list[Callable[[], object]], threads: int = JOB_THREADS) -> list:
    """Run independent Spark jobs from driver threads; results in task order.

    All tasks finish before anything is raised; then the first failure in
    task order is raised, so a gate reports the same entity it would report
    run one by one."""
    if threads <= 1 or len(tasks) <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=min(threads, len(tasks))) as pool:
        futures = [pool.submit(t) for t in tasks]
    return [f.result() for f in futures]


def _metrics(spark, paths: LayerPaths, run_id: str, layer: str, written: dict[str, str],
             validation_passed: bool = True):
    frames = {e: spark.read.parquet(p) for e, p in written.items()}
    audit.append_layer_metrics(
        audit.layer_metrics(run_id, layer, frames, validation_passed=validation_passed),
        paths.audit("layer_metrics"),
        layer,
    )


# ---------------------------------------------------------------------- L1


def run_raw(spark: SparkSession, paths: LayerPaths, rules: Rules = RETAIL_RULES,
            run_id: str | None = None) -> list[dict]:
    """L1: S1 discovery -> S8 verified ingest per file -> S9 -> A1."""
    ensure_defaults(spark)
    run_id = run_id or uuid.uuid4().hex
    required = [f"{e}.csv" for e in rules.entity_order]
    found = sources.discover_sources(spark, paths.source, required)
    results = run_in_order(
        [
            partial(
                sources.ingest_file, spark, path, paths.raw_dir, rules.struct_type(e), e,
                multiline=e in rules.multiline_entities,
            )
            for path, e in zip(found, rules.entity_order)
        ]
    )
    sources.validate_raw_layer(spark, paths.raw_dir, rules.entity_order)
    _metrics(spark, paths, run_id, "raw", {e: paths.raw(e) for e in rules.entity_order})
    return results


# ---------------------------------------------------------------------- L2


def run_staging(spark: SparkSession, paths: LayerPaths, rules: Rules = RETAIL_RULES,
                run_id: str | None = None, on_quality_failure: str = "raise",
                raw_null_check: bool = False) -> DataFrame:
    """L2: G2 schema gate (footers only) -> E1-E7 cleanse and write -> G5
    quality gate on the written stage -> A1.  Returns the quality findings.

    The null-rate limits run on the cleaned stage, as in the reference, where
    a filled column (the product category) can no longer fail.
    ``raw_null_check`` also measures them on Raw, before cleaning, and
    writes ``audit/raw_null_rates``; in ``raise`` mode a failure there stops
    the layer too."""
    ensure_defaults(spark)
    run_id = run_id or uuid.uuid4().hex
    schemas = {
        e: sources.parquet_schema(spark, paths.raw(e))
        if sources.files.path_exists(spark, paths.raw(e)) else None
        for e in rules.schemas
    }
    checks.validate_all_schemas(spark, schemas, rules)
    if raw_null_check:
        raw_rates = audit._union(
            [
                checks.null_rate_findings(
                    to_snake_case(spark.read.parquet(paths.raw(e))), e, limits
                )
                for e, limits in rules.null_thresholds.items()
                if limits
            ]
        )
        sources.write_parquet(raw_rates, paths.audit("raw_null_rates"))
        # One row per configured limit: the failing ones are few, and the
        # first in rule order is reported.
        rank = {(e, c): i for i, (e, c) in enumerate(
            (e, c) for e, limits in rules.null_thresholds.items() for c in limits)}
        failing = sorted(
            spark.read.parquet(paths.audit("raw_null_rates")).filter(~F.col("passed")).collect(),
            key=lambda r: rank[(r["entity"], r["column"])],
        )
        if failing and on_quality_failure == "raise":
            r = failing[0]
            raise QualityCheckError(
                f"[{r['entity']}] null_rate on '{r['column']}' in Raw: "
                f"{r['null_rate']} exceeds limit {r['threshold']}"
            )

    def stage_one(e: str) -> None:
        cleaned = clean.clean_entity(e, spark.read.parquet(paths.raw(e)))
        sources.write_parquet(cleaned, paths.staging(e))

    run_in_order([partial(stage_one, e) for e in rules.entity_order])
    # G5 findings are computed once and written (a few rows per entity); the
    # gate and the metrics flag read that table, never the entities again.
    staged = {e: spark.read.parquet(paths.staging(e)) for e in rules.entity_order}
    sources.write_parquet(checks.quality_findings(staged, rules), paths.audit("quality_findings"))
    findings = spark.read.parquet(paths.audit("quality_findings"))
    if on_quality_failure == "raise":
        checks.raise_on_quality_failure(findings)
    passed = not findings.filter(~F.col("passed")).take(1)
    _metrics(spark, paths, run_id, "staging", {e: paths.staging(e) for e in rules.entity_order},
             validation_passed=passed)
    return findings


# ---------------------------------------------------------------------- L3


def fk_levels(rules: Rules) -> list[list[str]]:
    """FK children grouped by depth, in dependency order: every parent of an
    entity is cleaned in an earlier group (or is not a child at all)."""
    children = set(rules.foreign_keys)
    order = rules.fk_order()
    done: set[str] = set()
    levels = []
    while len(done) < len(order):
        level = [
            e
            for e in order
            if e not in done
            and all(
                fk.parent not in children or fk.parent in done or fk.parent == e
                for fk in rules.foreign_keys[e]
            )
        ]
        levels.append(level)
        done.update(level)
    return levels


def run_core(spark: SparkSession, paths: LayerPaths, rules: Rules = RETAIL_RULES,
             run_id: str | None = None, broadcast_max_rows: int = 1_000_000,
             known_duplicates: dict[str, int] | None = None,
             keep_runs: int = KEEP_RUNS) -> dict:
    """L3: D1 per entity -> F3 cascade -> R4 reconciliation -> A1, A2.

    Writes a snapshot of its own and publishes it at the end; the last
    ``keep_runs`` finished ones stay.  A run that fails takes only its own
    folder away, so the last good Core stays what ``current_core`` reads.

    ``known_duplicates``: entity -> duplicate count of the staged data for
    the rules' key, when the caller has just computed it (see
    ``duplicate_counts``); entities without one are counted here.

    ``broadcast_max_rows``: a parent whose stage holds at most this many rows
    (checked with an incremental take that stops past n rows) is broadcast to the FK
    joins.  Of a larger parent, the child's distinct keys that it lacks are written
    first; where they are at most so many they are broadcast instead, so that the
    child's rows stay where they are, and beyond that the rows are shuffled."""
    ensure_defaults(spark)
    run_id = run_id or uuid.uuid4().hex
    # A name of its own even when a run id is used again.
    paths = replace(paths, snapshot=f"{run_id}-{uuid.uuid4().hex[:12]}")
    try:
        out = _run_core(spark, paths, rules, run_id, broadcast_max_rows, known_duplicates)
    except BaseException:
        sources.files.delete_path(spark, paths.core_run)
        raise
    _publish(spark, paths, out["stages"], keep_runs)
    _metrics(spark, paths, run_id, "core", {e: out["stages"][e] for e in rules.entity_order})
    return {**out, "snapshot": paths.snapshot}


def _run_core(spark: SparkSession, paths: LayerPaths, rules: Rules, run_id: str,
              broadcast_max_rows: int, known_duplicates: dict[str, int] | None) -> dict:
    # Paths written by *this* run; later steps read only these, never a
    # stage a previous run may have left behind.
    stage: dict[str, str] = {}

    # D1.  ``known_duplicates`` (from ``run_layers``) carries the duplicate
    # count per entity (rows minus distinct keys) that the staging gate just
    # computed on this same staged data, so the keys are not shuffled again;
    # called on its own, the count is computed here.  No duplicates: a copy.
    # Duplicates: the winner per key with a tiebreaker, ``DeduplicationError``
    # without one.
    surplus_of = dict(known_duplicates or {})

    def dedup_one(e: str) -> tuple[str, int]:
        df = spark.read.parquet(paths.staging(e))
        deduped, removed = dedupe.dedup_entity(
            df, e, rules.primary_keys[e], rules.tiebreakers.get(e), surplus_of.get(e)
        )
        sources.write_parquet(deduped, paths.core("1_dedup", e))
        return e, removed

    dedup_rows = run_in_order([partial(dedup_one, e) for e in rules.entity_order])
    for e in rules.entity_order:
        stage[e] = paths.core("1_dedup", e)

    # children in dependency order.  Each child is flagged and written
    # once, partitioned by its failure mask; the per-rule counts are observed
    # during that write, the clean rows are the ``mask=0`` folder (the next
    # stage, no second copy) and the orphan lists read only the failing
    # folders, which partition pruning keeps small.
    def fk_one(e: str) -> tuple[str, list[tuple], DataFrame]:
        fks = rules.foreign_keys[e]
        parents = {fk.parent: spark.read.parquet(stage[fk.parent]) for fk in fks}
        # Parents with a proven small key set are broadcast.  Of the others
        # the missing keys are, where those are few; the rest stay shuffle
        # joins (AQE may still convert them from measured sizes).
        small = frozenset(
            name for name, df in parents.items() if fits_broadcast(df, broadcast_max_rows)
        )
        child = spark.read.parquet(stage[e])

        def lost_keys(i: int) -> tuple[int, DataFrame]:
            fk, path = fks[i], paths.core("2_absent", f"{e}-{i}")
            sources.write_parquet(
                absent_keys(child, fk.column, parents[fk.parent], fk.parent_column), path
            )
            return i, spark.read.parquet(path)

        large = [i for i, fk in enumerate(fks) if fk.parent not in small]
        absent = {
            i: lost for i, lost in run_in_order([partial(lost_keys, i) for i in large])
            if fits_broadcast(lost, broadcast_max_rows)
        }
        # Of a parent that is shuffled, a key that many rows hold is spread.
        hot = {fks[i].column: heavy_keys(child, fks[i].column) for i in large if i not in absent}
        flagged = keys._flag_all(
            child, fks, parents, small, keys.salt_columns(rules.primary_keys[e], fks), hot, absent
        )
        flags = [f"_fk_ok_{i}" for i in range(len(fks))]
        masked = flagged.select(*child.columns, keys.fail_mask(flags).alias(keys.FAIL_MASK))
        obs = Observation(f"fk_{e}_{uuid.uuid4().hex[:8]}")
        observed = masked.observe(
            obs,
            *[
                F.count_if(keys.failed_rule(keys.FAIL_MASK, i)).alias(f"rule_{i}")
                for i in range(len(fks))
            ],
        )
        sources.write_parquet(observed, paths.core("2_keys", e), partition_by=[keys.FAIL_MASK])
        counts = obs.get
        clean_path = paths.fk_clean(e)
        if not sources.files.path_exists(spark, clean_path):
            # Every row failed a rule: the clean stage is empty but typed.
            sources.write_parquet(spark.createDataFrame([], child.schema), clean_path)
        failing = spark.read.parquet(paths.core("2_keys", e)).filter(
            F.col(keys.FAIL_MASK) != 0
        )
        report = [(e, fk.column, fk.parent, int(counts[f"rule_{i}"])) for i, fk in enumerate(fks)]
        broken = [(fk, keys.failed_rule(keys.FAIL_MASK, i)) for i, fk in enumerate(fks)]
        return clean_path, report, keys.missing_values(failing, e, broken)

    # Children whose parents are all done run together (items, payments and
    # reviews all wait for orders only); reports keep dependency order.
    # A partitioned write normally sorts every task's rows by the partition
    # column.  A child has at most 2^rules mask values, so for this phase each
    # task keeps one open writer per value instead and the largest child is
    # never sorted just to be split (beyond the cap Spark sorts the rest).
    most_rules = max((len(fks) for fks in rules.foreign_keys.values()), default=0)
    fk_reports, fk_missing = [], []
    with _mask_writers(spark, min(2 ** most_rules, MAX_MASK_WRITERS)):
        for level in fk_levels(rules):
            for e, (clean_path, report, missing) in zip(
                level, run_in_order([partial(fk_one, e) for e in level])
            ):
                stage[e] = clean_path
                fk_reports.extend(report)
                fk_missing.append(missing)
    fk_report = spark.createDataFrame(
        fk_reports, "entity string, column string, parent string, removed_count bigint"
    )
    sources.write_parquet(fk_report, paths.core_audit("fk_report"))
    if fk_missing:
        sources.write_parquet(audit._union(fk_missing), paths.core_audit("fk_missing"))

    # Reconcile the current orders/items/payments.  The per-order totals
    # are written once and every output (summary, breakdown, quarantine)
    # reads them; the three tables then lose the quarantined orders by an
    # anti join against the *written* quarantine, not a recomputed one.
    orders = spark.read.parquet(stage["orders"])
    items = spark.read.parquet(stage["order_items"])
    payments = spark.read.parquet(stage["payments"])

    def materialize(totals: DataFrame) -> DataFrame:
        sources.write_parquet(totals, paths.order_totals)
        return spark.read.parquet(paths.order_totals)

    outcome = reconcile.run_reconciliation(
        orders, items, payments, rules.tolerance, rules.on_failure, materialize=materialize
    )
    # The stage is always written (unchanged tables in raise mode, an empty
    # quarantine when nothing failed) so a rerun never reads a stale one.
    quarantine = outcome.quarantine
    if quarantine is None:
        quarantine = reconcile.build_quarantine_records(
            *reconcile.reconcile_payments(items, payments, rules.tolerance), orders
        ).limit(0)
    sources.write_parquet(quarantine, paths.quarantine)
    if outcome.quarantine is None:
        kept = {"orders": orders, "order_items": items, "payments": payments}
    else:
        q = spark.read.parquet(paths.quarantine).select("order_id")
        # Distinct order ids: where they are too many to send, each task hashes
        # its share of them, so that the tables' rows need no sort.
        q = q.hint("broadcast" if fits_broadcast(q, broadcast_max_rows) else "shuffle_hash")
        kept = {
            "orders": reconcile.remove_quarantined(orders, q),
            "order_items": reconcile.remove_quarantined(items, q),
            "payments": reconcile.remove_quarantined(payments, q),
        }
    run_in_order(
        [partial(sources.write_parquet, df, paths.core("3_reconciled", e)) for e, df in kept.items()]
    )
    for e in kept:
        stage[e] = paths.core("3_reconciled", e)

    summary_cols = ["total_orders_checked", "orders_passed", "orders_failed",
                    "max_difference", "tolerance_used", "excluded_order_count"]
    recon_row = spark.createDataFrame(
        [tuple(outcome.summary[c] for c in summary_cols)],
        "total_orders_checked bigint, orders_passed bigint, orders_failed bigint, "
        "max_difference double, tolerance_used double, excluded_order_count bigint",
    )
    dedup_df = spark.createDataFrame(dedup_rows, "entity string, removed_count bigint")
    sources.write_parquet(
        audit.core_quality_report(dedup_df, fk_report, recon_row), paths.core_audit("core_quality")
    )
    # The rest of the reconciliation summary: mode, quarantined orders, and
    # the excluded orders by status.
    sources.write_parquet(
        recon_row.select(
            F.lit(run_id).alias("run_id"),
            "*",
            F.lit(outcome.summary["on_failure_mode"]).alias("on_failure_mode"),
            F.lit(outcome.summary.get("quarantined_order_count", 0)).cast("bigint")
            .alias("quarantined_order_count"),
        ),
        paths.core_audit("reconciliation"),
    )
    sources.write_parquet(outcome.breakdown, paths.core_audit("excluded_by_status"))
    return {
        "deduplication": [{"entity": e, "removed_count": n} for e, n in dedup_rows],
        "foreign_key_validation": [
            {"entity": e, "column": c, "parent": p, "removed_count": n}
            for e, c, p, n in fk_reports
        ],
        "financial_reconciliation": outcome.summary,
        "stages": dict(stage),
    }


# ---------------------------------------------------------------------- L4


def run_analytics(spark: SparkSession, paths: LayerPaths, run_id: str | None = None,
                  stages: dict[str, str] | None = None) -> dict:
    """L4: B1-B5 written -> G8 validation -> A1, A3.  ``stages`` (from
    ``run_core``) names the Core paths to read; without it those of the last
    Core run that finished.  The ranges, the validation findings and the
    overall status are written also when the validation then raises."""
    ensure_defaults(spark)
    run_id = run_id or uuid.uuid4().hex
    stages = stages or current_stages(spark, paths)

    def core(e: str) -> DataFrame:
        return spark.read.parquet(stages[e])

    orders, payments = core("orders"), core("payments")
    items, reviews = core("order_items"), core("reviews")
    built = {
        "sales_performance": reports.sales_performance(orders, payments),
        "customer_lifetime_value": reports.customer_lifetime_value(orders, payments),
        "seller_performance": reports.seller_performance(items, reviews),
        "product_performance": reports.product_performance(items, reviews),
        "customer_retention": reports.customer_retention(orders),
    }
    run_in_order(
        [partial(sources.write_parquet, df, paths.analytics(name)) for name, df in built.items()]
    )
    written = {name: spark.read.parquet(paths.analytics(name)) for name in built}
    findings = checks.analytics_validation_findings(
        written["sales_performance"], written["customer_lifetime_value"], payments
    )
    sources.write_parquet(findings, paths.audit("analytics_validation"))
    findings = spark.read.parquet(paths.audit("analytics_validation"))
    ranges = audit.report_ranges(
        {n: (written[n], cols) for n, cols in audit.REPORT_VALUE_COLUMNS.items()}
    )
    sources.write_parquet(ranges, paths.audit("report_ranges"))
    status = F.when(F.bool_and("passed"), F.lit("passed")).otherwise(F.lit("failed"))
    sources.write_parquet(
        findings.agg(status.alias("overall_status")).select(
            F.lit(run_id).alias("run_id"), "overall_status"
        ),
        paths.audit("analytics_status"),
    )
    validation = checks.run_analytics_validation(
        written["sales_performance"], written["customer_lifetime_value"], payments
    )
    _metrics(spark, paths, run_id, "analytics", {n: paths.analytics(n) for n in built})
    report = audit.analytics_quality_report(
        spark.read.parquet(paths.audit("report_ranges")), validation
    )
    # Orders without a purchase time cannot join a cohort; say how many.
    report["reports"]["customer_retention"]["orders_without_purchase_time"] = int(
        reports.undated_orders(orders).first()[0]
    )
    return report


def duplicate_counts(findings: DataFrame, rules: Rules) -> dict[str, int]:
    """entity -> duplicate count from G5 findings (one row per entity), for
    the findings whose key is the one ``rules`` dedup on."""
    out = {}
    for r in (
        findings.filter(F.col("check") == "primary_key")
        .select("entity", "column", "value")
        .collect()
    ):
        if r["column"] == ",".join(rules.primary_keys.get(r["entity"], [])):
            out[r["entity"]] = int(r["value"])
    return out


def run_layers(spark: SparkSession, root: str, rules: Rules = RETAIL_RULES,
               on_quality_failure: str = "raise") -> dict:
    """All four layers over ``root``/source/*.csv, one run id.  The staging
    gate's duplicate counts go straight to Core's dedup."""
    paths = LayerPaths(root)
    run_id = uuid.uuid4().hex
    raw = run_raw(spark, paths, rules, run_id)
    findings = run_staging(spark, paths, rules, run_id, on_quality_failure)
    core = run_core(spark, paths, rules, run_id,
                    known_duplicates=duplicate_counts(findings, rules))
    analytics = run_analytics(spark, paths, run_id, core["stages"])
    return {"run_id": run_id, "raw": raw, "core": core, "analytics": analytics}
