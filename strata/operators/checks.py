"""G1-G8 quality gates as findings tables.

Every gate returns a small DataFrame of findings (one row per check, never
one per data row), computed with one aggregate per input, plus a thin
``raise_on_failure`` that collects only the failing findings.  The reference
stops at the first failure; here all findings are computed, and the error
names the first failing one in rule order.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.errors import (
    AnalyticsValidationError,
    PaymentValidationError,
    QualityCheckError,
    SchemaValidationError,
)
from strata.functions.columns import MONEY_TYPE, money
from strata.operators.dedupe import duplicate_summary
from strata.rules import TYPE_NAMES, Rules

logger = logging.getLogger(__name__)

FINDINGS_SCHEMA = (
    "check string, entity string, column string, metric string, "
    "value double, limit double, passed boolean"
)

# GMV of the sales report must equal the core payments within this amount.
GMV_TOLERANCE = 0.01


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def raise_on_failure(findings: DataFrame, error: type[Exception], describe=None) -> None:
    """Raise ``error`` naming the first failing finding (by ``_order`` if
    present) and how many fail: one aggregate, of which one row comes back."""
    order = F.col("_order") if "_order" in findings.columns else F.lit(0)
    failing = findings.filter(~F.col("passed"))
    found = failing.agg(
        F.count(F.lit(1)).alias("n"), F.min_by(F.struct(*findings.columns), order).alias("first")
    ).first()
    if found["n"]:
        first = found["first"].asDict()
        msg = describe(first) if describe else str(first)
        raise error(f"{msg} ({found['n']} failing check(s))")


# ------------------------------------------------------------------ G1


@dataclass(frozen=True)
class ValueRule:
    """A count of rows that break a rule on a value: ``fail`` stops the gate and
    fails the finding where any row does, ``warn`` is logged, ``record`` only
    counted.  The gate and the findings table are both made from the rules."""

    metric: str
    broken: Callable[[Column], Column]
    on_break: str
    message: str = ""


PAYMENT_RULES = (
    ValueRule("negative_count", lambda v: v < 0, "fail", "Negative payments: {n} rows have payment_value < 0."),
    ValueRule("zero_count", lambda v: v == 0, "warn", "{n} payments of exactly zero were read."),
    ValueRule("null_count", lambda v: v.isNull(), "record"),
    # NaN would turn every sum it enters into NaN, so it never passes as money.
    ValueRule("nan_count", lambda v: F.isnan(v), "fail", "Payments that are no number: {n} rows hold NaN."),
)


def value_count_columns(column: str, rules: tuple[ValueRule, ...]) -> list[Column]:
    """One count for each rule, usable in ``agg`` or in an ``Observation``."""
    return [F.count_if(r.broken(F.col(column))).alias(r.metric) for r in rules]


def check_value_counts(counts: dict, rules: tuple[ValueRule, ...], error: type[Exception]) -> dict:
    """The rules as a gate on counted values: log the warnings, raise the first
    failure in rule order, else return the counts."""
    found = {r.metric: int(counts[r.metric]) for r in rules}
    for r in rules:
        if r.on_break == "warn" and found[r.metric]:
            logger.warning("%s", r.message.format(n=found[r.metric]))
    for r in rules:
        if r.on_break == "fail" and found[r.metric]:
            raise error(r.message.format(n=found[r.metric]))
    return found


def value_findings(df: DataFrame, check: str, entity: str, column: str, rules: tuple[ValueRule, ...]) -> DataFrame:
    """The rules as a findings table, one row a rule, from one aggregate."""

    def finding(r: ValueRule) -> Column:
        fails = r.on_break == "fail"
        return F.struct(
            F.lit(r.metric).alias("metric"),
            F.col(r.metric).cast("double").alias("value"),
            F.lit(0.0 if fails else None).cast("double").alias("limit"),
            (F.col(r.metric) == 0 if fails else F.lit(True)).alias("passed"),
        )

    counts = df.agg(*value_count_columns(column, rules))
    return counts.select(
        F.lit(check).alias("check"),
        F.lit(entity).alias("entity"),
        F.lit(column).alias("column"),
        F.explode(F.array(*[finding(r) for r in rules])).alias("f"),
    ).select("check", "entity", "column", "f.*")


def payment_count_columns() -> list[Column]:
    """The G1 counts, e.g. for the ``Observation`` on the write of the ingest."""
    return value_count_columns("payment_value", PAYMENT_RULES)


def check_payment_counts(counts: dict) -> dict:
    """G1 on counted values: raise on negative and NaN payments, log zero ones."""
    return check_value_counts(counts, PAYMENT_RULES, PaymentValidationError)


def payment_value_checks(payments: DataFrame, entity: str = "payments") -> DataFrame:
    """G1 as a table: negative values and NaNs fail, zero values are a warning
    (passed), nulls are counted for the record."""
    return value_findings(payments, "payment_value", entity, "payment_value", PAYMENT_RULES)


def validate_payments(payments: DataFrame) -> dict:
    """G1 as a gate: raise where a finding fails, return the counts."""
    return check_payment_counts(payments.agg(*payment_count_columns()).first().asDict())


# ------------------------------------------------------------------ G2


def _type_name(dt: T.DataType) -> str:
    for name, t in TYPE_NAMES.items():
        if t == dt:
            return name
    return dt.simpleString()


SCHEMA_FINDINGS_SCHEMA = (
    "entity string, column string, expected_type string, actual_type string, "
    "status string, passed boolean, _order int"
)


def schema_finding_rows(
    entity: str, actual: T.StructType | None, expected: dict[str, str]
) -> list[tuple]:
    """G2 rows for one entity, compared from the schema alone (metadata: the
    footers, never a data row)."""
    for t in expected.values():
        if t not in TYPE_NAMES:
            raise ValueError(f"The rules name the type {t!r}, which is none of: {', '.join(sorted(TYPE_NAMES))}")
    fields = {f.name: f.dataType for f in actual.fields} if actual is not None else {}
    rows = []
    for i, (col, t) in enumerate(expected.items()):
        if actual is None:
            status, got = "dataset_missing", None
        elif col not in fields:
            status, got = "missing_column", None
        else:
            got = _type_name(fields[col])
            status = "ok" if got == t else "type_mismatch"
        rows.append((entity, col, t, got, status, status == "ok", i))
    return rows


def schema_findings(
    spark: SparkSession, entity: str, actual: T.StructType | None, expected: dict[str, str]
) -> DataFrame:
    """G2 for one entity: entity, column, expected_type, actual_type, status,
    passed.  ``actual`` is a schema (footer only, no row is read); ``None``
    means the dataset is missing.  Extra columns are allowed; an expected
    column that is missing or has another type fails; type names are exact
    (``int`` is not ``Int64``)."""
    return spark.createDataFrame(
        schema_finding_rows(entity, actual, expected), SCHEMA_FINDINGS_SCHEMA
    )


def validate_all_schemas(
    spark: SparkSession, schemas: dict[str, T.StructType | None], rules: Rules
) -> DataFrame:
    """G2 over all entities in rule order; raises on the first failure.

    The comparison is metadata only, so it is checked on the driver without
    a Spark job; the findings are returned as a table."""
    rows = [
        (*r[:-1], r[-1] + 1000 * i)
        for i, e in enumerate(rules.schemas)
        for r in schema_finding_rows(e, schemas.get(e), rules.schemas[e])
    ]
    failing = [r for r in rows if not r[5]]
    if failing:
        entity, column, expected, actual, status = failing[0][:5]
        n = len(failing)
        raise SchemaValidationError(
            f"[{entity}] column '{column}' {status}: has type {actual}, expected {expected} "
            f"({n} failing check(s))"
        )
    return spark.createDataFrame(rows, SCHEMA_FINDINGS_SCHEMA)


# ---------------------------------------------------------------- G3-G5


def primary_key_findings(df: DataFrame, entity: str, key: list[str]) -> DataFrame:
    """Entity, key, rows, distinct_keys, duplicated_keys, surplus_rows,
    passed (zero tolerance; composite keys supported)."""
    return duplicate_summary(df, key).select(
        F.lit(entity).alias("entity"),
        F.lit(",".join(key)).alias("key"),
        "rows",
        "distinct_keys",
        "duplicated_keys",
        "surplus_rows",
        (F.col("surplus_rows") == 0).alias("passed"),
    )


def null_rate_findings(df: DataFrame, entity: str, thresholds: dict[str, float]) -> DataFrame:
    """Entity, column, null_rate, threshold, passed; one aggregate for all
    named columns.  Rate = nulls / rows, 0.0 on an empty frame; fails only
    when the rate is above the limit."""
    missing = [c for c in thresholds if c not in df.columns]
    if missing:
        raise ValueError(f"[{entity}] null threshold column(s) not found: {missing}")
    n = F.count(F.lit(1))
    rates = df.agg(
        *[
            F.when(n > 0, F.count_if(F.col(c).isNull()).cast("double") / n)
            .otherwise(F.lit(0.0))
            .alias(f"r{i}")
            for i, c in enumerate(thresholds)
        ]
    )
    return rates.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(entity).alias("entity"),
                        F.lit(c).alias("column"),
                        F.col(f"r{i}").alias("null_rate"),
                        F.lit(float(t)).alias("threshold"),
                        (F.col(f"r{i}") <= F.lit(float(t))).alias("passed"),
                    )
                    for i, (c, t) in enumerate(thresholds.items())
                ]
            )
        ).alias("f")
    ).select("f.*")


def entity_profile(df: DataFrame, key: list[str], null_columns: list[str]) -> DataFrame:
    """One pass over ``df`` for G3 and G4 together: rows, distinct_keys,
    duplicated_keys, surplus_rows and a null count per named column.

    Rows are grouped by the key (partial aggregation on the map side), so the
    null counts ride along the key shuffle instead of costing a second scan.
    """
    missing = [c for c in [*key, *null_columns] if c not in df.columns]
    if missing:
        raise ValueError(f"column(s) not found: {missing}")
    per_key = df.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_z{i}") for i, c in enumerate(null_columns)],
    )
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.count_if(F.col("_n") > 1).alias("duplicated_keys"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("long").alias("surplus_rows"),
        *[
            F.coalesce(F.sum(f"_z{i}"), F.lit(0)).cast("long").alias(f"_z{i}")
            for i in range(len(null_columns))
        ],
    )


def quality_findings(entities: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """Primary-key then null-rate findings for each entity in rule order,
    in the common findings shape (plus ``_order``).  One aggregate per
    entity covers both checks."""
    parts = []
    for i, (entity, key) in enumerate(rules.primary_keys.items()):
        thresholds = rules.null_thresholds.get(entity, {})
        cols = list(thresholds)
        prof = entity_profile(entities[entity], key, cols)
        rows = [
            f"'primary_key', '{','.join(key)}', 'duplicate_count', "
            f"CAST(surplus_rows AS DOUBLE), CAST(0.0 AS DOUBLE), surplus_rows = 0, {2 * i}"
        ]
        for j, (c, t) in enumerate(thresholds.items()):
            rate = f"(CASE WHEN rows > 0 THEN CAST(_z{j} AS DOUBLE) / rows ELSE 0.0 END)"
            rows.append(
                f"'null_rate', '{c}', 'null_rate', {rate}, CAST({float(t)!r} AS DOUBLE), "
                f"{rate} <= CAST({float(t)!r} AS DOUBLE), {2 * i + 1}"
            )
        parts.append(
            prof.selectExpr(
                f"stack({len(rows)}, {', '.join(rows)}) "
                "AS (check, column, metric, value, limit, passed, _order)"
            ).select(
                "check", F.lit(entity).alias("entity"), "column", "metric", "value", "limit",
                "passed", "_order",
            )
        )
    return _union(parts)


def raise_on_quality_failure(findings: DataFrame) -> None:
    """Raise ``QualityCheckError`` naming the first failing G5 finding."""
    raise_on_failure(
        findings,
        QualityCheckError,
        lambda r: f"[{r['entity']}] {r['check']} on '{r['column']}': "
        f"{r['metric']}={r['value']} exceeds limit {r['limit']}",
    )


def run_quality_check(entities: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """G5 as a gate: raise ``QualityCheckError`` on the first failing check."""
    findings = quality_findings(entities, rules)
    raise_on_quality_failure(findings)
    return findings


# ---------------------------------------------------------------- G6-G8


def gmv_reconciliation(sales: DataFrame, payments: DataFrame, tolerance: float = GMV_TOLERANCE):
    """analytics_gmv, core_payments_total, difference, passed (one row).

    Both totals come from one aggregate over the two inputs tagged and
    unioned (no cross join); sums are exact decimals.
    """
    tagged = sales.select(
        money("gmv").alias("_gmv"), F.lit(None).cast(MONEY_TYPE).alias("_pay")
    ).unionByName(
        payments.select(F.lit(None).cast(MONEY_TYPE).alias("_gmv"), money("payment_value").alias("_pay"))
    )
    zero = F.lit(0).cast(MONEY_TYPE)
    totals = tagged.agg(
        F.coalesce(F.sum("_gmv"), zero).alias("_a"), F.coalesce(F.sum("_pay"), zero).alias("_c")
    )
    diff = F.abs(F.col("_a") - F.col("_c"))
    return totals.select(
        F.col("_a").cast("double").alias("analytics_gmv"),
        F.col("_c").cast("double").alias("core_payments_total"),
        diff.cast("double").alias("difference"),
        (diff <= F.lit(f"{tolerance:.20f}").cast(MONEY_TYPE)).alias("passed"),
    )


def key_null_findings(sales: DataFrame, clv: DataFrame) -> DataFrame:
    """Column, null_count, passed for gmv, aov (sales) and clv."""
    s = sales.agg(
        F.count_if(F.col("gmv").isNull()).alias("gmv"),
        F.count_if(F.col("aov").isNull()).alias("aov"),
    ).selectExpr("stack(2, 'gmv', gmv, 'aov', aov) AS (column, null_count)")
    c = clv.agg(F.count_if(F.col("clv").isNull()).alias("null_count")).select(
        F.lit("clv").alias("column"), "null_count"
    )
    return s.unionByName(c).withColumn("passed", F.col("null_count") == 0)


def analytics_validation_findings(
    sales: DataFrame, clv: DataFrame, payments: DataFrame, tolerance: float = GMV_TOLERANCE
) -> DataFrame:
    """G8 as a table: check, column, metric, value, limit, passed; the G6 row
    first, then the three G7 rows (the order the gate raises in)."""
    gmv = gmv_reconciliation(sales, payments, tolerance).select(
        F.lit("gmv_reconciliation").alias("check"),
        F.lit(None).cast("string").alias("column"),
        F.lit("difference").alias("metric"),
        F.col("difference").alias("value"),
        F.lit(float(tolerance)).alias("limit"),
        "passed",
        F.lit(0).alias("_order"),
    )
    nulls = key_null_findings(sales, clv).select(
        F.lit("null_check").alias("check"),
        "column",
        F.lit("null_count").alias("metric"),
        F.col("null_count").cast("double").alias("value"),
        F.lit(0.0).alias("limit"),
        "passed",
        F.when(F.col("column") == "gmv", 1).when(F.col("column") == "aov", 2).otherwise(3)
        .alias("_order"),
    )
    return gmv.unionByName(nulls).orderBy("_order").drop("_order")


def run_analytics_validation(sales: DataFrame, clv: DataFrame, payments: DataFrame) -> dict:
    """G6 then G7; raises ``AnalyticsValidationError`` on a failure."""
    gmv = gmv_reconciliation(sales, payments).first().asDict()
    if not gmv["passed"]:
        raise AnalyticsValidationError(
            f"Monthly GMV adds up to {gmv['analytics_gmv']:.2f}, but Core payments to "
            f"{gmv['core_payments_total']:.2f}: {gmv['difference']:.4f} apart, where "
            f"{GMV_TOLERANCE} is allowed"
        )
    nulls = {r["column"]: r["null_count"] for r in key_null_findings(sales, clv).collect()}
    for column in ("gmv", "aov", "clv"):
        if nulls[column] > 0:
            raise AnalyticsValidationError(
                f"Report column '{column}' holds {nulls[column]} nulls"
            )
    gmv.pop("passed")
    return {"gmv_reconciliation": gmv, "null_checks": nulls, "passed": True}
