"""A1-A3 audit outputs as tables (the reference writes JSON files).

Row counts and value ranges are aggregates computed by Spark; only their few
result rows ever reach the driver.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def entity_row_counts(entities: dict[str, DataFrame]) -> DataFrame:
    """entity, row_count: one aggregate per entity, unioned into one job."""
    return _union(
        [
            df.agg(F.count(F.lit(1)).alias("row_count")).select(
                F.lit(name).alias("entity"), "row_count"
            )
            for name, df in entities.items()
        ]
    )


def layer_metrics(
    run_id: str,
    layer: str,
    entities: dict[str, DataFrame],
    status: str = "success",
    validation_passed: bool = True,
) -> DataFrame:
    """A1: run_id, layer, entity, row_count, status, validation_passed,
    completed_at."""
    return entity_row_counts(entities).select(
        F.lit(run_id).alias("run_id"),
        F.lit(layer).alias("layer"),
        "entity",
        "row_count",
        F.lit(status).alias("status"),
        F.lit(bool(validation_passed)).alias("validation_passed"),
        F.current_timestamp().alias("completed_at"),
    )


def append_layer_metrics(metrics: DataFrame, path: str, layer: str) -> None:
    """Append A1 rows of one layer to the run log.  Every call has a folder of
    its own (``layer=…/batch=…``): runs that end at the same time do not share
    a committer's work folder, so neither removes the other's files."""
    metrics.drop("layer").write.parquet(f"{path}/layer={layer}/batch=b{uuid.uuid4().hex}")


def core_quality_report(
    dedup: DataFrame, fk_report: DataFrame, reconciliation: DataFrame
) -> DataFrame:
    """A2: card, entity, column, metric, value (long rows).

    ``dedup``: entity, removed_count.  ``fk_report``: entity, column, parent,
    removed_count.  ``reconciliation``: the one-row R5 summary.
    """
    d = dedup.select(
        F.lit("deduplication").alias("card"),
        "entity",
        F.lit(None).cast("string").alias("column"),
        F.lit("removed_count").alias("metric"),
        F.col("removed_count").cast("double").alias("value"),
    )
    f = fk_report.select(
        F.lit("foreign_key_validation").alias("card"),
        "entity",
        "column",
        F.lit("removed_count").alias("metric"),
        F.col("removed_count").cast("double").alias("value"),
    )
    metrics = [c for c in reconciliation.columns]
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)
    r = reconciliation.selectExpr(f"stack({len(metrics)}, {stack}) AS (metric, value)").select(
        F.lit("financial_reconciliation").alias("card"),
        F.lit("orders").alias("entity"),
        F.lit(None).cast("string").alias("column"),
        "metric",
        "value",
    )
    return _union([d, f, r])


def report_ranges(reports: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """A3: report, column, row_count, min_value, max_value; one aggregate
    per report covering all of its value columns."""
    parts = []
    for name, (df, cols) in reports.items():
        agg = df.agg(
            F.count(F.lit(1)).alias("_rows"),
            *[F.min(c).cast("double").alias(f"_min{i}") for i, c in enumerate(cols)],
            *[F.max(c).cast("double").alias(f"_max{i}") for i, c in enumerate(cols)],
        )
        stack = ", ".join(f"'{c}', _min{i}, _max{i}" for i, c in enumerate(cols))
        parts.append(
            agg.selectExpr(
                f"'{name}' AS report", "_rows AS row_count",
                f"stack({len(cols)}, {stack}) AS (column, min_value, max_value)",
            ).select("report", "column", "row_count", "min_value", "max_value")
        )
    return _union(parts)


# Value columns summarised per report (the reference's choice).
REPORT_VALUE_COLUMNS = {
    "sales_performance": ["gmv", "aov"],
    "customer_lifetime_value": ["clv"],
    "seller_performance": ["revenue"],
    "product_performance": ["revenue"],
    "customer_retention": ["retention_rate"],
}


def analytics_quality_report(ranges: DataFrame, validation: dict) -> dict:
    """A3 summary: ranges (collected: a few rows per report) plus validation
    and the overall status."""
    reports: dict[str, dict] = {}
    for r in ranges.collect():
        rep = reports.setdefault(r["report"], {"row_count": r["row_count"], "value_ranges": {}})
        rep["value_ranges"][r["column"]] = {"min": r["min_value"], "max": r["max_value"]}
    return {
        "reports": reports,
        "validation": validation,
        "overall_status": "passed" if validation.get("passed") else "failed",
    }
