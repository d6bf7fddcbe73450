"""Column-level building blocks (names, strings, timestamps, money).

Every function here is a projection built from ``pyspark.sql.functions``, so
Catalyst folds a chain of them into one Project inside whole-stage codegen.
Name checks happen on the driver against ``df.columns`` (metadata only).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Timestamp layout of the raw text columns (Spark datetime pattern).
TIMESTAMP_PATTERN = "yyyy-MM-dd HH:mm:ss"

# Exact money arithmetic: values are summed as decimals, so a sum does not
# depend on shuffle order, and cast back to double on output.  Eight decimals
# and twenty digits before them: no amount that prices or fees have is rounded,
# a tolerance is compared at the same scale, and sums widen to 38 digits, so a
# total over a hot key at any scale still fits.  A larger amount raises under
# ANSI rather than wrapping.  NaN has no decimal: it becomes null here, the
# payments gate (G1) fails on it and reconciliation (R1) fails its order.
MONEY_TYPE = "decimal(28,8)"


def _require(df: DataFrame, columns: list[str], caller: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{caller}: column(s) not found in DataFrame: {missing}")


def snake_name(name: str) -> str:
    """strip, lower, then space and hyphen to underscore (only those two)."""
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def to_snake_case(df: DataFrame) -> DataFrame:
    """Rename every column to snake_case; two names mapping to one raise."""
    names = [snake_name(c) for c in df.columns]
    if len(set(names)) != len(names):
        seen: dict[str, list[str]] = {}
        for old, new in zip(df.columns, names):
            seen.setdefault(new, []).append(old)
        clashes = {k: v for k, v in seen.items() if len(v) > 1}
        raise ValueError(f"to_snake_case: column names collide: {clashes}")
    if names == df.columns:
        return df
    return df.toDF(*names)


def uppercase_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Upper-case the named string columns only."""
    _require(df, columns, "uppercase_columns")
    return df.withColumns({c: F.upper(F.col(c)) for c in columns})


def parse_timestamp(col: str | Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Strict parse to ``timestamp_ntz``: null stays null, a malformed value
    raises at run time (ANSI mode, see ``session.REQUIRED_CONF``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.to_timestamp_ntz(c, F.lit(pattern))


def try_parse_timestamp(col: str | Column, pattern: str = TIMESTAMP_PATTERN) -> Column:
    """Lenient parse: a malformed value becomes null (used to count bad rows)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c, F.lit(pattern)).cast("timestamp_ntz")


def parse_dates(
    df: DataFrame, columns: list[str], pattern: str = TIMESTAMP_PATTERN
) -> DataFrame:
    """Strict timestamp parse of the named columns."""
    _require(df, columns, "parse_dates")
    return df.withColumns({c: parse_timestamp(c, pattern) for c in columns})


def unparsable_dates(
    df: DataFrame, columns: list[str], pattern: str = TIMESTAMP_PATTERN
) -> DataFrame:
    """Quarantine form of P3: count per column the non-null values that do not
    parse (one aggregate, no exception)."""
    _require(df, columns, "unparsable_dates")
    return df.agg(
        *[
            F.count_if(F.col(c).isNotNull() & try_parse_timestamp(c, pattern).isNull()).alias(c)
            for c in columns
        ]
    )


def fill_null_with(df: DataFrame, column: str, value) -> DataFrame:
    """Fill nulls of one named column with one value."""
    _require(df, [column], "fill_null_with")
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def rename_strict(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P5: rename columns; an absent source name raises (Spark ignores it)."""
    _require(df, list(mapping), "rename_strict")
    return df.withColumnsRenamed(mapping)


def month_label(col: str | Column) -> Column:
    """``yyyy-MM`` text of a naive timestamp; sorts chronologically."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM")


def month_index(col: str | Column) -> Column:
    """Months since year 0 (``year * 12 + month - 1``) as an int.

    Grouping, min/max and month ranges run on this fixed-width value (hash
    aggregation, cheap shuffles); ``month_label_of`` turns it into the
    ``yyyy-MM`` text only on the few output rows."""
    c = F.col(col) if isinstance(col, str) else col
    return F.year(c) * 12 + F.month(c) - 1


def month_label_of(index: str | Column) -> Column:
    """``yyyy-MM`` text of a ``month_index`` value (same text as ``month_label``);
    null for a null month."""
    i = F.col(index) if isinstance(index, str) else index
    text = F.format_string("%04d-%02d", F.floor(i / 12).cast("int"), (F.pmod(i, F.lit(12)) + 1))
    return F.when(i.isNotNull(), text)


def money(col: str | Column) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return c.cast(MONEY_TYPE)


def money_sum(col: str | Column) -> Column:
    """A-sum: exact decimal sum, 0.0 for an all-null or empty group (the
    reference's frame library sums nulls to zero), returned as double."""
    return F.coalesce(F.sum(money(col)), F.lit(0).cast(MONEY_TYPE)).cast("double")
