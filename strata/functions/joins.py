"""Join helpers with explicit size bounds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Default row bound under which a key set is shipped to every executor.
BROADCAST_MAX_ROWS = 2_000_000


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> bool:
    """True when ``df`` provably holds at most ``max_rows`` rows.

    The check asks for the row after the first ``max_rows``
    (``offset(max_rows).limit(1)``), which Spark runs as an incremental
    take: one partition first, then four times more per round, each task
    reading only the rows still needed, so it stops once the bound is passed
    and never scans a large input whole.  It projects a literal, so a file
    scan reads no column data, and the counted rows stay in the JVM: at most
    one reaches Python.  (``limit(n).count()`` would instead read up to n
    rows from *every* partition and shuffle them to one task.)  A frame
    behind a shuffle is computed up to that shuffle first; pass the
    smallest upstream frame that bounds it, e.g. a written stage."""
    probe = df.select(F.lit(1).alias("_row")).offset(max_rows).limit(1)
    return len(probe.collect()) == 0


def bounded_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``df`` only when ``fits_broadcast`` proves its size bound.

    Above the bound the frame is returned unhinted and the join stays a
    shuffle join (AQE may still convert it at run time from measured sizes).
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


# Null child keys never match a parent, yet hash to one shuffle partition:
# a third of all rows with a null key would land in one task.  They are
# spread over this many partitions by a salt taken from the row's own values.
NULL_KEY_SALTS = 64

# A non-null key held by this share of a child's rows or more is hot: its rows
# are spread likewise, and only its parent key is repeated for every salt.
HOT_SHARE = 1 / 256
HOT_KEYS = 255  # as many keys as can reach the share
HOT_TRACKED = 8192  # counters of the sketch; a hot key is never pushed out
HOT_KEY_SALTS = 64


def heavy_keys(child: DataFrame, column: str, share: float = HOT_SHARE) -> list:
    """The non-null values of ``column`` that ``share`` of the rows or more hold,
    from one scan of that column with a frequent-items sketch that is merged
    per task (no shuffle by key).  At most ``1 / share`` values reach the driver.
    A sketch may name a key that is a little below the share; that costs a few
    more copies of one parent key and changes no result."""
    found = child.agg(
        F.expr(f"approx_top_k(`{column}`, {HOT_KEYS}, {HOT_TRACKED})").alias("top"),
        F.count(F.lit(1)).alias("rows"),
    ).first()
    return [r["item"] for r in found["top"] or [] if r["item"] is not None and r["count"] >= share * found["rows"]]


def absent_keys(child: DataFrame, column: str, keys: DataFrame, key_column: str) -> DataFrame:
    """``column``: the distinct non-null child values that are not among the keys.

    The child's values are made distinct on the map side first, so this shuffles
    at most one narrow row per value and task, never whole child rows."""
    own = child.select(column).filter(F.col(column).isNotNull()).distinct()
    held = keys.select(F.col(key_column).alias(column)).filter(F.col(column).isNotNull())
    return own.join(held.hint("shuffle_hash"), column, "left_anti")


def flag_present(child: DataFrame, column: str, absent: DataFrame, flag: str) -> DataFrame:
    """``flag_membership`` for a key set of which only the child's ``absent`` values
    (``absent_keys``, few) are known: they go to every executor and no child row
    is shuffled.  A null child value is flagged False."""
    marker = f"__{flag}_absent"
    lost = F.broadcast(absent.select(column).withColumn(marker, F.lit(True)))
    found = F.col(column).isNotNull() & F.col(marker).isNull()
    return child.join(lost, column, "left").select(*child.columns, found.alias(flag))


def _among(column: str, values: list) -> Column:
    return F.col(column).isin(values) if values else F.lit(False)


def flag_membership(
    child: DataFrame,
    column: str,
    keys: DataFrame,
    key_column: str,
    flag: str,
    broadcast_keys: bool = False,
    salt_columns: list[str] | None = None,
    hot: list | None = None,
) -> DataFrame:
    """Add boolean ``flag``: True where ``child[column]`` is among the keys.

    A left join against the *distinct* keys with a literal marker keeps the
    child's row count (no fan-out) and makes per-rule counts a single pass.
    A null child value never matches, so its flag is False; those rows get a
    deterministic salt in the join key so they do not pile into one task.
    So do rows of a ``hot`` key (see ``heavy_keys``), whose parent key is
    repeated once for every salt; all other parent keys are sent once.
    ``broadcast_keys`` ships the key set to every executor; set it only after
    bounding its size (see ``bounded_broadcast``).  ``salt_columns`` are the
    columns the salt hashes (default: all of them).  Pass the entity's key
    columns: they tell its rows apart just as well, and a plan that needs
    only the flags then reads only those columns.
    """
    marker = f"__{flag}_hit"
    salt = f"__{flag}_salt"
    hot = [] if broadcast_keys else list(hot or [])
    # The parent salt is always 0 but for hot keys, written as an expression of
    # the key so Catalyst keeps it a join key (a literal 0 is folded into a join
    # filter, and the null rows would again share one partition).  It is
    # there before the distinct, whose partitioning the join then reuses.
    salts = F.pmod(F.xxhash64(column), F.lit(1)).cast("int")
    if hot:
        every = F.sequence(F.lit(0), F.lit(HOT_KEY_SALTS - 1))
        salts = F.explode(F.when(_among(column, hot), every).otherwise(F.array(salts)))
    k = (
        keys.select(F.col(key_column).alias(column))
        .filter(F.col(column).isNotNull())
        .select(column, salts.alias(salt))
        .distinct()
        .withColumn(marker, F.lit(True))
    )
    if broadcast_keys:
        k = F.broadcast(k)
    own = F.xxhash64(*(salt_columns or child.columns))
    spread = F.when(F.col(column).isNull(), F.pmod(own, F.lit(NULL_KEY_SALTS)))
    if hot:
        spread = spread.when(_among(column, hot), F.pmod(own, F.lit(HOT_KEY_SALTS)))
    salted = child.withColumn(salt, spread.otherwise(F.lit(0)).cast("int"))
    return salted.join(k, on=[column, salt], how="left").select(
        *child.columns, F.coalesce(F.col(marker), F.lit(False)).alias(flag)
    )
