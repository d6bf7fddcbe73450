"""F1-F3 foreign-key cleaning with cascade.

A child row survives only if every one of its foreign keys is found in the
parent.  Each rule becomes one left join of the child against the parent's
*distinct* key column carrying a marker (no fan-out, child row count kept),
so all rule counts come from one aggregate over the flagged rows.  Parent key
sets are joined as ordinary joins: AQE broadcasts one at run time when its
measured size is under the broadcast threshold and otherwise keeps the
shuffle join, so a parent that grows with the data is never forced into
executor memory.

Counts follow the reference: a row failing several rules is counted under
each of them, and a null key is dropped and counted but never listed as a
missing value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.joins import flag_membership, flag_present
from strata.operators.dedupe import TEXT_KEYS
from strata.rules import ForeignKey, Rules

REPORT_COLUMNS = ["entity", "column", "parent", "removed_count"]

# Partition column of a flagged child written by the layer runner: bit i is
# set where rule i failed, so the folder ``_fk_fail_mask=0`` holds exactly the
# clean rows (a partition value lives in the folder name, not in the files).
FAIL_MASK = "_fk_fail_mask"
MAX_RULES = 62  # bits of a bigint


def fail_mask(flags: list[str]):
    """Bigint column: bit i set where boolean column ``flags[i]`` is False."""
    if len(flags) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} foreign keys per entity, got {len(flags)}")
    mask = F.lit(0).cast("bigint")
    for i, f in enumerate(flags):
        mask = mask + F.when(~F.col(f), F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    return mask


def failed_rule(mask_column: str, i: int):
    """True where rule ``i`` is marked failed in ``mask_column``."""
    return F.col(mask_column).bitwiseAND(F.lit(1 << i)) != 0


def check_foreign_key(
    child: DataFrame,
    column: str,
    parent: DataFrame,
    parent_column: str,
    flag: str = "_fk_ok",
    hot: list | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(child with boolean ``flag``, distinct missing values).

    ``missing`` has one column, ``column``: the non-null child values absent
    from the parent.  ``hot`` are key values to spread (``joins.heavy_keys``).
    """
    flagged = flag_membership(child, column, parent, parent_column, flag, hot=hot)
    missing = (
        flagged.filter(~F.col(flag) & F.col(column).isNotNull()).select(column).distinct()
    )
    return flagged, missing


def missing_values(flagged: DataFrame, entity: str, failed: list[tuple]) -> DataFrame:
    """entity, column, missing_value (text): the distinct non-null values that
    break a rule.  ``failed`` pairs each rule with its failure condition; all
    rules share one pass, a row giving one pair for each rule it breaks."""
    pairs = [
        F.when(
            broken & F.col(fk.column).isNotNull(),
            F.struct(
                F.lit(fk.column).alias("column"),
                F.col(fk.column).cast("string").alias("missing_value"),
            ),
        )
        for fk, broken in failed
    ]
    if not pairs:
        return flagged.sparkSession.createDataFrame(
            [], "entity string, column string, missing_value string"
        )
    return (
        flagged.select(F.explode(F.array_compact(F.array(*pairs))).alias("_pair"))
        .select(F.lit(entity).alias("entity"), "_pair.column", "_pair.missing_value")
        .distinct()
    )


def salt_columns(key: list[str], fks: list[ForeignKey]) -> list[str]:
    """Columns that tell an entity's rows apart for the null-key salt: its
    primary key and foreign-key columns."""
    return list(dict.fromkeys([*key, *[fk.column for fk in fks]]))


def _flag_all(
    df: DataFrame,
    fks: list[ForeignKey],
    parents: dict[str, DataFrame],
    broadcast_parents: frozenset[str] = frozenset(),
    salt: list[str] | None = None,
    hot: dict[str, list] | None = None,
    absent: dict[int, DataFrame] | None = None,
) -> DataFrame:
    """``absent``: of some rules, by number, the few child keys their parent lacks."""
    flagged = df
    for i, fk in enumerate(fks):
        if absent and i in absent:
            flagged = flag_present(flagged, fk.column, absent[i], f"_fk_ok_{i}")
            continue
        flagged = flag_membership(
            flagged,
            fk.column,
            parents[fk.parent],
            fk.parent_column,
            f"_fk_ok_{i}",
            broadcast_keys=fk.parent in broadcast_parents,
            salt_columns=salt,
            hot=(hot or {}).get(fk.column),
        )
    return flagged


def validate_entity_relationships(
    df: DataFrame,
    entity: str,
    fks: list[ForeignKey],
    parents: dict[str, DataFrame],
    key: list[str] | None = None,
    hot: dict[str, list] | None = None,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean rows, per-rule report, missing values).

    report: entity, column, parent, removed_count (one row per rule).
    missing: entity, column, missing_value (text), distinct per rule.
    The three frames share the flagged plan; materialise it once (a stage
    write or ``checkpoint``) when more than one of them is consumed at scale.
    ``key`` (the entity's primary key) narrows the null-key salt to the key
    and FK columns, so a plan that needs only the counts reads only those.
    ``hot`` maps a foreign-key column to its hot values (``joins.heavy_keys``),
    whose rows are spread over many tasks.
    """
    # Narrow the salt only when the frame carries the whole key.
    salt = salt_columns(key, fks) if key and all(k in df.columns for k in key) else None
    flagged = _flag_all(df, fks, parents, salt=salt, hot=hot)
    flags = [f"_fk_ok_{i}" for i in range(len(fks))]
    clean = flagged.filter(F.expr(" AND ".join(flags)) if flags else F.lit(True)).select(
        *df.columns
    )
    counts = flagged.agg(
        *[F.count_if(~F.col(f)).alias(f) for f in flags]
    ) if flags else None
    if counts is not None:
        stack = ", ".join(
            f"'{fk.column}', '{fk.parent}', `{f}`" for fk, f in zip(fks, flags)
        )
        report = counts.selectExpr(
            f"stack({len(fks)}, {stack}) AS (column, parent, removed_count)"
        ).select(F.lit(entity).alias("entity"), "column", "parent", "removed_count")
    else:
        report = df.sparkSession.createDataFrame(
            [], "entity string, column string, parent string, removed_count bigint"
        )
    failed = [(fk, ~F.col(f)) for fk, f in zip(fks, flags)]
    return clean, report, missing_values(flagged, entity, failed)


_EVENT = "struct<_g:int,_key:string,_known:boolean,_rule:int>"


def _same_as_text(a: T.DataType, b: T.DataType) -> bool:
    whole = T.IntegralType
    return isinstance(a, TEXT_KEYS) and (a == b or isinstance(a, whole) and isinstance(b, whole))


def _event(group: int, key: Column | None, known: Column | bool, rule: int) -> Column:
    """One row of the counting pass: a key that a parent holds (``known``), or
    a key that a child's rule ``rule`` looks for among the keys of ``group``."""
    return F.struct(
        F.lit(group).alias("_g"),
        (F.lit(None) if key is None else key).cast("string").alias("_key"),
        (known if isinstance(known, Column) else F.lit(known)).alias("_known"),
        F.lit(rule).alias("_rule"),
    ).cast(_EVENT)


def _unmatched(entities: dict[str, DataFrame], rules: Rules) -> tuple[DataFrame, list[tuple[str, ForeignKey]]]:
    """(unmatched keys, rules): a row for each child key that its parent does
    not hold, with ``_key`` as text (null for null keys) and ``_n0``, ``_n1``, ...: the
    rows that break each rule, in the order of the list.

    It needs no row-level join.  Every parent key and every child key
    becomes one row of one union, and a single aggregate by (parent, key) says
    whether the parent holds the key and how many rows of each rule name it.  It
    combines on the map side, so a key (or the null key) held by a third of all
    rows leaves each task as one row; each entity is scanned once and whole rows
    are never shuffled.  Only an entity that is a child *and* a parent is
    joined to its own parents, since its clean rows decide which keys it holds;
    so is a child whose key type differs from its parent's.
    """
    order = rules.fk_order()
    numbered = [(e, fk) for e in order for fk in rules.foreign_keys[e]]
    number = {pair: i for i, pair in enumerate(numbered)}
    parent_entities = {fk.parent for _, fk in numbered}
    groups: dict[tuple[str, str], int] = {}
    events: dict[str, list[Column]] = {}
    frames, clean = dict(entities), dict(entities)
    whole: dict[str, Column] = {}
    for e in order:
        fks, types = rules.foreign_keys[e], {f.name: f.dataType for f in entities[e].schema}
        joined = []
        for fk in fks:
            held = entities[fk.parent].schema[fk.parent_column].dataType
            if e in parent_entities or not _same_as_text(types[fk.column], held):
                joined.append(fk)
            else:
                group = groups.setdefault((fk.parent, fk.parent_column), len(groups))
                events.setdefault(e, []).append(_event(group, F.col(fk.column), False, number[e, fk]))
        if not joined:
            continue
        salt = salt_columns(rules.primary_keys.get(e) or [], fks)
        salt = salt if all(c in types for c in salt) else None
        parents = {fk.parent: clean[fk.parent] for fk in joined}
        frames[e] = _flag_all(entities[e], joined, parents, salt=salt)
        ok = [F.col(f"_fk_ok_{i}") for i in range(len(joined))]
        for flag, fk in zip(ok, joined):
            # No parent is in group -1, so these rows count as failed.
            events.setdefault(e, []).append(F.when(~flag, _event(-1, F.col(fk.column), False, number[e, fk])))
        if e in parent_entities:
            whole[e] = F.expr(" AND ".join(f"_fk_ok_{i}" for i in range(len(joined))))
            clean[e] = frames[e].filter(whole[e]).select(*entities[e].columns)
    for (parent, column), group in groups.items():
        holds = F.col(column).isNotNull() & whole.get(parent, F.lit(True))
        events.setdefault(parent, []).append(F.when(holds, _event(group, F.col(column), True, -1)))
    rows = None
    for e, own in events.items():
        one = F.array_compact(F.array(*own))
        part = frames[e].select(F.explode(one).alias("_e")).select("_e.*")
        rows = part if rows is None else rows.unionAll(part)
    names = [f"_n{i}" for i in range(len(numbered))]
    per_key = rows.groupBy("_g", "_key").agg(
        F.max("_known").alias("_known"),
        *[F.count_if(F.col("_rule") == i).alias(n) for i, n in enumerate(names)],
    )
    return per_key.filter(~F.col("_known")), numbered


def relationship_counts(entities: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """F3's report alone: entity, column, parent, removed_count, the same rows as
    ``clean_relationships`` reports, for callers that need no cleaned frames;
    see ``_unmatched``."""
    if not any(rules.foreign_keys.values()):
        return SparkSession.getActiveSession().createDataFrame(
            [], "entity string, column string, parent string, removed_count bigint"
        )
    keys, numbered = _unmatched(entities, rules)
    names = [f"_n{i}" for i in range(len(numbered))]
    counts = keys.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
    stack = ", ".join(f"'{e}', '{fk.column}', '{fk.parent}', {n}" for (e, fk), n in zip(numbered, names))
    return counts.selectExpr(f"stack({len(names)}, {stack}) AS ({', '.join(REPORT_COLUMNS)})")


def relationship_missing(entities: dict[str, DataFrame], rules: Rules) -> DataFrame:
    """F1's missing values of all rules: entity, column, missing_value (text), the
    same rows as ``clean_relationships`` lists.  The unmatched keys are distinct
    already, so the list costs no further shuffle (but where two rules of an
    entity share a column)."""
    if not any(rules.foreign_keys.values()):
        return SparkSession.getActiveSession().createDataFrame(
            [], "entity string, column string, missing_value string"
        )
    keys, numbered = _unmatched(entities, rules)
    broken = [
        F.when(F.col(f"_n{i}") > 0, F.struct(F.lit(e).alias("entity"), F.lit(fk.column).alias("column")))
        for i, (e, fk) in enumerate(numbered)
    ]
    found = (
        keys.filter(F.col("_key").isNotNull())
        .select(F.explode(F.array_compact(F.array(*broken))).alias("_r"), "_key")
        .select("_r.entity", "_r.column", F.col("_key").alias("missing_value"))
    )
    return found.distinct() if len({(e, fk.column) for e, fk in numbered}) < len(numbered) else found


def clean_relationships(
    entities: dict[str, DataFrame], rules: Rules, checkpoint_parents: bool = False
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """clean every child entity in dependency order, so rows dropped from
    a parent (an order of an unknown customer) also drop the rows that point
    at them (its items, payments and reviews): the cascade.

    Returns (entities after cleaning, report of all rules, missing values).
    The cleaned frames are lazy.  With ``checkpoint_parents`` a cleaned
    entity that later rules read as a parent is written once with a reliable
    ``checkpoint()`` (under ``spark.checkpoint.dir``), so its children do not
    each recompute its joins and a lost executor restarts from there.  The
    layer runner instead writes every step to its own stage path.
    """
    current = dict(entities)
    reports, missings = [], []
    later_parents = {fk.parent for fks in rules.foreign_keys.values() for fk in fks}
    for entity in rules.fk_order():
        fks = rules.foreign_keys[entity]
        parents = {fk.parent: current[fk.parent] for fk in fks}
        clean, report, missing = validate_entity_relationships(
            current[entity], entity, fks, parents, rules.primary_keys.get(entity)
        )
        if checkpoint_parents and entity in later_parents:
            clean = clean.checkpoint(eager=True)
        current[entity] = clean
        reports.append(report)
        missings.append(missing)
    if not reports:
        # No foreign-key rules: nothing is cleaned and both tables are empty.
        spark = SparkSession.getActiveSession()
        return (
            current,
            spark.createDataFrame([], "entity string, column string, parent string, "
                                      "removed_count bigint"),
            spark.createDataFrame([], "entity string, column string, missing_value string"),
        )
    report_all = reports[0]
    for r in reports[1:]:
        report_all = report_all.unionByName(r)
    missing_all = missings[0]
    for m in missings[1:]:
        missing_all = missing_all.unionByName(m)
    return current, report_all, missing_all
