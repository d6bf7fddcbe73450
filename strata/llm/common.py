"""Helpers shared by the operators of this package.

Every operator takes DataFrames and reads from them only the columns it names
in its docstring, so further columns (whatever their names) never clash.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

#: Text of this many bytes is worked on at a time.
SLICE_BYTES = 2 << 20

#: The columns of ``documents`` and their types, in order.
DOCUMENT = (("doc_id", "long"), ("text", "string"), ("lang", "string"), ("source", "string"), ("n_chars", "long"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame) -> DataFrame:
    """The five columns of ``documents``, in order, whatever else ``df`` has."""
    return df.select(*[F.col(c).cast(t).alias(c) for c, t in DOCUMENT])


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Bound the Arrow batches handed to Python: this many documents at most."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that the session names."""
    return f"{ensure_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here, so
    the shuffle files of the write go once it is done."""
    spark = df.sparkSession
    path = scratch(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path, compression=codec)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Delete tables made by ``written`` after their last reader has run."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def crc_fold(doc_id: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null id: the empty text's)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def range_bounds(df: DataFrame, key: str, n: int) -> list[float]:
    """At most ``n - 1`` ascending cut points that split ``key`` into ranges of
    about equal row counts, from a scan of that column alone."""
    got = df.agg(F.percentile_approx(F.col(key), [i / n for i in range(1, n)], 10 * n).alias("q")).first() if n > 1 else None
    return sorted({int(x) for x in (got["q"] if got and got["q"] else [])})


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """Number of cut points below or at ``key`` by binary search; null: 0.

    A balanced tree of comparisons, so its depth is the logarithm of the count.
    """
    if not bounds:
        return F.lit(0)
    # array_position on the sorted cut points would be linear; a nested CASE
    # tree grows with n, so two levels of arrays keep the expression small.
    step = max(1, round(len(bounds) ** 0.5))
    heads = bounds[step - 1 :: step]
    count = lambda values, k: F.size(F.filter(F.lit(values).cast("array<bigint>"), lambda b: b <= k))
    block = count(heads, key)
    blocks = [bounds[i : i + step] for i in range(0, len(bounds) + 1, step)]
    table_ = F.array(*[F.lit(b).cast("array<bigint>") if b else F.array().cast("array<bigint>") for b in blocks])
    inner = F.size(F.filter(F.get(table_, block), lambda b: b <= key))
    return F.coalesce(block * step + F.when(inner < 0, 0).otherwise(inner), F.lit(0))


def slices(batch: pa.RecordBatch, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Stretches of a batch's rows with at most ``limit`` bytes of text and
    binaries each (a longer row is a stretch of its own): working arrays are a
    multiple of that, however long the texts of a batch are."""
    size = np.zeros(batch.num_rows, "i8")
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_large_string(c.type) or pa.types.is_binary(c.type):
            size += np.asarray(pc.fill_null(pc.binary_length(c), 0)).astype("i8")
    upto, lo = np.cumsum(size), 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(upto, upto[lo] - size[lo] + limit, "right"))
        hi = max(lo + 1, hi)
        # Copied, not sliced: some Arrow text kernels misread arrays with an offset.
        yield batch if hi - lo == batch.num_rows else batch.take(pa.array(np.arange(lo, hi)))
        lo = hi


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, limit: int = SLICE_BYTES) -> DataFrame:
    """``mapInArrow`` for a function of one bounded stretch of rows."""

    def run(batches):
        for b in batches:
            for part in slices(b, limit):
                yield fn(part)

    return df.mapInArrow(run, schema)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph: (id, component), component the least id.

    ``edges`` has long columns ``a`` and ``b``.  Alternating large-star and
    small-star steps; each is a per-node minimum (combined before the shuffle,
    so a hub costs no task more than others) and a join.  Every step ends in a
    table in the shared folder.  Vertices without an edge are not returned.
    """
    e = written(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")

    def star(e: DataFrame, large: bool) -> DataFrame:
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        if large:
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            out = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            low = e.groupBy("u").agg(F.min("v").alias("m"))
            out = e.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    def mark(e: DataFrame) -> tuple:
        # Rows and an order-free checksum of 64-bit hashes: equal only if nothing moved.
        return tuple(e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = mark(e)
    for _ in range(max_rounds):
        e = written(star(star(e, True), False), "cc")
        now = mark(e)
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(e.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int) -> tuple[DataFrame, dict[int, int]]:
    """A bounded sample to learn from, and all learnable labels' counts by class.

    Only rows whose ``crc_fold`` is not 0 are used.  Of each class, the
    ``per_class`` documents least by a hash of doc_id; those longer than
    ``max_chars`` are not learned from.  A doc_id with several labels counts
    once, with the larger; of rows that share a doc_id one is learned from, that
    of the least text hash.  Columns: doc_id, text, lang, y.
    """
    usable = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & (crc_fold(F.col("doc_id")) != 0))
    usable = usable.groupBy("doc_id").agg(F.max(F.col(label)).cast("int").alias("y"))
    counts = {r["y"]: r["count"] for r in usable.groupBy("y").count().collect()}
    picked = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class)
        picked = part if picked is None else picked.unionAll(part)
    rows = [(r["doc_id"], r["y"]) for r in picked.collect()]  # at most 2 * per_class ids
    ids = F.broadcast(docs.sparkSession.createDataFrame(rows, "doc_id long, y int"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    found = docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.col("lang").cast("string")).join(ids, "doc_id")
    one = F.min_by(F.struct("text", "lang", "y"), F.struct(F.xxhash64("text"), "text", "lang"))
    found = found.where(F.char_length("text") <= max_chars).groupBy("doc_id").agg(one.alias("row"))
    return found.select("doc_id", "row.text", "row.lang", "row.y"), counts


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


def platt(z: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """(a, b) so that sigmoid(a z + b) fits y, by weighted Newton steps with a
    little smoothing of the targets."""
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    if not n1 or not n0:
        return 1.0, 0.0
    target = np.where(y == 1, 1 - 1 / (len(y) + 2), 1 / (len(y) + 2))
    x = np.stack((z, np.ones_like(z)), 1)
    v = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(x @ v)
        g = x.T @ (weight * (p - target)) + np.array([1e-3 * (v[0] - 1), 0])
        h = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag([1e-3, 1e-9])
        move = np.linalg.solve(h, g)
        v -= np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-6:
            break
    return float(max(v[0], 1e-3)), float(v[1])
