"""Source discovery, CSV and Parquet scans, verified ingest, sinks.

File listings go through the cluster's Hadoop ``FileSystem`` (works for HDFS
and object stores alike); data always goes through Spark readers and writers.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.errors import SchemaValidationError, SourceError
from strata.operators.checks import check_payment_counts, payment_count_columns
from strata.session import ensure_checkpoint_dir

# ------------------------------------------------------------------ listing


def _fs_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str, prune_empty_parent: bool = False) -> None:
    """Remove a dataset folder (used to withdraw output that failed a gate).
    ``prune_empty_parent`` also removes the parent folder when nothing else
    is left in it, restoring the state before the write."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)
    parent = p.getParent()
    if prune_empty_parent and parent is not None and fs.exists(parent):
        if len(fs.listStatus(parent)) == 0:
            fs.delete(parent, True)


def child_names(spark: SparkSession, directory: str) -> list[str]:
    """Names of a folder's direct entries, sorted; none where it is missing."""
    fs, p = _fs_path(spark, directory)
    if not fs.exists(p):
        return []
    return sorted(st.getPath().getName() for st in fs.listStatus(p))


def replace_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a dataset folder over another one."""
    fs, to = _fs_path(spark, target)
    fs.delete(to, True)
    if not fs.rename(_fs_path(spark, source)[1], to):
        raise SourceError(f"could not move {source} to {target}")


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Move a dataset folder to a name that nothing has yet; missing parent
    folders are made."""
    fs, to = _fs_path(spark, target)
    fs.mkdirs(to.getParent())
    if not fs.rename(_fs_path(spark, source)[1], to):
        raise SourceError(f"could not move {source} to {target}")


def path_size(spark: SparkSession, path: str) -> int:
    """Bytes under ``path`` (a file, or a dataset directory of part files)."""
    fs, p = _fs_path(spark, path)
    return int(fs.getContentSummary(p).getLength())


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file under ``path``."""
    fs, p = _fs_path(spark, path)
    files, most = fs.listFiles(p, True), 0
    while files.hasNext():
        most = max(most, int(files.next().getLen()))
    return most


def list_files(spark: SparkSession, directory: str) -> DataFrame:
    """name, path, size_bytes, is_dir of a directory's direct entries.

    Metadata only: one row per entry, never file contents."""
    fs, p = _fs_path(spark, directory)
    rows = []
    if fs.exists(p):
        for st in fs.listStatus(p):
            rows.append(
                (
                    st.getPath().getName(),
                    st.getPath().toString(),
                    int(st.getLen()) if not st.isDirectory() else path_size(spark, st.getPath().toString()),
                    bool(st.isDirectory()),
                )
            )
    return spark.createDataFrame(
        rows, "name string, path string, size_bytes bigint, is_dir boolean"
    )


def source_manifest(spark: SparkSession, source_dir: str, required: list[str]) -> DataFrame:
    """S1 as a table: file, status (ok / missing / empty), size_bytes, in
    the order of ``required``."""
    expected = spark.createDataFrame(
        [(i, name) for i, name in enumerate(required)], "_pos int, name string"
    )
    listing = list_files(spark, source_dir).select("name", "size_bytes")
    return (
        expected.join(listing, "name", "left")
        .select(
            F.col("name").alias("file"),
            F.when(F.col("size_bytes").isNull(), "missing")
            .when(F.col("size_bytes") == 0, "empty")
            .otherwise("ok")
            .alias("status"),
            "size_bytes",
            "_pos",
        )
        .orderBy("_pos")
        .drop("_pos")
    )


def discover_sources(spark: SparkSession, source_dir: str, required: list[str]) -> list[str]:
    """Every required file exists and is non-empty; paths in list order.
    Missing raises ``FileNotFoundError``, empty raises ``ValueError``."""
    base = source_dir.rstrip("/")
    paths = []
    for name in required:
        path = f"{base}/{name}"
        if not path_exists(spark, path):
            raise FileNotFoundError(f"No {name} among the source files in {base}")
        if path_size(spark, path) == 0:
            raise ValueError(f"Source file {name} has no bytes (empty)")
        paths.append(path)
    return paths


# --------------------------------------------------------------------- scans


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    sep: str = ",",
    multiline: bool = True,
) -> DataFrame:
    """CSV with a header and an explicit schema.

    FAILFAST raises on a value that does not fit its type (PERMISSIVE would
    null it silently); ``enforceSchema=False`` checks the header names against
    the schema; quoted newlines and doubled quotes are honoured.  Spark reads a
    multi-line CSV file in one task; ``read_split_csv`` splits large ones.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("enforceSchema", False)
        .option("multiLine", multiline)
        .option("escape", '"')
        .csv(path)
    )


def split_bytes(spark: SparkSession) -> int:
    """The size of a scan split, ``spark.sql.files.maxPartitionBytes``."""
    jvm = spark.sparkContext._jvm
    return int(jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes")))


def read_split_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """S2-S4 for large files whose quoted fields hold line breaks: the rows of
    ``read_csv(multiline=True)``, with a file's byte ranges read by many tasks.

    A line break ends a record only where an even number of quotes precedes
    it (doubled quotes keep the count even).  A range does not know whether it
    begins inside quotes, so a first scan reports, for each range, its quotes'
    parity and how many records end in it for either state; a running sum over
    a file's ranges (one small row each) settles every range's state and the
    number of its first record.  The second scan cuts the records: whole ones
    at once, while the pieces of a record that crosses ranges are put together
    by record number, however many ranges it spans.  Both scans read physical
    lines, which Spark's text reader splits at any byte range.

    The header of every file is checked against the schema.  A file that ends
    inside quotes raises (a quote inside an unquoted field is not counted as
    plain text here; such files need ``read_csv``).  Column pruning and errors
    are those of ``from_csv`` in FAILFAST mode.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value")
    )
    ranges = lines.mapInArrow(_range_facts, "file string, start long, quotes long, ends0 long, ends1 long, crlf boolean")
    ranges = ranges.groupBy("file", "start").agg(F.sum("quotes").alias("quotes"), F.sum("ends0").alias("ends0"), F.sum("ends1").alias("ends1"), F.bool_or("crlf").alias("crlf"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    state = F.pmod(F.coalesce(F.sum("quotes").over(before), F.lit(0)), F.lit(2))
    placed = ranges.withColumn("state", state).withColumn("ends", F.when(F.col("state") == 0, F.col("ends0")).otherwise(F.col("ends1")))
    placed = placed.withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    # Lines end as the file's first line does.
    placed = placed.withColumn("crlf", F.bool_or("crlf").over(Window.partitionBy("file")))
    # One row for each byte range of the files.
    facts = {(r["file"], r["start"]): (r["state"], r["first"], r["crlf"]) for r in placed.select("file", "start", "state", "first", "crlf").collect()}
    known = spark.sparkContext.broadcast(facts)

    def cut(batches):
        yield from _cut_records(batches, known.value)

    pieces = lines.mapInArrow(cut, "file string, record long, start long, whole boolean, text string")
    whole = pieces.filter("whole").select("file", "record", "text")
    crossing = pieces.filter("not whole").groupBy("file", "record").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
    crossing = crossing.select("file", "record", F.array_join("parts.text", "\n").alias("text"))
    records = whole.unionByName(crossing)
    checked = F.when(
        F.col("record") == 0,
        F.when(_header_names(F.col("text"), sep) == F.array(*[F.lit(n) for n in schema.names]), F.lit(False)).otherwise(
            F.raise_error(F.concat(F.lit("The CSV header does not match the schema in "), F.col("file"))).cast("boolean")
        ),
    ).otherwise(F.col("text") != "")
    complete = F.when(F.pmod(F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit(""))), F.lit(2)) == 0, checked).otherwise(
        F.raise_error(F.concat(F.lit("The CSV ends inside quotes: "), F.col("file"))).cast("boolean")
    )
    options = {"sep": sep, "escape": '"', "mode": "FAILFAST"}
    parsed = records.filter(complete).select(F.from_csv("text", _ddl(schema), options).alias("row"))
    return parsed.select("row.*")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


def _header_names(text: Column, sep: str) -> Column:
    """The names of a header line: unquoted or quoted, without a separator in them."""
    return F.transform(F.split(F.regexp_replace(text, "^\\ufeff", ""), re.escape(sep)), lambda c: F.regexp_replace(c, '^"|"$', ""))


def _stretches(b: pa.RecordBatch) -> Iterator[tuple[str, int, pa.Array]]:
    """A batch's lines, range by range."""
    file, start = b.column(0).to_pylist(), b.column(1).to_pylist()
    lo = 0
    for i in range(1, len(file) + 1):
        if i == len(file) or (file[i], start[i]) != (file[lo], start[lo]):
            yield file[lo], start[lo], b.column(2).slice(lo, i - lo)
            lo = i


def _quotes(lines: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.count_substring(lines, '"'), 0)).astype("i8")


def _range_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each range, in stretches of lines: quotes, and the line breaks that end
    a record if the range begins outside (``ends0``) or inside (``ends1``) quotes.

    Lines of a range come in order, from one task; the parity so far carries on
    from one stretch to the next."""
    at, parity = None, 0
    for b in batches:
        rows = []
        for file, start, lines in _stretches(b):
            crlf = False
            if (file, start) != at:
                at, parity = (file, start), 0
                crlf = start == 0 and lines[0].as_py().endswith("\r")
            upto = parity + np.cumsum(_quotes(lines))
            even = int((upto % 2 == 0).sum())
            rows.append((file, start, int(upto[-1]) - parity, even, len(upto) - even, crlf))
            parity = int(upto[-1]) % 2
        cols = list(zip(*rows)) or [()] * 6
        types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["file", "start", "quotes", "ends0", "ends1", "crlf"])


def _cut_records(batches: Iterator[pa.RecordBatch], known: dict) -> Iterator[pa.RecordBatch]:
    """(file, record, start, whole, text): records within a range, and the pieces
    at its ends of those that cross into others."""
    at, parity, record, crlf, open_, head = None, 0, 0, False, [], False

    def made(rows: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [()] * 5
        types = (pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=["file", "record", "start", "whole", "text"])

    for b in batches:
        rows = []
        for file, start, lines in _stretches(b):
            if (file, start) != at:
                if open_:
                    rows.append((*at[:1], record, at[1], False, "\n".join(open_)))
                at = (file, start)
                parity, record, crlf = known[at]
                open_, head = [], parity == 1  # the first record began in an earlier range
            upto = parity + np.cumsum(_quotes(lines))
            if crlf:
                lines = pc.replace_substring_regex(lines, "\r$", "")
            for text, total in zip(lines.to_pylist(), upto.tolist()):
                if total % 2:
                    open_.append(text)
                    continue
                if open_:
                    open_.append(text)
                    text, open_ = "\n".join(open_), []
                rows.append((file, record, start, not head, text))
                record, head = record + 1, False
            parity = int(upto[-1]) % 2
        if rows:
            yield made(rows)
    if open_:
        yield made([(at[0], record, at[1], False, "\n".join(open_))])


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Parquet scan (pruned and filtered at the scan by Catalyst)."""
    return spark.read.parquet(path)


def parquet_schema(spark: SparkSession, path: str) -> T.StructType:
    """The dataset's schema from the footers of all its part files, which
    tasks read; no row is read.  Part files that give one column two types fail
    the schema gate."""
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except Exception as e:
        if "CANNOT_MERGE" not in str(e):
            raise
        raise SchemaValidationError(f"{path}: the part files do not agree on their columns: {e}") from e


# --------------------------------------------------------------------- sinks


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    compression: str = "snappy",
    partition_by: list[str] | None = None,
) -> None:
    """Parquet sink, Snappy by default.  Never point ``path`` at a
    dataset the same plan reads (the stage paths of the layer runner keep
    every input immutable)."""
    # Static: an overwrite replaces the dataset whatever the session's mode is,
    # so a rerun never finds partitions of an earlier run.
    w = df.write.mode(mode).option("compression", compression)
    w = w.option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",", mode: str = "overwrite") -> None:
    """CSV sink; blanks around a text stay.  An empty text and a null are both
    written as nothing and read back as null, as the source files have them."""
    df.write.mode(mode).option("header", True).option("sep", sep).option(
        "escape", '"'
    ).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).option(
        "timestampNTZFormat", "yyyy-MM-dd HH:mm:ss"
    ).csv(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"


# -------------------------------------------------------------------- ingest


def ingest_file(
    spark: SparkSession,
    source_path: str,
    raw_dir: str,
    schema: T.StructType,
    entity: str | None = None,
    sep: str = ",",
    multiline: bool = True,
) -> dict:
    """CSV source -> Raw Parquet, verified.

    The source row count is taken *during* the write with an ``Observation``
    (no separate count, which would skip parsing pruned columns); the written
    dataset is then counted from its footers and both must agree.  For
    payments the G1 counts ride on the same ``Observation`` (the source is
    parsed once); a negative payment removes the written dataset and raises,
    so Raw never keeps it.  The metrics sit in the writing (result) stage,
    where Spark applies each task's update once even under retries.
    ``multiline=False`` makes large files splittable when the source has no
    quoted line breaks; with them, a source with a file larger than one scan split
    is read by ``read_split_csv``, with the same rows.
    """
    name = entity or source_path.rstrip("/").rsplit("/", 1)[-1].rsplit(".", 1)[0]
    out = f"{raw_dir.rstrip('/')}/{name}"
    if multiline and largest_file(spark, source_path) > split_bytes(spark):
        df = read_split_csv(spark, source_path, schema, sep=sep)
    else:
        df = read_csv(spark, source_path, schema, sep=sep, multiline=multiline)
    metrics = [F.count(F.lit(1)).alias("rows")]
    if name == "payments":
        metrics += payment_count_columns()
    obs = Observation(f"ingest_{name}_{uuid.uuid4().hex[:8]}")
    # Written beside Raw, checked, then moved: a file that fails leaves the
    # dataset of an earlier ingest as it was.
    pending = f"{raw_dir.rstrip('/')}/_pending-{name}-{uuid.uuid4().hex}"
    try:
        write_parquet(df.observe(obs, *metrics), pending)
        if name == "payments":
            check_payment_counts(obs.get)  # G1, counted during the same write
        source_rows = int(obs.get["rows"])
        written_rows = spark.read.parquet(pending).count()
        if source_rows != written_rows:
            raise SourceError(
                f"'{name}': {source_rows} rows were read, {written_rows} are in the dataset."
            )
        replace_path(spark, pending, out)
    finally:
        delete_path(spark, pending)
    return {
        "source_file_path": source_path,
        "output_file_path": out,
        "source_row_count": source_rows,
        "output_row_count": written_rows,
    }


def raw_completeness(spark: SparkSession, raw_dir: str, datasets: list[str]) -> DataFrame:
    """S9 as a table: dataset, status (ok / missing / empty).

    Emptiness is an incremental ``take(1)`` of a literal per dataset: Spark
    scans one partition first and stops at the first row, reading no column
    data, so a zero-row file with a footer is caught without a task per
    partition (``limit(1)`` under an aggregate would launch one on every
    partition).  One row per dataset is built from the statuses."""
    base = raw_dir.rstrip("/")
    rows = []
    for name in datasets:
        path = f"{base}/{name}"
        if not path_exists(spark, path):
            status = "missing"
        else:
            first = spark.read.parquet(path).select(F.lit(1).alias("_row")).take(1)
            status = "ok" if first else "empty"
        rows.append((name, status))
    return spark.createDataFrame(rows, "dataset string, status string")


def validate_raw_layer(spark: SparkSession, raw_dir: str, datasets: list[str]) -> None:
    """S9 as a gate: missing -> ``FileNotFoundError``, no rows -> ``ValueError``."""
    for row in raw_completeness(spark, raw_dir, datasets).collect():
        if row["status"] == "missing":
            raise FileNotFoundError(f"Raw has no dataset {row['dataset']}")
        if row["status"] == "empty":
            raise ValueError(f"Raw dataset {row['dataset']} has no rows (empty)")
