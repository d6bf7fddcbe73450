"""Hot foreign keys, two-phase dedup and large quoted CSV files."""

from __future__ import annotations

import os
import statistics

import pytest
from conftest import scratch
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata import sources
from strata.functions import joins
from strata.operators import dedupe, keys
from strata.rules import ForeignKey


@pytest.fixture
def shuffled(spark):
    """No broadcasts and no skew splits: what the plan itself spreads."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _rows_by_task(flagged):
    """Rows that each task of the join reads and writes."""
    return [r["count"] for r in flagged.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("count"), F.count_if("_fk_ok")).collect()]


def test_hot_foreign_key_is_spread(shuffled):
    spark = shuffled
    n = 30_000
    product = F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(F.col("id") % 5000)
    child = spark.range(n).select(F.col("id").alias("item"), product.cast("long").alias("product_id"))
    parents = spark.range(4500).select(F.col("id").alias("product_id"))
    hot = joins.heavy_keys(child, "product_id")
    assert hot == [7]
    flagged, missing = keys.check_foreign_key(child, "product_id", parents, "product_id", hot=hot)
    sizes = _rows_by_task(flagged)
    assert sum(sizes) == n and max(sizes) <= 3 * statistics.median(sizes)
    plain, missing_plain = keys.check_foreign_key(child, "product_id", parents, "product_id")
    assert max(_rows_by_task(plain)) > n / 3  # what the salt prevents
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(flagged) == rows(plain) and rows(missing) == rows(missing_plain)


def test_hot_keys_absent_from_the_parent_and_text_keys(shuffled):
    spark = shuffled
    child = spark.createDataFrame([(i, "gone" if i % 2 else f"k{i % 40}") for i in range(2000)] + [(5000, None)], "item long, k string")
    parents = spark.createDataFrame([(f"k{i}",) for i in range(0, 40, 4)] * 2, "k string")
    hot = joins.heavy_keys(child, "k")
    assert "gone" in hot and None not in hot
    fks = [ForeignKey("k", "parent", "k")]
    got = keys.validate_entity_relationships(child, "items", fks, {"parent": parents}, hot={"k": hot})
    want = keys.validate_entity_relationships(child, "items", fks, {"parent": parents})
    for a, b in zip(got, want):
        assert sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert joins.heavy_keys(child.limit(0), "k") == []


def test_few_absent_keys_flag_the_child_without_a_shuffle(shuffled):
    spark = shuffled
    key = F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 11 == 0, F.lit("gone")).otherwise(F.concat(F.lit("k"), F.col("id") % 300))
    child = spark.range(5000).select(F.col("id").alias("item"), key.alias("k"))
    parents = spark.range(280).select(F.concat(F.lit("k"), F.col("id")).alias("pk")).unionAll(spark.createDataFrame([(None,), ("k1",)], "pk string"))
    absent = joins.absent_keys(child, "k", parents, "pk")
    assert sorted(r["k"] for r in absent.collect()) == sorted(["gone", *[f"k{i}" for i in range(280, 300)]])
    absent = spark.createDataFrame(absent.collect(), "k string")
    got = joins.flag_present(child, "k", absent, "_fk_ok")
    want = joins.flag_membership(child, "k", parents, "pk", "_fk_ok")
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    assert "hashpartitioning" in _plan(want) and "hashpartitioning" not in _plan(got)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_two_phase_dedup_equals_the_aggregate(spark):
    rows = [(i, i % 7, f"t{i % 5}", float(i)) for i in range(500)] + [(3, 3, "t9", 1.0), (3, 3, None, 2.0), (3, 3, "t9", 0.5), (None, 1, "a", 1.0), (None, 1, "b", 0.0), (None, None, "a", 1.0)]
    df = spark.createDataFrame(rows, "order_id long, item long, at string, price double")
    key = ["order_id", "item"]
    few, removed = dedupe.dedup_entity(df, "items", key, "at")
    assert removed == 4
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert few.columns == df.columns
    assert rows(few) == rows(dedupe.keep_latest(df, key, "at"))


def test_single_rows_are_not_shuffled_by_dedup(spark):
    df = spark.range(1000).select((F.col("id") % 999).alias("k"), F.col("id").cast("string").alias("t"), F.lit("wide").alias("w"))
    few = dedupe.keep_latest_of_few(df, ["k"], "t")
    straight, contested = _plan(few).split("SortAggregate", 1)
    # Rows of single keys go from the scan to the union; key counts are hash aggregates.
    assert "LeftAnti" in straight and "Exchange hashpartitioning(t" not in straight
    assert "max(struct" not in straight and "LeftSemi" in contested
    assert few.count() == 999


def test_many_surplus_rows_take_the_aggregate(spark, monkeypatch):
    monkeypatch.setattr(dedupe, "FEW_SURPLUS_ROWS", 1)
    df = spark.createDataFrame([(1, "a"), (1, "b"), (1, "c"), (2, "a")], "k long, t string")
    out, removed = dedupe.dedup_entity(df, "x", ["k"], "t")
    assert removed == 2 and sorted(map(tuple, out.collect())) == [(1, "c"), (2, "a")]
    assert "LeftAnti" not in _plan(out)


REVIEW = T.StructType([T.StructField("id", T.LongType()), T.StructField("title", T.StringType()), T.StructField("message", T.StringType()), T.StructField("score", T.LongType())])


def _write(name: str, body: str) -> str:
    folder = scratch("split-csv")
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(body)
    return path


def _review_lines(n: int) -> str:
    """Records with quoted breaks, doubled quotes, separators, blank and empty
    fields; some longer than several ranges."""
    out = ["id,title,message,score\n"]
    for i in range(n):
        message = [f"plain {i}", f'"line one {i}\nline ""two"", {i}\n\nlast"', '""', "", f'"{"long text, " * (60 if i % 50 == 0 else 2)}\n{i}"', f'"ends with break {i}\n"'][i % 6]
        title = ["", f'"a ""{i}"" b"', "t"][i % 3]
        out.append(f"{i},{title},{message},{i % 5}\n")
    return "".join(out)


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0", "spark.sql.files.minPartitionNum": "1"}
    old = {k: spark.conf.get(k, None) for k in names}
    yield lambda size: [spark.conf.set(k, v if k != "spark.sql.files.maxPartitionBytes" else str(size)) for k, v in names.items()]
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("size", [50, 97, 400, 4000])
def test_split_csv_equals_the_whole_file_reader(spark, small_splits, size):
    path = _write("reviews.csv", _review_lines(120))
    want = sorted(map(tuple, sources.read_csv(spark, path, REVIEW).collect()))
    assert len(want) == 120
    small_splits(size)
    lines = spark.read.option("lineSep", "\n").text(path)
    assert lines.rdd.getNumPartitions() > os.path.getsize(path) / size / 2  # many tasks
    assert sorted(map(tuple, sources.read_split_csv(spark, path, REVIEW).collect())) == want


def test_split_csv_of_many_files_crlf_and_separator(spark, small_splits):
    folder = os.path.dirname(_write("a.csv", "id;title;message;score\r\n1;x;\"a\r\nb\";5\r\n2;;c;1\r\n"))
    with open(os.path.join(folder, "b.csv"), "w", newline="") as f:
        f.write('"id";title;message;score\n\n3;"p;q";"one\n\ntwo";4')  # a blank line, no break at the end
    want = sorted(map(tuple, sources.read_csv(spark, folder, REVIEW, sep=";").collect()), key=str)
    small_splits(10)
    got = sorted(map(tuple, sources.read_split_csv(spark, folder, REVIEW, sep=";").collect()), key=str)
    assert got == want and len(got) == 3


def test_split_csv_raises_on_header_value_and_open_quotes(spark, small_splits):
    small_splits(20)
    for body, said in (
        ("id,title,text,score\n1,a,b,2\n", "header"),
        ("id,title,message,score\n1,a,b,two\n", "MALFORMED|parse|cannot"),
        ('id,title,message,score\n1,a,"b,2\n2,a,b,2\n', "inside quotes"),
    ):
        with pytest.raises(Exception, match=f"(?i){said}"):
            sources.read_split_csv(spark, _write("x.csv", body), REVIEW).collect()


def test_ingest_splits_a_large_multiline_file(spark, small_splits):
    path = _write("reviews.csv", _review_lines(120))
    whole = sources.ingest_file(spark, path, scratch("raw"), REVIEW)
    small_splits(500)
    assert os.path.getsize(path) > sources.files.split_bytes(spark)
    split = sources.ingest_file(spark, path, scratch("raw"), REVIEW)
    assert split["source_row_count"] == whole["source_row_count"] == 120
    rows = [sorted(map(tuple, spark.read.parquet(r["output_file_path"]).collect())) for r in (whole, split)]
    assert rows[0] == rows[1]


def test_ingest_reads_many_small_files_whole(spark, small_splits, monkeypatch):
    """A folder larger than a split, but of files that are not: one task a file."""
    folder = scratch("parts")
    os.makedirs(folder, exist_ok=True)
    text = open(_write("reviews.csv", _review_lines(60)), "rb").read()
    for i in range(4):
        with open(os.path.join(folder, f"part-{i}.csv"), "wb") as f:
            f.write(text)
    small_splits(len(text) + 1)
    monkeypatch.setattr(sources.files, "read_split_csv", None)
    out = sources.ingest_file(spark, folder, scratch("raw"), REVIEW, entity="reviews")
    assert out["source_row_count"] == 4 * 60
