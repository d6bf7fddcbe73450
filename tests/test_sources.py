import os

import pytest

from strata import sources
from strata.errors import PaymentValidationError
from strata.rules import RETAIL_RULES

from conftest import scratch


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_discovery_missing_and_empty(spark):
    d = scratch("src")
    _write(os.path.join(d, "a.csv"), "x\n1\n")
    assert sources.discover_sources(spark, d, ["a.csv"]) == [f"{d}/a.csv"]
    with pytest.raises(FileNotFoundError, match="b.csv"):
        sources.discover_sources(spark, d, ["a.csv", "b.csv"])
    _write(os.path.join(d, "b.csv"), "")
    with pytest.raises(ValueError, match="empty"):
        sources.discover_sources(spark, d, ["a.csv", "b.csv"])
    status = {r["file"]: r["status"] for r in sources.source_manifest(spark, d, ["a.csv", "b.csv", "c.csv"]).collect()}
    assert status == {"a.csv": "ok", "b.csv": "empty", "c.csv": "missing"}


def test_csv_custom_separator(spark):
    d = scratch("sep")
    _write(os.path.join(d, "t.csv"), "city;country\nparis;fr\nrio;br\n")
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("city", T.StringType()), T.StructField("country", T.StringType())])
    df = sources.read_csv(spark, f"{d}/t.csv", schema, sep=";")
    assert df.columns == ["city", "country"] and df.count() == 2


def test_csv_bad_value_fails_fast(spark):
    d = scratch("bad")
    _write(os.path.join(d, "t.csv"), "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
           "o1,1,card,1,abc\n")
    df = sources.read_csv(spark, f"{d}/t.csv", RETAIL_RULES.struct_type("payments"))
    with pytest.raises(Exception):
        df.collect()


def test_csv_header_must_match_schema(spark):
    d = scratch("hdr")
    _write(os.path.join(d, "t.csv"), "wrong,payment_sequential,payment_type,payment_installments,payment_value\n"
           "o1,1,card,1,2.0\n")
    df = sources.read_csv(spark, f"{d}/t.csv", RETAIL_RULES.struct_type("payments"))
    with pytest.raises(Exception):
        df.collect()


def test_csv_quoted_newline_and_quotes(spark):
    d = scratch("q")
    _write(os.path.join(d, "t.csv"), 'id,txt\n1,"line one\nline two"\n2,"say ""hi"""\n')
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("txt", T.StringType())])
    rows = sources.read_csv(spark, f"{d}/t.csv", schema).orderBy("id").collect()
    assert [r["txt"] for r in rows] == ["line one\nline two", 'say "hi"']


def test_ingest_payments_counts_and_gate(spark):
    d = scratch("ing")
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    _write(os.path.join(d, "payments.csv"), header + "o1,1,card,1,10.5\no2,1,card,2,0\n")
    info = sources.ingest_file(spark, f"{d}/payments.csv", f"{d}/raw", RETAIL_RULES.struct_type("payments"))
    assert info["source_row_count"] == info["output_row_count"] == 2
    assert sources.parquet_schema(spark, info["output_file_path"]) == RETAIL_RULES.struct_type("payments")
    _write(os.path.join(d, "neg.csv"), header + "o1,1,card,1,-1\n")
    with pytest.raises(PaymentValidationError):
        sources.ingest_file(spark, f"{d}/neg.csv", f"{d}/raw2", RETAIL_RULES.struct_type("payments"), "payments")


def test_raw_layer_missing_and_zero_rows(spark):
    d = scratch("raw")
    spark.createDataFrame([("a",)], "x string").write.parquet(f"{d}/ok")
    spark.createDataFrame([], "x string").write.parquet(f"{d}/empty")
    status = {r["dataset"]: r["status"] for r in sources.raw_completeness(spark, d, ["ok", "empty", "gone"]).collect()}
    assert status == {"ok": "ok", "empty": "empty", "gone": "missing"}
    with pytest.raises(ValueError, match="empty"):
        sources.validate_raw_layer(spark, d, ["ok", "empty"])
    with pytest.raises(FileNotFoundError, match="gone"):
        sources.validate_raw_layer(spark, d, ["ok", "gone"])


def test_parquet_snappy_roundtrip(spark):
    d = scratch("pq")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id bigint, v string")
    sources.write_parquet(df, f"{d}/t")
    files = [f for f in os.listdir(f"{d}/t") if f.endswith(".parquet")]
    assert files and all(".snappy." in f for f in files)
    assert sorted(sources.read_parquet(spark, f"{d}/t").collect()) == sorted(df.collect())


def test_csv_bom_and_crlf_header(spark):
    d = scratch("bom")
    with open(os.path.join(d, "t.csv"), "wb") as f:
        f.write("﻿product_category_name,product_category_name_english\r\nbeleza,beauty\r\n".encode("utf-8"))
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("product_category_name", T.StringType()),
                           T.StructField("product_category_name_english", T.StringType())])
    rows = sources.read_csv(spark, f"{d}/t.csv", schema).collect()
    assert [(r[0], r[1]) for r in rows] == [("beleza", "beauty")]


def test_line_by_line_csv_splits_but_multiline_stays_whole(spark):
    from pyspark.sql import types as T

    from strata.sources import read_csv

    d = scratch("split")
    path = os.path.join(d, "orders.csv")
    with open(path, "w") as f:
        f.write("order_id,payment_value\n")
        for i in range(20000):
            f.write(f"o{i},{i}.5\n")
    schema = "order_id string, payment_value double"
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        split = read_csv(spark, path, T.StructType.fromDDL(schema), multiline=False)
        whole = read_csv(spark, path, T.StructType.fromDDL(schema), multiline=True)
        assert split.rdd.getNumPartitions() > 1
        assert whole.rdd.getNumPartitions() == 1
        assert split.count() == whole.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_payments_gate_counted_in_the_write_leaves_nothing_on_failure(spark, caplog):
    import logging

    d = scratch("ing-gate")
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"
    _write(os.path.join(d, "neg.csv"), header + "o1,1,card,1,10\no2,1,card,1,-1\no3,1,card,1,-2\n")
    with pytest.raises(PaymentValidationError, match="Negative payments: 2"):
        sources.ingest_file(spark, f"{d}/neg.csv", f"{d}/raw", RETAIL_RULES.struct_type("payments"),
                            "payments")
    assert not os.path.exists(f"{d}/raw/payments")
    _write(os.path.join(d, "zero.csv"), header + "o1,1,card,1,0\no2,1,card,1,5\n")
    with caplog.at_level(logging.WARNING, logger="strata.operators.checks"):
        info = sources.ingest_file(spark, f"{d}/zero.csv", f"{d}/raw",
                                   RETAIL_RULES.struct_type("payments"), "payments")
    assert info["output_row_count"] == 2
    assert "1 payments of exactly zero" in caplog.text


def test_rejected_file_keeps_the_earlier_dataset(spark, tmp_path):
    from pyspark.sql import types as T

    from strata.errors import PaymentValidationError
    from strata.sources.files import ingest_file

    schema = T.StructType([T.StructField("order_id", T.StringType()), T.StructField("payment_value", T.DoubleType())])
    raw = str(tmp_path / "raw")
    for text, good in (("o1,5.0\n", True), ("o2,NaN\n", False), ("o3,-1.0\n", False)):
        source = tmp_path / "payments.csv"
        source.write_text("order_id,payment_value\n" + text)
        if good:
            ingest_file(spark, str(source), raw, schema)
        else:
            with pytest.raises(PaymentValidationError):
                ingest_file(spark, str(source), raw, schema)
    assert [r["order_id"] for r in spark.read.parquet(f"{raw}/payments").collect()] == ["o1"]


def test_overwrite_replaces_all_partitions_in_dynamic_mode(spark, tmp_path):
    from strata.sources.files import write_parquet

    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for part in (0, 1):
            write_parquet(spark.createDataFrame([(part, "x")], "p int, v string"), str(tmp_path / "d"), partition_by=["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert [r["p"] for r in spark.read.parquet(str(tmp_path / "d")).collect()] == [1]


def test_schema_of_all_part_files(spark):
    from conftest import scratch

    from strata.errors import SchemaValidationError

    path = scratch("parts") + "/data"
    spark.range(3).selectExpr("id AS a").write.parquet(path)
    spark.range(3).selectExpr("id AS a", "'x' AS b").write.mode("append").parquet(path)
    assert sorted(sources.parquet_schema(spark, path).names) == ["a", "b"]
    spark.range(3).selectExpr("CAST(id AS INT) AS a").write.mode("append").parquet(path)
    with pytest.raises(SchemaValidationError, match="do not agree"):
        sources.parquet_schema(spark, path)
