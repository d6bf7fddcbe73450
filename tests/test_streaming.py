import os

import pytest

from strata.rules import RETAIL_RULES
from strata.streaming import ingest_stream

from conftest import scratch

HEADER = "order_id,payment_sequential,payment_type,payment_installments,payment_value\n"


def _write(path, rows):
    with open(path, "w", encoding="utf-8") as f:
        f.write(HEADER + "".join(f"{r}\n" for r in rows))


def test_each_file_ingested_once(spark):
    d = scratch("stream")
    src, raw, cp = f"{d}/src", f"{d}/raw", f"{d}/cp"
    os.makedirs(src)
    _write(f"{src}/a.csv", ["o1,1,card,1,10.0", "o2,1,card,1,20.0"])
    _write(f"{src}/b.csv", ["o3,1,card,1,30.0"])
    schema = RETAIL_RULES.struct_type("payments")
    first = ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp)
    assert sum(b["rows"] for b in first) == 3
    assert ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp) == []
    _write(f"{src}/c.csv", ["o4,1,card,1,40.0"])
    third = ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp)
    assert sum(b["rows"] for b in third) == 1
    ids = sorted(r["order_id"] for r in spark.read.parquet(f"{raw}/payments").collect())
    assert ids == ["o1", "o2", "o3", "o4"]


def test_negative_payment_stops_the_stream(spark):
    d = scratch("stream-neg")
    src = f"{d}/src"
    os.makedirs(src)
    _write(f"{src}/a.csv", ["o1,1,card,1,-5.0"])
    with pytest.raises(Exception, match="payment_value < 0"):
        ingest_stream(spark, src, f"{d}/raw", "payments", RETAIL_RULES.struct_type("payments"),
                      checkpoint=f"{d}/cp")
    assert not os.path.exists(f"{d}/raw/payments")


def test_failing_batch_is_withdrawn_and_earlier_batches_stay(spark):
    d = scratch("stream-partial")
    src, raw, cp = f"{d}/src", f"{d}/raw", f"{d}/cp"
    os.makedirs(src)
    schema = RETAIL_RULES.struct_type("payments")
    _write(f"{src}/a.csv", ["o1,1,card,1,10.0"])
    assert sum(b["rows"] for b in ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp)) == 1
    _write(f"{src}/b.csv", ["o2,1,card,1,-3.0"])
    with pytest.raises(Exception, match="payment_value < 0"):
        ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp)
    # the good batch is still there, the failing one left nothing behind
    assert sorted(os.listdir(f"{raw}/payments")) == ["batch_id=0"]
    ids = [r["order_id"] for r in spark.read.parquet(f"{raw}/payments").collect()]
    assert ids == ["o1"]
    # a restart replays the failing batch (its offsets were never committed)
    with pytest.raises(Exception, match="payment_value < 0"):
        ingest_stream(spark, src, raw, "payments", schema, checkpoint=cp)
