import os

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grainline.catalog.registry import scratch_dir
from grainline.sinks import outbox as OB
from grainline.sinks import writers as W


def _part(numbers):
    return pa.record_batch({"batch_number": pa.array(numbers, pa.int64()), "batch_size": pa.array([1] * len(numbers), pa.int32()),
                            "total_batches": pa.array([9] * len(numbers), pa.int64()), "payload": pa.array(["{}"] * len(numbers))})


def _numbers(spark, path, run=None):
    return sorted(r.batch_number for r in OB.sent_batches(spark, path, run).collect())


def _files(path):
    return os.listdir(path.removeprefix("file:") + "/data")


def test_each_batch_once(spark):
    path = scratch_dir(spark, "t-outbox")
    df = spark.range(0, 1037, numPartitions=7).select("id", (F.col("id") % 5).alias("v"))
    assert OB.send_batches(df, path, ["id"], 50, "a") == "a"
    assert _numbers(spark, path) == list(range(1, 22))
    OB.send_batches(df, path, ["id"], 50, "a")                  # again: nothing
    assert _numbers(spark, path) == list(range(1, 22))
    OB.send_batches(df.limit(0), path, ["id"], 50, "empty")
    OB.send_batches(df.where("id < 60"), path, ["id"], 50, "b")
    assert _numbers(spark, path, "b") == [1, 2] and _numbers(spark, path, "empty") == []
    ids = OB.sent_batches(spark, path, "a").select(
        F.explode(F.from_json("payload", "data array<struct<id: bigint>>")["data"]["id"]).alias("id"))
    assert sorted(r.id for r in ids.collect()) == list(range(1037))


def test_retried_and_speculative_attempts_send_nothing_twice(spark):
    path = scratch_dir(spark, "t-outbox-retry")
    w = OB.OutboxWriter(path, "r")

    def breaks():
        yield _part([1, 2])
        raise RuntimeError("executor lost")

    with pytest.raises(RuntimeError):
        w.write(breaks())
    assert _files(path) == []                                   # its file is gone
    w.write(iter([_part([1, 2])]))                              # lost after writing: nobody names its file
    kept = [w.write(iter([_part([1, 2]), _part([3])])), w.write(iter([])), w.write(iter([_part([4])]))]
    assert OB.sent_batches(spark, path).count() == 0            # not committed yet
    w.commit(kept)
    assert _numbers(spark, path) == [1, 2, 3, 4]
    w.commit([w.write(iter([_part([1])]))])                     # the run's second driver comes too late
    assert _numbers(spark, path) == [1, 2, 3, 4] and len(_files(path)) == 3


def test_abort_removes_what_was_written(spark):
    path = scratch_dir(spark, "t-outbox-abort")
    w = OB.OutboxWriter(path, "r")
    w.abort([w.write(iter([_part([1])])), None, OB.Written(None, 0)])
    assert _files(path) == [] and _numbers(spark, path) == []


def test_failing_job_sends_nothing(spark):
    path = scratch_dir(spark, "t-outbox-fail")
    df = spark.range(0, 300).select("id", F.expr("if(id = 250, raise_error('bad row'), id)").alias("v"))
    with pytest.raises(Exception, match="bad row"):
        OB.send_batches(df, path, ["id"], 50, "f")
    assert OB.sent_batches(spark, path).count() == 0


def test_target_and_names(spark):
    path = scratch_dir(spark, "t-outbox-target")
    df = spark.range(0, 30)
    W.write_targets(df, [{"type": "requests", "path": path, "order_by": ["id"], "batch_size": 7, "run": "x-1"},
                         {"type": "parquet", "path": path + "-p"}])
    assert _numbers(spark, path, "x-1") == [1, 2, 3, 4, 5]
    for bad in ("", "../x", ".x", "a/b"):
        with pytest.raises(ValueError):
            OB.send_batches(df, path, ["id"], run=bad)
    assert OB.sent_batches(spark, path + "-none").count() == 0
