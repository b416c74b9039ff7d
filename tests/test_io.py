import json

import pandas as pd
from pyspark.sql import functions as F

from grainline.catalog.registry import scratch_dir
from grainline.sinks import batches as BT
from grainline.sinks import writers as W
from grainline.sources import files as SF
from grainline.sources import misc as SM


def test_csv_skip_rows_per_file(spark):
    def _preamble(batches):
        first = True
        for pdf in batches:
            if first:
                yield pd.DataFrame({"value": ["junk one", "junk two", "a,b"]})
                first = False
            yield pdf

    path = scratch_dir(spark, "t-skip")
    lines = spark.range(0, 1000, numPartitions=4).select(
        F.concat_ws(",", F.col("id").cast("string"), (F.col("id") * 2).cast("string")).alias("value"))
    lines.mapInPandas(_preamble, "value string").write.text(path)
    df = SF.read_csv(spark, path, skip_rows=2)
    assert df.columns == ["a", "b"] and dict(df.dtypes) == {"a": "bigint", "b": "bigint"}
    got = df.toPandas()
    assert len(got) == 1000 and (got.b == got.a * 2).all()


def test_csv_na_tokens_and_inference(spark):
    path = scratch_dir(spark, "t-na")
    spark.createDataFrame([("1", "x", "NA"), ("2", "missing", "2.5"), ("3", "", "n/a")], "a string, b string, c string") \
        .write.option("header", "true").csv(path)
    df = SF.read_csv(spark, path, na_values=["missing"])
    rows = sorted(df.collect())
    assert dict(df.dtypes) == {"a": "bigint", "b": "string", "c": "double"}
    assert [tuple(r) for r in rows] == [(1, "x", None), (2, None, 2.5), (3, None, None)]


def test_paged_stops_after_short_page(spark):
    bodies = [(1, json.dumps({"data": [{"v": 1}, {"v": 2}]})), (2, json.dumps({"data": [{"v": 3}]})),
              (3, json.dumps({"data": [{"v": 4}, {"v": 5}]})), (4, json.dumps({"other": 1}))]
    pages = spark.createDataFrame(bodies, "page int, body string")
    got = sorted(r["v"] for r in SM.paged_records(pages, "data", page_size=2).collect())
    assert got == [1, 2, 3]
    assert sorted(r["v"] for r in SM.paged_records(pages, "data", page_size=2, paginate=False).collect()) == [1, 2]
    one = spark.createDataFrame([(1, json.dumps({"data": {"v": 9}}))], "page int, body string")
    assert [r["v"] for r in SM.paged_records(one, "data", page_size=2).collect()] == [9]


def test_union_promotes_conflicting_types(spark):
    a = spark.createDataFrame([(1, "x")], "k int, v string")
    b = spark.createDataFrame([(2, 2.5)], "k int, v double")
    u = SM.union_sources({"a": a, "b": b})
    assert dict(u.dtypes)["v"] == "string"
    assert sorted((r["k"], r["v"], r["_source"]) for r in u.collect()) == [(1, "x", "a"), (2, "2.5", "b")]


def test_split_by_group_drops_null_and_escapes(spark):
    path = scratch_dir(spark, "t-split")
    df = spark.createDataFrame([(1, "a/b"), (2, None), (3, "c"), (4, "a/b")], "id int, g string")
    W.write_split_by_group(df, path, "g", "parquet")
    back = spark.read.parquet(path)
    assert sorted((r["id"], r["g"]) for r in back.collect()) == [(1, "a_b"), (3, "c"), (4, "a_b")]


def test_request_batches_envelope(spark):
    df = spark.range(250).select(F.col("id").alias("k"))
    out = BT.request_batches(df, ["k"], 100).orderBy("batch_number").collect()
    assert [r["batch_size"] for r in out] == [100, 100, 50]
    last = json.loads(out[-1]["payload"])
    assert last["batch_info"] == {"batch_number": 3, "batch_size": 50, "total_batches": 3}
    assert [d["k"] for d in last["data"]] == list(range(200, 250))


def test_flatten_nested(spark):
    df = spark.createDataFrame([(1, (2, (3, "x")), [1, 2])], "a int, b struct<c:int, d:struct<e:int, f:string>>, l array<int>")
    assert SF.flatten(df).columns == ["a", "b.c", "b.d.e", "b.d.f", "l"]


def test_csv_max_rows_are_the_first_rows_in_file_order(spark):
    path = scratch_dir(spark, "t-maxrows")
    spark.range(0, 5000, numPartitions=3).select(F.col("id").alias("k")) \
        .write.option("header", "true").csv(path)
    got = [r["k"] for r in SF.read_csv(spark, path, max_rows=40).collect()]
    files = sorted(r[0] for r in spark.read.text(path).select(F.col("_metadata.file_path")).distinct().collect())
    first_file = spark.read.option("header", "true").csv(files[0]).limit(40).collect()
    assert sorted(got) == sorted(int(r["k"]) for r in first_file)
    assert len(got) == 40


def test_union_skips_empty_sources(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([], "k int, only_here string")
    u = SM.union_sources({"a": a, "b": b})
    assert u.columns == ["k", "_source"] and u.count() == 1


def test_csv_skip_rows_when_a_file_has_many_splits(spark):
    def _preamble(batches):
        first = True
        for pdf in batches:
            if first:
                yield pd.DataFrame({"value": ["junk", "a,b"]})
                first = False
            yield pdf

    path = scratch_dir(spark, "t-skip-split")
    lines = spark.range(0, 60000, numPartitions=1).select(
        F.concat_ws(",", F.col("id").cast("string"), (F.col("id") + 1).cast("string")).alias("value"))
    lines.mapInPandas(_preamble, "value string").write.text(path)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(64 * 1024))
    try:
        df = SF.read_csv(spark, path, skip_rows=1)
        got = df.toPandas()
        parts = spark.read.text(path).rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert parts > 1
    assert len(got) == 60000 and (got.b == got.a + 1).all() and got.a.min() == 0
