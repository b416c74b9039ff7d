"""Queries for sources and sinks.

Every file these queries read is written first by Spark from a driver table
into a fresh folder under the shared checkpoint location, so the work grows
with the tables.  Sinks are checked by a round trip (write, read back).
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import functions as F

from ..sinks import batches as BT
from ..sinks import outbox as OB
from ..sinks import writers as W
from ..sources import files as SF
from ..sources import misc as SM
from .registry import ORDERS_GAPS_SQL, orders_gaps, register, scratch_dir, table

ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_SQL = "SELECT " + ", ".join(ORDER_COLS) + " FROM orders"


# ------------------------------------------------------------------- sources
@register("src_csv", """SELECT l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, l_quantity,
  l_extendedprice, l_returnflag, l_shipdate FROM lineitem""")
def q_src_csv(spark, sf):
    path = scratch_dir(spark, "src-csv")
    table(spark, sf, "lineitem").write.option("header", "true").csv(path)
    return SF.read_csv(spark, path, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice",
                                             "l_returnflag", "l_shipdate"],
                       dtypes={"l_linenumber": "int32"}, date_columns=["l_shipdate"])


# fixed values: lead lines written before the header of every file
PREAMBLE = ["# orders export", "# generated for the skip-rows reader"]
SKIP_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]


def _with_preamble(batches):
    first = True
    for pdf in batches:
        if first:
            yield pd.DataFrame({"value": PREAMBLE + [",".join(SKIP_COLS)]})
            first = False
        yield pdf


@register("src_csv_skip", "SELECT " + ", ".join(SKIP_COLS) + " FROM orders")
def q_src_csv_skip(spark, sf):
    path = scratch_dir(spark, "src-csv-skip")
    o = table(spark, sf, "orders")
    lines = o.select(F.concat_ws(",", *[F.col(c).cast("string") for c in SKIP_COLS]).alias("value"))
    lines.mapInPandas(_with_preamble, "value string").write.text(path)
    return SF.read_csv(spark, path, skip_rows=len(PREAMBLE))


@register("src_na_values", """SELECT event_id, user_id,
  CASE WHEN event_id % 7 = 0 OR event_id % 11 = 0 THEN NULL ELSE value END AS value FROM events""")
def q_src_na_values(spark, sf):
    path = scratch_dir(spark, "src-na")
    e = table(spark, sf, "events")
    text_value = (F.when(F.col("event_id") % 7 == 0, F.lit("missing"))
                  .when(F.col("event_id") % 11 == 0, F.lit("NA")).otherwise(F.col("value").cast("string")))
    e.select("event_id", "user_id", text_value.alias("value")).write.option("header", "true").csv(path)
    return SF.read_csv(spark, path, na_values=["missing"])


@register("src_limit", "SELECT * FROM lineitem LIMIT 100")
def q_src_limit(spark, sf):
    return SF.read_parquet_first_rows(spark, f"{sf}/lineitem.parquet", 100)


def _json_docs(spark, sf, path):
    o = table(spark, sf, "orders")
    n_docs = max(1, math.ceil(o.count() / 5000))
    rec = F.struct(*ORDER_COLS)
    docs = o.groupBy((F.col("o_orderkey") % n_docs).alias("doc")).agg(F.collect_list(rec).alias("data"))
    body = F.to_json(F.struct(F.struct(F.col("data"), F.lit("ok").alias("status")).alias("response")))
    docs.select(body.alias("value")).write.text(path)


@register("src_json_path", ORDER_SQL)
def q_src_json_path(spark, sf):
    path = scratch_dir(spark, "src-json")
    _json_docs(spark, sf, path)
    df = SF.read_json_records(spark, path, "response.data")
    return SF.apply_dtypes(df, None, ["o_orderdate"])


@register("flatten_nested", """SELECT o_orderkey, o_custkey AS "detail.o_custkey",
  o_totalprice AS "detail.money.o_totalprice", o_orderpriority AS "detail.money.o_orderpriority" FROM orders""")
def q_flatten(spark, sf):
    o = table(spark, sf, "orders")
    nested = o.select("o_orderkey", F.struct("o_custkey", F.struct("o_totalprice", "o_orderpriority")
                                                          .alias("money")).alias("detail"))
    return SF.flatten(nested)


@register("src_parquet", "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_quantity > 40")
def q_src_parquet(spark, sf):
    df = SF.read_parquet(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_partkey", "l_quantity"])
    return df.where(F.col("l_quantity") > 40)


@register("src_sql_params", """SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
  WHERE l_quantity > 45 AND l_returnflag = 'R'""")
def q_src_sql_params(spark, sf):
    return SM.sql_with_params(
        spark, "SELECT l_orderkey, l_linenumber, l_quantity FROM {li} WHERE l_quantity > :q AND l_returnflag = :flag",
        {"q": 45, "flag": "R"}, li=table(spark, sf, "lineitem"))


PAGE = 100
SHORT_PAGE, SHORT_LEN = 7, 60


@register("src_paged_json", f"""{ORDER_SQL} WHERE o_orderkey // {PAGE} < {SHORT_PAGE}
  OR (o_orderkey // {PAGE} = {SHORT_PAGE} AND o_orderkey % {PAGE} < {SHORT_LEN})""")
def q_src_paged(spark, sf):
    o = table(spark, sf, "orders")
    page = (F.col("o_orderkey") / PAGE).cast("long")
    o = o.where(~((page == SHORT_PAGE) & (F.col("o_orderkey") % PAGE >= SHORT_LEN)))
    pages = o.groupBy(page.alias("page")).agg(F.collect_list(F.struct(*ORDER_COLS)).alias("data"))
    pages = pages.select("page", F.to_json(F.struct("data")).alias("body"))
    df = SM.paged_records(pages, "data", page_size=PAGE)
    return SF.apply_dtypes(df, None, ["o_orderdate"])


@register("src_paged_json_all", ORDER_SQL)
def q_src_paged_all(spark, sf):
    """Every order: all pages are full, so paging ends with the last one."""
    o = table(spark, sf, "orders")
    low = F.lit(o.agg(F.min("o_orderkey")).first()[0])
    pages = o.groupBy(F.floor((F.col("o_orderkey") - low) / PAGE).alias("page")).agg(F.collect_list(F.struct(*ORDER_COLS)).alias("data"))
    df = SM.paged_records(pages.select("page", F.to_json(F.struct("data")).alias("body")), "data", page_size=PAGE)
    return SF.apply_dtypes(df, None, ["o_orderdate"])


@register("multi_source_union", """
SELECT c_custkey AS key, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS segment,
  'customers' AS _source FROM customer
UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal, NULL, 'suppliers' FROM supplier""")
def q_union(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
                                            F.col("c_nationkey").alias("nationkey"), F.col("c_acctbal").alias("acctbal"),
                                            F.col("c_mktsegment").alias("segment"))
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
                                            F.col("s_nationkey").alias("nationkey"), F.col("s_acctbal").alias("acctbal"))
    return SM.union_sources({"customers": c, "suppliers": s})


# --------------------------------------------------------------------- sinks
@register("sink_csv", f"SELECT * FROM {ORDERS_GAPS_SQL}")
def q_sink_csv(spark, sf):
    path = scratch_dir(spark, "sink-csv")
    W.write_csv(orders_gaps(spark, sf), path, separator="|", na_representation="NULL",
                float_format="%.2f", date_format="yyyy-MM-dd HH:mm:ss")
    return SF.read_csv(spark, path, separator="|", na_values=["NULL"], date_columns=["o_orderdate"])


@register("sink_timestamped_copy", ORDER_SQL)
def q_sink_stamp(spark, sf):
    base = scratch_dir(spark, "sink-stamp") + "/orders.csv"
    paths = W.write_csv(table(spark, sf, "orders"), base, timestamped_copy=True)
    return SF.read_csv(spark, paths[1], date_columns=["o_orderdate"])


@register("sink_json", ORDER_SQL)
def q_sink_json(spark, sf):
    path = scratch_dir(spark, "sink-json")
    W.write_json(table(spark, sf, "orders"), path)
    return SF.apply_dtypes(spark.read.json(path), None, ["o_orderdate"])


@register("sink_parquet", "SELECT * FROM lineitem")
def q_sink_parquet(spark, sf):
    path = scratch_dir(spark, "sink-parquet")
    W.write_parquet(table(spark, sf, "lineitem"), path, compression="snappy")
    return spark.read.parquet(path)


@register("sink_request_batches", """
WITH r AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders)
SELECT (pos - 1) // 100 + 1 AS batch_number, CAST(count(*) AS INTEGER) AS batch_size,
  (SELECT CAST(ceil(count(*) / 100) AS INTEGER) FROM orders) AS total_batches,
  min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM r GROUP BY 1""")
def q_sink_batches(spark, sf):
    out = BT.request_batches(table(spark, sf, "orders"), ["o_orderkey"], 100)
    return out.select("batch_number", "batch_size", F.col("total_batches").cast("int").alias("total_batches"),
                      F.get_json_object("payload", "$.data[0].o_orderkey").cast("long").alias("first_key"),
                      F.element_at(F.from_json(F.get_json_object("payload", "$.data[*].o_orderkey"),
                                               "array<bigint>"), -1).alias("last_key"))


@register("sink_request_outbox", """
SELECT run, (pos - 1) // 100 + 1 AS batch_number, CAST(count(*) OVER (PARTITION BY run, (pos - 1) // 100) AS INTEGER) AS batch_size,
  (pos - 1) % 100 AS place, o_orderkey, o_orderstatus, o_totalprice
FROM (SELECT 'all' AS run, *, row_number() OVER (ORDER BY o_orderkey) AS pos FROM orders
  UNION ALL SELECT 'open', *, row_number() OVER (ORDER BY o_orderkey) FROM orders WHERE o_orderstatus = 'O')""")
def q_sink_outbox(spark, sf):
    path = scratch_dir(spark, "sink-outbox")
    orders = table(spark, sf, "orders")
    OB.send_batches(orders, path, ["o_orderkey"], run="all")
    OB.send_batches(orders.where("o_orderstatus = 'O'"), path, ["o_orderkey"], run="open")
    OB.send_batches(orders, path, ["o_orderkey"], run="all")           # sent already
    record = "o_orderkey bigint, o_orderstatus string, o_totalprice double"
    data = F.from_json("payload", f"data array<struct<{record.replace(' ', ': ').replace(',: ', ', ')}>>")["data"]
    return (OB.sent_batches(spark, path).select("run", "batch_number", "batch_size", F.posexplode(data).alias("place", "r"))
            .select("run", "batch_number", "batch_size", F.col("place").cast("long").alias("place"), "r.*"))


def _split_group():
    p = F.col("o_orderpriority")
    return F.when(F.col("o_orderkey") % 17 == 0, None).otherwise(
        F.when(p == "1-URGENT", F.lit("1/URGENT")).otherwise(p))


@register("sink_split_by_group", """
SELECT replace(g, '/', '_') AS grp, count(*) AS n FROM (SELECT CASE WHEN o_orderkey % 17 = 0 THEN NULL
  WHEN o_orderpriority = '1-URGENT' THEN '1/URGENT' ELSE o_orderpriority END AS g FROM orders)
WHERE g IS NOT NULL GROUP BY 1""")
def q_sink_split(spark, sf):
    path = scratch_dir(spark, "sink-split")
    df = table(spark, sf, "orders").withColumn("grp", _split_group())
    W.write_split_by_group(df, path, "grp", "parquet")
    back = spark.read.parquet(path)
    return back.groupBy(F.col("grp").cast("string").alias("grp")).agg(F.count(F.lit(1)).alias("n"))


@register("sink_multi_target", """SELECT 'csv' AS target, count(*) AS n FROM orders
UNION ALL SELECT 'json', count(*) FROM orders UNION ALL SELECT 'parquet', count(*) FROM orders""")
def q_sink_multi(spark, sf):
    base = scratch_dir(spark, "sink-multi")
    W.write_targets(table(spark, sf, "orders"), [
        {"type": "csv", "path": f"{base}/csv"}, {"type": "json", "path": f"{base}/json"},
        {"type": "parquet", "path": f"{base}/parquet"}])
    parts = [spark.read.option("header", "true").csv(f"{base}/csv").select(F.lit("csv").alias("target")),
             spark.read.json(f"{base}/json").select(F.lit("json").alias("target")),
             spark.read.parquet(f"{base}/parquet").select(F.lit("parquet").alias("target"))]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
