"""Request payloads: records in numbered batches with an envelope.

``{"data": [...records...], "batch_info": {"batch_number", "batch_size",
"total_batches"}}`` — re-aimed from HTTP calls to a DataFrame of payloads a
``foreachPartition`` client (or any writer) can send.  Positions come from the
two-level global numbering, so no task sorts the whole table; each batch is a
group of at most ``batch_size`` rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import qcol
from ..functions.ordering import global_row_number


def request_batches(df: DataFrame, order_by: list[str], batch_size: int = 100) -> DataFrame:
    """``(batch_number, batch_size, total_batches, payload)`` per batch."""
    numbered, total = global_row_number(df, order_by, name="__pos", with_total=True)
    total_batches = -(-total // batch_size) if total else 0
    rec = F.struct(*[qcol(c) for c in df.columns])
    batched = numbered.select(((F.col("__pos") - 1) / F.lit(batch_size)).cast("long").alias("b"),
                              F.struct(F.col("__pos").alias("p"), rec.alias("r")).alias("x"))
    grouped = batched.groupBy("b").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    records = F.transform(F.col("xs"), lambda x: x["r"])
    info = F.struct((F.col("b") + 1).alias("batch_number"), F.size("xs").alias("batch_size"),
                    F.lit(total_batches).alias("total_batches"))
    return grouped.select((F.col("b") + 1).alias("batch_number"), F.size("xs").alias("batch_size"),
                          F.lit(total_batches).alias("total_batches"),
                          F.to_json(F.struct(records.alias("data"), info.alias("batch_info")),
                                    {"ignoreNullFields": "false"}).alias("payload"))
