"""Operator 4: token counts from an exact length histogram.

Every text is encoded whole with a public byte-level BPE vocabulary; documents
are aggregated by encoded length, so everything that depends on lengths alone
is answered from one row per distinct length.  Suffix sums over the histogram
give, for a context limit equal to any length, the documents and tokens within
it, the documents at or above it, and the tokens left when every document is
truncated to it; ``at_limits`` answers any other limit and ``quantiles`` any
share.  The sums are two-level (blocks of lengths, then within a block).

The vocabulary file is a parameter.  The driver reads it (its size is checked
against ``MAX_VOCABULARY``) and broadcasts it; executors need no file.

Edge cases: null and empty text has length 0; strings that look like special
tokens are ordinary text; repeated rows count as often as they occur; an empty
table gives an empty histogram; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import text as T
from .shared import written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
MAX_VOCABULARY = 16 << 20
BLOCK = 1024
#: fixed value: the pre-tokenising pattern that belongs to the vocabulary
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

_ENCODERS: dict = {}


def _encoder(raw: bytes):
    name = hashlib.sha256(raw).hexdigest()
    if name not in _ENCODERS:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in raw.splitlines() if x)}
        _ENCODERS[name] = tiktoken.Encoding(name, pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODERS[name]


def lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``(doc_id, n_tokens)`` per row of ``docs``."""
    spark = docs.sparkSession
    T.prepare(spark)
    if os.path.getsize(vocabulary) > MAX_VOCABULARY:
        raise ValueError(f"vocabulary file of more than {MAX_VOCABULARY} bytes")
    with open(vocabulary, "rb") as f:
        raw = spark.sparkContext.broadcast(f.read())
    schema = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(raw.value)
        for batch, arr in T.rows(batches):
            n = np.fromiter((len(enc.encode_ordinary(t)) for t in arr.to_pylist()), np.int64, len(arr))
            yield pa.record_batch([batch.column(0), pa.array(n)], schema=schema)

    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .mapInArrow(run, "doc_id bigint, n_tokens bigint"))


def histogram(counts: DataFrame) -> DataFrame:
    """One row per encoded length with the sums on either side of it."""
    hist = written(counts.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n_docs")), "lengths")
    hist = hist.withColumn("block", F.expr(f"n_tokens div {BLOCK}")).withColumn("t", F.col("n_tokens") * F.col("n_docs"))
    blocks = hist.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("t").alias("bt"))
    over = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)      # one row a block of lengths
    whole = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select("block", F.coalesce(F.sum("bd").over(over), F.lit(0)).alias("pd"),
                           F.coalesce(F.sum("bt").over(over), F.lit(0)).alias("pt"),
                           F.sum("bd").over(whole).alias("docs"), F.sum("bt").over(whole).alias("tokens"))
    inner = Window.partitionBy("block").orderBy("n_tokens")
    out = (hist.withColumn("d", F.sum("n_docs").over(inner)).withColumn("s", F.sum("t").over(inner)).join(blocks, "block")
           .select("n_tokens", "n_docs", (F.col("pd") + F.col("d")).alias("docs_within"),
                   (F.col("pt") + F.col("s")).alias("tokens_within"), "docs", "tokens"))
    return out.select(
        "n_tokens", "n_docs", "docs_within", "tokens_within",
        (F.col("docs") - F.col("docs_within") + F.col("n_docs")).alias("docs_at_least"),
        (F.col("tokens_within") + (F.col("docs") - F.col("docs_within")) * F.col("n_tokens")).alias("truncated_tokens"),
        F.col("docs").alias("all_docs"), F.col("tokens").alias("all_tokens"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``(context, docs_within, truncated_tokens)`` for any context limits."""
    want = hist.sparkSession.createDataFrame([(int(x),) for x in limits], "context bigint")
    each = hist.join(F.broadcast(want))                     # a row per distinct length and asked limit
    return each.groupBy("context").agg(
        F.sum(F.when(F.col("n_tokens") <= F.col("context"), F.col("n_docs")).otherwise(0)).alias("docs_within"),
        F.sum(F.least("n_tokens", "context") * F.col("n_docs")).alias("truncated_tokens"))


def quantiles(hist: DataFrame, shares: list[float]) -> dict[float, int | None]:
    """Smallest length that at least the given share of documents does not exceed."""
    row = hist.agg(*[F.min(F.when(F.col("docs_within") >= F.col("all_docs") * s, F.col("n_tokens"))).alias(f"q{i}")
                     for i, s in enumerate(shares)]).first()
    return {s: row[f"q{i}"] for i, s in enumerate(shares)}
