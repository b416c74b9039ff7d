"""Spark helpers the operators share: written tables, bounded bitmaps, and the
search for keys that occur more than once."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SINGLE, WITNESS, KNOWN = 0, 1, 2


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet under ``spark.checkpoint.dir`` and read it back.

    Cuts the lineage in storage all executors share, and gives the planner
    the table's true size, so that Spark itself picks broadcast or shuffle."""
    from ..session import ensure_checkpoint_dir
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    if base is None:
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is needed")
    path = f"{base.rstrip('/')}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def place() -> Column:
    """A number per row of a written table, its own and the same in every pass:
    the number of its file, then its row in the file."""
    part = F.coalesce(F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).try_cast("bigint"), F.lit(0))
    return part * (1 << 33) + F.col("_metadata.row_index")


def same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def bitmap(df: DataFrame, key: str, bits: int = 24) -> np.ndarray:
    """Bitmap of ``2**bits`` bits with the bit of every 64-bit ``key`` set.

    Its size is fixed (2 MB at 24 bits) whatever the number of keys; a full
    bitmap lets everything through, so users only save work by it."""
    low = F.col(key).bitwiseAND(F.lit((1 << bits) - 1))
    got = (df.select(F.shiftright(low, 6).alias("w"), low.bitwiseAND(F.lit(63)).cast("int").alias("b"))
           .groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, b)")).alias("m")).toPandas())
    out = np.zeros(1 << (bits - 6), np.int64)
    out[got["w"].to_numpy(np.int64)] = got["m"].to_numpy(np.int64)
    return np.unpackbits(out.view(np.uint8), bitorder="little").astype(bool)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    return bits[(keys & np.uint64(len(bits) - 1)).astype(np.int64)]


def route(keys: np.ndarray) -> np.ndarray:
    """What a batch knows about each of its (sorted) keys.

    A key with two rows in the batch is known to be shared: its first row is
    the witness, which travels on the key; the others need no answer and are
    dealt out evenly.  So a key sends at most one row a batch to the task
    that decides on it, however many rows hold it."""
    prev = np.zeros(len(keys), bool)
    prev[1:] = keys[1:] == keys[:-1]
    nxt = np.zeros(len(keys), bool)
    nxt[:-1] = prev[1:]
    return np.where(prev, KNOWN, np.where(nxt, WITNESS, SINGLE)).astype(np.int64)


def recurring(df: DataFrame, key: str, meta: str, spread: str) -> DataFrame:
    """Rows whose ``key`` occurs more than once anywhere.

    The two low bits of ``meta`` hold the state that ``route`` gave the row.
    One shuffle; rows known to be shared are dealt by ``spread`` as well, all
    others by the key.  Each task streams its sorted rows and holds back one
    row at most."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = F.col(meta).bitwiseAND(F.lit(3)) == F.lit(KNOWN)
    ordered = (df.repartition(n, F.when(known, F.xxhash64(key, spread)).otherwise(F.col(key)))
               .sortWithinPartitions(key))
    at, flag = df.columns.index(key), df.columns.index(meta)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last = None, None          # last row of the batch before, if still undecided; its key
        for batch in batches:
            if not batch.num_rows:
                continue
            k = batch.column(at).to_numpy(zero_copy_only=False)
            s = batch.column(flag).to_numpy(zero_copy_only=False) & 3
            prev = np.zeros(len(k), bool)
            prev[1:] = k[1:] == k[:-1]
            prev[0] = last is not None and last == k[0]
            nxt = np.zeros(len(k), bool)
            nxt[:-1] = prev[1:]
            if held is not None and prev[0]:
                yield held
            take = prev | nxt | (s != SINGLE)
            held = None if take[-1] else batch.slice(len(k) - 1, 1)
            last = k[-1]
            if take.any():
                yield batch.filter(pa.array(take))

    return ordered.mapInArrow(keep, df.schema)


def small_rows(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)
