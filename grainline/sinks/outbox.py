"""Batch outbox: a file-backed target that takes each request batch once.

A Python Data Source (``format("batch_outbox")``) with a commit protocol:

* Every task attempt writes its batches to a Parquet file of its own,
  ``<path>/data/<random name>.parquet``, in shared storage.  An attempt that
  fails removes its file; one that is lost leaves a file nobody names.
* The driver commits by writing one list of the files of the attempts that
  Spark accepted, ``<path>/commits/<run>.json``, under another name first and
  then renamed.  A batch counts as sent when a list names its file, so retried,
  speculative and lost attempts send nothing twice.
* A run that is committed already is not sent again; its repeat has no effect.
  One driver at a time may write a run.

``sent_batches`` reads what is committed; a client that posts the payloads, or
any other reader, works from there.  The driver holds one file name per task.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from .batches import request_batches

#: columns of a batch, as ``request_batches`` makes them
SCHEMA = "batch_number bigint, batch_size int, total_batches bigint, payload string"
_RUN = re.compile(r"[A-Za-z0-9._-]+")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and plain path of a shared location (file, hdfs, s3, ...)."""
    if path.startswith("file:") and not path.startswith("file://"):
        path = "file://" + path[len("file:"):]
    return pafs.FileSystem.from_uri(path.rstrip("/"))


def _exists(fs: pafs.FileSystem, path: str) -> bool:
    return fs.get_file_info(path).type != pafs.FileType.NotFound


@dataclass
class Written(WriterCommitMessage):
    """What an accepted attempt wrote; ``file`` is None for a task without rows."""

    file: str | None
    batches: int


class OutboxWriter(DataSourceArrowWriter):
    def __init__(self, path: str, run: str):
        self.path, self.run = path, run

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, root = _open(self.path)
        name, out, n = f"{uuid.uuid4().hex}.parquet", None, 0
        target = f"{root}/data/{name}"
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    fs.create_dir(f"{root}/data", recursive=True)
                    out = pq.ParquetWriter(target, batch.schema, filesystem=fs)
                out.write_batch(batch)
                n += batch.num_rows
            if out is not None:
                out.close()
        except BaseException:
            if out is not None:
                out.close()
                fs.delete_file(target)
            raise
        return Written(name if n else None, n)

    def commit(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        listed = f"{root}/commits/{self.run}.json"
        if _exists(fs, listed):
            self.abort(messages)
            return
        fs.create_dir(f"{root}/commits", recursive=True)
        draft = f"{root}/commits/.{uuid.uuid4().hex}"
        with fs.open_output_stream(draft) as f:
            for m in messages:
                if m is not None and m.file:
                    f.write(json.dumps({"run": self.run, "file": m.file, "batches": m.batches}).encode() + b"\n")
        fs.move(draft, listed)

    def abort(self, messages: list[Written | None]) -> None:
        fs, root = _open(self.path)
        for m in messages:
            if m is not None and m.file and _exists(fs, f"{root}/data/{m.file}"):
                fs.delete_file(f"{root}/data/{m.file}")


class BatchOutbox(DataSource):
    @classmethod
    def name(cls) -> str:
        return "batch_outbox"

    def writer(self, schema, overwrite: bool) -> OutboxWriter:
        if overwrite:
            raise ValueError("an outbox is appended to; what was sent cannot be taken back")
        return OutboxWriter(self.options["path"], self.options["run"])


def send_batches(df: DataFrame, path: str, order_by: list[str], batch_size: int = 100, run: str | None = None) -> str:
    """Send ``df`` in batches of ``batch_size`` records to the outbox at ``path``;
    returns the run's name.  ``run`` names the delivery: sent again, it has no effect."""
    from ..session import ship_package
    run = uuid.uuid4().hex if run is None else run
    if not _RUN.fullmatch(run) or run.startswith("."):
        raise ValueError(f"run {run!r}: letters, digits, '_', '-' and '.' only, no '.' first")
    spark = df.sparkSession
    fs, root = _open(path)
    if _exists(fs, f"{root}/commits/{run}.json"):
        return run
    ship_package(spark)
    spark.dataSource.register(BatchOutbox)
    out = request_batches(df, order_by, batch_size)
    out.select(*[F.col(f.split()[0]).cast(f.split()[1]) for f in SCHEMA.split(", ")]) \
        .write.format("batch_outbox").mode("append").option("run", run).save(path)
    return run


def sent_batches(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """``(run, batch_number, batch_size, total_batches, payload)`` of all committed
    runs, or of ``run``.  No row for an outbox that does not exist yet."""
    fs, root = _open(path)
    if not _exists(fs, f"{root}/data") or not _exists(fs, f"{root}/commits"):
        return spark.createDataFrame([], "run string, " + SCHEMA)
    lists = spark.read.schema("run string, file string").json(f"{path.rstrip('/')}/commits")
    if run is not None:
        lists = lists.where(F.col("run") == run)
    rows = spark.read.schema(SCHEMA).parquet(f"{path.rstrip('/')}/data").select("*", F.col("_metadata.file_name").alias("file"))
    return rows.join(lists, "file").select("run", *[f.split()[0] for f in SCHEMA.split(", ")])
