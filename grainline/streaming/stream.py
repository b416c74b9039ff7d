"""Row-local and fitted operators on Structured Streaming.

The operators marked stream-safe are projections and filters; fitted ones
(scalers, imputers, bins, outlier bounds) are fitted on a batch table and
applied to the stream as literals — no state store is needed.  The sink is a
Parquet folder with a checkpoint location in the shared checkpoint folder, so
a restarted query resumes exactly once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def file_stream(spark: SparkSession, directory: str, schema, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(directory)


def run_available(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], sink_dir: str,
                  checkpoint_dir: str, fmt: str = "parquet") -> None:
    """Transform a stream and process everything available now, then stop."""
    query = (transform(stream).writeStream.format(fmt).option("checkpointLocation", checkpoint_dir)
             .outputMode("append").trigger(availableNow=True).start(sink_dir))
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def run_available_to_targets(stream: DataFrame, transform: Callable[[DataFrame], DataFrame],
                             targets: list[dict], checkpoint_dir: str) -> None:
    """Stream into the batch writers (split-by-group folders, JDBC tables, CSV…)
    with ``foreachBatch``: every micro-batch is appended to every target.  The
    checkpoint makes a restarted query resume after the last committed batch;
    a batch interrupted half-way is replayed (at-least-once for these sinks)."""
    from ..sinks.writers import write_targets

    appended = [{**t, "mode": "append"} if t.get("type") != "jdbc" else {**t, "if_exists": "append"}
                for t in targets]

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        write_targets(batch, appended)

    query = (transform(stream).writeStream.foreachBatch(write_batch)
             .option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
