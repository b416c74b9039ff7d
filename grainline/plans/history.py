"""Run history as append-only Parquet tables in a shared folder.

Tables (fixed schemas): ``runs``, ``logs``, ``quality``.  A run appends one
row to ``runs`` and its log lines to ``logs``; quality metrics come from rule
results and profiles.  The read side is plain DataFrame queries: recent runs
(a top-k), one run with its ordered logs, records per second.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RUNS_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("config_name", T.StringType()),
    T.StructField("status", T.StringType()), T.StructField("start_time", T.TimestampType()),
    T.StructField("end_time", T.TimestampType()), T.StructField("records_processed", T.LongType()),
    T.StructField("error_message", T.StringType()), T.StructField("created_at", T.TimestampType()),
])
LOGS_SCHEMA = T.StructType([
    T.StructField("pipeline_run_id", T.StringType()), T.StructField("level", T.StringType()),
    T.StructField("message", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
])
QUALITY_SCHEMA = T.StructType([
    T.StructField("pipeline_run_id", T.StringType()), T.StructField("step", T.StringType()),
    T.StructField("metric_name", T.StringType()), T.StructField("metric_value", T.DoubleType()),
    T.StructField("metric_description", T.StringType()), T.StructField("timestamp", T.TimestampType()),
])


class History:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _append(self, name: str, rows: list[tuple], schema: T.StructType) -> None:
        if rows:
            self.spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{self.root}/{name}")

    def table(self, name: str) -> DataFrame:
        schema = {"runs": RUNS_SCHEMA, "logs": LOGS_SCHEMA, "quality": QUALITY_SCHEMA}[name]
        try:
            return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")
        except Exception:  # noqa: BLE001 - no run recorded yet
            return self.spark.createDataFrame([], schema)

    def extend(self, name: str, rows: DataFrame) -> None:
        """Append rows kept elsewhere (another tool's history) to a table: columns
        of the fixed schema, absent ones null; a distributed append."""
        schema = {"runs": RUNS_SCHEMA, "logs": LOGS_SCHEMA, "quality": QUALITY_SCHEMA}[name]
        cols = [(F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields]
        rows.select(*cols).write.mode("append").parquet(f"{self.root}/{name}")

    def record(self, result, spec: dict | None = None) -> None:
        status = "completed" if result.success else "failed"
        self._append("runs", [(result.run_id, result.name, status, result.start_time, result.end_time,
                               result.records_processed, result.error, _dt.datetime.now())], RUNS_SCHEMA)
        self._append("logs", [(result.run_id, lvl, msg, step, ts) for ts, lvl, step, msg in result.logs],
                     LOGS_SCHEMA)
        for phase, results in (getattr(result, "validation", None) or {}).items():
            self.record_quality(result.run_id, f"{phase}_validate", results)

    def record_quality(self, run_id: str, step: str, results: DataFrame) -> None:
        """Append rule results (``rule``/``metric``) as quality metrics — a
        distributed append, the result table is not collected."""
        out = results.select(F.lit(run_id).alias("pipeline_run_id"), F.lit(step).alias("step"),
                             F.col("rule").alias("metric_name"), F.col("metric").alias("metric_value"),
                             F.col("message").alias("metric_description"),
                             F.current_timestamp().alias("timestamp"))
        out.write.mode("append").parquet(f"{self.root}/quality")


    def record_profile(self, run_id: str, step: str, profiles: dict) -> None:
        """Append table-profile numbers (``plans.profile.profile``) as quality
        metrics: missing share per column, duplicate rows, numeric statistics."""
        parts = []
        if "missing" in profiles:
            parts.append(profiles["missing"].where(F.col("column") != "*").select(
                F.concat(F.lit("missing_pct."), F.col("column")).alias("metric_name"),
                F.col("missing_percentage").alias("metric_value"),
                F.lit("share of missing values, %").alias("metric_description")))
        if "duplicates" in profiles:
            parts.append(profiles["duplicates"].select(
                F.lit("duplicate_rows").alias("metric_name"),
                F.col("duplicate_rows").cast("double").alias("metric_value"),
                F.lit("rows equal to an earlier row").alias("metric_description")))
        if "numeric" in profiles:
            parts.append(profiles["numeric"].select(
                F.concat(F.col("stat"), F.lit("."), F.col("column")).alias("metric_name"),
                F.col("value").alias("metric_value"), F.lit("numeric summary").alias("metric_description")))
        if not parts:
            return
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        out.select(F.lit(run_id).alias("pipeline_run_id"), F.lit(step).alias("step"), "metric_name",
                   "metric_value", "metric_description", F.current_timestamp().alias("timestamp")) \
            .write.mode("append").parquet(f"{self.root}/quality")


def recent_runs(runs: DataFrame, n: int = 10) -> DataFrame:
    """Last ``n`` runs by start time (a top-k, the limit is the feature)."""
    return runs.orderBy(F.desc("start_time"), F.desc("id")).limit(n)


def run_status(runs: DataFrame, logs: DataFrame, run_id: str | None = None) -> DataFrame:
    """Runs with their logs ordered by time (one row per run)."""
    r = runs if run_id is None else runs.where(F.col("id") == run_id)
    grouped = logs.groupBy("pipeline_run_id").agg(F.array_sort(F.collect_list(
        F.struct("timestamp", "level", "step", "message"))).alias("logs"))
    return r.join(grouped, r["id"] == grouped["pipeline_run_id"], "left").drop("pipeline_run_id")


def run_throughput(runs: DataFrame) -> DataFrame:
    secs = (F.unix_micros(F.col("end_time")) - F.unix_micros(F.col("start_time"))) / 1e6
    return runs.select("id", "config_name", "records_processed", secs.alias("duration_seconds"),
                       F.try_divide(F.col("records_processed").cast("double"), secs).alias("records_per_second"))
