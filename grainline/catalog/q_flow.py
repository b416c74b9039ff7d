"""Queries for the spec runner, run history and the streaming path."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import features as FE
from ..operators import predicates as P
from ..operators import scale as S
from ..plans import history as H
from ..plans import rules as R
from ..plans.runner import extract, run_spec, transform
from ..streaming import stream as ST
from .q_quality import SUITE, SUITE_SQL
from .registry import events_gaps, register, rounded, scratch_dir, table


def _orders_spec(sf, extra_steps=(), fail_on_step_error=True, targets=None):
    return {
        "name": "orders_prep",
        "extraction": {"sources": [{"name": "orders", "type": "parquet", "path": f"{sf}/orders.parquet"}],
                       "filters": [{"column": "o_totalprice", "condition": "greater_than", "value": 100000}]},
        "validation": {"pre": {"schema": [{"type": "required_columns", "columns": ["o_orderkey", "o_totalprice"]}]}},
        "transformation": {"fail_on_step_error": fail_on_step_error, "steps": [
            {"type": "clean", "config": {"text_cleaning": {"o_orderpriority": ["lowercase"]},
                                         "row_filters": [{"column": "o_orderstatus", "condition": "not_equals",
                                                          "value": "P"}]}},
            *extra_steps,
            {"type": "feature_engineering", "config": {"features": [
                {"name": "price_k", "type": "arithmetic", "operation": "ratio",
                 "columns": ["o_totalprice", "o_custkey"]},
                {"type": "datetime", "column": "o_orderdate", "extract_features": ["year", "quarter"]}]}},
        ]},
        "loading": {"targets": targets or []},
    }


SPEC_SQL = """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, lower(o_orderpriority) AS o_orderpriority,
  'orders' AS _source, o_totalprice / (o_custkey + 1e-8) AS price_k, CAST(year(o_orderdate) AS INTEGER) AS o_orderdate_year,
  CAST(quarter(o_orderdate) AS INTEGER) AS o_orderdate_quarter
FROM orders WHERE o_totalprice > 100000 AND o_orderstatus IS DISTINCT FROM 'P'"""


@register("spec_run", SPEC_SQL)
def q_spec_run(spark, sf):
    out = scratch_dir(spark, "spec-run")
    res = run_spec(spark, _orders_spec(sf, targets=[{"type": "parquet", "path": out}]))
    if not res.success:
        raise RuntimeError(res.error)
    return spark.read.parquet(out)


@register("pipeline_run", SPEC_SQL)
def q_pipeline_run(spark, sf):
    """A run with two named targets in the shape of the source tool's specs; the Parquet one is read back."""
    out = scratch_dir(spark, "pipeline-run")
    targets = [{"name": "table", "type": "parquet", "path": f"{out}/table", "compression": "snappy"},
               {"name": "by status", "type": "multiple_files", "base_path": f"{out}/groups", "group_by": "o_orderstatus",
                "file_format": "csv", "include_header": True, "include_index": False}]
    res = run_spec(spark, _orders_spec(sf, targets=targets))
    if not res.success:
        raise RuntimeError(res.error)
    return spark.read.parquet(f"{out}/table")


@register("pipeline_steps", SPEC_SQL)
def q_pipeline_steps(spark, sf):
    """The steps of a spec applied in order to a table at hand."""
    spec = _orders_spec(sf)
    raw = extract(spark, spec["extraction"])
    return transform(raw, spec["transformation"], observe=False)[0]


@register("spec_steps", SPEC_SQL)
def q_spec_steps(spark, sf):
    broken = {"type": "custom", "config": {"expression": "no_such_column * 2", "new_column": "bad"}}
    res = run_spec(spark, _orders_spec(sf, [broken], fail_on_step_error=False))
    if not res.success:
        raise RuntimeError(res.error)
    return res.data


@register("step_shapes", """
SELECT 0 AS step, 'clean' AS type, CAST(count_if(o_orderstatus IS DISTINCT FROM 'P') AS BIGINT) AS rows_out, 7 AS columns_in,
  7 AS columns_out FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT 1, 'feature_engineering', CAST(count_if(o_orderstatus IS DISTINCT FROM 'P') AS BIGINT), 7, 10
  FROM orders WHERE o_totalprice > 100000""")
def q_step_shapes(spark, sf):
    res = run_spec(spark, _orders_spec(sf))
    if not res.success:
        raise RuntimeError(res.error)
    rows = [(s["step"], s["type"], s["rows_out"], s["columns_in"], s["columns_out"]) for s in res.shapes]
    return spark.createDataFrame(rows, "step int, type string, rows_out bigint, columns_in int, columns_out int")


# ------------------------------------------------------------------ history
# every event stands for one run of a job named after its type, every line item for a log line
RUNS_SQL = """(SELECT CAST(event_id AS VARCHAR) AS id, event_type AS config_name,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'completed' END AS status, ts AS start_time,
  1 + event_id % 600 AS seconds, CAST(floor(value * 100) AS BIGINT) AS records_processed FROM events)"""


def _history(spark, sf) -> H.History:
    hist = H.History(spark, scratch_dir(spark, "history"))
    e = table(spark, sf, "events")
    start, failed = F.col("ts").cast("timestamp"), F.col("event_type").eqNullSafe("error")
    end = F.timestamp_micros(F.unix_micros(start) + (F.col("event_id") % 600 + 1) * 1_000_000)
    hist.extend("runs", e.select(
        F.col("event_id").alias("id"), F.col("event_type").alias("config_name"),
        F.when(failed, "failed").otherwise("completed").alias("status"), start.alias("start_time"),
        end.alias("end_time"), F.floor(F.col("value") * 100).alias("records_processed"),
        F.when(failed, F.col("props")).alias("error_message"), end.alias("created_at")))
    line = table(spark, sf, "lineitem")
    hist.extend("logs", line.select(
        F.col("l_orderkey").alias("pipeline_run_id"),
        F.when(F.col("l_returnflag") == "R", "ERROR").otherwise("INFO").alias("level"),
        F.col("l_linestatus").alias("message"), F.concat(F.lit("line"), "l_linenumber").alias("step"),
        F.col("l_shipdate").alias("timestamp")))
    return hist


@register("run_recent", f"""SELECT id, config_name, status, start_time, records_processed FROM {RUNS_SQL}
ORDER BY start_time DESC, id DESC LIMIT 10""")
def q_run_recent(spark, sf):
    return H.recent_runs(_history(spark, sf).table("runs"), 10).select(
        "id", "config_name", "status", F.col("start_time").cast("timestamp_ntz").alias("start_time"), "records_processed")


@register("run_status", f"""SELECT r.id, r.config_name, r.status, r.records_processed, CAST(coalesce(l.n, 0) AS INTEGER) AS log_lines,
  l.steps FROM {RUNS_SQL} r LEFT JOIN (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, count(*) AS n, string_agg('line' || l_linenumber, ',' ORDER BY l_shipdate,
    CASE WHEN l_returnflag = 'R' THEN 'ERROR' ELSE 'INFO' END, 'line' || l_linenumber, l_linestatus) AS steps
  FROM lineitem GROUP BY l_orderkey) l ON r.id = l.id""")
def q_run_status(spark, sf):
    hist = _history(spark, sf)
    return H.run_status(hist.table("runs"), hist.table("logs")).select(
        "id", "config_name", "status", "records_processed", F.coalesce(F.size("logs"), F.lit(0)).alias("log_lines"),
        F.array_join("logs.step", ",").alias("steps"))


@register("run_throughput", f"""SELECT id, config_name, records_processed, CAST(seconds AS DOUBLE) AS duration_seconds,
  records_processed / CAST(seconds AS DOUBLE) AS records_per_second FROM {RUNS_SQL} WHERE status = 'completed'""")
def q_run_throughput(spark, sf):
    return H.run_throughput(_history(spark, sf).table("runs").where(F.col("status") == "completed"))


@register("quality_metrics", f"""SELECT 'post_validate' AS step, rule AS metric_name, metric AS metric_value
FROM ({SUITE_SQL})""")
def q_quality_metrics(spark, sf):
    hist = H.History(spark, scratch_dir(spark, "quality"))
    results = rounded(R.validate(events_gaps(spark, sf), SUITE))
    hist.record_quality("run-events", "post_validate", results)
    return hist.table("quality").select("step", "metric_name", "metric_value")


# ---------------------------------------------------------------- streaming
@register("stream_row_local", """
SELECT event_id, user_id, (round((value - s.m) / s.sd, 6) + 0.0) AS value, CAST(isodow(ts) - 1 AS INTEGER) AS ts_dayofweek,
  CAST(length(props) AS INTEGER) AS props_length
FROM events, (SELECT avg(value) AS m, stddev_pop(value) AS sd FROM events) s WHERE value > 10""")
def q_stream(spark, sf):
    batch = table(spark, sf, "events")
    model = S.fit_scaler(batch, ["value"], "standard")          # fitted on the batch table

    def prep(df):
        df = P.filter_rows(df, "value", "greater_than", 10)
        df = FE.datetime_features(df, "ts", ["dayofweek"])
        df = FE.text_features(df, "props", ["length"])
        return model.transform(df).select("event_id", "user_id", "value", "ts_dayofweek", "props_length")

    base = scratch_dir(spark, "stream")
    stream = ST.file_stream(spark, sf, batch.schema, glob="events.parquet")
    ST.run_available(stream, prep, f"{base}/out", f"{base}/checkpoint")
    return rounded(spark.read.parquet(f"{base}/out"))
