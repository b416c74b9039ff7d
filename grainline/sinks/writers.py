"""Sinks: CSV, JSON lines, Parquet, JDBC, one output per group, several
targets from one computed plan.

Every writer is a plain distributed ``DataFrameWriter`` call (one file per
task, written by the executors); nothing is gathered on the driver.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol
from ..functions.staging import staged
from .outbox import send_batches

log = logging.getLogger(__name__)

# fixed values: characters a group value may not carry into a file name, and their replacement
UNSAFE_GROUP_CHARS = ("/", "\\")
GROUP_CHAR_REPLACEMENT = "_"


def _mode(mode: str) -> str:
    return {"w": "overwrite", "a": "append", "replace": "overwrite", "append": "append",
            "fail": "errorifexists"}.get(mode, mode)


def timestamped_path(path: str, when: _dt.datetime | None = None) -> str:
    """``base_YYYYmmdd_HHMMSS`` next to ``path`` (extension kept)."""
    when = when or _dt.datetime.now()
    stamp = when.strftime("%Y%m%d_%H%M%S")
    head, dot, ext = path.rpartition(".")
    if dot and "/" not in ext:
        return f"{head}_{stamp}.{ext}"
    return f"{path}_{stamp}"


def write_csv(df: DataFrame, path: str, separator: str = ",", encoding: str = "utf-8",
              include_header: bool = True, mode: str = "w", na_representation: str = "",
              float_format: str | None = None, date_format: str | None = None,
              timestamped_copy: bool = False) -> list[str]:
    """CSV files under ``path``; ``float_format`` is a printf pattern applied to
    floating columns before writing (e.g. ``%.2f``)."""
    out = df
    if float_format:
        out = out.withColumns({f.name: F.format_string(float_format, qcol(f.name))
                               for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))})

    def writer(frame):
        w = (frame.write.mode(_mode(mode)).option("sep", separator).option("encoding", encoding)
             .option("header", str(include_header).lower()).option("nullValue", na_representation)
             .option("emptyValue", ""))
        if date_format:
            w = (w.option("timestampFormat", date_format).option("timestampNTZFormat", date_format)
                 .option("dateFormat", date_format))
        return w

    paths = [path] + ([timestamped_path(path)] if timestamped_copy else [])
    target = staged(out, "copies") if len(paths) > 1 else out
    for p in paths:
        writer(target).csv(p)
    return paths


def write_json(df: DataFrame, path: str, mode: str = "w", date_format: str | None = None) -> str:
    """JSON lines (one record per line), ISO timestamps by default."""
    w = df.write.mode(_mode(mode)).option("ignoreNullFields", "false")
    if date_format:
        w = w.option("timestampFormat", date_format).option("timestampNTZFormat", date_format)
    w.json(path)
    return path


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "w",
                  partition_by: list[str] | None = None) -> str:
    w = df.write.mode(_mode(mode)).option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_jdbc(df: DataFrame, url: str, table_name: str, if_exists: str = "replace",
               chunksize: int = 10_000, **options) -> None:
    """Database sink; ``chunksize`` is the insert batch size of every task."""
    w = df.write.format("jdbc").option("url", url).option("dbtable", table_name) \
        .option("batchsize", chunksize).mode(_mode(if_exists))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def sanitize_group(col):
    out = col.cast("string")
    for ch in UNSAFE_GROUP_CHARS:
        out = F.replace(out, F.lit(ch), F.lit(GROUP_CHAR_REPLACEMENT))
    return out


def write_split_by_group(df: DataFrame, path: str, group_by: str, file_format: str = "parquet",
                         mode: str = "w", **options) -> str:
    """One output folder per value of ``group_by`` (``group=value``); rows with
    a null group are dropped; path separators in values are replaced.

    Rows are rebalanced by group first, so a folder gets few files; AQE splits
    the partitions of a hot group by size, so it never ends in one task (a plain
    ``repartition(group)`` would do that)."""
    if group_by not in df.columns:
        raise ValueError(f"group column {group_by!r} not found")
    out = df.where(qcol(group_by).isNotNull()).withColumn(group_by, sanitize_group(qcol(group_by)))
    w = out.hint("rebalance", qcol(group_by)).write.mode(_mode(mode)).partitionBy(group_by).format(file_format)
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


#: the options of every target type; other keys are a mistake and raise
TARGET_OPTIONS = {
    "csv": {"path", "separator", "encoding", "include_header", "include_index", "mode", "na_representation", "float_format",
            "date_format", "timestamped_copy", "create_timestamped_copy"},
    "json": {"path", "mode", "orient", "date_format"},
    "parquet": {"path", "mode", "compression", "partition_by"},
    "split": {"path", "base_path", "group_by", "format", "file_format", "filename_template", "mode", "separator",
              "encoding", "include_header", "include_index", "compression", "na_representation"},
    "jdbc": {"url", "connection_string", "table_name", "if_exists", "chunksize"},
    "requests": {"path", "order_by", "batch_size", "run"},
}
#: other names of target types
TARGET_NAMES = {"multiple_files": "split", "database": "jdbc"}
_FILE_OPTIONS = {"separator": "sep", "encoding": "encoding", "include_header": "header", "compression": "compression",
                 "na_representation": "nullValue"}


def _write_target(data: DataFrame, kind: str, t: dict) -> str:
    """Write one target; returns where it went."""
    if t.get("include_index"):
        raise ValueError("include_index: rows have no index; number them in a step to write one")
    mode = t.get("mode", "w")
    if kind == "csv":
        opts = {k: v for k, v in t.items() if k not in ("path", "include_index", "create_timestamped_copy")}
        if t.get("create_timestamped_copy"):
            opts["timestamped_copy"] = True
        write_csv(data, t["path"], **opts)
    elif kind == "json":
        if t.get("orient", "records") != "records":
            raise ValueError("orient: only records are written, one per line")
        write_json(data, t["path"], mode, None if t.get("date_format") == "iso" else t.get("date_format"))
    elif kind == "parquet":
        write_parquet(data, t["path"], t.get("compression", "snappy"), mode, t.get("partition_by"))
    elif kind == "split":
        if t.get("filename_template"):
            raise ValueError("filename_template: a group is a folder named group=value, not a file")
        fmt = t.get("file_format", t.get("format", "csv" if "base_path" in t else "parquet"))
        wanted = {name: str(t[k]).lower() if k == "include_header" else t[k] for k, name in _FILE_OPTIONS.items() if k in t}
        if fmt == "csv":
            wanted = {"header": "true", **wanted}
        write_split_by_group(data, t.get("base_path", t.get("path")), t["group_by"], fmt, mode, **wanted)
        return t.get("base_path", t.get("path"))
    elif kind == "requests":
        send_batches(data, t["path"], t["order_by"], t.get("batch_size", 100), t.get("run"))
    else:
        write_jdbc(data, t.get("url", t.get("connection_string")), t["table_name"], t.get("if_exists", "replace"),
                   t.get("chunksize", 10_000))
        return t["table_name"]
    return t["path"]


def write_targets(df: DataFrame, targets: list[dict], fail_on_target_error: bool = True) -> list[dict]:
    """Write one table to several targets.

    Several targets: the table is computed once and staged in shared storage,
    each target is then a write of its own from there, so a lost executor or a
    failed target repeats that target only.  A file target is complete when
    its ``_SUCCESS`` marker is there.  Types and options are checked before
    anything is written."""
    plans = []
    for t in targets:
        kind = TARGET_NAMES.get(t.get("type"), t.get("type"))
        try:
            if kind not in TARGET_OPTIONS:
                raise ValueError(f"unknown target type {t.get('type')!r}; types are {sorted(TARGET_OPTIONS | TARGET_NAMES)}")
            opts = {k: v for k, v in t.items() if k not in ("type", "name", "description")}
            odd = set(opts) - TARGET_OPTIONS[kind]
            if odd:
                raise ValueError(f"target {t.get('name', kind)} has no option {sorted(odd)}; options are {sorted(TARGET_OPTIONS[kind])}")
            plans.append((t, kind, opts, None))
        except ValueError as exc:
            if fail_on_target_error:
                raise
            plans.append((t, kind, {}, exc))
    data = staged(df, "targets") if sum(p[3] is None for p in plans) > 1 else df
    results = []
    for t, kind, opts, exc in plans:
        where = {"target": t.get("path", t.get("base_path", t.get("table_name"))), "type": t.get("type")}
        if "name" in t:
            where["name"] = t["name"]
        try:
            if exc is not None:
                raise exc
            results.append({**where, "target": _write_target(data, kind, opts), "ok": True})
        except Exception as failed:  # noqa: BLE001 - policy decides
            if fail_on_target_error:
                raise
            log.warning("target %s failed: %s", t, failed)
            results.append({**where, "ok": False, "error": str(failed)})
    return results
