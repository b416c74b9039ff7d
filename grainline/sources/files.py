"""File sources: CSV (with skipped lead lines and extra null tokens), JSON
documents with a dotted record path, Parquet, nested-struct flattening.

Type inference after null-token removal is one Spark aggregate over the text
columns (``try_cast`` success counts), never a driver-side sample.
"""

from __future__ import annotations

import csv
import io
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol
from ..operators.clean import DTYPE_NAMES, parse_datetime_expr

# fixed values: the text tokens pandas reads as missing by default
DEFAULT_NA_TOKENS = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
                     "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
                     "nan", "null"]


def _reader(spark: SparkSession, separator: str, encoding: str, header: bool, multiline: bool):
    return (spark.read.option("sep", separator).option("encoding", encoding)
            .option("header", str(header).lower()).option("quote", '"').option("escape", '"')
            .option("multiLine", str(multiline).lower()).option("mode", "PERMISSIVE"))


# fixed values: text shapes that read as integers / decimal numbers
INTEGER_TEXT = r"^\s*[+-]?[0-9]{1,18}\s*$"
NUMBER_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def infer_text_types(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cast text columns to bigint / double / boolean when every non-null value
    has that shape (one aggregate job over all columns), like a CSV reader
    would.  Shapes are tested with regular expressions: a failed cast per
    value is far slower than a pattern test."""
    cols = [c for c in (columns or df.columns) if isinstance(df.schema[c].dataType, T.StringType)]
    if not cols:
        return df
    checks = []
    for i, c in enumerate(cols):
        v = qcol(c)
        checks += [F.count(v).alias(f"n{i}"),
                   F.count_if(v.rlike(INTEGER_TEXT)).alias(f"l{i}"),
                   F.count_if(v.rlike(NUMBER_TEXT)).alias(f"d{i}"),
                   F.count_if(F.lower(v).isin("true", "false")).alias(f"b{i}")]
    row = df.agg(*checks).first()
    exprs = {}
    for i, c in enumerate(cols):
        n = row[f"n{i}"]
        if n == 0:
            continue
        if row[f"l{i}"] == n:
            exprs[c] = F.trim(qcol(c)).try_cast("bigint")
        elif row[f"d{i}"] == n:
            exprs[c] = F.trim(qcol(c)).try_cast("double")
        elif row[f"b{i}"] == n:
            exprs[c] = F.lower(qcol(c)) == F.lit("true")
    return df.withColumns(exprs) if exprs else df


def apply_dtypes(df: DataFrame, dtypes: dict | None, date_columns=None) -> DataFrame:
    exprs = {}
    for c, name in (dtypes or {}).items():
        if c in df.columns:
            exprs[c] = qcol(c).try_cast(DTYPE_NAMES.get(name, name))
    for c in date_columns or []:
        if c in df.columns:
            exprs[c] = parse_datetime_expr(df, c)
    return df.withColumns(exprs) if exprs else df


def null_tokens(df: DataFrame, tokens: list[str]) -> DataFrame:
    """Text values equal to a token become null (all text columns)."""
    toks = list(dict.fromkeys(tokens))
    exprs = {f.name: F.when(~qcol(f.name).isin(toks), qcol(f.name)) for f in df.schema.fields
             if isinstance(f.dataType, T.StringType) and not f.name.startswith("__")}
    return df.withColumns(exprs) if exprs else df


def read_csv(spark: SparkSession, path: str, separator: str = ",", encoding: str = "utf-8",
             header: int | None = 0, columns: list[str] | None = None, dtypes: dict | None = None,
             date_columns: list[str] | None = None, skip_rows: int = 0, na_values: list[str] | None = None,
             max_rows: int | None = None, multiline: bool | None = None, schema=None) -> DataFrame:
    """CSV scan with the options of the spec.

    ``header`` is the number of the line that holds the names (lines before it are
    dropped; ``None``: no names).  Fields may hold quoted line breaks: whether any
    line leaves a quote open is found by one scan of the lines, which stops at the
    first, unless ``multiline`` says so.  Only then is a file read by one task.

    Without ``dtypes``/``schema`` every column is read as text, the pandas null
    tokens (plus ``na_values``) become null, and types are inferred by one
    aggregate.  ``skip_rows`` drops the first lines of **each file** (see
    ``_skip_lines``).
    """
    if header is not None and int(header) > 0:
        skip_rows, header = skip_rows + int(header), 0
    if multiline is None:
        multiline = not spark.read.text(path).where(F.regexp_count("value", F.lit('"')) % 2 == 1).isEmpty()
    if skip_rows:
        df = _csv_after_skip(spark, path, separator, encoding, header, skip_rows, multiline)
    elif schema is not None:
        df = _csv_with_schema(_reader(spark, separator, encoding, header is not None, multiline), path, schema, na_values)
    else:
        df = _reader(spark, separator, encoding, header is not None, multiline).option(
            "inferSchema", "false").csv(path)
    order = []
    if max_rows is not None and not skip_rows:
        # "first n rows" in file order: file path, then position inside the file
        # (ids are consecutive within a split, and a file's splits come in order)
        df = df.withColumns({"__f": F.col("_metadata.file_path"), "__i": F.monotonically_increasing_id()})
        order = ["__f", "__i"]
    elif max_rows is not None:
        order = []
    if columns:
        df = df.select(*[qcol(c) for c in columns if c in df.columns], *order)
    if schema is None:
        df = null_tokens(df, DEFAULT_NA_TOKENS + list(na_values or []))
        if dtypes:
            df = apply_dtypes(df, dtypes)
        rest = [c for c in df.columns if c not in (dtypes or {}) and c not in (date_columns or [])
                and c not in ("__f", "__i")]
        df = infer_text_types(df, rest)
    df = apply_dtypes(df, None, date_columns)
    if max_rows is not None:
        df = (df.orderBy(*order).limit(int(max_rows)).drop(*order) if order
              else df.limit(int(max_rows)))
    return df


def _csv_with_schema(reader, path: str, schema, na_values: list[str] | None) -> DataFrame:
    """CSV under a given schema; with ``na_values`` the columns are read as text,
    cleared of null tokens, and then cast (what does not parse is null)."""
    if not na_values:
        return reader.schema(schema).csv(path)
    want = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    text = reader.schema(T.StructType([T.StructField(f.name, T.StringType()) for f in want.fields])).csv(path)
    text = null_tokens(text, DEFAULT_NA_TOKENS + list(na_values))
    return text.select(*[qcol(f.name).try_cast(f.dataType).alias(f.name) for f in want.fields])


def _skip_lines(spark: SparkSession, path: str, encoding: str, n: int) -> DataFrame:
    """Lines of every text file with the first ``n`` lines of each file removed.

    Only splits that start a file (``_metadata.file_block_start == 0``) can
    hold those lines; rows of every other split pass straight through.  Inside
    a first split, a line's ``monotonically_increasing_id`` is consecutive and
    in file order, so the first ``n`` lines of a file are the ids
    ``first .. first+n-1`` where ``first`` is the smallest id of that file
    (valid while the skipped lines lie in the first split, i.e. any realistic
    ``n``).  The per-file minimum is a partial aggregate with one row per file.
    """
    raw = F.col("value") if encoding.lower().replace("-", "").replace("_", "") == "utf8" \
        else F.decode(F.col("value").cast("binary"), encoding)       # lines keep their bytes until here
    lines = (spark.read.text(path)
             .select(raw.alias("value"), F.col("_metadata.file_path").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__start"),
                     F.monotonically_increasing_id().alias("__id")))
    head = lines.where(F.col("__start") == 0)
    firsts = head.groupBy("__file").agg(F.min("__id").alias("__first"))   # one row per file
    kept = head.join(F.broadcast(firsts), "__file").where(F.col("__id") >= F.col("__first") + n)
    kept = kept.select("value", "__file", "__start", "__id", (F.col("__id") - F.col("__first") - n).alias("__line"))
    rest = lines.where(F.col("__start") > 0).select("value", "__file", "__start", "__id", F.lit(1 << 62).alias("__line"))
    return kept.unionByName(rest)


def _whole_records(lines: DataFrame) -> DataFrame:
    """Lines joined to records where a quoted field runs over several: a line
    starts a record when the quotes before it in its file are closed.  A file is
    one window, as a file with such fields can only be read from its start."""
    order = Window.partitionBy("__file").orderBy("__start", "__id")
    before = F.coalesce(F.sum(F.regexp_count("value", F.lit('"'))).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    marked = lines.withColumn("__new", (before % 2 == 0).cast("long"))
    marked = marked.withColumn("__rec", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    joined = marked.groupBy("__file", "__rec").agg(
        F.array_sort(F.collect_list(F.struct("__start", "__id", "value"))).alias("__parts"), F.min("__line").alias("__line"))
    return joined.select(F.array_join("__parts.value", "\n").alias("value"), "__file", "__line")


def _csv_after_skip(spark, path, separator, encoding, header, n, multiline=False) -> DataFrame:
    lines = _skip_lines(spark, path, encoding, n)
    if multiline:
        lines = _whole_records(lines)
    lines = lines.where(F.trim("value") != "")
    if header is not None:
        # the first line left of each file holds the names
        first = lines.where(F.col("__line") < F.lit(1 << 62)).orderBy("__file", "__line").select("value").limit(1).collect()
        names = next(csv.reader(io.StringIO(first[0]["value"]), delimiter=separator)) if first else []
        heads = lines.groupBy("__file").agg(F.min("__line").alias("__head"))
        body = lines.join(F.broadcast(heads), "__file").where(F.col("__line") > F.col("__head"))
    else:
        sample = lines.select("value").limit(1).collect()
        width = len(next(csv.reader(io.StringIO(sample[0]["value"]), delimiter=separator))) if sample else 0
        names = [f"_c{i}" for i in range(width)]
        body = lines
    ddl = ", ".join(f"`{c}` STRING" for c in names)
    parsed = body.select(F.from_csv("value", ddl, {"sep": separator, "quote": '"', "escape": '"'}).alias("r"))
    return parsed.select(*[F.col("r").getField(c).alias(c) for c in names])


# ---------------------------------------------------------------------- json
def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested structs become columns named ``a.b.c``; arrays are kept."""
    def walk(dt: T.DataType, path: list[str]) -> list[Column]:
        if isinstance(dt, T.StructType):
            out = []
            for f in dt.fields:
                out += walk(f.dataType, path + [f.name])
            return out
        col = reduce(lambda c, name: c.getField(name), path[1:], qcol(path[0]))
        return [col.alias(sep.join(path))]
    cols = []
    for f in df.schema.fields:
        cols += walk(f.dataType, [f.name])
    return df.select(*cols)


def _is_document(line: str) -> bool:
    try:
        json.loads(line)
        return True
    except ValueError:
        return False


def read_json_records(spark: SparkSession, path: str, json_path: str | None = None,
                      multiline: bool | None = None, schema=None) -> DataFrame:
    """JSON documents → one row per record under the dotted ``json_path``
    (a list explodes into rows, a single object is one row), then flattened.
    A missing key fails at analysis, as a missing key does in the source tool.

    A file is one whole document (``multiline=True``) or holds one per line
    (``False``, read in parallel); by default its first line tells, which is a
    document of its own in the second case only."""
    if multiline is None:
        first = spark.read.text(path).where(F.trim("value") != "").first()
        multiline = first is not None and not _is_document(first["value"])
    reader = spark.read.option("multiLine", str(multiline).lower())
    if schema is not None:
        reader = reader.schema(schema)
    docs = reader.json(path)
    if not json_path:
        return flatten(docs)
    parts = json_path.split(".")
    target = reduce(lambda c, name: c.getField(name), parts[1:], qcol(parts[0]))
    dt = docs.select(target.alias("t")).schema["t"].dataType
    if isinstance(dt, T.ArrayType):
        recs = docs.select(F.explode(target).alias("r"))
    else:
        recs = docs.select(target.alias("r"))
    rdt = recs.schema["r"].dataType
    if isinstance(rdt, T.StructType):
        return flatten(recs.select("r.*"))
    return recs.withColumnRenamed("r", "value")


# ------------------------------------------------------------------- parquet
def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*[qcol(c) for c in columns]) if columns else df


def read_parquet_first_rows(spark: SparkSession, path: str, n: int, columns=None) -> DataFrame:
    """The first ``n`` rows in file order (file path, then row index inside the
    file): a distributed top-k over the first files only.

    Files are taken in path order, one, then two more, then four more, until
    their footers count ``n`` rows; all others are pruned from the scan."""
    df = spark.read.parquet(path)
    cols = columns or df.columns
    here = F.col("_metadata.file_path")
    names, taken, rows = sorted(df.inputFiles()), [], 0
    while names and (rows < n or not taken):
        step = max(1, 2 * len(taken))
        more, names = names[:step], names[step:]
        rows += spark.read.schema(df.schema).parquet(*more).count()
        taken += more
    ordered = (spark.read.schema(df.schema).parquet(*taken) if taken else df).where(F.col("_metadata.row_index") < int(n)).select(
        *[qcol(c) for c in cols], here.alias("__f"), F.col("_metadata.row_index").alias("__r"))
    return ordered.orderBy("__f", "__r").limit(int(n)).select(*[qcol(c) for c in cols])
