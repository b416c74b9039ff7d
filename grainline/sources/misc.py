"""Database, parameterised-SQL, paged-response and multi-source inputs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import qcol
from .files import flatten


# ---------------------------------------------------------------------- jdbc
def read_jdbc(spark: SparkSession, url: str, query: str | None = None, table: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int = 10_000, **options) -> DataFrame:
    """Database scan.  With ``table`` and a ``partition_column`` range the read
    is split into ``num_partitions`` parallel range queries; a ``query`` runs
    as one read (the database does the work).  Filters and projections on the
    result are pushed into the SQL Spark sends."""
    reader = spark.read.format("jdbc").option("url", url).option("fetchsize", fetch_size)
    for k, v in options.items():
        reader = reader.option(k, v)
    if query is not None:
        return reader.option("query", query).load()
    reader = reader.option("dbtable", table)
    if partition_column:
        reader = (reader.option("partitionColumn", partition_column).option("lowerBound", lower_bound)
                  .option("upperBound", upper_bound).option("numPartitions", num_partitions or 8))
    return reader.load()


# ------------------------------------------------------------- sql with args
def sql_with_params(spark: SparkSession, query: str, params: dict | None = None, **frames: DataFrame) -> DataFrame:
    """``spark.sql`` with named parameters (``:name``) bound as literals and
    DataFrames bound by name (``{name}``) — never string-formatted values."""
    if frames:
        return spark.sql(query, args=params or None, **frames)
    return spark.sql(query, args=params or None)


# ------------------------------------------------------------ paged results
FIRST_WINDOW = 1024             # pages whose lengths are looked at first


def _stop_page(pages: DataFrame, raw, page_size: int, low: int, end: int) -> int:
    """The first page from ``low`` on with fewer than ``page_size`` records, ``end`` if there is none."""
    n = F.when(raw.isNull(), F.lit(0)).when(F.trim(raw).startswith("["), F.coalesce(F.json_array_length(raw), F.lit(0))) \
        .otherwise(F.lit(1))
    width = FIRST_WINDOW
    while low <= end:
        window = pages.where((F.col("page") >= F.lit(low)) & (F.col("page") < F.lit(low + width)) & (F.col("page") <= F.lit(end)))
        stop = window.agg(F.min(F.when(n < page_size, F.col("page")))).first()[0]
        if stop is not None:
            return stop
        low, width = low + width, width * 8
    return end


def paged_records(pages: DataFrame, data_path: str = "data", page_size: int = 100,
                  max_pages: int | None = None, paginate: bool = True,
                  record_schema: T.DataType | None = None) -> DataFrame:
    """Records of a paged API, from a table of raw responses ``(page, body)``.

    Paging stops at the first empty page and after the first page shorter than
    ``page_size``; at most ``max_pages`` pages are read (one page without
    paging).  A body whose ``data_path`` holds an object counts as one record;
    a body without the key has no records.

    The stop is found first, in windows of pages that grow: only the records
    of a window's pages are counted (their array lengths, no parsing), and pages
    behind the window that holds the stop are not read at all.  Record types are
    inferred from, and bodies parsed for, the pages up to the stop only.
    """
    parts = data_path.split(".")
    json_path = "$." + ".".join(parts)
    raw = F.get_json_object(F.col("body"), json_path)
    low, high = pages.agg(F.min("page"), F.max("page")).first()
    last = low
    if paginate and low is not None:
        end = high if max_pages is None else min(high, low + max_pages - 1)
        last = _stop_page(pages, raw, page_size, low, end)
    kept = pages if last is None else pages.where(F.col("page") <= F.lit(last))
    if record_schema is None:
        # one distributed pass over the pages that count: fields and wider types of any page
        bodies = kept.select(raw.alias("d")).where(F.col("d").isNotNull())
        found = pages.sparkSession.read.option("columnNameOfCorruptRecord", "__bad").json(
            bodies.rdd.map(lambda r: r[0])).schema
        if [f.name for f in found.fields] in ([], ["__bad"]):       # lists of plain values, or nothing
            sample = bodies.limit(1).collect()
            text = sample[0]["d"] if sample else "[]"
            is_list = text.lstrip().startswith("[")
            schema_text = F.schema_of_json(F.lit(text if is_list else f"[{text}]"))
            record_schema = pages.sparkSession.range(1).select(schema_text).first()[0]
        else:
            record_schema = T.ArrayType(T.StructType([f for f in found.fields if f.name != "__bad"]))
    else:
        record_schema = T.ArrayType(record_schema) if not isinstance(record_schema, T.ArrayType) else record_schema
    as_list = F.when(F.trim(raw).startswith("["), raw).otherwise(F.concat(F.lit("["), raw, F.lit("]")))
    kept = kept.select("page", F.from_json(as_list, record_schema).alias("recs"))
    rows = kept.select("page", F.explode("recs").alias("r"))
    if isinstance(rows.schema["r"].dataType, T.StructType):
        return flatten(rows.select("r.*"))
    return rows.select(F.col("r").alias("value"))


# --------------------------------------------------------------------- union
def union_sources(frames: dict[str, DataFrame] | list[tuple[str, DataFrame]], tag_column: str = "_source",
                  skip_empty: bool = True) -> DataFrame:
    """Union by column name; missing columns become null; each row tagged with
    its source name (pairs may repeat a name: both sources carry it).  Empty sources are left out (one ``limit(1)`` probe each),
    so their columns do not appear.  Columns whose types conflict between
    sources are promoted to text first (Spark would otherwise widen
    text+number to number and fail at run time)."""
    pairs = frames.items() if isinstance(frames, dict) else frames
    items = [(name, df) for name, df in pairs if df is not None]
    if skip_empty and len(items) > 1:
        kept = [(name, df) for name, df in items if not df.isEmpty()]
        items = kept or items[:1]
    if not items:
        raise ValueError("no source produced data")
    types: dict[str, set] = {}
    for _, df in items:
        for f in df.schema.fields:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    conflicts = {c for c, ts in types.items() if len(ts) > 1 and not _numeric_only(ts)}
    tagged = []
    for name, df in items:
        exprs = {c: qcol(c).cast("string") for c in df.columns if c in conflicts}
        d = df.withColumns(exprs) if exprs else df
        tagged.append(d.withColumn(tag_column, F.lit(name)))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


_NUMERIC = {"tinyint", "smallint", "int", "bigint", "float", "double"}


def _numeric_only(type_names: set) -> bool:
    return all(t in _NUMERIC for t in type_names)
