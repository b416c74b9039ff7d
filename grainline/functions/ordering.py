"""Order-dependent operators without a one-task global window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into a single
task, and ``partitionBy(key)`` does the same for a key that holds a third of
the table.  Both fills and the numberings here are multi-level scans instead:

1. **Range buckets.**  One exchange, ``repartitionByRange`` over ``(keys...,
   order...)`` and a hash of the row, sorts the table into buckets.  The result
   is staged in shared storage with the bucket of each row and its position in
   the bucket (both from ``monotonically_increasing_id`` over the sorted
   partition), so every later step sees the same buckets, also after an
   executor loss.
2. **Summary.**  A partial aggregate gives one row per bucket: its row count,
   or its last (first) non-null value and the key its first (last) row has.
3. **Scan.**  ``scan`` carries sums or last values over the summary rows.  The
   summary is a table like any other: it is cut into groups of ``WIDTH``
   buckets, the groups are summed up and scanned in turn, and a window runs
   within each group.  No row of it reaches the driver, and the number of
   buckets has no bound.
4. **Local step.**  Rows join their bucket's carry (broadcast under a checked
   size) and finish within the bucket.

A hot key is split across buckets, and so are ties of the sort key; only
rows equal in every column stay together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import qcol
from .joins import join_lookup
from .staging import staged

WIDTH = 1024                    # summary rows one window task scans
BUCKET, AT = "__bucket", "__at"
_LOCAL_BITS = 33                # fixed value: monotonically_increasing_id numbers rows in its low 33 bits


def _hashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(_hashable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return _hashable(dtype.elementType)
    return isinstance(dtype, (T.AtomicType, T.NullType))


def arranged(df: DataFrame, sort_cols: list[str], n_buckets: int | None = None) -> tuple[DataFrame, int]:
    """A staged copy of ``df`` in range buckets over ``sort_cols`` (ascending,
    nulls first), and the number of buckets.

    Its columns are ``c0, c1, ...`` in the order of ``df.columns``, then the
    bucket and the row's position in it."""
    n = n_buckets or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    keys = [qcol(_spot(df, c)) for c in sort_cols]
    spread = [qcol(f.name) for f in plain.schema.fields if _hashable(f.dataType)]
    order = [*keys, F.xxhash64(*spread)] if spread else keys
    ordered = plain.repartitionByRange(n, *order).sortWithinPartitions(*order) if order else plain
    numbered = staged(ordered.withColumn("__id", F.monotonically_increasing_id()), "arranged")
    return numbered.select(*plain.columns, F.shiftright("__id", _LOCAL_BITS).alias(BUCKET),
                           F.col("__id").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)).alias(AT)), n


def _spot(df: DataFrame, name: str) -> str:
    """Positional name of column ``name`` (compared as Spark compares names)."""
    if name in df.columns:
        return f"c{df.columns.index(name)}"
    low = [c.lower() for c in df.columns]
    if name.lower() not in low:
        raise ValueError(f"no column {name}; columns are {df.columns}")
    return f"c{low.index(name.lower())}"


def scan(table: DataFrame, n: int, values: list[str], how: str, forward: bool = True, width: int = WIDTH,
         keep: tuple[str, ...] = ()) -> DataFrame:
    """``(bucket, keep..., values...)``: for each bucket what the buckets before it
    (behind it, if not ``forward``) amount to: their ``sum``, or the ``last``
    non-null value met on the way to the bucket."""
    way = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())

    def carried(v: str, over) -> Column:
        return F.sum(v).over(over) if how == "sum" else F.last(v, ignorenulls=True).over(over)

    if n <= width:                                   # at most ``width`` rows
        over = Window.partitionBy(F.expr(f"{BUCKET} div {width}")).orderBy(way(BUCKET))
        over = over.rowsBetween(Window.unboundedPreceding, -1)
        return table.select(BUCKET, *keep, *[carried(v, over).alias(v) for v in values])
    grouped = table.withColumn("__group", F.expr(f"{BUCKET} div {width}"))
    last = F.max_by if forward else F.min_by
    upper = grouped.groupBy("__group").agg(*[
        (F.sum(v) if how == "sum" else last(F.col(v), F.when(F.col(v).isNotNull(), F.col(BUCKET)))).alias(v)
        for v in values])
    upper = scan(upper.withColumnRenamed("__group", BUCKET), -(-n // width), values, how, forward, width)
    upper = upper.select(F.col(BUCKET).alias("__group"), *[F.col(v).alias(f"__up_{v}") for v in values])
    over = Window.partitionBy("__group").orderBy(way(BUCKET)).rowsBetween(Window.unboundedPreceding, -1)
    both = grouped.join(upper, "__group", "left")
    if how == "sum":
        out = [(F.coalesce(carried(v, over), F.lit(0)) + F.coalesce(f"__up_{v}", F.lit(0))).alias(v) for v in values]
    else:
        out = [F.coalesce(carried(v, over), f"__up_{v}").alias(v) for v in values]
    return both.select(BUCKET, *keep, *out)


def ordered_fill(df: DataFrame, columns: list[str], order_by: list[str],
                 partition_by: list[str] | None = None, direction: str = "forward",
                 n_buckets: int | None = None, width: int = WIDTH) -> DataFrame:
    """Forward / backward fill of ``columns`` along ``order_by`` within
    ``partition_by`` groups (or over the whole table)."""
    pkeys = list(partition_by or [])
    forward = direction == "forward"
    data, n = arranged(df, pkeys + list(order_by), n_buckets)
    keys = [_spot(df, c) for c in pkeys]
    fills = [_spot(df, c) for c in columns]
    key = F.struct(*[F.col(k).alias(f"p{i}") for i, k in enumerate(keys)]) if keys else F.struct(F.lit(0).alias("p0"))
    nearest, enter = (F.max_by, F.min_by) if forward else (F.min_by, F.max_by)
    summary = data.groupBy(BUCKET).agg(
        enter(key, F.col(AT)).alias("__enter"),
        *[nearest(F.struct(key.alias("p"), F.col(c).alias("v")), F.when(F.col(c).isNotNull(), F.col(AT))).alias(f"s{i}")
          for i, c in enumerate(fills)])
    names = [f"s{i}" for i in range(len(fills))]
    # the value nearest to the bucket counts only where it is of the key the bucket starts with
    carry = scan(summary, n, names, "last", forward, width, ("__enter",))
    carry = carry.select(BUCKET, "__enter", *[F.when(F.col(f"{s}.p") == F.col("__enter"), F.col(f"{s}.v")).alias(s)
                                              for s in names])
    if keys:
        carry = carry.select(BUCKET, *[F.col(f"__enter.p{i}").alias(f"__k{i}") for i in range(len(keys))], *names)
    else:
        carry = carry.select(BUCKET, *names)
    # a backward fill walks its rows from the end: a frame that grows keeps one value, one that shrinks is
    # read anew for every row
    w = Window.partitionBy(BUCKET, *keys).orderBy(F.col(AT).asc() if forward else F.col(AT).desc())
    w = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    done = data.withColumns({c: F.last(F.col(c), ignorenulls=True).over(w) for c in dict.fromkeys(fills)})
    done = join_lookup(done, carry, BUCKET, "left", n)
    entered = F.lit(True)
    for i, k in enumerate(keys):
        entered = entered & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    done = done.withColumns({c: F.coalesce(F.col(c), F.when(entered, F.col(s))) for c, s in zip(fills, names)})
    return done.select(*[f"c{i}" for i in range(len(df.columns))]).toDF(*df.columns)


def global_row_number(df: DataFrame, order_by: list[str], name: str = "row_pos",
                      n_buckets: int | None = None, with_total: bool = False, width: int = WIDTH):
    """1-based position of each row in ``order_by`` order, ``bigint``.
    ``with_total=True`` also returns the row count."""
    data, n = arranged(df, list(order_by), n_buckets)
    counts = data.groupBy(BUCKET).agg(F.count(F.lit(1)).alias("__n"))
    offsets = scan(counts, n, ["__n"], "sum", width=width)
    out = join_lookup(data, offsets, BUCKET, "left", n)
    out = out.select(*[f"c{i}" for i in range(len(df.columns))],
                     (F.coalesce("__n", F.lit(0)) + F.col(AT) + 1).alias("__pos")).toDF(*df.columns, name)
    return (out, data.count()) if with_total else out


def numbered_within(df: DataFrame, keys: list[str], order_by: list[str], name: str = "row_pos",
                    n_buckets: int | None = None, width: int = WIDTH) -> DataFrame:
    """1-based position of each row among the rows of its ``keys`` (nulls are
    a key), in ``order_by`` order; a hot key is numbered by many tasks."""
    data, n = arranged(df, list(keys) + list(order_by), n_buckets)
    spots = [_spot(df, c) for c in keys]
    parts = staged(data.groupBy(BUCKET, *spots).agg(F.count(F.lit(1)).alias("__n"), F.min(AT).alias("__first")), "parts")
    offsets = scan(parts.groupBy(BUCKET).agg(F.sum("__n").alias("__n")), n, ["__n"], "sum", width=width)
    parts = parts.select(BUCKET, *spots, "__first").join(offsets, BUCKET, "left") \
        .withColumn("__from", F.coalesce("__n", F.lit(0)))
    named = [F.col(s).alias(f"__k{i}") for i, s in enumerate(spots)]
    # where a key starts; one row per key and bucket, so a key is as wide as its buckets
    starts = parts.groupBy(*named).agg(F.min(F.col("__from") + F.col("__first")).alias("__start"))
    same = F.lit(True)
    for i, s in enumerate(spots):
        same = same & F.col(s).eqNullSafe(F.col(f"__k{i}"))
    table = parts.join(starts, same).select(F.col(BUCKET).alias("__b"), *[f"__k{i}" for i in range(len(spots))],
                                            (F.col("__from") - F.col("__start")).alias("__shift"))
    out = data.join(table, (F.col(BUCKET) == F.col("__b")) & same)
    return out.select(*[f"c{i}" for i in range(len(df.columns))],
                      (F.col("__shift") + F.col(AT) + 1).alias("__pos")).toDF(*df.columns, name)
