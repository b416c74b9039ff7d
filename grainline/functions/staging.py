"""Tables staged in shared storage.

``staged`` writes a DataFrame as Parquet under ``spark.checkpoint.dir`` and
reads it back: lineage ends in storage every executor sees, later passes read
only the columns they use, and the planner knows the table's true size.
Columns are stored under positional names, so duplicate or odd names survive.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .exprs import qcol


def shared_path(df: DataFrame, label: str) -> str:
    """A fresh path for ``label`` in the session's shared folder."""
    from ..session import ensure_checkpoint_dir
    base = ensure_checkpoint_dir(df.sparkSession)
    if base is None:
        raise RuntimeError("spark.checkpoint.dir is not set; a shared folder is needed")
    return f"{base.rstrip('/')}/staged/{label}-{uuid.uuid4().hex[:12]}"


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df``, written once; columns without a type are kept as null literals."""
    path = shared_path(df, label)
    plain = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
    typed = [f for f in plain.schema.fields if not isinstance(f.dataType, T.NullType)]
    plain.select(*[f.name for f in typed]).write.parquet(path)
    back = df.sparkSession.read.schema(T.StructType([T.StructField(f.name, f.dataType) for f in typed])).parquet(path)
    have = {f.name for f in typed}
    return back.select(*[qcol(f.name) if f.name in have else F.lit(None).alias(f.name)
                         for f in plain.schema.fields]).toDF(*df.columns)
