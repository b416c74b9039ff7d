"""Spark session helpers.

The library never creates its own cluster settings beyond what a job needs:
AQE on, UTC session time zone, UI off. The checkpoint folder is read from the
session (``spark.checkpoint.dir``); a folder is only chosen here when none is
configured and the master is local (tests, benchmarks).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, app: str = "grainline",
              shuffle_partitions: int | None = None,
              driver_memory: str = "16g") -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "*")
    master = master or f"local[{cpus}]"
    builder = (
        SparkSession.builder.master(master).appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the shared checkpoint folder; set a scratch one only in local mode."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="grainline-ckpt-"))
        return sc.getCheckpointDir()
    return None


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``grainline`` importable in Python workers (pandas UDFs,
    ``applyInPandas``): zip the package once per application and add it with
    ``addPyFile``, the same as ``--py-files`` on ``spark-submit``.

    Only in local mode; on a cluster the package is shipped with
    ``spark-submit --py-files`` (no machine-local staging folder is used)."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED or not sc.master.startswith("local"):
        return
    import os
    import zipfile
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    base = ensure_checkpoint_dir(spark)
    if base and base.startswith("file:"):
        out_dir = os.path.join(base[len("file:"):], "grainline-pyfiles")
    else:
        out_dir = tempfile.mkdtemp(prefix="grainline-pyfiles-")
    os.makedirs(out_dir, exist_ok=True)
    target = os.path.join(out_dir, f"grainline-{app}.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(root, name)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(target)
    _SHIPPED.add(app)
