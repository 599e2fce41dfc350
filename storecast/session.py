"""Spark session and shared-folder helpers.

The library never creates its own session inside an operator: every function
takes a ``SparkSession`` or a ``DataFrame``.  ``get_session`` is only for
scripts, tests and ``bench.py``.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "storecast", cpus: int | str | None = None,
                shuffle_partitions: int | None = None) -> SparkSession:
    """Local session tuned for the library (AQE on, UI off, UTC)."""
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    # on a cluster: about input bytes / 128 MB; AQE coalesces small partitions
    parts = shuffle_partitions or int(os.environ.get("STORECAST_SHUFFLE_PARTITIONS", int(cpus) * 2))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "128m")
        .config("spark.sql.files.maxPartitionBytes", "128m")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STORECAST_DRIVER_MEMORY", "16g"))
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system folder and is read as
    is.  Only when it is unset on a local master (tests, scripts) a fresh scratch
    folder is created and registered; elsewhere that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(conf_dir)
        return conf_dir
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} it must name a folder that all machines share")
    local = tempfile.mkdtemp(prefix="storecast-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder (never machine-local
    on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/storecast/{name}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder; survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


METHOD_BYTES = 4000       # half of what the JVM compiles at all: it takes long over larger ones, and compiles them badly


def limit_methods(spark: SparkSession) -> None:
    """A stage whose generated method is larger than the JVM compiles (well) would be interpreted, row by
    row; under this limit Spark runs its operators one by one, compiled.  A lower limit stays."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if int(spark.conf.get(name)) > METHOD_BYTES:
        spark.conf.set(name, str(METHOD_BYTES))


def write_to(df: DataFrame, path: str, mode: str = "overwrite", **options: str) -> None:
    limit_methods(df.sparkSession)
    df.write.mode(mode).options(**options).parquet(path)


def write_table(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back: lineage is cut, later
    reads prune columns, and the planner knows the size."""
    path = scratch_path(df.sparkSession, name)
    write_to(df, path, "errorifexists", **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_MEMO: dict[tuple, DataFrame] = {}


def memo_checkpoint(spark: SparkSession, key: tuple, build) -> DataFrame:
    """Build a (small, reused) DataFrame once per session and cut its lineage
    with a reliable checkpoint, so later plans read it instead of
    recomputing the pipeline behind it."""
    k = (spark.sparkContext.applicationId,) + tuple(key)
    if k not in _MEMO:
        _MEMO[k] = cut_lineage(build())
    return _MEMO[k]


def clear_memo() -> None:
    _MEMO.clear()
