"""Session helpers: configuration for tests/bench and the shared checkpoint dir.

Operators never create sessions; these helpers are for entry points only.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "riskweave", extra: dict | None = None) -> SparkSession:
    """Local/test session with AQE on and the UI off."""
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.appName(app_name)
        .master(master or f"local[{cpus}]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.session.timeZone", "UTC")
        # Wide projections (the 47-column processed fact) generate one method
        # larger than the JIT's 8000-byte limit and would run interpreted; let
        # Spark fall back for such stages only.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", os.environ.get("RISKWEAVE_DRIVER_MEMORY", "8g"))
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the session.

    ``spark.checkpoint.dir`` is read from the session; without one it is a
    folder under ``spark.sql.warehouse.dir``. On a cluster that folder must not
    be on a local file system: executors would not see each other's files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        base = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
        local = base.startswith(("file:", "/"))
        if local and not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share; "
                               f"{base} is on a local file system")
    sc.setCheckpointDir(base)
    return sc.getCheckpointDir()
