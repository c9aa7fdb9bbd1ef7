"""Intermediate Parquet tables in the shared checkpoint folder."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from .session import checkpoint_dir

#: How long the metrics of a finished write may take to arrive.
EVENT_SECONDS = 20


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that its path names."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def replace_path(spark: SparkSession, made: str, path: str) -> None:
    """Put the complete folder ``made`` where ``path`` is. The old folder is
    moved aside first and deleted last; if the switch fails it is moved back."""
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    new, target, old = Path(made), Path(path), Path(f"{made}.old")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    had = fs.exists(target)
    if had and not fs.rename(target, old):
        raise OSError(f"cannot move {path} aside")
    if not fs.rename(new, target):
        if had:
            fs.rename(old, target)
        raise OSError(f"cannot move {made} to {path}")
    if had:
        fs.delete(old, True)


class Scratch:
    """The intermediate tables of one run. A written table cuts lineage (lost
    executors reread files) and is a plain scan to the optimizer, so joins on it
    can be split by AQE. ``drop`` removes tables that no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex[:12]}"
        self.names: set[str] = set()
        self.tables: dict[str, str] = {}

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        self.names.add(name)
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def counted(self, df: DataFrame, name: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """A table and aggregates of its rows, observed by the job that writes
        it: no second job, exact, 0 if there is no row. The observation comes
        with a listener event; should that event be lost, the table is asked."""
        wanted = [F.coalesce(m, F.lit(0)).alias(k) for k, m in metrics.items()]
        seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
        table = self.table(df.observe(seen, *wanted), name)
        until = time.monotonic() + EVENT_SECONDS
        while not seen._jo.future().isCompleted():
            if time.monotonic() > until:
                return table, table.agg(*wanted).first().asDict()
            time.sleep(0.002)
        found = seen.get
        return table, {k: found.get(k) or 0 for k in metrics}

    def bucketed(self, df: DataFrame, name: str, buckets: int, *keys: str) -> DataFrame:
        """A table whose rows are hashed by ``keys`` into sorted buckets: joins
        on the keys read it bucket by bucket, without an exchange, as often as
        they like, and a lost executor rereads files."""
        table = f"{os.path.basename(self.base)}_{name}".replace("-", "_")
        (df.write.mode("overwrite").format("parquet").bucketBy(buckets, *keys).sortBy(*keys)
           .option("path", self.path(name)).saveAsTable(table))
        self.names.add(name)
        self.tables[name] = table
        return self.spark.table(table)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.tables:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.tables.pop(name)}")
            delete_path(self.spark, self.path(name))
            self.names.discard(name)

    def clear(self) -> None:
        for table in self.tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self.tables.clear()
        delete_path(self.spark, self.base)
        self.names.clear()
