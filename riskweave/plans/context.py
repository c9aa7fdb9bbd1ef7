"""Per-session intermediate tables.

The reference pipeline hands data between stages as Parquet (processed fact,
reports, graph tables). We do the same inside one session: an intermediate that
several queries read (the processed fact, the graph tables, PageRank) is
computed once, written as Parquet under the session's shared checkpoint folder
and read back. That cuts lineage (a lost executor re-reads files instead of
recomputing the joins), and keeps predicate pushdown and column pruning for
every downstream query, unlike ``persist`` or RDD checkpoints.

The memo is keyed by application and input folder: files that are added to a
folder later are not seen until ``forget`` drops its tables.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..scratch import Scratch

_LOCK = threading.RLock()
_TABLES: dict[tuple, tuple[DataFrame, Scratch]] = {}


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name)


def shared_table(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
                 write: Callable[[DataFrame, Scratch], DataFrame] | None = None) -> DataFrame:
    """Memoised intermediate ``name`` for (session, input folder), written once;
    ``write`` replaces the Parquet round trip by another one."""
    key = _key(spark, sf_dir, name)
    with _LOCK:
        if key not in _TABLES:
            scratch = Scratch(spark, name)
            df = build()
            _TABLES[key] = (write(df, scratch) if write else scratch.table(df, name)), scratch
        return _TABLES[key][0]


def shared_path(spark: SparkSession, sf_dir: str, name: str) -> str:
    """The folder of an intermediate that has been written."""
    return _TABLES[_key(spark, sf_dir, name)][1].path(name)


def known(spark: SparkSession, sf_dir: str, name: str) -> DataFrame | None:
    """The intermediate if it has been written already."""
    return _TABLES.get(_key(spark, sf_dir, name), (None, None))[0]


def forget(spark: SparkSession, sf_dir: str | None = None, keep: tuple[str, ...] = ()) -> None:
    """Delete this session's intermediates (of one input folder, or of all)."""
    with _LOCK:
        for key in list(_TABLES):
            app, folder, name = key
            if (app == spark.sparkContext.applicationId and name not in keep
                    and sf_dir in (None, folder)):
                _TABLES.pop(key)[1].clear()
