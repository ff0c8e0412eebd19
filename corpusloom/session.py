"""Session defaults and the two session-level helpers the operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import AbstractContextManager, contextmanager
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest side, in rows, that an operator may mark for broadcast after counting it.
BROADCAST_ROWS = 1_000_000


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are tuned for.

    Lookup joins carry no hint: Catalyst broadcasts a side only while its size
    estimate is below ``autoBroadcastJoinThreshold`` and sort-merges above it.
    ``conf`` adds or overrides settings by their full name.
    """
    b = (
        SparkSession.builder.appName("corpusloom")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(64 << 20))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # Short Python tasks otherwise wait for the loopback device's delayed acknowledgements.
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    if master:
        b = b.master(master)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        b = b.config(name, value)
    return b.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder; a temporary one only for a local master."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="corpusloom-checkpoint-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


_scopes: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """Delete every table that ``cut_lineage`` writes inside the block when it ends.

    For runs that write their results elsewhere: nothing that leaves the block
    may still read from one of its tables.
    """
    paths: list[str] = []
    _scopes.append(paths)
    try:
        yield
    finally:
        _scopes.remove(paths)
        for path in paths:
            delete_table(spark, path)


def delete_table(spark: SparkSession, path: str) -> None:
    """Delete a folder below the checkpoint folder."""
    old = spark._jvm.org.apache.hadoop.fs.Path(path)
    old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def _new_table_path(spark: SparkSession) -> str:
    """A fresh folder for a table below the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """Set a setting of the session for the queries that are run inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_removed(spark: SparkSession) -> AbstractContextManager[None]:
    """Delete shuffle files of a query that is run inside the block when it ends, not when its plan is garbage.

    A DataFrame that is built inside must not be returned: it would lose its shuffles at its first action.
    """
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def cut_lineage(df: DataFrame, path: str | None = None) -> DataFrame:
    """Write ``df`` below the checkpoint folder and read it back.

    A lost executor then costs one file read. Unlike ``checkpoint()`` the result
    has the size of its files as its statistics, not the product of all sizes in
    its history, so a loop can run for any number of rounds and Catalyst keeps
    choosing its joins by true sizes.
    """
    spark = df.sparkSession
    path = path or _new_table_path(spark)
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class LoopState:
    """The state of an iterative job: each round's table replaces the one before."""

    def __init__(self, spark: SparkSession) -> None:
        self._spark = spark
        self._path: str | None = None

    def save(self, df: DataFrame) -> DataFrame:
        path = _new_table_path(self._spark)
        saved = cut_lineage(df, path)
        if self._path:
            delete_table(self._spark, self._path)
        self._path = path
        return saved


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys of one name where null equals null, keeping the left side's key columns."""
    renamed = {k: f"_right_{k}" for k in keys}
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(r)) for k, r in renamed.items()))
    return left.join(right.withColumnsRenamed(renamed), same, how).drop(*renamed.values())


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark ``df`` for broadcast only if counting shows at most ``max_rows`` rows.

    Meant for materialised or already aggregated tables; beyond the bound the
    join stays a shuffle join.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
