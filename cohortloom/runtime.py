"""Session-side helpers shared by the operators: shared scratch space, written
intermediate tables, and joins whose broadcast side has a known size."""

from __future__ import annotations

import contextlib
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's checkpoint folder.

    Only a local session that names none gets a folder of its own. On a cluster such a folder would be one of many, each
    with a part of the data, so there it is an error.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="cohortloom-"))
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the shared folder; removed at the end of an enclosing :func:`scratch_scope`."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove the scratch tables made inside when the block ends, so nothing lazy may leave it."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            remove_path(spark, path)


def cleans_up(step: Callable) -> Callable:
    """For steps that write their result: their scratch tables go when they end. The session is an argument."""

    @functools.wraps(step)
    def run(*args, **kwargs):
        spark = next(a for a in [*args, *kwargs.values()] if isinstance(a, (SparkSession, DataFrame)))
        with scratch_scope(spark if isinstance(spark, SparkSession) else spark.sparkSession):
            return step(*args, **kwargs)

    return run


_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_go(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a table written inside go when it is written.

    They would stay until the driver happens to collect its garbage. A write plans its frame anew, so no other use of the
    frame reads them.
    """
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLE_CLEANUP)
        else:
            spark.conf.set(_SHUFFLE_CLEANUP, before)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Spark ML's iterative fits checkpoint every few rounds; give them a folder."""
    base = shared_dir(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(base)


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and leaves a table whose
    size Catalyst knows, so that a later join broadcasts it only when it is
    really below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_go(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, keys: Sequence[str], buckets: int, label: str = "bucketed") -> DataFrame:
    """Write ``df`` to the shared folder in hash buckets of ``keys`` and read it back.

    Groupings, joins and cogroups by these keys then read it without a shuffle of its rows; only the other side moves.
    The catalog entry goes at once, the files stay as those of :func:`materialize` do.
    """
    spark = df.sparkSession
    path, name = scratch_path(spark, label), f"{label}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys).write.format("parquet").option("path", path).option("compression", "zstd")
    with shuffles_go(spark):
        dealt.bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"drop table {name}")
    return table


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path))


def folder_entries(spark: SparkSession, path: str) -> set[str]:
    """Names of the files and folders in a folder; none if it is absent."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(jvm_path):
        return set()
    return {entry.getPath().getName() for entry in files.listStatus(jvm_path)}


def remove_path(spark: SparkSession, path: str) -> None:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def present(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """The given columns that the frame has, in the given order."""
    have = set(df.columns)
    return [c for c in columns if c in have]


def all_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a & b, conditions)


def any_of(conditions: Sequence[Column]) -> Column:
    return functools.reduce(lambda a, b: a | b, conditions)


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join of per-group statistics, null groups matching null groups.

    ``stats`` should be a written table (:func:`materialize`): Catalyst then
    broadcasts it if its files are small, and otherwise plans a shuffle join
    whose hot groups adaptive execution splits on the ``df`` side.
    """
    renamed = stats
    for i, key in enumerate(keys):
        renamed = renamed.withColumnRenamed(key, f"__k{i}")
    on = all_of([df[key].eqNullSafe(renamed[f"__k{i}"]) for i, key in enumerate(keys)])
    return df.join(renamed, on, "left").drop(*[f"__k{i}" for i in range(len(keys))])
