"""The folder that the driver and all executors share, and tables written to it.

The cluster names the folder in ``spark.checkpoint.dir``.  Only a local master,
where driver and executors are one process, may do without that setting.

Tables between stages belong to the run that made them: :func:`clean` deletes
them, and what is left goes when the JVM ends.
"""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

LOCAL_FALLBACK = "/tmp/checkpoints/tidemark"
#: Bytes of input, as the optimizer estimates it, that a task of an operator with Python workers gets.
TASK_BYTES = 64 << 20
_SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: What this process made and has not deleted: (path, table name or None).
_MADE: list[tuple[str, str | None]] = []


def _local_folder() -> str:
    """A folder of this process, gone when it ends."""
    folder = f"{LOCAL_FALLBACK}-{os.getpid()}"
    if not os.path.isdir(folder):
        os.makedirs(folder)
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return f"file://{folder}"


def is_local(spark: SparkSession) -> bool:
    """Whether tasks run in the driver's own process."""
    return spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"


def shared_dir(spark: SparkSession) -> str:
    """Return the shared folder, and make it Spark's checkpoint folder as well."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = _local_folder()
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path, and its Path class."""
    kind = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return kind(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), kind


def new_path(spark: SparkSession, name: str, table: str | None = None) -> str:
    """A path in the shared folder that nothing else uses; it is deleted by :func:`clean`, or when the JVM ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, kind = file_system(spark, path)
    fs.deleteOnExit(kind(path))
    _MADE.append((path, path.rsplit("/", 1)[1].replace("-", "_") if table is not None else None))
    return path


def made() -> int:
    """How many paths this process made so far: a mark for :func:`clean`."""
    return len(_MADE)


def clean(spark: SparkSession, since: int = 0, but: tuple[DataFrame, ...] = ()) -> None:
    """Delete the tables and files made after the mark ``since``, except those that ``but`` read."""
    spared = {_folder(f) for df in but for f in df.inputFiles()}
    for entry in _MADE[since:]:
        path, table = entry
        if any(s.rstrip("/").endswith(path.rsplit("/", 1)[1]) for s in spared):
            continue
        if table is not None:
            spark.sql(f"drop table if exists `{table}`")
        fs, kind = file_system(spark, path)
        fs.delete(kind(path), True)
        _MADE.remove(entry)


def _folder(file: str) -> str:
    return file.rsplit("/", 1)[0]


@contextlib.contextmanager
def _short_lived_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write go as soon as it has ended: what it took is in the written table."""
    before = spark.conf.get(_SHUFFLE_CLEANUP, None)
    spark.conf.set(_SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(_SHUFFLE_CLEANUP) if before is None else spark.conf.set(_SHUFFLE_CLEANUP, before)


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: what it took is not done again."""
    path = new_path(df.sparkSession, name)
    with _short_lived_shuffles(df.sparkSession):
        df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_by(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The same as a table bucketed by ``key``: a later join or cogroup on it does not shuffle this side."""
    spark = df.sparkSession
    path = new_path(spark, name, table=name)
    table = _MADE[-1][1]
    with _short_lived_shuffles(spark):
        df.write.bucketBy(buckets, key).option("compression", "zstd").option("path", path).saveAsTable(table)
    return spark.table(table)


def remove(df: DataFrame) -> None:
    """Delete what :func:`materialize` or :func:`materialize_by` wrote for ``df`` once nothing reads it any more."""
    spark = df.sparkSession
    for name in {_folder(f).rsplit("/", 1)[1] for f in df.inputFiles()}:
        for entry in [e for e in _MADE if e[0].endswith(name)]:
            if entry[1] is not None:
                spark.sql(f"drop table if exists `{entry[1]}`")
            fs, kind = file_system(spark, entry[0])
            fs.delete(kind(entry[0]), True)
            _MADE.remove(entry)


def tasks_for(df: DataFrame, task_bytes: int = TASK_BYTES) -> int:
    """A number of partitions that grows with the input: the session's, or more if a task would get over ``task_bytes`` of what the plan scans."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size())]
    known = sum(s for s in sizes if s < 1 << 60)  # Spark's word for a size that it doesn't know is a greater one
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-known // task_bytes))


def bound_batches(spark: SparkSession, rows: int = 2000, megabytes: int = 8) -> None:
    """Keep Arrow batches to Python small enough that rows of long text fit a worker's memory.

    Spark has no such limit per operator, so this lowers the session's two limits, and never raises one.
    """
    for name, most in (("maxRecordsPerBatch", rows), ("maxBytesPerBatch", megabytes << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        held = int("".join(c for c in spark.conf.get(key) if c.isdigit() or c == "-"))
        if held <= 0 or held > most:
            spark.conf.set(key, str(most))
