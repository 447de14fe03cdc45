"""Intermediate tables in the cluster's shared folder.

Operators that pass over a table more than once write it first. Reading it back
is column-pruned, and a lost executor costs a re-read, not a re-run of the large
aggregate that produced it.

All tables of an application lie in one folder, which is removed when the driver
ends. Inside :func:`scope` they lie in a folder of their own, which is removed
when the block is left, by an error too.
"""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

from patronlens.sources.buckets import default_buckets, read_bucketed, write_bucketed

# Folders of the open scopes, and of applications whose shared folder has been tried.
_OPEN: list[str] = []
_TRIED: set[str] = set()
_TRIAL_PARTS = 16


def shared_folder(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Only a single-machine session without the setting falls back to a local
    temporary folder; on a cluster no machine-local folder is ever used.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not on_one_machine(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="patronlens-"))
    return context.getCheckpointDir().rstrip("/")


def on_one_machine(spark: SparkSession) -> bool:
    """Whether driver and executors are one process, which ``local-cluster`` is not."""
    return re.match(r"local(\[|$)", spark.sparkContext.master) is not None


def remove(path: str) -> None:
    """Delete a folder through the file system it lies in."""
    jvm = SparkContext._jvm
    if jvm is not None:
        context = SparkContext._active_spark_context
        settings = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(settings).delete(target, True)


def _remove_at_exit(path: str) -> None:
    with suppress(Exception):  # the JVM may have ended before
        remove(path)


def application_folder(spark: SparkSession) -> str:
    """The folder of this application's tables, tried out and set to be removed at the end."""
    folder = f"{shared_folder(spark)}/patronlens/{spark.sparkContext.applicationId}"
    if folder not in _TRIED:
        _TRIED.add(folder)
        atexit.register(_remove_at_exit, folder)
        if not on_one_machine(spark):
            _try_out(spark, f"{folder}/trial")
    return folder


def _try_out(spark: SparkSession, path: str) -> None:
    """Raise if the driver does not see what executors write, as with a folder of each machine's own."""
    spark.range(0, _TRIAL_PARTS, 1, _TRIAL_PARTS).write.parquet(path)
    target = SparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(target)
    if sum(f.getPath().getName().startswith("part-") for f in files) < _TRIAL_PARTS:
        raise RuntimeError(f"{path} is not shared: the driver does not see files that executors wrote there")


@contextmanager
def scope(spark: SparkSession) -> Iterator[str]:
    """Tables stored inside the block are removed with it; what is to last must be written elsewhere."""
    folder = f"{application_folder(spark)}/run-{uuid.uuid4().hex}"
    _OPEN.append(folder)
    try:
        yield folder
    finally:
        _OPEN.remove(folder)
        remove(folder)


def new_path(spark: SparkSession, name: str) -> str:
    """An unused path for one intermediate table."""
    folder = _OPEN[-1] if _OPEN else application_folder(spark)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, key: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    With ``key``, which should differ from row to row, the table lies in buckets of it: joins and aggregates on the key
    then move nothing.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if key is not None:
        buckets = default_buckets(spark)
        write_bucketed(df, path, key, buckets)
        return read_bucketed(spark, path, key, buckets, df.schema)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`stage` returned, once nothing that is still to run reads them."""
    for table in tables:
        for folder in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            remove(folder)
