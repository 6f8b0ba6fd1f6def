"""Directories: whether one is there, and new ones for written intermediate tables."""

import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_kept: list[tempfile.TemporaryDirectory] = []


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A new directory in the shared folder the session names in ``spark.checkpoint.dir``.

    Where none is named, as in tests on one machine, a temporary one that goes with the
    process. On a cluster each executor would write to a folder of its own there, so that
    fails.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    require_local(spark.sparkContext.master)
    _kept.append(tempfile.TemporaryDirectory(prefix=f"{name}-"))
    return _kept[-1].name


def require_local(master: str) -> None:
    """Fail unless all tasks run on this machine, in this process."""
    if not (master == "local" or master.startswith("local[")):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors of {master} share")


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` in full, as the file system names it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(target).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is there, on whatever file system it names."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def create_file(spark: SparkSession, path: str, text: str) -> bool:
    """Write a new small file; False, and nothing done, where there is one already."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        stream = files.create(target, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def replace_directories(spark: SparkSession, source: str, target: str, names: Sequence[str]) -> None:
    """Move directories ``names`` from ``source`` to ``target``, in place of those there; ``source`` goes.

    What was there is moved aside first and deleted when all are in place, so a run that is cut
    off between two renames has lost nothing; running the job again puts all in place.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    files = hadoop.Path(target).getFileSystem(spark._jsc.hadoopConfiguration())
    aside = f"{source}-before"
    files.mkdirs(hadoop.Path(target))
    files.mkdirs(hadoop.Path(aside))
    for name in names:
        there = hadoop.Path(f"{target}/{name}")
        if files.exists(there) and not files.rename(there, hadoop.Path(f"{aside}/{name}")):
            raise OSError(f"cannot move {there}")
        if not files.rename(hadoop.Path(f"{source}/{name}"), there):
            raise OSError(f"cannot move {source}/{name}")
    for path in (source, aside):
        files.delete(hadoop.Path(path), True)
