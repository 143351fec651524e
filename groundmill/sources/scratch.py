"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, as an address.

    Where the setting is missing on a local master (tests, one machine) a temporary folder is made and remembered;
    on a cluster executors would each write to a disk of their own, so that is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = getattr(shared_dir, "own", None) or tempfile.mkdtemp(prefix="spark-groundmill-")
        shared_dir.own = base
    return base if "://" in base or base.startswith("file:") else f"file://{base}"


def home(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{shared_dir(spark)}/groundmill/{spark.sparkContext.applicationId}"


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{home(spark)}/{name}-{uuid.uuid4().hex}"


_copies = threading.local()


def mark() -> int:
    """A point in the row of copies that this thread makes, for ``release``."""
    _copies.paths = getattr(_copies, "paths", [])
    return len(_copies.paths)


def release(spark: SparkSession, since: int, *keep: DataFrame) -> None:
    """Remove the copies made since a mark but those of ``keep``; results may read no others."""
    stay = {df.written for df in keep}
    for path in _copies.paths[since:]:
        if path not in stay:
            remove(spark, path)
    _copies.paths[since:] = [p for p in _copies.paths[since:] if p in stay]


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return a reader of that copy.

    The copy ends the lineage: losing executors later never recomputes what stands above it, and what reads it more
    than once does not compute it again. It stays until ``discard``, ``release`` or ``clean`` is called.
    """
    path = fresh_path(df.sparkSession, name)
    mark()
    _copies.paths.append(path)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def exists(spark: SparkSession, path: str) -> bool:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def remove(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def discard(*frames: DataFrame) -> None:
    """Remove the copies that ``cut`` made of ``frames``, which nothing may read any more."""
    for df in frames:
        remove(df.sparkSession, df.written)


def clean(spark: SparkSession) -> None:
    """Remove all copies of this application; results that were not written elsewhere can no longer be read."""
    remove(spark, home(spark))
