"""Tables that cut a plan's lineage, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_inner: ContextVar[str | None] = ContextVar("_inner", default=None)
#: Spark's own setting: the shuffle files of a query go when it ends, not when the driver happens to collect its garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's spark.checkpoint.dir; where that is unset on a local master, as in tests, a folder of this session."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


def _own(spark: SparkSession) -> str:
    """This application's folder in the shared one."""
    return f"{shared_folder(spark)}/panelwise/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, codec: str = "snappy", by: str | None = None, folder: str | None = None) -> DataFrame:
    """df written to the shared folder and read again, so that a lost executor costs no earlier work. Tables of texts are worth zstd.

    What is read may be part of a caller's lazy result, so tables stay until the
    caller calls clear(), or until the end of the passing() that they are stored
    in. by is a column whose values lie in folders of their own. The shuffle
    files of the write go with it.
    """
    spark = df.sparkSession
    path, before = f"{folder or _inner.get() or _own(spark)}/{uuid.uuid4().hex}", spark.conf.get(SHUFFLES_GO, None)
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        df.write.option("compression", codec).partitionBy(*([by] if by else [])).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_GO)
        else:
            spark.conf.set(SHUFFLES_GO, before)
    return spark.read.schema(df.schema).parquet(path)


def lasting(df: DataFrame) -> DataFrame:
    """stored() for a table of few rows that stays until clear(), wherever it is stored."""
    return stored(df, folder=_own(df.sparkSession))


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[..., DataFrame]]:
    """Tables that are stored inside are deleted at the end, but for those stored by the function given, which takes what stored() takes."""
    outer = _inner.get() or _own(spark)
    folder = f"{_own(spark)}/{uuid.uuid4().hex}"
    token = _inner.set(folder)
    try:
        yield lambda df, *args: stored(df, *args, folder=outer)
    finally:
        _inner.reset(token)
        _delete(spark, folder)


def finished(spark: SparkSession, make: Callable[[], DataFrame], codec: str = "zstd") -> DataFrame:
    """make()'s result as a stored table; the tables that make() itself stored on the way are deleted."""
    with passing(spark) as keep:
        return keep(make(), codec)


def clear(spark: SparkSession) -> None:
    """Deletes this application's tables of stored(); no DataFrame that was built on them can be read afterwards."""
    _delete(spark, _own(spark))
