"""Where intermediate tables and stream checkpoints go, and how they are taken away again."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []
#: Where paths are noted instead while a ``scratch`` block runs, in its own thread only.
_noted: ContextVar[list[str] | None] = ContextVar("noted", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; every executor must see it.

    Without the setting, as in tests, it is a folder in Spark's warehouse; on a cluster either of
    them has to name a place that all executors share.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/metricwin-shared"


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that nobody used before; ``clean`` removes it."""
    path = f"{shared_dir(spark)}/metricwin-{label}-{uuid.uuid4().hex}"
    noted = _noted.get()
    (_made if noted is None else noted).append(path)
    return path


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def make_dir(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.mkdirs(place)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file."""
    place, files = _file_system(spark, path)
    files.create(place, True).close()


def remove(spark: SparkSession, path: str) -> None:
    place, files = _file_system(spark, path)
    files.delete(place, True)


def replace_dir(spark: SparkSession, source: str, target: str) -> None:
    """Put the folder ``source`` in the place of ``target``, on the same file system."""
    place, files = _file_system(spark, target)
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(_file_system(spark, source)[0], place):
        raise OSError(f"cannot move {source} to {target}")


def clean(spark: SparkSession) -> None:
    """Remove every intermediate folder of this process. Results that read them end with it."""
    while _made:
        remove(spark, _made.pop())


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate folders made inside the block go at its end: a batch of a stream leaves none."""
    noted: list[str] = []
    token = _noted.set(noted)
    try:
        yield
    finally:
        _noted.reset(token)
        for path in noted:
            remove(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    place, files = _file_system(spark, path)
    return files.exists(place)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder once and read from there ever after."""
    path = fresh_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def kept(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """``df`` written to the shared folder once, for several readings inside the block."""
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        remove(spark, path)
        (_noted.get() or _made).remove(path)
