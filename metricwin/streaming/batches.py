"""Results that a stream writes batch by batch, to several places, each batch once.

A batch has a folder ``batch=N`` in every place and overwrites it, so a batch that is run again
after a failure adds no row. What a batch hands on to the next lies in such a folder as well.
Places and checkpoint belong together in the folder of one run.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from metricwin.storage import exists, make_dir, make_file, replace_dir


def start_batches(
    stream: DataFrame, batch: Callable[[DataFrame, int], None], folder: str, interval: str | None
) -> StreamingQuery:
    """Hand each batch to ``batch`` until present input is done, or every ``interval``."""
    make_dir(stream.sparkSession, folder)
    writer = stream.writeStream.foreachBatch(batch).option("checkpointLocation", f"{folder}/checkpoint")
    if interval:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def write_batch(df: DataFrame, place: str, batch: int, form: str = "parquet", **options) -> None:
    """The rows of one batch, in the place of what an earlier try of it may have left."""
    df.write.mode("overwrite").format(form).options(**options).save(f"{place}/batch={batch}")


def move_batch(spark: SparkSession, source: str, place: str, batch: int) -> None:
    """Put a folder of written rows in the place of what an earlier try of the batch may have left.

    There need be no such folder: a batch without rows is an empty one. It lies on the same file system.
    """
    make_dir(spark, source)
    make_file(spark, f"{source}/_SUCCESS")
    replace_dir(spark, source, f"{place}/batch={batch}")


def move_batch_once(spark: SparkSession, source: str, place: str, batch: int) -> None:
    """As ``move_batch``, for places that a stream follows: it must neither see a batch in part nor
    find its rows again in other files. A batch appears whole, and one that is there stays.

    A batch that is run again has the same rows, so nothing is lost by leaving the first ones. Where
    files are renamed one by one, as in object stores, a batch broken off meanwhile is put anew.
    """
    if not exists(spark, f"{place}/batch={batch}/_SUCCESS"):
        move_batch(spark, source, place, batch)


def _typed(schema: str | T.StructType) -> T.StructType:
    return T._parse_datatype_string(schema) if isinstance(schema, str) else schema


def batch_of(spark: SparkSession, place: str, schema: str | T.StructType, batch: int) -> DataFrame:
    return spark.read.schema(_typed(schema)).parquet(f"{place}/batch={batch}")


def previous(spark: SparkSession, place: str, schema: str | T.StructType, batch: int) -> DataFrame:
    """What the batch before handed on; no rows before the first."""
    if not batch:
        return spark.createDataFrame([], _typed(schema))
    if not exists(spark, f"{place}/batch={batch - 1}/_SUCCESS"):
        raise FileNotFoundError(f"{place}: batch {batch - 1} is not there; was its run begun elsewhere?")
    return batch_of(spark, place, schema, batch - 1)


def read_batches(
    spark: SparkSession, place: str, schema: str | T.StructType, form: str = "parquet", **options
) -> DataFrame:
    """All batches of a place, with their number in ``batch``; none if there is none yet."""
    make_dir(spark, place)
    whole = T.StructType([*_typed(schema).fields, T.StructField("batch", T.LongType())])
    return spark.read.schema(whole).format(form).options(**options).load(place)


def last_batch(spark: SparkSession, place: str) -> int:
    """The number of the last batch of a place, -1 if there is none: one row of folder names."""
    row = read_batches(spark, place, T.StructType()).agg(F.max("batch")).first()
    return -1 if row[0] is None else int(row[0])
