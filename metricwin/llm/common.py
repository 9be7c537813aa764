"""Helpers the operators of this folder share."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metricwin.storage import fresh_dir

#: Rows of some numbers to broadcast at most: about 12 MB, of which files may be a tenth.
BROADCAST_ROWS = 1 << 19


def table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet once and return the written table.

    Later steps read the files, so a lost executor costs a re-read and not a re-run.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def merged(df: DataFrame) -> DataFrame:
    """``df`` for a join with a table that grows as well: sorted and merged, neither side broadcast.

    Spark sizes a written table by its compressed files, and what is exploded or made by Python by
    the rows it is made of. What it takes for 10 MB may be hundreds in the driver.
    """
    return df.hint("merge")


def few_or_merged(df: DataFrame, rows: int) -> DataFrame:
    """``df`` of ``rows`` rows of some numbers: ``merged`` if they are too many to be broadcast."""
    return merged(df) if rows > BROADCAST_ROWS else df


def small_batches(df: DataFrame, rows: int = 1000) -> DataFrame:
    """``df``, after telling its session to hand Python ``rows`` rows at a time.

    Spark's own 10,000 rows are a lot of text, held several times over on both sides.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clean_vector(vector: str | Column, dim: int | None = None) -> Column:
    """Whether a vector has only finite components, not all zero, and ``dim`` of them if given."""
    v = F.col(vector) if isinstance(vector, str) else vector

    def sound(x: Column) -> Column:
        d = x.cast("double")
        return x.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))

    ok = v.isNotNull() & (F.size(v) > 0) & F.forall(v, sound)
    ok = ok & F.exists(v, lambda x: x != 0)
    if dim is not None:
        ok = ok & (F.size(v) == dim)
    return F.coalesce(ok, F.lit(False))


def lengths(vectors: DataFrame, column: str) -> list[int]:
    """The lengths that occur among sound vectors, in order: a few, as models have few."""
    sizes = vectors.where(clean_vector(column)).select(F.size(column).alias("dim")).distinct()
    return sorted(r["dim"] for r in sizes.collect())


def matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """A list column whose lists all have ``dim`` items, as a double matrix."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = array.flatten().to_numpy(zero_copy_only=False)
    return values.astype(np.float64).reshape(-1, dim)
