"""Headed CSV inputs: wide readings and the four metric tables. Bound by name, as text."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metricwin.functions.fields import number
from metricwin.schemas import METRIC_CSV_COLUMNS, WIDE_COLUMNS, WIDE_METRICS


def _headed_csv(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """The named columns as text, wherever in the header they are; other columns are ignored.

    All files of a folder have the header of its first one, which the reader checks. A folder
    without files has no rows.
    """
    reader = spark.read.option("header", True).option("enforceSchema", False)
    try:
        found = reader.csv(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        found = list(columns)
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)} among {', '.join(found)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in found])
    return reader.schema(schema).csv(path).select(*columns)


def read_wide_text(spark: SparkSession, path: str) -> DataFrame:
    return _headed_csv(spark, path, WIDE_COLUMNS)


def _has_bad_number():
    return reduce(lambda a, b: a | b, [number(F.col(m)).isNull() for m in WIDE_METRICS])


def wide_rows(raw: DataFrame, on_bad: str = "reject") -> DataFrame:
    """Type the metrics of text readings; a row with a bad number is dropped or fatal."""
    if on_bad == "reject":
        return raw.where(~_has_bad_number()).withColumns({m: number(F.col(m)) for m in WIDE_METRICS})
    if on_bad != "fail":
        raise ValueError("on_bad must be 'reject' or 'fail'")
    bad = F.raise_error(F.concat(F.lit("not a number: "), F.to_json(F.struct(*WIDE_METRICS))))
    return raw.withColumns(
        {m: F.coalesce(number(F.col(m)), bad.cast("double")) for m in WIDE_METRICS}
    )


def wide_rejects(raw: DataFrame) -> DataFrame:
    """The readings ``wide_rows`` leaves out, untouched."""
    return raw.where(_has_bad_number())


def read_metric_csv(spark: SparkSession, path: str, metric: str, value_type: str) -> DataFrame:
    """One metric table: ``server_id``, ``ts`` and the metric, null where it is no number."""
    return _headed_csv(spark, path, METRIC_CSV_COLUMNS[metric]).select(
        "server_id", "ts", number(F.col(metric), value_type).alias(metric)
    )
