"""The alert label of a window."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from metricwin.specs import PairSpec


def alert_label(spec: PairSpec, first: Column, second: Column) -> Column:
    """Four-way label of two rounded aggregates; the empty text when nothing is exceeded.

    Every branch tests both values, so a null on either side gives the empty text.
    """
    both, first_only, second_only = spec.labels
    high1, high2 = first > spec.first_threshold, second > spec.second_threshold
    low1, low2 = first <= spec.first_threshold, second <= spec.second_threshold
    return (
        F.when(high1 & high2, F.lit(both))
        .when(high1 & low2, F.lit(first_only))
        .when(high2 & low1, F.lit(second_only))
        .otherwise(F.lit(""))
    )
