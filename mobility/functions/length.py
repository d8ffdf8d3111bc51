"""The long/short trip flag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: a trip is long from 30 miles on.
DEFAULT_LONG_THRESHOLD = 30


def is_long(distance: Column | str, threshold: float = DEFAULT_LONG_THRESHOLD) -> Column:
    """``distance >= threshold``; a null distance gives a null flag."""
    d = F.col(distance) if isinstance(distance, str) else distance
    return d >= F.lit(threshold)


def with_length_flag(
    trips: DataFrame,
    distance: str = "trip_distance",
    threshold: float = DEFAULT_LONG_THRESHOLD,
    name: str = "isLong",
) -> DataFrame:
    """Add the boolean ``isLong`` column."""
    return trips.withColumn(name, is_long(distance, threshold))
