"""File sources for trips and zones."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from mobility.functions.time import to_wall_clock
from mobility.schema import DAY_TRIPS, ZONE_SCHEMA, TripColumns


def normalize_trips(trips: DataFrame, cols: TripColumns = DAY_TRIPS) -> DataFrame:
    """Cast the pickup time to ``timestamp_ntz`` once, at the source."""
    return trips.withColumn(cols.pickup_time, to_wall_clock(cols.pickup_time))


def read_trips(
    spark: SparkSession,
    path: str,
    cols: TripColumns = DAY_TRIPS,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """Load a trip table (default format parquet) with a wall-clock pickup time.

    Nothing is read here beyond the file footers (none with a declared
    ``schema``, e.g. ``DAY_TRIP_SCHEMA``); later filters and column choices
    reach the scan (pushed filters, pruned read schema), and a table written
    by ``write_trips_by_day`` is pruned by day.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return normalize_trips(reader.load(path), cols)


def read_zones(spark: SparkSession, path: str) -> DataFrame:
    """Load the zone CSV (header line) with a declared schema.

    Declaring the schema saves the extra pass that type inference costs.
    Text such as ``N/A`` stays text; only empty fields become null.
    """
    return spark.read.schema(ZONE_SCHEMA).option("header", True).option("mode", "FAILFAST").csv(path)
