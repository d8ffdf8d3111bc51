"""Windowed trip counts over a stream of trip files.

The batch operators ``rideshare_groups_window`` (O13) and ``peak_demand``
(O18) group by tumbling windows; here the same grouping runs incrementally
with a watermark, so a window is emitted once (append mode) when no trip
older than the watermark can still arrive, and its state is then dropped.

Watermarks need a zoned timestamp, so the wall-clock pickup time is turned
into the instant with the same UTC reading (zone-free arithmetic) and back
for output; windows stay aligned on the wall clock under any session zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from mobility.functions.time import LABEL_FORMAT, instant_to_wall_clock, wall_clock_to_instant
from mobility.operators.dimension import attach_zone
from mobility.operators.rideshare import BUCKET_SECONDS, MAX_SHARED_PASSENGERS
from mobility.schema import DAY_TRIPS, TripColumns
from mobility.session import checkpoint_dir

EVENT_TIME = "__event_time"


def read_trip_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Stream trip files as they land in ``path`` (schema declared up front)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def _windowed(
    trips: DataFrame,
    cols: TripColumns,
    duration: str,
    watermark: str,
    with_amount: bool,
) -> DataFrame:
    zone = cols.pickup_zone
    timed = trips.withColumn(
        EVENT_TIME, wall_clock_to_instant(F.col(cols.pickup_time).cast(T.TimestampNTZType()))
    ).withWatermark(EVENT_TIME, watermark)
    aggs = [F.count(F.lit(1)).alias("total_trips")]
    if with_amount:
        aggs.append(F.sum(cols.amount).alias("total_amount"))
    return timed.groupBy(F.window(EVENT_TIME, duration).alias("__w"), F.col(zone)).agg(*aggs)


def stream_rideshare_groups(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    duration: str = "5 minutes",
    watermark: str = "10 minutes",
) -> DataFrame:
    """Streaming O13: groupable trips per (window, pickup zone).

    -> <zone id>, total_trips, total_amount, window-start, window-end, Borough, Zone.
    """
    cols.require("passengers")
    groupable = trips.where(F.col(cols.passengers) < MAX_SHARED_PASSENGERS + 1)
    counts = _windowed(groupable, cols, duration, watermark, with_amount=True).select(
        cols.pickup_zone,
        "total_trips",
        "total_amount",
        instant_to_wall_clock("__w.start").alias("window-start"),
        instant_to_wall_clock("__w.end").alias("window-end"),
    )
    return attach_zone(counts, zones, cols.pickup_zone)


def stream_rideshare_groups_nearest(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    seconds: int = BUCKET_SECONDS,
    watermark: str = "10 minutes",
) -> DataFrame:
    """Streaming O12: groupable trips per (nearest mark, pickup zone).

    -> <zone id>, total_trips, total_amount, approximate_datetime, Borough, Zone.
    The mark ``b`` covers [b*s - s/2, b*s + s/2): a tumbling window of ``s``
    seconds started ``s/2`` after the epoch, labelled by its start + s/2.
    Same groups as the batch operator for times after 1970 (before it, the
    batch rounding sends exact half marks away from zero).  Trips without a
    pickup time are left out, as a stream cannot close their group.
    """
    cols.require("passengers")
    half = seconds // 2
    groupable = trips.where(F.col(cols.passengers) < MAX_SHARED_PASSENGERS + 1)
    zone = cols.pickup_zone
    timed = groupable.withColumn(
        EVENT_TIME, wall_clock_to_instant(F.col(cols.pickup_time).cast(T.TimestampNTZType()))
    ).withWatermark(EVENT_TIME, watermark)
    counts = (
        timed.groupBy(
            F.window(EVENT_TIME, f"{seconds} seconds", f"{seconds} seconds", f"{half} seconds").alias("__w"),
            F.col(zone),
        )
        .agg(F.count(F.lit(1)).alias("total_trips"), F.sum(cols.amount).alias("total_amount"))
        .select(
            zone,
            "total_trips",
            "total_amount",
            F.date_format(
                F.timestamp_add("SECOND", F.lit(half), instant_to_wall_clock("__w.start")), LABEL_FORMAT
            ).alias("approximate_datetime"),
        )
    )
    return attach_zone(counts, zones, zone)


def stream_peak_demand(
    trips: DataFrame,
    zones: DataFrame,
    duration: str = "2 hours",
    cols: TripColumns = DAY_TRIPS,
    watermark: str = "30 minutes",
) -> DataFrame:
    """Streaming O18: all trips per (window, pickup zone).

    -> peak-range-start, peak-range-end, <zone id>, total_trips, Borough, Zone.
    """
    counts = _windowed(trips, cols, duration, watermark, with_amount=False).select(
        instant_to_wall_clock("__w.start").alias("peak-range-start"),
        instant_to_wall_clock("__w.end").alias("peak-range-end"),
        cols.pickup_zone,
        "total_trips",
    )
    return attach_zone(counts, zones, cols.pickup_zone)


def write_stream(
    df: DataFrame,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    checkpoint_location: str | None = None,
    trigger_available_now: bool = False,
) -> StreamingQuery:
    """Start an append-mode sink.

    The checkpoint goes under the shared ``spark.checkpoint.dir`` unless given,
    so a restarted query (or one whose executors were lost) resumes from its
    committed offsets and state.
    """
    if fmt == "memory":
        raise ValueError("the memory sink would keep every row on the driver")
    spark = df.sparkSession
    location = checkpoint_location or f"{checkpoint_dir(spark)}/streams/{name}"
    writer = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", location).queryName(name)
    if path is not None:
        writer = writer.option("path", path)
    if trigger_available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()
