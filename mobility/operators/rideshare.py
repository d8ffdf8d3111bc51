"""Ride-sharing opportunities: trips starting close in space and time.

O11 groupable_trip_count, O12 rideshare_groups_nearest,
O13 rideshare_groups_window, O19 rideshare_groups_scaled,
G7 via the ``predicate`` argument (e.g. ``short_trips()``).

A group is (time bucket, pickup zone).  At scale the number of groups is
buckets x zones; the aggregation is partial on the map side (count and sum
combine), so a hot zone never lands whole in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.functions.length import DEFAULT_LONG_THRESHOLD, with_length_flag
from mobility.functions.time import bucket_label, nearest_bucket, tumbling_window
from mobility.operators._common import count_all, desc, maybe_sort
from mobility.operators.dimension import attach_zone
from mobility.schema import DAY_TRIPS, HISTORY_TRIPS, TripColumns

# At most this many passengers may share; trips are grouped
# by 5-minute (300 s) marks; the share of groupable trips measured on one day
# (289,623 of 331,893 trips) is used for trip tables without passenger counts.
MAX_SHARED_PASSENGERS = 2
BUCKET_SECONDS = 300
GROUPABLE_TRIPS_DAY = 289623
ALL_TRIPS_DAY = 331893
GROUPABLE_SHARE = GROUPABLE_TRIPS_DAY * 1.0 / ALL_TRIPS_DAY


def is_groupable(cols: TripColumns = DAY_TRIPS) -> Column:
    """At most two passengers; null for an unknown count."""
    cols.require("passengers")
    return F.col(cols.passengers) < MAX_SHARED_PASSENGERS + 1


def groupable(
    trips: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    predicate: Column | None = None,
    threshold: float = DEFAULT_LONG_THRESHOLD,
) -> DataFrame:
    """Trips with at most two passengers (null counts excluded), optionally
    also meeting ``predicate``, which may refer to ``isLong``."""
    out = trips.where(is_groupable(cols))
    if predicate is not None:
        if cols.distance is not None:
            out = with_length_flag(out, cols.distance, threshold)
        out = out.where(predicate)
    return out


def groupable_trip_count(trips: DataFrame, cols: TripColumns = DAY_TRIPS) -> DataFrame:
    """One row: groupable_trips."""
    return groupable(trips, cols).agg(count_all("groupable_trips"))


def _nearest_groups(trips: DataFrame, cols: TripColumns, seconds: int, trip_count: Column) -> DataFrame:
    zone = cols.pickup_zone
    return (
        trips.select(
            nearest_bucket(cols.pickup_time, seconds).alias("__bucket"),
            F.col(zone),
            F.col(cols.amount),
        )
        .groupBy("__bucket", zone)
        .agg(trip_count.alias("total_trips"), F.sum(cols.amount).alias("total_amount"))
        .select(
            zone,
            "total_trips",
            "total_amount",
            bucket_label("__bucket", seconds).alias("approximate_datetime"),
        )
    )


def rideshare_groups_nearest(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    predicate: Column | None = None,
    seconds: int = BUCKET_SECONDS,
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Groupable trips per (nearest 5-minute mark, pickup zone).

    -> <zone id>, total_trips, total_amount, approximate_datetime, Borough, Zone.
    The mark is ``round(epoch_seconds / 300)``: a label covers
    [label - 150 s, label + 150 s).  A null pickup time forms its own group
    with a null label.
    """
    base = groupable(trips, cols, predicate, threshold)
    groups = _nearest_groups(base, cols, seconds, F.count(F.lit(1)))
    out = attach_zone(groups, zones, cols.pickup_zone)
    return maybe_sort(out, sort, desc("total_trips"), F.col("approximate_datetime"), F.col(cols.pickup_zone))


def rideshare_groups_window(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    predicate: Column | None = None,
    duration: str = "5 minutes",
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Groupable trips per (tumbling window, pickup zone).

    -> <zone id>, total_trips, total_amount, window-start, window-end,
    Borough, Zone.  Windows are floor-aligned [start, end), unlike the
    nearest-mark buckets of ``rideshare_groups_nearest``.
    """
    zone = cols.pickup_zone
    base = groupable(trips, cols, predicate, threshold)
    groups = (
        base.groupBy(tumbling_window(cols.pickup_time, duration).alias("__w"), F.col(zone))
        .agg(count_all("total_trips"), F.sum(cols.amount).alias("total_amount"))
        .select(
            zone,
            "total_trips",
            "total_amount",
            F.col("__w.start").alias("window-start"),
            F.col("__w.end").alias("window-end"),
        )
    )
    out = attach_zone(groups, zones, zone)
    return maybe_sort(out, sort, desc("total_trips"), F.col("window-start"), F.col(zone))


def rideshare_groups_scaled(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = HISTORY_TRIPS,
    share: float = GROUPABLE_SHARE,
    scale_amount: bool = False,
    seconds: int = BUCKET_SECONDS,
    sort: bool = True,
) -> DataFrame:
    """``rideshare_groups_nearest`` for trips without passenger counts.

    Every trip counts, scaled by ``share``: total_trips is a double.  The
    amount stays unscaled unless ``scale_amount`` (the original model scales
    trips but not money).
    """
    groups = _nearest_groups(trips, cols, seconds, F.count(F.lit(1)) * F.lit(share))
    if scale_amount:
        groups = groups.withColumn("total_amount", F.col("total_amount") * F.lit(share))
    out = attach_zone(groups, zones, cols.pickup_zone)
    return maybe_sort(out, sort, desc("total_trips"), F.col("approximate_datetime"), F.col(cols.pickup_zone))
