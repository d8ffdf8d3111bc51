"""Where and when trips start: zones, boroughs, hours, peak windows.

O01 pickups_by_zone (G1 with role='dropoff'), O02 pickups_by_borough,
O03 pickups_by_hour, O17 total_trip_count, O18 peak_demand,
G5 peak_share, G6 peak_per_zone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.functions.time import hour_of_day, tumbling_window
from mobility.operators._common import count_all, desc, maybe_sort
from mobility.operators.dimension import attach_zone
from mobility.schema import DAY_TRIPS, TripColumns


def pickups_by_zone(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    role: str = "pickup",
    sort: bool = True,
    weight: str | None = None,
) -> DataFrame:
    """Trips per zone with its names, busiest first.

    -> <zone id>, totalTrips, Borough, Zone.  ``role='dropoff'`` counts
    drop-offs instead.  Counted per id first (partial aggregation on the map
    side), so a zone holding most trips costs one row per map task.
    ``weight`` names a column with the number of trips a row stands for, where
    ``trips`` is already counted by something finer.
    """
    key = cols.zone(role)
    total = count_all("totalTrips") if weight is None else F.sum(weight).cast("bigint").alias("totalTrips")
    counts = trips.groupBy(key).agg(total)
    out = attach_zone(counts, zones, key)
    return maybe_sort(out, sort, desc("totalTrips"), F.col(key))


def pickups_by_borough(by_zone: DataFrame, sort: bool = True) -> DataFrame:
    """Roll the per-zone counts of ``pickups_by_zone`` up to boroughs.

    -> Borough, totalTrips.
    """
    out = by_zone.groupBy("Borough").agg(F.sum("totalTrips").cast("bigint").alias("totalTrips"))
    return maybe_sort(out, sort, desc("totalTrips"), F.col("Borough"))


def pickups_by_hour(trips: DataFrame, cols: TripColumns = DAY_TRIPS, sort: bool = True) -> DataFrame:
    """Trips per hour of day; hours without trips are absent.  -> hour, totalTrips."""
    out = trips.groupBy(hour_of_day(cols.pickup_time).alias("hour")).agg(count_all("totalTrips"))
    return maybe_sort(out, sort, desc("totalTrips"), F.col("hour"))


def total_trip_count(trips: DataFrame) -> DataFrame:
    """One row: total_trips."""
    return trips.agg(count_all("total_trips"))


def _window_counts(trips: DataFrame, cols: TripColumns, duration: str) -> DataFrame:
    """(window, zone) -> total_trips; rows with a null pickup time fall out."""
    w = tumbling_window(cols.pickup_time, duration)
    return (
        trips.groupBy(w.alias("peak_range"), F.col(cols.pickup_zone))
        .agg(count_all("total_trips"))
        .select(
            F.col("peak_range.start").alias("peak-range-start"),
            F.col("peak_range.end").alias("peak-range-end"),
            cols.pickup_zone,
            "total_trips",
        )
    )


def peak_demand(
    trips: DataFrame,
    zones: DataFrame,
    duration: str = "2 hours",
    cols: TripColumns = DAY_TRIPS,
    sort: bool = True,
    flatten: bool = True,
) -> DataFrame:
    """Trips per (tumbling window of ``duration``, pickup zone), busiest first.

    -> peak-range-start, peak-range-end, <zone id>, total_trips, Borough, Zone.
    All trips count (no passenger filter).  Ties: Borough, then start and id.
    ``flatten=False`` returns the window as one struct column ``peak-range``
    (start, end) in place of the two columns.
    """
    out = attach_zone(_window_counts(trips, cols, duration), zones, cols.pickup_zone)
    out = maybe_sort(
        out, sort, desc("total_trips"), F.col("Borough"), F.col("peak-range-start"), F.col(cols.pickup_zone)
    )
    if flatten:
        return out
    window = F.struct(F.col("peak-range-start").alias("start"), F.col("peak-range-end").alias("end"))
    return out.select(window.alias("peak-range"), cols.pickup_zone, "total_trips", "Borough", "Zone")


def peak_share(
    trips: DataFrame,
    zones: DataFrame,
    duration: str = "2 hours",
    cols: TripColumns = DAY_TRIPS,
    sort: bool = True,
    all_trips: DataFrame | None = None,
) -> DataFrame:
    """``peak_demand`` plus each cell's share of all trips, in percent.

    The total is a scalar subquery over the whole trip table (evaluated once,
    then inlined), so no global window pulls the rows into one partition and
    no value makes a round trip through Python.  ``all_trips`` is the table
    counted for the total (default ``trips``): pass a cheaper form with the
    same rows when ``trips`` is built by lookups the count does not need.
    """
    total = (trips if all_trips is None else all_trips).agg(F.count(F.lit(1))).scalar()
    out = peak_demand(trips, zones, duration, cols, sort=False).withColumn(
        "share_pct", F.col("total_trips") * F.lit(100.0) / total
    )
    return maybe_sort(
        out, sort, desc("total_trips"), F.col("Borough"), F.col("peak-range-start"), F.col(cols.pickup_zone)
    )


def peak_per_zone(
    trips: DataFrame,
    zones: DataFrame,
    duration: str = "2 hours",
    cols: TripColumns = DAY_TRIPS,
    sort: bool = True,
) -> DataFrame:
    """The busiest window of every zone (ties: the earliest window).

    -> <zone id>, peak-range-start, peak-range-end, total_trips, Borough, Zone.
    Picked with ``max(struct(count, -start))`` per zone: an ordinary
    aggregate, combined map-side, so a zone with many windows is never
    gathered into one task.
    """
    counts = _window_counts(trips, cols, duration)
    best = F.max(
        F.struct(
            F.col("total_trips").alias("n"),
            (-F.unix_timestamp(F.col("peak-range-start"))).alias("neg_start"),
            F.col("peak-range-start").alias("s"),
            F.col("peak-range-end").alias("e"),
        )
    ).alias("best")
    per_zone = counts.groupBy(cols.pickup_zone).agg(best).select(
        cols.pickup_zone,
        F.col("best.s").alias("peak-range-start"),
        F.col("best.e").alias("peak-range-end"),
        F.col("best.n").alias("total_trips"),
    )
    out = attach_zone(per_zone, zones, cols.pickup_zone)
    return maybe_sort(out, sort, desc("total_trips"), F.col(cols.pickup_zone))
