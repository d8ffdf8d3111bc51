"""Trip length: statistics, the long/short split, popular zone pairs.

O04 distance_stats, O05 with_length_flag (in ``mobility.functions``),
O06 trips_by_length, O07 pickups_by_hour_and_length, O08 zone_pair_popularity,
G4/G8 top_zones_by_length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mobility.functions.length import DEFAULT_LONG_THRESHOLD, with_length_flag
from mobility.functions.time import hour_of_day
from mobility.operators._common import count_all, desc, maybe_sort
from mobility.operators.dimension import attach_zone
from mobility.schema import DAY_TRIPS, TripColumns


def distance_stats(
    trips: DataFrame, cols: TripColumns = DAY_TRIPS, threshold: float = DEFAULT_LONG_THRESHOLD
) -> DataFrame:
    """One row: count, threshold, mean, stddev (sample), min, max of distance.

    ``count`` counts every trip; the others skip null distances.  A single
    partial+final aggregate.
    """
    cols.require("distance")
    d = F.col(cols.distance)
    return trips.agg(
        count_all("count"),
        F.lit(threshold).alias("threshold"),
        F.avg(d).alias("mean"),
        F.stddev_samp(d).alias("stddev"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
    )


def trips_by_length(
    trips: DataFrame, cols: TripColumns = DAY_TRIPS, threshold: float = DEFAULT_LONG_THRESHOLD
) -> DataFrame:
    """Trips per ``isLong`` value (null distance -> null group).  -> isLong, count."""
    cols.require("distance")
    flagged = with_length_flag(trips, cols.distance, threshold)
    return flagged.groupBy("isLong").agg(count_all("count"))


def pickups_by_hour_and_length(
    trips: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Trips per (hour, isLong).  -> hour, isLong, totalTrips."""
    cols.require("distance")
    flagged = with_length_flag(trips, cols.distance, threshold)
    out = flagged.groupBy(hour_of_day(cols.pickup_time).alias("hour"), "isLong").agg(count_all("totalTrips"))
    return maybe_sort(out, sort, desc("totalTrips"), F.col("hour"), F.col("isLong"))


def short_trips() -> Column:
    """Predicate for ``zone_pair_popularity``: not long (null distance excluded)."""
    return ~F.col("isLong")


def long_trips() -> Column:
    return F.col("isLong")


def zone_pair_popularity(
    trips: DataFrame,
    zones: DataFrame,
    predicate: Column | None = None,
    cols: TripColumns = DAY_TRIPS,
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Trips per (pickup zone, drop-off zone) among trips meeting ``predicate``.

    ``predicate`` may use ``isLong`` (see ``short_trips``/``long_trips``).
    -> totalTrips, Pickup_Zone, Dropoff_Zone.  Pairs are counted per id pair
    and the ids dropped afterwards, so two ids with one name stay two rows.
    The zone table plays both roles; both joins are broadcast.
    """
    cols.require("distance", "dropoff_zone")
    pu, do = cols.pickup_zone, cols.dropoff_zone
    flagged = with_length_flag(trips, cols.distance, threshold)
    if predicate is not None:
        flagged = flagged.where(predicate)
    counts = flagged.groupBy(pu, do).agg(count_all("totalTrips"))
    named = attach_zone(counts, zones, pu, keep=("Zone",), rename={"Zone": "Pickup_Zone"})
    named = attach_zone(named, zones, do, keep=("Zone",), rename={"Zone": "Dropoff_Zone"})
    out = named.select("totalTrips", "Pickup_Zone", "Dropoff_Zone", pu, do)
    out = maybe_sort(out, sort, desc("totalTrips"), F.col(pu), F.col(do))
    return out.drop(pu, do)


def top_zones_by_length(
    trips: DataFrame,
    zones: DataFrame,
    role: str = "pickup",
    k: int = 3,
    cols: TripColumns = DAY_TRIPS,
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Top ``k`` pickup (or drop-off) zones for long and for short trips.

    -> isLong, rank, <zone id>, totalTrips, Borough, Zone.  Trips with a null
    distance are in neither class; equal counts rank the smaller id first.
    ``row_number() <= k`` plans as a partial ``WindowGroupLimit`` before the
    shuffle, so each map task sends at most ``k`` rows per class.
    """
    cols.require("distance")
    key = cols.zone(role)
    flagged = with_length_flag(trips, cols.distance, threshold).where(F.col("isLong").isNotNull())
    counts = flagged.groupBy("isLong", key).agg(count_all("totalTrips"))
    named = attach_zone(counts, zones, key)
    w = Window.partitionBy("isLong").orderBy(desc("totalTrips"), F.col(key))
    ranked = named.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    out = ranked.select("isLong", "rank", key, "totalTrips", "Borough", "Zone")
    return maybe_sort(out, sort, F.col("isLong"), F.col("rank"))
