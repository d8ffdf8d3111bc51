"""Rate codes and payment types: distribution, by length, by day.

O09 rate_code_distribution, O10 rate_code_evolution,
G2 payment_by_length, G3 payment_evolution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.functions.length import DEFAULT_LONG_THRESHOLD, with_length_flag
from mobility.functions.time import pickup_day
from mobility.operators._common import count_all, desc, maybe_sort
from mobility.schema import DAY_TRIPS, TripColumns


def rate_code_distribution(trips: DataFrame, cols: TripColumns = DAY_TRIPS, sort: bool = True) -> DataFrame:
    """Trips per rate code.  -> RateCodeID, totalTrips."""
    cols.require("rate_code")
    out = trips.groupBy(F.col(cols.rate_code).alias("RateCodeID")).agg(count_all("totalTrips"))
    return maybe_sort(out, sort, desc("totalTrips"), F.col("RateCodeID"))


def rate_code_evolution(trips: DataFrame, cols: TripColumns = DAY_TRIPS, sort: bool = True) -> DataFrame:
    """Trips per (pickup day, rate code).  -> pickup_day, RateCodeID, totalTrips."""
    cols.require("rate_code")
    out = trips.groupBy(
        pickup_day(cols.pickup_time).alias("pickup_day"), F.col(cols.rate_code).alias("RateCodeID")
    ).agg(count_all("totalTrips"))
    return maybe_sort(out, sort, F.col("pickup_day"), F.col("RateCodeID"))


def payment_by_length(
    trips: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    threshold: float = DEFAULT_LONG_THRESHOLD,
    sort: bool = True,
) -> DataFrame:
    """Trips per (payment type, isLong).  -> payment_type, isLong, totalTrips."""
    cols.require("payment_type", "distance")
    flagged = with_length_flag(trips, cols.distance, threshold)
    out = flagged.groupBy(F.col(cols.payment_type).alias("payment_type"), "isLong").agg(count_all("totalTrips"))
    return maybe_sort(out, sort, F.col("isLong"), desc("totalTrips"), F.col("payment_type"))


def payment_evolution(trips: DataFrame, cols: TripColumns = DAY_TRIPS, sort: bool = True) -> DataFrame:
    """Trips per (pickup day, payment type).  -> pickup_day, payment_type, totalTrips."""
    cols.require("payment_type")
    out = trips.groupBy(
        pickup_day(cols.pickup_time).alias("pickup_day"), F.col(cols.payment_type).alias("payment_type")
    ).agg(count_all("totalTrips"))
    return maybe_sort(out, sort, F.col("pickup_day"), F.col("payment_type"))
