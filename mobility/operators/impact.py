"""The economic impact model of grouped rides.

O14 average_trip_amount, O15/O20 rideshare_impact, O16/O21 rideshare_impact_total
(over the frame of O15) and impact_total (the same total straight from trips).

    avgCostReduction = cost_reduction_share * avg(amount over ALL trips)
    groupedRides     = total_trips * attempt_share
    accepted         = groupedRides * accept_share * (avgCostReduction - discount)
    rejected         = groupedRides * (1 - accept_share) * solo_extra_cost
    totalImpact      = accepted + rejected

The average is a scalar subquery inside the same plan: Spark runs it once and
inlines the value, with no cross join and no Python round trip.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mobility.operators.dimension import bounded_broadcast
from mobility.schema import DAY_TRIPS, TripColumns


@dataclass(frozen=True)
class ImpactParams:
    # The published model's defaults.
    attempt_share: float = 0.05  # share of trips found groupable at any time
    accept_share: float = 0.3  # share of riders who accept to be grouped
    discount: float = 5  # discount on a grouped ride
    solo_extra_cost: float = 2  # extra paid for riding alone
    cost_reduction_share: float = 0.6  # cost saved per grouping, share of an average ride


DEFAULT_PARAMS = ImpactParams()

def average_trip_amount(trips: DataFrame, cols: TripColumns = DAY_TRIPS) -> DataFrame:
    """One row: avg_total_amount over all trips (null for an empty table)."""
    return trips.agg(F.avg(cols.amount).alias("avg_total_amount"))


def rideshare_impact(
    groups: DataFrame,
    trips: DataFrame,
    params: ImpactParams = DEFAULT_PARAMS,
    cols: TripColumns = DAY_TRIPS,
) -> DataFrame:
    """Append the four impact columns to ride-share groups (``total_trips``).

    ``trips`` is the unfiltered trip table the average is taken over.
    """
    avg_amount = trips.agg(F.avg(cols.amount)).scalar()
    avg_cost_reduction = F.lit(params.cost_reduction_share) * avg_amount
    grouped = F.col("total_trips") * F.lit(params.attempt_share)
    accepted = F.col("groupedRides") * F.lit(params.accept_share) * (avg_cost_reduction - F.lit(params.discount))
    rejected = F.col("groupedRides") * F.lit(1 - params.accept_share) * F.lit(params.solo_extra_cost)
    return (
        groups.withColumn("groupedRides", grouped)
        .withColumn("acceptedGroupedRidesEconomicImpact", accepted)
        .withColumn("rejectedGroupedRidesEconomicImpact", rejected)
        .withColumn(
            "totalImpact",
            F.col("acceptedGroupedRidesEconomicImpact") + F.col("rejectedGroupedRidesEconomicImpact"),
        )
    )


def rideshare_impact_total(impact: DataFrame) -> DataFrame:
    """One row: total = sum(totalImpact)."""
    return impact.agg(F.sum("totalImpact").alias("total"))


def impact_total(
    trips: DataFrame,
    zones: DataFrame,
    params: ImpactParams = DEFAULT_PARAMS,
    cols: TripColumns = DAY_TRIPS,
    grouped: Column | None = None,
    share: float = 1.0,
) -> DataFrame:
    """One row: total, the sum of ``totalImpact`` over all ride-share groups, in one pass over ``trips``.

    The impact of a group is proportional to its trips, so the sum needs the
    number of groupable trips (``grouped``; null: every trip) in known zones
    and the average amount of all trips, and neither pickup times nor groups:
    trips are reduced to a row a zone and task before anything is shuffled.
    ``share`` scales the trip counts (the multi-year layout).  The total is
    null where no trip is groupable in a known zone or no amount is known.
    """
    counted = F.count(F.lit(1)) if grouped is None else F.count_if(F.coalesce(grouped, F.lit(False)))
    by_zone = trips.groupBy(F.col(cols.pickup_zone).alias("__zone")).agg(
        counted.alias("__n"), F.sum(cols.amount).alias("__sum"), F.count(cols.amount).alias("__amounts")
    )
    # an id that is listed twice gives its groups twice, as in a join with the zones
    ids = bounded_broadcast(zones.groupBy(F.col("LocationID").alias("__id")).agg(F.count(F.lit(1)).alias("__times")))
    known = by_zone.join(ids, by_zone["__zone"] == ids["__id"], "left")
    sums = known.agg(
        F.sum(F.when(F.col("__n") > 0, F.col("__n") * F.col("__times"))).alias("__trips"),
        (F.sum("__sum") / F.nullif(F.sum("__amounts"), F.lit(0))).alias("__avg"),
    )
    rides = F.col("__trips") * F.lit(share) * F.lit(params.attempt_share)
    saved = F.lit(params.cost_reduction_share) * F.col("__avg") - F.lit(params.discount)
    per_ride = F.lit(params.accept_share) * saved + F.lit((1 - params.accept_share) * params.solo_extra_cost)
    return sums.select((rides * per_ride).alias("total"))
