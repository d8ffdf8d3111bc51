"""All enquiries over one trip table, as one call.

``enquiries`` returns every result as a DataFrame that runs when it is written
or shown.  Building them runs one small job: the zone table is counted, once,
to decide whether it may be broadcast.  The results, named by what they answer:

    pickups_by_zone, dropoffs_by_zone, pickups_by_borough, pickups_by_hour,
    distance_stats, trips_by_length, pickups_by_hour_and_length,
    zone_pairs_short, zone_pairs_long, top3_pickup_zones, top3_dropoff_zones,
    rate_code_distribution, rate_code_evolution, payment_by_length,
    payment_evolution, groupable_trip_count, rideshare_groups_nearest,
    rideshare_groups_window, rideshare_short_trips, average_trip_amount,
    rideshare_impact, rideshare_impact_total, total_trip_count,
    peak_demand_2h/3h/4h, peak_share_2h, peak_per_zone_2h

Results needing a field the layout lacks (e.g. payment type) are left out.

    python -m mobility.plans.analysis <trips.parquet> <zones.csv> <out_dir> [name ...]

writes each chosen result as parquet under ``out_dir/<name>``; every write is
its own job over the source, with no result passing through the driver.
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from mobility.operators import (
    DEFAULT_PARAMS,
    ImpactParams,
    average_trip_amount,
    distance_stats,
    groupable_trip_count,
    impact_total,
    is_groupable,
    long_trips,
    payment_by_length,
    payment_evolution,
    peak_demand,
    peak_per_zone,
    peak_share,
    pickups_by_borough,
    pickups_by_hour,
    pickups_by_hour_and_length,
    pickups_by_zone,
    rate_code_distribution,
    rate_code_evolution,
    rideshare_groups_nearest,
    rideshare_groups_window,
    rideshare_impact,
    short_trips,
    top_zones_by_length,
    total_trip_count,
    trips_by_length,
    zone_pair_popularity,
)
from mobility.schema import DAY_TRIPS, TripColumns
from mobility.session import apply_scale_conf, stored_bytes
from mobility.sources.files import read_trips, read_zones


def enquiries(
    trips: DataFrame,
    zones: DataFrame,
    cols: TripColumns = DAY_TRIPS,
    params: ImpactParams = DEFAULT_PARAMS,
) -> dict[str, DataFrame]:
    """Every enquiry whose fields the layout has, as lazy DataFrames."""
    out: dict[str, Callable[[], DataFrame]] = {
        "pickups_by_zone": lambda: pickups_by_zone(trips, zones, cols),
        "pickups_by_borough": lambda: pickups_by_borough(pickups_by_zone(trips, zones, cols, sort=False)),
        "pickups_by_hour": lambda: pickups_by_hour(trips, cols),
        "total_trip_count": lambda: total_trip_count(trips),
        "average_trip_amount": lambda: average_trip_amount(trips, cols),
        "peak_demand_2h": lambda: peak_demand(trips, zones, "2 hours", cols),
        "peak_demand_3h": lambda: peak_demand(trips, zones, "3 hours", cols),
        "peak_demand_4h": lambda: peak_demand(trips, zones, "4 hours", cols),
        "peak_share_2h": lambda: peak_share(trips, zones, "2 hours", cols),
        "peak_per_zone_2h": lambda: peak_per_zone(trips, zones, "2 hours", cols),
    }
    if cols.dropoff_zone:
        out["dropoffs_by_zone"] = lambda: pickups_by_zone(trips, zones, cols, role="dropoff")
    if cols.distance:
        out.update(
            distance_stats=lambda: distance_stats(trips, cols),
            trips_by_length=lambda: trips_by_length(trips, cols),
            pickups_by_hour_and_length=lambda: pickups_by_hour_and_length(trips, cols),
            top3_pickup_zones=lambda: top_zones_by_length(trips, zones, "pickup", 3, cols),
        )
        if cols.dropoff_zone:
            out.update(
                zone_pairs_short=lambda: zone_pair_popularity(trips, zones, short_trips(), cols),
                zone_pairs_long=lambda: zone_pair_popularity(trips, zones, long_trips(), cols),
                top3_dropoff_zones=lambda: top_zones_by_length(trips, zones, "dropoff", 3, cols),
            )
    if cols.rate_code:
        out.update(
            rate_code_distribution=lambda: rate_code_distribution(trips, cols),
            rate_code_evolution=lambda: rate_code_evolution(trips, cols),
        )
    if cols.payment_type:
        out["payment_evolution"] = lambda: payment_evolution(trips, cols)
        if cols.distance:
            out["payment_by_length"] = lambda: payment_by_length(trips, cols)
    if cols.passengers:
        out.update(
            groupable_trip_count=lambda: groupable_trip_count(trips, cols),
            rideshare_groups_nearest=lambda: rideshare_groups_nearest(trips, zones, cols),
            rideshare_groups_window=lambda: rideshare_groups_window(trips, zones, cols),
            rideshare_impact=lambda: rideshare_impact(rideshare_groups_nearest(trips, zones, cols), trips, params, cols),
            rideshare_impact_total=lambda: impact_total(trips, zones, params, cols, is_groupable(cols)),
        )
        if cols.distance:
            out["rideshare_short_trips"] = lambda: rideshare_groups_nearest(trips, zones, cols, predicate=short_trips())
    return {name: build() for name, build in sorted(out.items())}


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="mobility.plans.analysis", description="Write every enquiry's result")
    p.add_argument("trips")
    p.add_argument("zones")
    p.add_argument("out_dir")
    p.add_argument("names", nargs="*", help="results to write (default: all)")
    args = p.parse_args(argv)
    spark = SparkSession.builder.appName("mobility-analysis").getOrCreate()
    apply_scale_conf(spark, stored_bytes(spark, args.trips))
    results = enquiries(read_trips(spark, args.trips), read_zones(spark, args.zones))
    unknown = set(args.names) - set(results)
    if unknown:
        p.error(f"unknown results: {', '.join(sorted(unknown))}")
    for name in args.names or results:
        results[name].write.mode("overwrite").parquet(f"{args.out_dir}/{name}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
