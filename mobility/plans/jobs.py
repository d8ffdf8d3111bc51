"""Batch jobs: the economic impact of grouped rides, end to end.

O22 ``day_impact_job``: trips in the one-day layout (passenger counts known).
O23 ``history_impact_job``: trips in the multi-year layout (no passenger
count; counts scaled by the measured groupable share).

Each job is one plan with one scan of the trips (``operators.impact.impact_total``:
the model is linear in a group's trips, so its total needs counts and sums by
zone only), written once; the printed result is the small written file read
back, not a second run of the plan.  The command line sizes the shuffle from
the trip table's bytes in its store.

    python -m mobility.plans.jobs day <trips> <zones.csv> <out>
    python -m mobility.plans.jobs history <trips> <zones.csv> <out>
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from mobility.operators.impact import DEFAULT_PARAMS, ImpactParams, impact_total
from mobility.operators.rideshare import GROUPABLE_SHARE, is_groupable
from mobility.schema import DAY_TRIPS, HISTORY_TRIPS, TripColumns
from mobility.session import apply_scale_conf, stored_bytes
from mobility.sources.files import read_trips, read_zones
from mobility.sources.sinks import write_result_csv

TOTAL_SCHEMA = "total double"


def day_impact(
    trips: DataFrame, zones: DataFrame, params: ImpactParams = DEFAULT_PARAMS, cols: TripColumns = DAY_TRIPS
) -> DataFrame:
    """One row: total impact over groupable trips (the sum of O15 over the groups of O12)."""
    return impact_total(trips, zones, params, cols, grouped=is_groupable(cols))


def history_impact(
    trips: DataFrame,
    zones: DataFrame,
    params: ImpactParams = DEFAULT_PARAMS,
    cols: TripColumns = HISTORY_TRIPS,
    share: float = GROUPABLE_SHARE,
) -> DataFrame:
    """One row: total impact with scaled trip counts (the sum of O20 over the groups of O19).

    Money is the average over all trips, so scaling the groups' amounts
    (``scale_amount`` of O19) does not change it.
    """
    return impact_total(trips, zones, params, cols, share=share)


def _finish(spark: SparkSession, total: DataFrame, out_path: str) -> DataFrame:
    write_result_csv(total, out_path)
    result = spark.read.schema(TOTAL_SCHEMA).option("header", True).csv(out_path)
    result.show(truncate=False)
    return result


def day_impact_job(
    spark: SparkSession, trips_path: str, zones_path: str, out_path: str, params: ImpactParams = DEFAULT_PARAMS
) -> DataFrame:
    trips = read_trips(spark, trips_path, DAY_TRIPS)
    return _finish(spark, day_impact(trips, read_zones(spark, zones_path), params), out_path)


def history_impact_job(
    spark: SparkSession,
    trips_path: str,
    zones_path: str,
    out_path: str,
    params: ImpactParams = DEFAULT_PARAMS,
) -> DataFrame:
    trips = read_trips(spark, trips_path, HISTORY_TRIPS)
    trips.printSchema()
    total = history_impact(trips, read_zones(spark, zones_path), params)
    return _finish(spark, total, out_path)


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="mobility.plans.jobs", description="Economic impact of grouped rides")
    p.add_argument("layout", choices=("day", "history"), help="trip table layout")
    p.add_argument("trips", help="trip table (parquet)")
    p.add_argument("zones", help="zone CSV with header")
    p.add_argument("out", help="output folder (CSV, overwritten)")
    d = DEFAULT_PARAMS
    p.add_argument("--attempt-share", type=float, default=d.attempt_share)
    p.add_argument("--accept-share", type=float, default=d.accept_share)
    p.add_argument("--discount", type=float, default=d.discount)
    p.add_argument("--solo-extra-cost", type=float, default=d.solo_extra_cost)
    p.add_argument("--cost-reduction-share", type=float, default=d.cost_reduction_share)
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    params = ImpactParams(
        attempt_share=args.attempt_share,
        accept_share=args.accept_share,
        discount=args.discount,
        solo_extra_cost=args.solo_extra_cost,
        cost_reduction_share=args.cost_reduction_share,
    )
    spark = SparkSession.builder.appName("mobility-impact").getOrCreate()
    apply_scale_conf(spark, stored_bytes(spark, args.trips))
    if args.layout == "day":
        day_impact_job(spark, args.trips, args.zones, args.out, params)
    else:
        history_impact_job(spark, args.trips, args.zones, args.out, params)
    return 0


if __name__ == "__main__":
    sys.exit(main())
