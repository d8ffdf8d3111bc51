import pytest

from mobility.operators import (
    DEFAULT_PARAMS,
    ImpactParams,
    average_trip_amount,
    rideshare_groups_nearest,
    rideshare_groups_scaled,
    rideshare_impact,
    rideshare_impact_total,
)
from mobility.plans.jobs import day_impact, history_impact
from mobility.schema import HISTORY_TRIPS
from tests.conftest import make_trips, trip

# Fixed values printed with the original model: a group of 115 trips when the
# average amount is 15.896471422975342.
AVERAGE = 15.896471422975342


def _groups(spark, *counts):
    return spark.createDataFrame([(c,) for c in counts], "total_trips long")


def test_impact_golden_row(spark):
    trips = make_trips(spark, [trip(amount=AVERAGE)])
    r = rideshare_impact(_groups(spark, 115), trips).first()
    assert r.groupedRides == pytest.approx(5.75)
    assert round(r.acceptedGroupedRidesEconomicImpact, 12) == 7.827847922779
    assert r.rejectedGroupedRidesEconomicImpact == pytest.approx(8.05)
    assert round(r.totalImpact, 12) == 15.877847922779


def test_impact_total_golden(spark):
    # 289,623 groupable trips at that average: 39,987.73868642742
    trips = make_trips(spark, [trip(amount=AVERAGE)])
    total = rideshare_impact_total(rideshare_impact(_groups(spark, 289000, 623), trips)).first().total
    assert total == pytest.approx(39987.73868642742, rel=1e-12)


def test_average_over_all_trips_not_groupable(spark, zones):
    # the 3-passenger trip is not grouped but counts in the average
    trips = make_trips(spark, [trip(pax=1, amount=10.0), trip(pax=3, amount=30.0)])
    assert average_trip_amount(trips).first().avg_total_amount == 20.0
    total = day_impact(trips, zones).first().total
    expected = 1 * 0.05 * 0.3 * (0.6 * 20.0 - 5) + 1 * 0.05 * 0.7 * 2
    assert total == pytest.approx(expected)


def test_low_average_gives_negative_accepted(spark):
    trips = make_trips(spark, [trip(amount=8.0)])
    r = rideshare_impact(_groups(spark, 10), trips).first()
    assert r.acceptedGroupedRidesEconomicImpact < 0


def test_impact_is_linear_in_trips(spark):
    trips = make_trips(spark, [trip(amount=AVERAGE)])
    one = rideshare_impact_total(rideshare_impact(_groups(spark, 1), trips)).first().total
    many = rideshare_impact_total(rideshare_impact(_groups(spark, 3, 4, 5), trips)).first().total
    assert many == pytest.approx(12 * one)


def test_params_are_arguments(spark):
    trips = make_trips(spark, [trip(amount=20.0)])
    p = ImpactParams(attempt_share=0.1, accept_share=0.5, discount=2, solo_extra_cost=1, cost_reduction_share=0.5)
    r = rideshare_impact(_groups(spark, 10), trips, p).first()
    assert r.acceptedGroupedRidesEconomicImpact == pytest.approx(1 * 0.5 * (10 - 2))
    assert r.rejectedGroupedRidesEconomicImpact == pytest.approx(1 * 0.5 * 1)
    assert DEFAULT_PARAMS.attempt_share == 0.05


def test_empty_trip_table(spark, zones):
    empty = make_trips(spark, [])
    assert average_trip_amount(empty).first().avg_total_amount is None
    assert day_impact(empty, zones).first().total is None


def _two_steps(trips, zones):
    return rideshare_impact_total(rideshare_impact(rideshare_groups_nearest(trips, zones, sort=False), trips)).first().total


def test_one_pass_equals_two_steps(spark, zones):
    rows = [trip(s, pu=z, pax=p, amount=a) for s in (0, 149, 150, None) for z in (237, 161, 999, None)
            for p in (1, 2, 3, None) for a in (7.25, None)]
    trips = make_trips(spark, rows)
    assert round(day_impact(trips, zones).first().total, 2) == round(_two_steps(trips, zones), 2)
    # an id that is listed twice doubles its groups in both
    twice = zones.unionByName(zones.where("LocationID = 237"))
    assert round(day_impact(trips, twice).first().total, 2) == round(_two_steps(trips, twice), 2)
    # nothing groupable in a known zone: no total in either
    unknown = make_trips(spark, [trip(pu=999), trip(pu=None), trip(pu=237, pax=5)])
    assert day_impact(unknown, zones).first().total is None and _two_steps(unknown, zones) is None


def test_one_pass_history_equals_two_steps(spark, zones):
    df = make_trips(spark, [trip(s, pu=z, amount=9.5) for s in (0, 400) for z in (237, 1, 999)]).selectExpr(
        "tpep_pickup_datetime AS pickup_datetime", "PULocationID AS pickup_taxizone_id", "total_amount"
    )
    groups = rideshare_groups_scaled(df, zones, HISTORY_TRIPS, sort=False)
    two = rideshare_impact_total(rideshare_impact(groups, df, cols=HISTORY_TRIPS)).first().total
    assert history_impact(df, zones).first().total == pytest.approx(two, rel=1e-12)
