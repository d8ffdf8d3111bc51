import datetime as dt

from pyspark.sql import types as T

from mobility.operators import (
    GROUPABLE_SHARE,
    groupable_trip_count,
    rideshare_groups_nearest,
    rideshare_groups_scaled,
    rideshare_groups_window,
    short_trips,
)
from mobility.schema import HISTORY_TRIPS
from tests.conftest import make_trips, trip


def test_groupable_passenger_filter(spark):
    df = make_trips(spark, [trip(pax=None), trip(pax=2), trip(pax=3)])
    assert groupable_trip_count(df).first().groupable_trips == 1


def test_nearest_groups_columns_and_values(spark, zones):
    rows = [trip(149, amount=1.5), trip(150, amount=2.0), trip(290, amount=3.0), trip(449, pax=3)]
    out = rideshare_groups_nearest(make_trips(spark, rows), zones)
    assert out.columns == ["PULocationID", "total_trips", "total_amount", "approximate_datetime", "Borough", "Zone"]
    got = [(r.total_trips, r.total_amount, r.approximate_datetime) for r in out.collect()]
    assert got == [(2, 5.0, "2018-01-25 18:05:00"), (1, 1.5, "2018-01-25 18:00:00")]


def test_null_pickup_time_nearest_vs_window(spark, zones):
    df = make_trips(spark, [trip(None), trip(None), trip(0)])
    nearest = rideshare_groups_nearest(df, zones).collect()
    assert sorted((r.approximate_datetime or "", r.total_trips) for r in nearest) == [
        ("", 2),
        ("2018-01-25 18:00:00", 1),
    ]
    window = rideshare_groups_window(df, zones).collect()
    assert [(r["window-start"], r.total_trips) for r in window] == [(dt.datetime(2018, 1, 25, 18, 0), 1)]


def test_unknown_zone_absent_but_counted(spark, zones):
    df = make_trips(spark, [trip(pu=999), trip(pu=None), trip(pu=237)])
    assert groupable_trip_count(df).first().groupable_trips == 3
    assert [r.PULocationID for r in rideshare_groups_nearest(df, zones).collect()] == [237]


def test_window_groups_floor_aligned(spark, zones):
    rows = [trip(149), trip(150), trip(299), trip(300)]
    out = rideshare_groups_window(make_trips(spark, rows), zones)
    assert out.columns == ["PULocationID", "total_trips", "total_amount", "window-start", "window-end", "Borough", "Zone"]
    got = sorted((r["window-start"], r["window-end"], r.total_trips) for r in out.collect())
    assert got == [
        (dt.datetime(2018, 1, 25, 18, 0), dt.datetime(2018, 1, 25, 18, 5), 3),
        (dt.datetime(2018, 1, 25, 18, 5), dt.datetime(2018, 1, 25, 18, 10), 1),
    ]


def test_short_trip_predicate(spark, zones):
    rows = [trip(0, dist=1.0), trip(0, dist=31.0), trip(0, dist=None)]
    out = rideshare_groups_nearest(make_trips(spark, rows), zones, predicate=short_trips())
    assert [r.total_trips for r in out.collect()] == [1]


def test_scaled_groups(spark, zones):
    schema = "pickup_datetime timestamp_ntz, pickup_taxizone_id int, total_amount double"
    t0 = dt.datetime(2016, 3, 1, 8, 0)
    df = spark.createDataFrame([(t0, 237, 10.0), (t0, 237, 20.0), (t0, 999, 5.0)], schema)
    out = rideshare_groups_scaled(df, zones, HISTORY_TRIPS)
    assert out.columns[:4] == ["pickup_taxizone_id", "total_trips", "total_amount", "approximate_datetime"]
    assert isinstance(out.schema["total_trips"].dataType, T.DoubleType)
    r = out.first()
    assert abs(r.total_trips - 2 * GROUPABLE_SHARE) < 1e-12
    assert r.total_amount == 30.0
    scaled_money = rideshare_groups_scaled(df, zones, HISTORY_TRIPS, scale_amount=True).first()
    assert abs(scaled_money.total_amount - 30.0 * GROUPABLE_SHARE) < 1e-12


def test_group_counts_sum_to_groupable_trips(spark, zones):
    rows = [trip(s, pu=z, pax=p) for s in range(0, 3000, 37) for z, p in ((237, 1), (161, 2), (56, 4))]
    df = make_trips(spark, rows)
    total = groupable_trip_count(df).first().groupable_trips
    near = sum(r.total_trips for r in rideshare_groups_nearest(df, zones).collect())
    win = sum(r.total_trips for r in rideshare_groups_window(df, zones).collect())
    assert near == win == total
