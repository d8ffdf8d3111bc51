import datetime as dt

import pytest
from pyspark.sql import functions as F

from mobility.functions import (
    bucket_label,
    instant_to_wall_clock,
    nearest_bucket,
    tumbling_window,
    wall_clock_to_instant,
)
from tests.conftest import make_trips, trip

ZONES = ["UTC", "+01:00", "America/New_York", "Asia/Kolkata"]


@pytest.fixture
def session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda tz: spark.conf.set("spark.sql.session.timeZone", tz)
    spark.conf.set("spark.sql.session.timeZone", before)


def test_nearest_vs_floor_buckets(spark):
    # 18:00 is a 5-minute mark; 149/150/449/450 s past it
    df = make_trips(spark, [trip(s) for s in (149, 150, 449, 450)])
    base = nearest_bucket(F.lit(dt.datetime(2018, 1, 25, 18, 0)).cast("timestamp_ntz"))
    rows = df.select(
        (nearest_bucket("tpep_pickup_datetime") - base).alias("nearest"),
        tumbling_window("tpep_pickup_datetime", "5 minutes").start.alias("start"),
    ).collect()
    assert [r.nearest for r in rows] == [0, 1, 1, 2]
    starts = [r.start for r in rows]
    assert starts == [dt.datetime(2018, 1, 25, 18, 0)] * 2 + [dt.datetime(2018, 1, 25, 18, 5)] * 2


def test_bucket_label_text(spark):
    df = make_trips(spark, [trip(149), trip(150)])
    labels = [r[0] for r in df.select(bucket_label(nearest_bucket("tpep_pickup_datetime"))).collect()]
    assert labels == ["2018-01-25 18:00:00", "2018-01-25 18:05:00"]


def test_time_results_ignore_session_zone(spark, session_zone):
    df = make_trips(spark, [trip(30 * 60)])  # 18:30 wall clock
    seen = set()
    for tz in ZONES:
        session_zone(tz)
        r = df.select(
            tumbling_window("tpep_pickup_datetime", "2 hours").alias("w"),
            F.hour("tpep_pickup_datetime").alias("h"),
            bucket_label(nearest_bucket("tpep_pickup_datetime")).alias("label"),
            F.to_date("tpep_pickup_datetime").alias("d"),
        ).first()
        seen.add((r.w.start, r.w.end, r.h, r.label, r.d))
    assert seen == {
        (
            dt.datetime(2018, 1, 25, 18, 0),
            dt.datetime(2018, 1, 25, 20, 0),
            18,
            "2018-01-25 18:30:00",
            dt.date(2018, 1, 25),
        )
    }


def test_bucket_after_2038_does_not_overflow(spark):
    df = spark.createDataFrame([(dt.datetime(2040, 6, 1, 12, 2, 31),)], "t timestamp_ntz")
    r = df.select(nearest_bucket("t").alias("b"), bucket_label(nearest_bucket("t")).alias("l")).first()
    assert r.b * 300 > 2**31
    assert r.l == "2040-06-01 12:05:00"


def test_null_time_gives_null_bucket(spark):
    df = make_trips(spark, [trip(None)])
    r = df.select(nearest_bucket("tpep_pickup_datetime").alias("b")).first()
    assert r.b is None


def test_instant_round_trip_ignores_zone(spark, session_zone):
    df = spark.createDataFrame([(dt.datetime(2018, 1, 25, 18, 30, 0, 123456),)], "t timestamp_ntz")
    for tz in ZONES:
        session_zone(tz)
        r = df.select(
            instant_to_wall_clock(wall_clock_to_instant("t")).alias("back"),
            instant_to_wall_clock(F.window(wall_clock_to_instant("t"), "2 hours").start).alias("ws"),
        ).first()
        assert r.back == dt.datetime(2018, 1, 25, 18, 30, 0, 123456)
        assert r.ws == dt.datetime(2018, 1, 25, 18, 0)


def test_operators_ignore_session_zone(spark, zones, session_zone):
    from mobility.operators import peak_demand, pickups_by_hour, rate_code_evolution, rideshare_groups_nearest

    df = make_trips(spark, [trip(s, pu=z) for s in range(0, 86400 * 2, 3037) for z in (237, 161)])
    seen = []
    for tz in ZONES:
        session_zone(tz)
        seen.append(
            (
                sorted(tuple(r) for r in rideshare_groups_nearest(df, zones).collect()),
                sorted(tuple(r) for r in peak_demand(df, zones, "3 hours").collect()),
                sorted(tuple(r) for r in pickups_by_hour(df).collect()),
                sorted(tuple(r) for r in rate_code_evolution(df).collect()),
            )
        )
    assert all(s == seen[0] for s in seen)


@pytest.mark.parametrize("zone", ZONES)
def test_zoned_times_answer_like_wall_clocks(spark, zones, session_zone, zone):
    from mobility.functions import hour_of_day, pickup_day
    from mobility.operators import peak_demand, pickups_by_hour, rideshare_groups_nearest, rideshare_groups_window

    session_zone(zone)
    # read in the session zone, so that 18:30 is 18:30 there
    wall = make_trips(spark, [trip(1800 + s) for s in (0, 149, 150, 7200)])
    zoned = wall.withColumn("tpep_pickup_datetime", F.col("tpep_pickup_datetime").cast("timestamp"))
    assert dict(zoned.dtypes)["tpep_pickup_datetime"] == "timestamp"
    for operator in (
        lambda t: t.select(hour_of_day("tpep_pickup_datetime"), pickup_day("tpep_pickup_datetime")),
        lambda t: rideshare_groups_nearest(t, zones),
        lambda t: rideshare_groups_window(t, zones),
        lambda t: peak_demand(t, zones, "2 hours"),
        lambda t: pickups_by_hour(t),
    ):
        a, b = operator(wall), operator(zoned)
        assert a.dtypes == b.dtypes and a.collect() == b.collect()
    first = rideshare_groups_nearest(zoned, zones, sort=False).orderBy("approximate_datetime").first()
    assert first.approximate_datetime == "2018-01-25 18:30:00"
