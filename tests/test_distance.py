from mobility.functions import with_length_flag
from mobility.operators import (
    distance_stats,
    long_trips,
    pickups_by_hour_and_length,
    short_trips,
    top_zones_by_length,
    trips_by_length,
    zone_pair_popularity,
)
from tests.conftest import make_trips, trip


def test_length_flag_nulls(spark):
    df = with_length_flag(make_trips(spark, [trip(dist=None), trip(dist=29.99), trip(dist=30.0)]))
    assert [r.isLong for r in df.collect()] == [None, False, True]


def test_null_distance_in_neither_class(spark, zones):
    df = make_trips(spark, [trip(dist=None), trip(dist=29.99), trip(dist=30.0)])
    assert zone_pair_popularity(df, zones, short_trips()).first().totalTrips == 1
    assert zone_pair_popularity(df, zones, long_trips()).first().totalTrips == 1
    got = {r.isLong: r["count"] for r in trips_by_length(df).collect()}
    assert got == {None: 1, False: 1, True: 1}


def test_distance_stats(spark):
    df = make_trips(spark, [trip(dist=d) for d in (1.0, 2.0, 3.0, None)])
    r = distance_stats(df).first()
    assert r.asDict() == {"count": 4, "threshold": 30, "mean": 2.0, "stddev": 1.0, "min": 1.0, "max": 3.0}


def test_distance_stats_empty(spark):
    r = distance_stats(make_trips(spark, [])).first()
    assert r["count"] == 0 and r["mean"] is None and r["stddev"] is None


def test_hour_and_length(spark):
    df = make_trips(spark, [trip(0, dist=31.0), trip(0, dist=1.0), trip(3600, dist=1.0), trip(3601, dist=2.0)])
    got = {(r.hour, r.isLong): r.totalTrips for r in pickups_by_hour_and_length(df).collect()}
    assert got == {(18, True): 1, (18, False): 1, (19, False): 2}


def test_pairs_keep_equal_names_apart(spark, zones):
    # 56 and 57 are both "Mill Corner": two pairs, two rows
    df = make_trips(spark, [trip(pu=56, do=237), trip(pu=57, do=237), trip(pu=57, do=237)])
    out = zone_pair_popularity(df, zones, short_trips())
    assert out.columns == ["totalTrips", "Pickup_Zone", "Dropoff_Zone"]
    assert [tuple(r) for r in out.collect()] == [
        (2, "Mill Corner", "Upper Park Row"),
        (1, "Mill Corner", "Upper Park Row"),
    ]


def test_pairs_drop_unknown_dropoff(spark, zones):
    df = make_trips(spark, [trip(pu=237, do=999), trip(pu=237, do=161)])
    assert zone_pair_popularity(df, zones).count() == 1


def test_top3_ties_by_smaller_id(spark, zones):
    rows = [trip(pu=z) for z in (237, 237, 161, 161, 104, 104, 103, 103, 56)]
    rows += [trip(pu=1, dist=40.0)]
    out = top_zones_by_length(make_trips(spark, rows), zones, k=3).collect()
    short = [(r["rank"], r.PULocationID, r.totalTrips) for r in out if r.isLong is False]
    assert short == [(1, 103, 2), (2, 104, 2), (3, 161, 2)]
    long_ = [(r["rank"], r.PULocationID) for r in out if r.isLong is True]
    assert long_ == [(1, 1)]


def test_top_dropoff_zones(spark, zones):
    rows = [trip(do=161), trip(do=161), trip(do=237)]
    out = top_zones_by_length(make_trips(spark, rows), zones, role="dropoff", k=1).collect()
    assert [(r.DOLocationID, r.totalTrips) for r in out] == [(161, 2)]
