import datetime as dt

from mobility.operators import (
    peak_demand,
    peak_per_zone,
    peak_share,
    pickups_by_borough,
    pickups_by_hour,
    pickups_by_zone,
    total_trip_count,
)
from tests.conftest import make_trips, trip


def _trips(spark):
    rows = (
        [trip(0, pu=237, do=161)] * 3
        + [trip(60, pu=161, do=237)] * 2
        + [trip(3600, pu=56, do=57), trip(3600, pu=57, do=56)]
        + [trip(7200, pu=999, do=1), trip(7200, pu=None, do=1)]  # unknown / null zone
    )
    return make_trips(spark, rows)


def test_pickups_by_zone(spark, zones):
    out = pickups_by_zone(_trips(spark), zones)
    assert out.columns == ["PULocationID", "totalTrips", "Borough", "Zone"]
    rows = [tuple(r) for r in out.collect()]
    assert rows == [
        (237, 3, "Midtown", "Upper Park Row"),
        (161, 2, "Midtown", "Clock Square"),
        (56, 1, "Eastbank", "Mill Corner"),
        (57, 1, "Eastbank", "Mill Corner"),
    ]


def test_dropoffs_by_zone(spark, zones):
    out = pickups_by_zone(_trips(spark), zones, role="dropoff")
    assert out.columns[:2] == ["DOLocationID", "totalTrips"]
    got = {r.DOLocationID: r.totalTrips for r in out.collect()}
    assert got == {161: 3, 237: 2, 57: 1, 56: 1, 1: 2}


def test_borough_is_rollup_of_zones(spark, zones):
    by_zone = pickups_by_zone(_trips(spark), zones)
    out = pickups_by_borough(by_zone)
    assert [tuple(r) for r in out.collect()] == [("Midtown", 5), ("Eastbank", 2)]
    assert dict(out.dtypes)["totalTrips"] == "bigint"


def test_pickups_by_hour_and_total(spark):
    trips = _trips(spark)
    assert {r.hour: r.totalTrips for r in pickups_by_hour(trips).collect()} == {18: 5, 19: 2, 20: 2}
    assert total_trip_count(trips).first().total_trips == 9


def test_empty_table_counts_zero(spark, zones):
    empty = make_trips(spark, [])
    assert total_trip_count(empty).first().total_trips == 0
    assert pickups_by_zone(empty, zones).count() == 0


def test_peak_demand_windows_and_order(spark, zones):
    out = peak_demand(_trips(spark), zones, "2 hours")
    assert out.columns == ["peak-range-start", "peak-range-end", "PULocationID", "total_trips", "Borough", "Zone"]
    rows = out.collect()
    assert rows[0]["PULocationID"] == 237 and rows[0]["total_trips"] == 3
    assert rows[0]["peak-range-start"] == dt.datetime(2018, 1, 25, 18, 0)
    assert rows[0]["peak-range-end"] == dt.datetime(2018, 1, 25, 20, 0)
    # 3-hour windows are epoch aligned: 18:00 falls in 18:00-21:00
    w3 = peak_demand(_trips(spark), zones, "3 hours").first()
    assert w3["peak-range-start"] == dt.datetime(2018, 1, 25, 18, 0)


def test_peak_demand_null_time_dropped(spark, zones):
    trips = make_trips(spark, [trip(None, pu=237), trip(0, pu=237)])
    assert [r.total_trips for r in peak_demand(trips, zones).collect()] == [1]


def test_peak_share_sums_to_matched_share(spark, zones):
    out = peak_share(_trips(spark), zones, "2 hours").collect()
    # 7 of 9 trips have a known zone
    assert abs(sum(r.share_pct for r in out) - 700.0 / 9) < 1e-9


def test_peak_per_zone_ties_take_earliest(spark, zones):
    rows = [trip(0, pu=237), trip(7200, pu=237), trip(7200 * 2, pu=237), trip(7200 * 2 + 5, pu=237)]
    rows += [trip(0, pu=161), trip(7200, pu=161)]
    out = {r.PULocationID: r for r in peak_per_zone(make_trips(spark, rows), zones).collect()}
    assert out[237].total_trips == 2
    assert out[237]["peak-range-start"] == dt.datetime(2018, 1, 25, 22, 0)
    assert out[161].total_trips == 1
    assert out[161]["peak-range-start"] == dt.datetime(2018, 1, 25, 18, 0)


def test_peak_demand_struct_window(spark, zones):
    out = peak_demand(_trips(spark), zones, "2 hours", flatten=False)
    assert out.columns == ["peak-range", "PULocationID", "total_trips", "Borough", "Zone"]
    first = out.first()
    assert first["peak-range"].start == dt.datetime(2018, 1, 25, 18, 0)
    assert first["peak-range"].end == dt.datetime(2018, 1, 25, 20, 0)
    assert first.total_trips == 3


def test_peak_share_empty_table(spark, zones):
    assert peak_share(make_trips(spark, []), zones).collect() == []


def test_operators_fit_transform(spark, zones):
    trips = _trips(spark)
    assert trips.transform(pickups_by_zone, zones).count() == 4
