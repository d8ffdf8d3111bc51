"""The trip views over the benchmark tables, on hand-made tables."""

import datetime as dt

import pytest

from mobility.operators import pickups_by_zone, total_trip_count
from mobility.sources.views import TABLE_SCHEMAS, events_trips, lineitem_trips, zones_view
from tests.plan_text import plan_text

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = tmp_path_factory.mktemp("tables")
    rows = {
        "region": [(0, "AFRICA"), (1, "AMERICA")],
        "nation": [(0, "NATION_0", 0), (1, "NATION_1", 1)],
        "supplier": [(10, "s10", 0, 1.0)],  # supplier 11 is missing
        "customer": [(100, "c100", 1, 1.0, "X")],  # customer 101 is missing
        "orders": [(1, 100, "O", 1.0, T0, "1-URGENT"), (2, 101, "O", 1.0, T0, "2-HIGH")],
        "lineitem": [
            (1, 5, 10, 1, 10.0, 100.0, 0.0, 0.0, "N", "O", T0),
            (1, 5, 11, 2, 40.0, 200.0, 0.0, 0.0, "R", "O", T0),
            (2, 5, 10, 1, 5.0, 50.0, 0.0, 0.0, "A", "F", T0 + dt.timedelta(days=1)),
        ],
        "events": [(0, T0, 31, "view", 1.5, '{"k": 40}'), (1, T0, 7, "click", 2.5, '{"k": 3}')],
    }
    for name, data in rows.items():
        spark.createDataFrame(data, TABLE_SCHEMAS[name]).write.parquet(str(d / f"{name}.parquet"))
    return str(d)


def test_lineitem_view_keeps_every_line(spark, tables):
    trips = lineitem_trips(spark, tables)
    assert total_trip_count(trips).first().total_trips == 3
    got = {(r.PULocationID, r.DOLocationID, r.payment_type) for r in trips.collect()}
    assert got == {(0, 1, "1-URGENT"), (None, 1, "1-URGENT"), (0, None, "2-HIGH")}


def test_lineitem_view_missing_supplier_absent_from_zones(spark, tables):
    out = pickups_by_zone(lineitem_trips(spark, tables, ("PULocationID",)), zones_view(spark, tables))
    assert [(r.PULocationID, r.totalTrips, r.Borough) for r in out.collect()] == [(0, 2, "AFRICA")]


def test_lineitem_view_only_needed_joins(spark, tables):
    plan = plan_text(lineitem_trips(spark, tables, ("trip_distance", "passenger_count")), "simple")
    assert "Join" not in plan


def test_events_view_fields(spark, tables):
    r = sorted(events_trips(spark, tables).collect(), key=lambda r: r.DOLocationID)
    assert [(x.PULocationID, x.DOLocationID, x.passenger_count, x.trip_distance) for x in r] == [
        (1, 0, 1, 40.0),
        (7, 1, 2, 3.0),
    ]


def test_zones_view(spark, tables):
    z = zones_view(spark, tables)
    assert z.dtypes == [("LocationID", "int"), ("Borough", "string"), ("Zone", "string"), ("service_zone", "string")]
    assert sorted(tuple(r) for r in z.collect()) == [(0, "AFRICA", "NATION_0", "Zone"), (1, "AMERICA", "NATION_1", "Zone")]


def test_keys_of_the_lineitem_view_are_unique(spark):
    # the left joins of the view rely on it
    for name, key in (("supplier", "s_suppkey"), ("orders", "o_orderkey"), ("customer", "c_custkey")):
        t = spark.read.parquet(f"/root/testdata/sf0.01/{name}.parquet")
        assert t.count() == t.select(key).distinct().count()
