"""A zone holding a third of all trips: same answers, same plan shape."""

import os

import duckdb
import pytest

from mobility.operators import pickups_by_zone, rideshare_groups_nearest
from mobility.sources.views import zones_view
from tests.plan_text import plan_text
from tools.oracle_check import frame_hash

SF = "/root/testdata/sf0.01"

# every third trip starts in zone 0
HOT_ZONE = "CASE WHEN event_id % 3 = 0 THEN 0 ELSE CAST(user_id % 30 AS INT) END"

TRIP_EXPRS = (
    "CAST(ts AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
    f"{HOT_ZONE} AS PULocationID",
    "CAST(event_id % 6 + 1 AS INT) AS passenger_count",
    "value AS total_amount",
)

DUCK_VIEWS = f"""
CREATE VIEW trips AS SELECT {', '.join(TRIP_EXPRS).replace('TIMESTAMP_NTZ', 'TIMESTAMP')}
FROM read_parquet('{SF}/events.parquet');
CREATE VIEW zones AS SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone
FROM read_parquet('{SF}/nation.parquet') JOIN read_parquet('{SF}/region.parquet') ON n_regionkey = r_regionkey;
"""


@pytest.fixture(scope="module")
def hot(spark):
    trips = spark.read.parquet(f"{SF}/events.parquet").selectExpr(*TRIP_EXPRS)
    con = duckdb.connect()
    con.execute(DUCK_VIEWS)
    return trips, zones_view(spark, SF), con


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
def test_hot_zone_counts(hot):
    trips, zones, con = hot
    got = pickups_by_zone(trips, zones).toPandas()
    want = con.execute(
        """SELECT t.PULocationID, COUNT(*) AS totalTrips, z.Borough, z.Zone
           FROM trips t JOIN zones z ON t.PULocationID = z.LocationID GROUP BY ALL"""
    ).df()
    assert frame_hash(got) == frame_hash(want)
    top = got.iloc[0]
    assert top.PULocationID == 0 and top.totalTrips * 3 >= got.totalTrips.sum()


@pytest.mark.skipif(not os.path.exists(SF), reason="test data missing")
def test_hot_zone_groups(hot):
    trips, zones, con = hot
    got = rideshare_groups_nearest(trips, zones).select("PULocationID", "total_trips", "approximate_datetime")
    want = con.execute(
        """SELECT PULocationID, COUNT(*) AS total_trips,
                  strftime(make_timestamp(CAST(round(floor(epoch(tpep_pickup_datetime)) / 300) AS BIGINT)
                           * 300 * 1000000), '%Y-%m-%d %H:%M:%S') AS approximate_datetime
           FROM trips WHERE passenger_count < 3 AND PULocationID IN (SELECT LocationID FROM zones)
           GROUP BY ALL"""
    ).df()
    assert frame_hash(got.toPandas()) == frame_hash(want)
    plan = plan_text(got, "simple")
    # partial aggregation before the exchange; the aggregated side is never broadcast
    assert plan.index("partial_count") > plan.index("Exchange hashpartitioning")
    assert "BuildRight" in plan and "BuildLeft" not in plan
