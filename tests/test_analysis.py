from mobility.plans.analysis import enquiries, main
from mobility.schema import HISTORY_TRIPS
from tests.conftest import make_trips, trip
from tests.test_sources import ZONE_CSV


def test_enquiries_cover_day_layout(spark, zones):
    trips = make_trips(spark, [trip(0), trip(60, pax=3, dist=40.0), trip(3600, pu=161, do=237)])
    results = enquiries(trips, zones)
    assert len(results) == 28
    assert results["total_trip_count"].first().total_trips == 3
    assert results["groupable_trip_count"].first().groupable_trips == 2
    assert {r.PULocationID for r in results["pickups_by_zone"].collect()} == {237, 161}


def test_enquiries_skip_missing_fields(spark, zones):
    trips = spark.createDataFrame([], "pickup_datetime timestamp_ntz, pickup_taxizone_id int, total_amount double")
    results = enquiries(trips, zones, HISTORY_TRIPS)
    assert "payment_by_length" not in results and "distance_stats" not in results
    assert "peak_demand_2h" in results


def test_analysis_cli_writes_results(spark, tmp_path):
    trips_path, zones_path, out = str(tmp_path / "t"), tmp_path / "z.csv", str(tmp_path / "out")
    make_trips(spark, [trip(0), trip(60)]).write.parquet(trips_path)
    zones_path.write_text(ZONE_CSV)
    assert main([trips_path, str(zones_path), out, "pickups_by_zone", "total_trip_count"]) == 0
    assert spark.read.parquet(f"{out}/total_trip_count").first().total_trips == 2
