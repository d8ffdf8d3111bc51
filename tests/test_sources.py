import datetime as dt
import os

import pytest

from mobility.plans.jobs import day_impact_job, history_impact_job, main
from mobility.session import SCALE_CONF, shuffle_partitions_for, stored_bytes
from mobility.sources import jdbc_options, read_trips, read_zones, transfer_tables, write_result_csv, write_trips_by_day
from tests.conftest import ZONE_ROWS, make_trips, trip
from tests.plan_text import plan_text

ZONE_IDS = (1, 56, 57, 103, 237, 264, 265)
ZONE_CSV = "\n".join(
    ['"LocationID","Borough","Zone","service_zone"']
    + [f'{r[0]},"{r[1]}","{r[2]}","{r[3]}"' for r in ZONE_ROWS if r[0] in ZONE_IDS]
    + [""]
)


@pytest.fixture
def zone_csv(tmp_path):
    p = tmp_path / "zones.csv"
    p.write_text(ZONE_CSV)
    return str(p)


def test_read_zones_declared_schema(spark, zone_csv):
    z = read_zones(spark, zone_csv)
    assert z.dtypes == [("LocationID", "int"), ("Borough", "string"), ("Zone", "string"), ("service_zone", "string")]
    rows = {r.LocationID: r for r in z.collect()}
    assert len(rows) == 7
    assert rows[264].service_zone == "N/A" and rows[265].Zone == "NA"
    assert rows[103].Zone.startswith("Miller's Isle/")


def test_read_trips_makes_wall_clock(spark, tmp_path):
    path = str(tmp_path / "trips")
    spark.createDataFrame(
        [(dt.datetime(2018, 1, 25, 18, 30), 237, 1, 12.5)],
        "tpep_pickup_datetime timestamp, PULocationID int, passenger_count int, total_amount double",
    ).write.parquet(path)
    t = read_trips(spark, path)
    assert dict(t.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert t.first().tpep_pickup_datetime == dt.datetime(2018, 1, 25, 18, 30)


def test_write_result_csv_overwrites(spark, tmp_path):
    out = str(tmp_path / "out")
    write_result_csv(spark.createDataFrame([(1.5,)], "total double"), out)
    write_result_csv(spark.createDataFrame([(2.5,)], "total double"), out)
    back = spark.read.option("header", True).schema("total double").csv(out).collect()
    assert [r.total for r in back] == [2.5]


def test_day_partitioned_trips_prune(spark, tmp_path):
    out = str(tmp_path / "by_day")
    write_trips_by_day(make_trips(spark, [trip(0), trip(86400), trip(86400 * 2)]), out)
    assert sorted(d for d in os.listdir(out) if d.startswith("pickup_date=")) == [
        "pickup_date=2018-01-25",
        "pickup_date=2018-01-26",
        "pickup_date=2018-01-27",
    ]
    df = spark.read.parquet(out).where("pickup_date = DATE'2018-01-26'")
    assert "PartitionFilters: [isnotnull(pickup_date" in plan_text(df, "simple")
    assert df.count() == 1


def test_writing_a_day_keeps_the_others(spark, tmp_path):
    out = str(tmp_path / "by_day")
    write_trips_by_day(make_trips(spark, [trip(0), trip(60), trip(86400)]), out)
    write_trips_by_day(make_trips(spark, [trip(86400 + 5), trip(86400 + 6), trip(86400 * 2)]), out)
    counts = {str(r.pickup_date): r["count"] for r in spark.read.parquet(out).groupBy("pickup_date").count().collect()}
    assert counts == {"2018-01-25": 2, "2018-01-26": 2, "2018-01-27": 1}


def test_equal_times_are_split_over_files(spark, tmp_path):
    out = str(tmp_path / "hot_day")
    rows = spark.range(400_000).selectExpr(
        "TIMESTAMP_NTZ'2018-01-25 00:00:00' AS tpep_pickup_datetime", "CAST(id AS INT) AS PULocationID"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_trips_by_day(rows, out, max_rows_per_file=90_000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = [f for f in os.listdir(f"{out}/pickup_date=2018-01-25") if f.endswith(".parquet")]
    assert len(files) >= 4
    assert spark.read.parquet(out).count() == 400_000
    assert max(spark.read.parquet(f"{out}/pickup_date=2018-01-25/{f}").count() for f in files) <= 90_000


def _write_day_trips(spark, path):
    rows = [trip(0, amount=10.0), trip(60, amount=20.0), trip(0, pax=3, amount=30.0), trip(0, pu=999)]
    make_trips(spark, rows).write.parquet(path)


def test_day_impact_job(spark, tmp_path, zone_csv):
    trips_path, out = str(tmp_path / "trips"), str(tmp_path / "out")
    _write_day_trips(spark, trips_path)
    result = day_impact_job(spark, trips_path, zone_csv, out).collect()
    avg = (10.0 + 20.0 + 30.0 + 10.0) / 4
    per_trip = 0.05 * 0.3 * (0.6 * avg - 5) + 0.05 * 0.7 * 2
    assert result[0].total == pytest.approx(2 * per_trip)


def test_history_impact_job_and_cli(spark, tmp_path, zone_csv):
    trips_path = str(tmp_path / "hist")
    t0 = dt.datetime(2016, 3, 1, 8, 0)
    spark.createDataFrame(
        [(t0, 237, 10.0), (t0, 237, 30.0)], "pickup_datetime timestamp_ntz, pickup_taxizone_id int, total_amount double"
    ).write.parquet(trips_path)
    out = str(tmp_path / "out")
    total = history_impact_job(spark, trips_path, zone_csv, out).first().total
    share = 289623 / 331893
    assert total == pytest.approx(2 * share * (0.05 * 0.3 * (0.6 * 20 - 5) + 0.05 * 0.7 * 2))
    out2 = str(tmp_path / "out2")
    changed = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes", *SCALE_CONF)
    before = {k: spark.conf.get(k, None) for k in changed}
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert main(["history", trips_path, zone_csv, out2, "--discount", "0"]) == 0
        # sized from the table's bytes: a small one gets the least count
        assert spark.conf.get("spark.sql.shuffle.partitions") == str(shuffle_partitions_for(stored_bytes(spark, trips_path)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)
    assert stored_bytes(spark, trips_path) == sum(
        os.path.getsize(os.path.join(trips_path, f)) for f in os.listdir(trips_path) if not f.endswith(".crc")
    )
    again = spark.read.option("header", True).schema("total double").csv(out2).first().total
    assert again == pytest.approx(2 * share * (0.05 * 0.3 * (0.6 * 20) + 0.05 * 0.7 * 2))


def test_jdbc_options_partitioned():
    opts = jdbc_options(
        "jdbc:postgresql://db.example/trips",
        "zones",
        user="u",
        password="p",
        partition_column="LocationID",
        lower_bound=1,
        upper_bound=265,
        num_partitions=4,
    )
    assert opts["dbtable"] == "public.zones"
    assert opts["partitionColumn"] == "LocationID" and opts["numPartitions"] == "4"
    assert opts["user"] == "u" and opts["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_transfer_tables_registers_views(spark):
    # any reader works; the JDBC one needs a database, which tests do not start
    frames = transfer_tables(spark, ["t_a", "t_b"], lambda s, name: s.createDataFrame([(name,)], "name string"))
    assert set(frames) == {"t_a", "t_b"}
    assert spark.sql("SELECT name FROM t_b").first().name == "t_b"


def test_transfer_tables_writes_the_warehouse(spark):
    rows = [(1, "a"), (2, "b")]

    def reader(s, name):
        return s.createDataFrame(rows, "id int, name string")

    for _ in range(2):  # again: overwritten, not appended
        transfer_tables(spark, ["wh_zones"], reader, write_to_warehouse=True, prefix="v_")
    assert {tuple(r) for r in spark.table("wh_zones").collect()} == set(rows)
    assert spark.catalog.tableExists("wh_zones") and spark.table("v_wh_zones").count() == 2
    kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
    assert kinds["wh_zones"] == "MANAGED" and kinds["v_wh_zones"] == "TEMPORARY"
    spark.sql("DROP TABLE wh_zones")


def test_unpartitioned_read_is_an_explicit_choice(spark):
    from mobility.sources import read_table

    with pytest.raises(ValueError):
        read_table(spark, "zones", "jdbc:postgresql://db.example/trips")


def test_read_trips_declared_schema(spark, tmp_path):
    from mobility.schema import DAY_TRIP_SCHEMA

    path = str(tmp_path / "day")
    row = tuple(
        dt.datetime(2018, 1, 25, 18, 30) if f.name == "tpep_pickup_datetime" else None for f in DAY_TRIP_SCHEMA.fields
    )
    spark.createDataFrame([row], DAY_TRIP_SCHEMA).write.parquet(path)
    t = read_trips(spark, path, schema=DAY_TRIP_SCHEMA)
    assert len(t.columns) == 17
    assert dict(t.dtypes)["tpep_pickup_datetime"] == "timestamp_ntz"
    assert t.first().tpep_pickup_datetime == dt.datetime(2018, 1, 25, 18, 30)
