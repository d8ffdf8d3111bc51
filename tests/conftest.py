from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from mobility.schema import ZONE_SCHEMA  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    s = (
        SparkSession.builder.master("local[2]")
        .appName("mobility-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield s


# Trip rows for tests: pickup time as wall clock (timestamp_ntz).
TRIP_SCHEMA = T.StructType(
    [
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType(), True),
        T.StructField("PULocationID", T.IntegerType(), True),
        T.StructField("DOLocationID", T.IntegerType(), True),
        T.StructField("passenger_count", T.IntegerType(), True),
        T.StructField("trip_distance", T.DoubleType(), True),
        T.StructField("total_amount", T.DoubleType(), True),
        T.StructField("RatecodeID", T.IntegerType(), True),
        T.StructField("payment_type", T.IntegerType(), True),
    ]
)

BASE = dt.datetime(2018, 1, 25, 18, 0, 0)


def trip(
    seconds: float | None = 0,
    pu: int | None = 237,
    do: int | None = 161,
    pax: int | None = 1,
    dist: float | None = 2.0,
    amount: float | None = 10.0,
    rate: int | None = 1,
    pay: int | None = 1,
):
    ts = None if seconds is None else BASE + dt.timedelta(seconds=seconds)
    return (ts, pu, do, pax, dist, amount, rate, pay)


def make_trips(spark, rows):
    return spark.createDataFrame(rows, TRIP_SCHEMA)


# Invented zone rows with the awkward cases a real table has: an airfield that is its own
# borough, one name for two and for three ids, an apostrophe and slashes, literal N/A.
ZONE_ROWS = [
    (1, "Airfield", "North Airfield", "Airfield"),
    (56, "Eastbank", "Mill Corner", "Outer Zone"),
    (57, "Eastbank", "Mill Corner", "Outer Zone"),
    (103, "Midtown", "Miller's Isle/Tern Rock/Gull Rock", "Inner Zone"),
    (104, "Midtown", "Miller's Isle/Tern Rock/Gull Rock", "Inner Zone"),
    (105, "Midtown", "Miller's Isle/Tern Rock/Gull Rock", "Inner Zone"),
    (161, "Midtown", "Clock Square", "Inner Zone"),
    (237, "Midtown", "Upper Park Row", "Inner Zone"),
    (264, "Unlisted", "ZZ", "N/A"),
    (265, "Unlisted", "NA", "N/A"),
]


@pytest.fixture(scope="session")
def zones(spark):
    return spark.createDataFrame(ZONE_ROWS, ZONE_SCHEMA)
