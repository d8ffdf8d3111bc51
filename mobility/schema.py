"""Schemas and the trip column mapping.

Two trip layouts exist: the 17-column day layout and the multi-year layout that
only carries pickup time, pickup zone and amount.  Operators take a
``TripColumns`` instead of hard-coding names, so one function serves both.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

ZONE_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType(), True),
        T.StructField("Borough", T.StringType(), True),
        T.StructField("Zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)

DAY_TRIP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType(), True),
        T.StructField("tpep_pickup_datetime", T.TimestampType(), True),
        T.StructField("tpep_dropoff_datetime", T.TimestampType(), True),
        T.StructField("passenger_count", T.IntegerType(), True),
        T.StructField("trip_distance", T.DoubleType(), True),
        T.StructField("RatecodeID", T.IntegerType(), True),
        T.StructField("store_and_fwd_flag", T.StringType(), True),
        T.StructField("PULocationID", T.IntegerType(), True),
        T.StructField("DOLocationID", T.IntegerType(), True),
        T.StructField("payment_type", T.IntegerType(), True),
        T.StructField("fare_amount", T.DoubleType(), True),
        T.StructField("extra", T.DoubleType(), True),
        T.StructField("mta_tax", T.DoubleType(), True),
        T.StructField("tip_amount", T.DoubleType(), True),
        T.StructField("tolls_amount", T.DoubleType(), True),
        T.StructField("improvement_surcharge", T.DoubleType(), True),
        T.StructField("total_amount", T.DoubleType(), True),
    ]
)


@dataclass(frozen=True)
class TripColumns:
    """Names of the trip fields the operators use (None = absent)."""

    pickup_time: str = "tpep_pickup_datetime"
    pickup_zone: str = "PULocationID"
    dropoff_zone: str | None = "DOLocationID"
    distance: str | None = "trip_distance"
    passengers: str | None = "passenger_count"
    amount: str = "total_amount"
    rate_code: str | None = "RatecodeID"
    payment_type: str | None = "payment_type"

    def with_(self, **kw) -> "TripColumns":
        return replace(self, **kw)

    def zone(self, role: str) -> str:
        """Zone id column for ``role`` ('pickup' or 'dropoff')."""
        if role == "pickup":
            return self.pickup_zone
        if role == "dropoff":
            if self.dropoff_zone is None:
                raise ValueError("this trip layout has no drop-off zone")
            return self.dropoff_zone
        raise ValueError(f"unknown zone role {role!r}")

    def require(self, *fields: str) -> None:
        missing = [f for f in fields if getattr(self, f) is None]
        if missing:
            raise ValueError(f"trip layout lacks {', '.join(missing)}")


# The one-day layout (17 columns).
DAY_TRIPS = TripColumns()

# The multi-year layout: no passenger count, distance, drop-off or codes.
HISTORY_TRIPS = TripColumns(
    pickup_time="pickup_datetime",
    pickup_zone="pickup_taxizone_id",
    dropoff_zone=None,
    distance=None,
    passengers=None,
    amount="total_amount",
    rate_code=None,
    payment_type=None,
)
