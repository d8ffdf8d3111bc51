"""Trip-shaped views over the benchmark tables.

The test data holds no taxi trips, so these views give its tables the trip
layout (``DAY_TRIPS`` / ``HISTORY_TRIPS`` column names).  Everything is
derived by Spark from the given tables, so the work grows with them.

events view (time-of-day work)        lineitem view (volume, pairs, codes, days)
  pickup time   ts                       l_shipdate
  PULocationID  user_id % 30             supplier's nation
  DOLocationID  event_id % 30            customer's nation (through orders)
  trip_distance props.k                  l_quantity
  passengers    event_id % 6 + 1         l_linenumber
  total_amount  value                    l_extendedprice
  RatecodeID    event_type               l_returnflag
  payment_type  -                        o_orderpriority

Zones: nation joined to region (LocationID = nation key, Zone = nation name,
Borough = region name).  Ids 25-29 of the events view match no zone, so the
inner zone joins really drop rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mobility.operators.dimension import bounded_broadcast

# Fixed values of the views.
EVENT_ZONE_MODULUS = 30
EVENT_PASSENGER_MODULUS = 6
SERVICE_ZONE = "Zone"

LINEITEM_FIELDS = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "passenger_count",
    "total_amount",
    "RatecodeID",
    "payment_type",
)


# Declared schemas of the tables the views read.  A declared schema spares the
# footer reads (a job over many files at scale) that inference costs.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
        "l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in TABLE_SCHEMAS:
        reader = reader.schema(TABLE_SCHEMAS[name])
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def zones_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LocationID int, Borough, Zone, service_zone from nation and region."""
    nation = table(spark, sf_dir, "nation")
    region = bounded_broadcast(table(spark, sf_dir, "region"))
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner").selectExpr(
        "CAST(n_nationkey AS INT) AS LocationID",
        "r_name AS Borough",
        "n_name AS Zone",
        f"'{SERVICE_ZONE}' AS service_zone",
    )


# The views as SQL expressions (one call per projection when a plan is built);
# they read like the DuckDB forms in ``mobility.plans.registry``.
_EVENT_TRIP_EXPRS = (
    "CAST(ts AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
    f"CAST(user_id % {EVENT_ZONE_MODULUS} AS INT) AS PULocationID",
    f"CAST(event_id % {EVENT_ZONE_MODULUS} AS INT) AS DOLocationID",
    "CAST(get_json_object(props, '$.k') AS DOUBLE) AS trip_distance",
    f"CAST(event_id % {EVENT_PASSENGER_MODULUS} + 1 AS INT) AS passenger_count",
    "value AS total_amount",
    "event_type AS RatecodeID",
)

_EVENT_HISTORY_EXPRS = (
    "CAST(ts AS TIMESTAMP_NTZ) AS pickup_datetime",
    f"CAST(user_id % {EVENT_ZONE_MODULUS} AS INT) AS pickup_taxizone_id",
    "value AS total_amount",
)

_LINEITEM_EXPRS = {
    "tpep_pickup_datetime": "CAST(l_shipdate AS TIMESTAMP_NTZ) AS tpep_pickup_datetime",
    "PULocationID": "CAST(s_nationkey AS INT) AS PULocationID",
    "DOLocationID": "CAST(c_nationkey AS INT) AS DOLocationID",
    "trip_distance": "CAST(l_quantity AS DOUBLE) AS trip_distance",
    "passenger_count": "CAST(l_linenumber AS INT) AS passenger_count",
    "total_amount": "CAST(l_extendedprice AS DOUBLE) AS total_amount",
    "RatecodeID": "l_returnflag AS RatecodeID",
    "payment_type": "o_orderpriority AS payment_type",
}


def events_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day-layout trips from ``events`` (no joins; a plain projection)."""
    return table(spark, sf_dir, "events").selectExpr(*_EVENT_TRIP_EXPRS)


def events_history_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Multi-year-layout trips from ``events``: pickup_datetime,
    pickup_taxizone_id, total_amount."""
    return table(spark, sf_dir, "events").selectExpr(*_EVENT_HISTORY_EXPRS)


def lineitem_trips(
    spark: SparkSession, sf_dir: str, fields: Iterable[str] = LINEITEM_FIELDS
) -> DataFrame:
    """Day-layout trips from ``lineitem``, joining only what ``fields`` need.

    The joins are left joins on foreign keys: ``s_suppkey``, ``o_orderkey`` and
    ``c_custkey`` are assumed to be unique (``tests/test_views.py`` checks the
    given tables), so every line item stays one trip whether or not a lookup is
    asked for; a missing supplier or customer gives a null zone.  The join with
    orders is always a shuffle join: both sides grow with the data, and no
    session's estimate may broadcast the line items.  Supplier and customer are broadcast only when their
    row count is within the dimension bound; otherwise, like orders, they are
    shuffle-joined, AQE splits a skewed join key (say one supplier with a
    third of the lines) and may broadcast a side whose shuffled size turns out
    small.
    """
    fields = tuple(fields)
    unknown = set(fields) - set(LINEITEM_FIELDS)
    if unknown:
        raise ValueError(f"unknown trip fields {sorted(unknown)}")
    out = table(spark, sf_dir, "lineitem")
    if "PULocationID" in fields:
        supplier = bounded_broadcast(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"))
        out = out.join(supplier, out["l_suppkey"] == supplier["s_suppkey"], "left")
    if "DOLocationID" in fields or "payment_type" in fields:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        if "DOLocationID" in fields:
            customer = bounded_broadcast(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
            orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
        out = out.join(orders.hint("merge"), out["l_orderkey"] == orders["o_orderkey"], "left")
    return out.selectExpr(*[_LINEITEM_EXPRS[f] for f in fields])


def lineitem_dropoff_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(DOLocationID, trips): the view's trips counted per order, for operators that only count.

    Line items of an order lie together, so counting them before the join
    shrinks what is shuffled to it, on the key that the join needs anyway.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("trips"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = bounded_broadcast(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"))
    orders = orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
    joined = lines.join(orders.hint("merge"), lines["l_orderkey"] == orders["o_orderkey"], "left")
    return joined.selectExpr(_LINEITEM_EXPRS["DOLocationID"], "trips")
