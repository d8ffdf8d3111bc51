"""Named queries over the benchmark tables, each with its DuckDB oracle.

Every query runs a library operator on a trip view derived from the given
tables (``mobility.sources.views``), over the whole tables.  Double columns
are rounded to 6 places on both sides so that summation order cannot change
the comparison, the money grand totals to cents (see ``CENT_DIGITS``);
nothing else is altered.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mobility.functions.length import DEFAULT_LONG_THRESHOLD, with_length_flag
from mobility.operators import (
    average_trip_amount,
    distance_stats,
    groupable_trip_count,
    long_trips,
    payment_by_length,
    payment_evolution,
    peak_demand,
    peak_per_zone,
    peak_share,
    pickups_by_borough,
    pickups_by_hour,
    pickups_by_hour_and_length,
    pickups_by_zone,
    rate_code_distribution,
    rate_code_evolution,
    rideshare_groups_nearest,
    rideshare_groups_scaled,
    rideshare_groups_window,
    rideshare_impact,
    short_trips,
    top_zones_by_length,
    total_trip_count,
    trips_by_length,
    zone_pair_popularity,
)
from mobility.operators.impact import impact_total
from mobility.operators.rideshare import ALL_TRIPS_DAY, GROUPABLE_SHARE, GROUPABLE_TRIPS_DAY, is_groupable
from mobility.plans.jobs import day_impact, history_impact
from mobility.schema import DAY_TRIPS, HISTORY_TRIPS
from mobility.sources.files import read_trips
from mobility.sources.jdbc import transfer_tables
from mobility.sources.views import (
    events_history_trips,
    events_trips,
    lineitem_dropoff_counts,
    lineitem_trips,
    table,
    zones_view,
)

DIGITS = 6
# Grand totals of money are summed over many groups of products; their
# last digits depend on summation order, so they are compared in cents.
CENT_DIGITS = 2

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class RegisteredQuery:
    name: str
    build: Builder
    sql: str | None


def round_doubles(df: DataFrame, digits: int = DIGITS, cents: tuple[str, ...] = ()) -> DataFrame:
    """Round every double column to ``digits`` places, the money totals in
    ``cents`` to 2 places (order of columns kept)."""

    def out(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if not isinstance(f.dataType, T.DoubleType):
            return c
        return F.round(c, CENT_DIGITS if f.name in cents else digits).alias(f.name)

    return df.select(*[out(f) for f in df.schema.fields])


# ---------------------------------------------------------------- views ----
# DuckDB forms of the trip views; they must match mobility.sources.views.

_ZONES_SQL = """zones AS (
  SELECT CAST(n_nationkey AS INTEGER) AS LocationID, r_name AS Borough, n_name AS Zone,
         'Zone' AS service_zone
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

_EVENTS_SQL = """trips AS (
  SELECT ts AS tpep_pickup_datetime,
         CAST(user_id % 30 AS INTEGER) AS PULocationID,
         CAST(event_id % 30 AS INTEGER) AS DOLocationID,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS trip_distance,
         CAST(event_id % 6 + 1 AS INTEGER) AS passenger_count,
         value AS total_amount,
         event_type AS RatecodeID
  FROM events)"""

_LINEITEM_SQL = """trips AS (
  SELECT l.l_shipdate AS tpep_pickup_datetime,
         CAST(s.s_nationkey AS INTEGER) AS PULocationID,
         CAST(c.c_nationkey AS INTEGER) AS DOLocationID,
         CAST(l.l_quantity AS DOUBLE) AS trip_distance,
         CAST(l.l_linenumber AS INTEGER) AS passenger_count,
         CAST(l.l_extendedprice AS DOUBLE) AS total_amount,
         l.l_returnflag AS RatecodeID,
         o.o_orderpriority AS payment_type
  FROM lineitem l
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN customer c ON o.o_custkey = c.c_custkey)"""

_HISTORY_SQL = """trips AS (
  SELECT ts AS pickup_datetime,
         CAST(user_id % 30 AS INTEGER) AS pickup_taxizone_id,
         value AS total_amount
  FROM events)"""

_VIEW_SQL = {"events": _EVENTS_SQL, "lineitem": _LINEITEM_SQL, "history": _HISTORY_SQL}


TripBuilder = Callable[..., DataFrame]


def _trips(view: str) -> TripBuilder:
    """(spark, sf_dir, *fields) -> trips.  Only the lineitem view uses
    ``fields``: it then joins just the tables those fields come from."""
    if view == "events":
        return lambda spark, sf_dir, *fields: events_trips(spark, sf_dir)
    return lambda spark, sf_dir, *fields: lineitem_trips(spark, sf_dir, fields)


# trip fields, for the lineitem view's join choice
TIME, PU, DO, DIST, PAX, AMT, RATE, PAY = (
    "tpep_pickup_datetime",
    "PULocationID",
    "DOLocationID",
    "trip_distance",
    "passenger_count",
    "total_amount",
    "RatecodeID",
    "payment_type",
)


def _with(view: str, body: str, ctes: tuple[str, ...] = ()) -> str:
    return "WITH " + ",\n".join((_VIEW_SQL[view], _ZONES_SQL, *ctes)) + "\n" + body


LONG = f"trip_distance >= {DEFAULT_LONG_THRESHOLD}"
LABEL = "strftime(make_timestamp(b * 300 * 1000000), '%Y-%m-%d %H:%M:%S')"
NEAREST = "CAST(round(floor(epoch(tpep_pickup_datetime)) / 300) AS BIGINT)"


def _interval(duration: str) -> str:
    n, unit = duration.split()
    return f"INTERVAL '{n} {unit}'"


# -------------------------------------------------------------- queries ----


def dropoffs_by_counted_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = lineitem_dropoff_counts(spark, sf_dir)
    return pickups_by_zone(counted, zones_view(spark, sf_dir), role="dropoff", weight="trips")


def transferred_order_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders by market segment, from two tables transferred to prefixed temp views."""
    prefix = "transferred_"
    transfer_tables(spark, ("orders", "customer"), lambda s, name: table(s, sf_dir, name), prefix=prefix)
    return spark.sql(
        f"""SELECT c.c_mktsegment AS segment, COUNT(*) AS orders, CAST(sum(o.o_totalprice) AS DOUBLE) AS total
FROM {prefix}orders o JOIN {prefix}customer c ON o.o_custkey = c.c_custkey GROUP BY 1"""
    )


def _registry() -> list[RegisteredQuery]:
    q: list[RegisteredQuery] = []

    def add(name: str, build: Builder, sql: str | None, cents: tuple[str, ...] = ()) -> None:
        q.append(
            RegisteredQuery(name, lambda spark, sf_dir, b=build, c=cents: round_doubles(b(spark, sf_dir), cents=c), sql)
        )

    for view in ("events", "lineitem"):
        trips = _trips(view)
        for role, key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
            label = "pickups" if role == "pickup" else "dropoffs"
            add(
                f"{label}_by_zone_{view}",
                dropoffs_by_counted_order
                if (view, role) == ("lineitem", "dropoff")
                else lambda s, d, t=trips, r=role, k=key: pickups_by_zone(t(s, d, k), zones_view(s, d), role=r),
                _with(
                    view,
                    f"""SELECT c.{key}, c.totalTrips, z.Borough, z.Zone
FROM (SELECT {key}, COUNT(*) AS totalTrips FROM trips GROUP BY {key}) c
JOIN zones z ON c.{key} = z.LocationID""",
                ),
            )
        add(
            f"pickups_by_borough_{view}",
            lambda s, d, t=trips: pickups_by_borough(pickups_by_zone(t(s, d, PU), zones_view(s, d), sort=False)),
            _with(
                view,
                """SELECT z.Borough, CAST(COUNT(*) AS BIGINT) AS totalTrips
FROM trips t JOIN zones z ON t.PULocationID = z.LocationID GROUP BY z.Borough""",
            ),
        )
        add(
            f"pickups_by_hour_{view}",
            lambda s, d, t=trips: pickups_by_hour(t(s, d, TIME)),
            _with(
                view,
                """SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, COUNT(*) AS totalTrips
FROM trips GROUP BY 1""",
            ),
        )
        add(
            f"total_trip_count_{view}",
            lambda s, d, t=trips: total_trip_count(t(s, d, TIME)),
            _with(view, "SELECT COUNT(*) AS total_trips FROM trips"),
        )
        add(
            f"distance_stats_{view}",
            lambda s, d, t=trips: distance_stats(t(s, d, DIST)),
            _with(
                view,
                f"""SELECT COUNT(*) AS count, {DEFAULT_LONG_THRESHOLD} AS threshold,
       round(avg(trip_distance), {DIGITS}) AS mean, round(stddev_samp(trip_distance), {DIGITS}) AS stddev,
       round(min(trip_distance), {DIGITS}) AS min, round(max(trip_distance), {DIGITS}) AS max
FROM trips""",
            ),
        )
        add(
            f"trips_by_length_{view}",
            lambda s, d, t=trips: trips_by_length(t(s, d, DIST)),
            _with(view, f"SELECT {LONG} AS isLong, COUNT(*) AS count FROM trips GROUP BY 1"),
        )
        add(
            f"pickups_by_hour_and_length_{view}",
            lambda s, d, t=trips: pickups_by_hour_and_length(t(s, d, TIME, DIST)),
            _with(
                view,
                f"""SELECT CAST(hour(tpep_pickup_datetime) AS INTEGER) AS hour, {LONG} AS isLong,
       COUNT(*) AS totalTrips
FROM trips GROUP BY 1, 2""",
            ),
        )
        for cls, pred, where in (("short", short_trips, f"NOT ({LONG})"), ("long", long_trips, LONG)):
            add(
                f"zone_pair_popularity_{cls}_{view}",
                lambda s, d, t=trips, p=pred: zone_pair_popularity(t(s, d, PU, DO, DIST), zones_view(s, d), p()),
                _with(
                    view,
                    f"""SELECT c.totalTrips, zp.Zone AS Pickup_Zone, zd.Zone AS Dropoff_Zone
FROM (SELECT PULocationID, DOLocationID, COUNT(*) AS totalTrips FROM trips
      WHERE {where} GROUP BY 1, 2) c
JOIN zones zp ON c.PULocationID = zp.LocationID
JOIN zones zd ON c.DOLocationID = zd.LocationID""",
                ),
            )
        for role, key in (("pickup", "PULocationID"), ("dropoff", "DOLocationID")):
            add(
                f"top3_{role}_zones_by_length_{view}",
                lambda s, d, t=trips, r=role, k=key: top_zones_by_length(t(s, d, k, DIST), zones_view(s, d), role=r, k=3),
                _with(
                    view,
                    f"""SELECT isLong, rank, {key}, totalTrips, Borough, Zone FROM (
  SELECT c.isLong, c.{key}, c.totalTrips, z.Borough, z.Zone,
         CAST(row_number() OVER (PARTITION BY c.isLong ORDER BY c.totalTrips DESC, c.{key}) AS INTEGER) AS rank
  FROM (SELECT {LONG} AS isLong, {key}, COUNT(*) AS totalTrips FROM trips
        WHERE trip_distance IS NOT NULL GROUP BY 1, 2) c
  JOIN zones z ON c.{key} = z.LocationID) r
WHERE rank <= 3""",
                ),
            )
        add(
            f"rate_code_distribution_{view}",
            lambda s, d, t=trips: rate_code_distribution(t(s, d, RATE)),
            _with(view, "SELECT RatecodeID AS RateCodeID, COUNT(*) AS totalTrips FROM trips GROUP BY 1"),
        )
        add(
            f"rate_code_evolution_{view}",
            lambda s, d, t=trips: rate_code_evolution(t(s, d, TIME, RATE)),
            _with(
                view,
                """SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_day, RatecodeID AS RateCodeID,
       COUNT(*) AS totalTrips
FROM trips GROUP BY 1, 2""",
            ),
        )
        add(
            f"groupable_trip_count_{view}",
            lambda s, d, t=trips: groupable_trip_count(t(s, d, PAX)),
            _with(view, "SELECT COUNT(*) AS groupable_trips FROM trips WHERE passenger_count < 3"),
        )
        nearest_body = f"""SELECT g.PULocationID, g.total_trips, round(g.total_amount, {DIGITS}) AS total_amount,
       {LABEL} AS approximate_datetime, z.Borough, z.Zone
FROM (SELECT {NEAREST} AS b, PULocationID, COUNT(*) AS total_trips,
             sum(total_amount) AS total_amount
      FROM trips WHERE passenger_count < 3{{extra}} GROUP BY 1, 2) g
JOIN zones z ON g.PULocationID = z.LocationID"""
        add(
            f"rideshare_groups_nearest_{view}",
            lambda s, d, t=trips: rideshare_groups_nearest(t(s, d, TIME, PU, AMT, PAX), zones_view(s, d)),
            _with(view, nearest_body.format(extra="")),
        )
        add(
            f"rideshare_short_trips_{view}",
            lambda s, d, t=trips: rideshare_groups_nearest(
                t(s, d, TIME, PU, AMT, PAX, DIST), zones_view(s, d), predicate=short_trips()
            ),
            _with(view, nearest_body.format(extra=f" AND NOT ({LONG})")),
        )
        window_body = f"""SELECT g.PULocationID, g.total_trips, round(g.total_amount, {DIGITS}) AS total_amount,
       g.ws AS "window-start", g.ws + INTERVAL '5 minutes' AS "window-end", z.Borough, z.Zone
FROM (SELECT time_bucket(INTERVAL '5 minutes', tpep_pickup_datetime, TIMESTAMP '1970-01-01') AS ws,
             PULocationID, COUNT(*) AS total_trips, sum(total_amount) AS total_amount
      FROM trips WHERE passenger_count < 3 AND tpep_pickup_datetime IS NOT NULL{{extra}} GROUP BY 1, 2) g
JOIN zones z ON g.PULocationID = z.LocationID"""
        add(
            f"rideshare_groups_window_{view}",
            lambda s, d, t=trips: rideshare_groups_window(t(s, d, TIME, PU, AMT, PAX), zones_view(s, d)),
            _with(view, window_body.format(extra="")),
        )
        # G7 on O13
        add(
            f"rideshare_short_window_{view}",
            lambda s, d, t=trips: rideshare_groups_window(
                t(s, d, TIME, PU, AMT, PAX, DIST), zones_view(s, d), predicate=short_trips()
            ),
            _with(view, window_body.format(extra=f" AND NOT ({LONG})")),
        )
        add(
            f"average_trip_amount_{view}",
            lambda s, d, t=trips: average_trip_amount(t(s, d, AMT)),
            _with(view, f"SELECT round(avg(total_amount), {DIGITS}) AS avg_total_amount FROM trips"),
        )
        impact_cols = f"""total_trips * CAST(0.05 AS DOUBLE) AS groupedRides,
       total_trips * CAST(0.05 AS DOUBLE) * CAST(0.3 AS DOUBLE)
         * (CAST(0.6 AS DOUBLE) * (SELECT avg(total_amount) FROM trips) - 5) AS accepted,
       total_trips * CAST(0.05 AS DOUBLE) * (1 - CAST(0.3 AS DOUBLE)) * 2 AS rejected"""
        impact_sql = f"""impact AS (
  SELECT g.PULocationID, g.total_trips, g.total_amount, {LABEL} AS approximate_datetime, z.Borough, z.Zone,
       {impact_cols}
  FROM (SELECT {NEAREST} AS b, PULocationID, COUNT(*) AS total_trips, sum(total_amount) AS total_amount
        FROM trips WHERE passenger_count < 3 GROUP BY 1, 2) g
  JOIN zones z ON g.PULocationID = z.LocationID)"""
        add(
            f"rideshare_impact_{view}",
            lambda s, d, t=trips: rideshare_impact(
                rideshare_groups_nearest(t(s, d, TIME, PU, AMT, PAX), zones_view(s, d)), t(s, d, AMT)
            ),
            _with(
                view,
                f"""SELECT PULocationID, total_trips, round(total_amount, {DIGITS}) AS total_amount, approximate_datetime,
       Borough, Zone, round(groupedRides, {DIGITS}) AS groupedRides,
       round(accepted, {DIGITS}) AS acceptedGroupedRidesEconomicImpact,
       round(rejected, {DIGITS}) AS rejectedGroupedRidesEconomicImpact,
       round(accepted + rejected, {DIGITS}) AS totalImpact
FROM impact""",
                (impact_sql,),
            ),
        )
        add(
            f"rideshare_impact_total_{view}",
            lambda s, d, t=trips: impact_total(
                t(s, d, PU, AMT, PAX), zones_view(s, d), grouped=is_groupable(DAY_TRIPS)
            ),
            _with(
                view,
                f"SELECT round(sum(accepted + rejected), {CENT_DIGITS}) AS total FROM impact",
                (impact_sql,),
            ),
            cents=("total",),
        )
        # O22: the same total as the job computes it, in one pass
        add(
            f"day_impact_{view}",
            lambda s, d, t=trips: day_impact(t(s, d, PU, AMT, PAX), zones_view(s, d)),
            _with(
                view,
                f"SELECT round(sum(accepted + rejected), {CENT_DIGITS}) AS total FROM impact",
                (impact_sql,),
            ),
            cents=("total",),
        )
        for duration in ("2 hours", "3 hours", "4 hours"):
            tag = duration.split()[0] + "h"
            window_counts = f"""(SELECT time_bucket({_interval(duration)}, tpep_pickup_datetime, TIMESTAMP '1970-01-01') AS ws,
             PULocationID, COUNT(*) AS total_trips
      FROM trips WHERE tpep_pickup_datetime IS NOT NULL GROUP BY 1, 2)"""
            add(
                f"peak_demand_{tag}_{view}",
                lambda s, d, t=trips, du=duration: peak_demand(t(s, d, TIME, PU), zones_view(s, d), du),
                _with(
                    view,
                    f"""SELECT c.ws AS "peak-range-start", c.ws + {_interval(duration)} AS "peak-range-end",
       c.PULocationID, c.total_trips, z.Borough, z.Zone
FROM {window_counts} c
JOIN zones z ON c.PULocationID = z.LocationID""",
                ),
            )
            if duration != "2 hours":
                continue
            add(
                f"peak_share_{tag}_{view}",
                lambda s, d, t=trips, du=duration: peak_share(
                    t(s, d, TIME, PU), zones_view(s, d), du, all_trips=t(s, d, TIME)
                ),
                _with(
                    view,
                    f"""SELECT c.ws AS "peak-range-start", c.ws + {_interval(duration)} AS "peak-range-end",
       c.PULocationID, c.total_trips, z.Borough, z.Zone,
       round(c.total_trips * CAST(100.0 AS DOUBLE) / (SELECT COUNT(*) FROM trips), {DIGITS}) AS share_pct
FROM {window_counts} c
JOIN zones z ON c.PULocationID = z.LocationID""",
                ),
            )
            add(
                f"peak_per_zone_{tag}_{view}",
                lambda s, d, t=trips, du=duration: peak_per_zone(t(s, d, TIME, PU), zones_view(s, d), du),
                _with(
                    view,
                    f"""SELECT r.PULocationID, r.ws AS "peak-range-start", r.ws + {_interval(duration)} AS "peak-range-end",
       r.total_trips, z.Borough, z.Zone
FROM (SELECT *, row_number() OVER (PARTITION BY PULocationID ORDER BY total_trips DESC, ws) AS rn
      FROM {window_counts} c) r
JOIN zones z ON r.PULocationID = z.LocationID
WHERE r.rn = 1""",
                ),
            )

    # O05: every trip with its length flag
    add(
        "with_length_flag_events",
        lambda s, d: with_length_flag(events_trips(s, d)),
        _with(
            "events",
            f"""SELECT tpep_pickup_datetime, PULocationID, DOLocationID, round(trip_distance, {DIGITS}) AS trip_distance,
       passenger_count, round(total_amount, {DIGITS}) AS total_amount, RatecodeID, {LONG} AS isLong
FROM trips""",
        ),
    )
    # O24: the trip source on a whole table, pickup time made wall clock
    add(
        "read_trips_events",
        lambda s, d: read_trips(s, f"{d}/events.parquet", DAY_TRIPS.with_(pickup_time="ts")),
        f"SELECT event_id, ts, user_id, event_type, round(value, {DIGITS}) AS value, props FROM events",
    )

    # payment type exists on the lineitem view only
    add(
        "payment_by_length_lineitem",
        lambda s, d: payment_by_length(lineitem_trips(s, d, (PAY, DIST))),
        _with(
            "lineitem",
            f"SELECT payment_type, {LONG} AS isLong, COUNT(*) AS totalTrips FROM trips GROUP BY 1, 2",
        ),
    )
    add(
        "payment_evolution_lineitem",
        lambda s, d: payment_evolution(lineitem_trips(s, d, (TIME, PAY))),
        _with(
            "lineitem",
            """SELECT CAST(tpep_pickup_datetime AS DATE) AS pickup_day, payment_type, COUNT(*) AS totalTrips
FROM trips GROUP BY 1, 2""",
        ),
    )

    # multi-year layout: no passenger count, counts scaled, money not
    share = f"(CAST({GROUPABLE_TRIPS_DAY} AS DOUBLE) / {ALL_TRIPS_DAY})"
    hist_nearest = NEAREST.replace("tpep_pickup_datetime", "pickup_datetime")
    scaled_sql = f"""scaled AS (
  SELECT g.pickup_taxizone_id, g.n * {share} AS total_trips, g.total_amount,
         {LABEL} AS approximate_datetime, z.Borough, z.Zone
  FROM (SELECT {hist_nearest} AS b, pickup_taxizone_id, COUNT(*) AS n, sum(total_amount) AS total_amount
        FROM trips GROUP BY 1, 2) g
  JOIN zones z ON g.pickup_taxizone_id = z.LocationID)"""
    scaled_impact = f"""total_trips * CAST(0.05 AS DOUBLE) AS groupedRides,
       total_trips * CAST(0.05 AS DOUBLE) * CAST(0.3 AS DOUBLE)
         * (CAST(0.6 AS DOUBLE) * (SELECT avg(total_amount) FROM trips) - 5) AS accepted,
       total_trips * CAST(0.05 AS DOUBLE) * (1 - CAST(0.3 AS DOUBLE)) * 2 AS rejected"""

    def scaled(s: SparkSession, d: str, sort: bool = True) -> DataFrame:
        return rideshare_groups_scaled(events_history_trips(s, d), zones_view(s, d), HISTORY_TRIPS, sort=sort)

    add(
        "rideshare_groups_scaled_events",
        scaled,
        _with(
            "history",
            f"""SELECT pickup_taxizone_id, round(total_trips, {DIGITS}) AS total_trips,
       round(total_amount, {DIGITS}) AS total_amount, approximate_datetime, Borough, Zone
FROM scaled""",
            (scaled_sql,),
        ),
    )
    add(
        "rideshare_impact_scaled_events",
        lambda s, d: rideshare_impact(scaled(s, d), events_history_trips(s, d), cols=HISTORY_TRIPS),
        _with(
            "history",
            f"""SELECT pickup_taxizone_id, round(total_trips, {DIGITS}) AS total_trips,
       round(total_amount, {DIGITS}) AS total_amount, approximate_datetime, Borough, Zone,
       round(groupedRides, {DIGITS}) AS groupedRides,
       round(accepted, {DIGITS}) AS acceptedGroupedRidesEconomicImpact,
       round(rejected, {DIGITS}) AS rejectedGroupedRidesEconomicImpact,
       round(accepted + rejected, {DIGITS}) AS totalImpact
FROM impact""",
            (scaled_sql, f"impact AS (SELECT *, {scaled_impact} FROM scaled)"),
        ),
    )
    add(
        "rideshare_impact_scaled_total_events",
        lambda s, d: impact_total(
            events_history_trips(s, d), zones_view(s, d), cols=HISTORY_TRIPS, share=GROUPABLE_SHARE
        ),
        _with(
            "history",
            f"SELECT round(sum(accepted + rejected), {CENT_DIGITS}) AS total FROM impact",
            (scaled_sql, f"impact AS (SELECT *, {scaled_impact} FROM scaled)"),
        ),
        cents=("total",),
    )
    add(
        "rideshare_groups_scaled_money_events",
        lambda s, d: rideshare_groups_scaled(
            events_history_trips(s, d), zones_view(s, d), HISTORY_TRIPS, scale_amount=True
        ),
        _with(
            "history",
            f"""SELECT pickup_taxizone_id, round(total_trips, {DIGITS}) AS total_trips,
       round(total_amount * {share}, {DIGITS}) AS total_amount, approximate_datetime, Borough, Zone
FROM scaled""",
            (scaled_sql,),
        ),
    )
    # O23: the same total as the job computes it, in one pass
    add(
        "history_impact_events",
        lambda s, d: history_impact(events_history_trips(s, d), zones_view(s, d)),
        _with(
            "history",
            f"SELECT round(sum(accepted + rejected), {CENT_DIGITS}) AS total FROM impact",
            (scaled_sql, f"impact AS (SELECT *, {scaled_impact} FROM scaled)"),
        ),
        cents=("total",),
    )
    # O12 on a zoned pickup time, which no source has cast: the label is its wall clock in the session zone
    add(
        "rideshare_groups_nearest_zoned_events",
        lambda s, d: rideshare_groups_nearest(
            events_trips(s, d).withColumn(TIME, F.col(TIME).cast("timestamp")), zones_view(s, d)
        ),
        _with(
            "events",
            f"""SELECT g.PULocationID, g.total_trips, round(g.total_amount, {DIGITS}) AS total_amount,
       {LABEL} AS approximate_datetime, z.Borough, z.Zone
FROM (SELECT {NEAREST} AS b, PULocationID, COUNT(*) AS total_trips, sum(total_amount) AS total_amount
      FROM trips WHERE passenger_count < 3 GROUP BY 1, 2) g
JOIN zones z ON g.PULocationID = z.LocationID""",
        ),
    )
    # O27b: tables transferred to temp views and joined there
    add(
        "transfer_tables_orders",
        transferred_order_totals,
        f"""SELECT c.c_mktsegment AS segment, COUNT(*) AS orders, round(sum(o.o_totalprice), {CENT_DIGITS}) AS total
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1""",
        cents=("total",),
    )
    return q


REGISTRY: list[RegisteredQuery] = _registry()
BY_NAME: dict[str, RegisteredQuery] = {r.name: r for r in REGISTRY}


def queries() -> dict[str, Builder]:
    return {r.name: r.build for r in REGISTRY}


def oracle_sql() -> dict[str, str]:
    return {r.name: r.sql for r in REGISTRY if r.sql is not None}
