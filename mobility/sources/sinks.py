"""Sinks: CSV results and a day-partitioned trip table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mobility.functions.time import pickup_day, to_wall_clock
from mobility.schema import DAY_TRIPS, TripColumns


# Rows of one file of the trip table: about 1 GB of 17 columns before compression.
MAX_ROWS_PER_FILE = 10_000_000


def write_result_csv(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with ``df`` as CSV with a header line.

    Every task writes its own part (a one-row result has one).  The commit
    protocol makes the overwrite safe against lost executors: failed tasks are
    retried and only committed task output becomes visible.
    """
    df.write.mode("overwrite").option("header", True).csv(path)


def write_trips_by_day(
    trips: DataFrame,
    path: str,
    cols: TripColumns = DAY_TRIPS,
    column: str = "pickup_date",
    max_rows_per_file: int = MAX_ROWS_PER_FILE,
) -> None:
    """Write trips as parquet partitioned by pickup day.

    Only the days that ``trips`` holds are replaced (dynamic partition
    overwrite); other days in ``path`` stay.  Queries that filter on
    ``pickup_date`` then read only the matching folders.

    Rows are range-partitioned on (day, pickup time, hash of the row): each
    task writes into one or two day folders, and a day holding a third of all
    trips is split over many tasks, also when all its times are equal (only
    rows equal in every column stay together).  Spark merges neighbouring
    small partitions; ``max_rows_per_file`` bounds what a task puts in a file.
    """
    ts = to_wall_clock(cols.pickup_time)
    dated = trips.withColumn(column, pickup_day(ts))
    (
        dated.repartitionByRange(F.col(column), ts, F.xxhash64(*[F.col(f"`{c}`") for c in trips.columns]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", str(max_rows_per_file))
        .partitionBy(column)
        .parquet(path)
    )
