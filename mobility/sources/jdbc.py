"""Relational tables over JDBC.

Connection details are arguments, never constants in code.  A table can be
read in parallel: with ``partition_column`` and bounds Spark opens
``num_partitions`` connections, each reading one stride of the key range,
instead of a single task pulling the whole table through one connection.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    schema: str | None = "public",
    user: str | None = None,
    password: str | None = None,
    driver: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | None = None,
    upper_bound: int | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = 10_000,
) -> dict[str, str]:
    """Reader options for ``spark.read.format('jdbc')``; ``dbtable`` is
    ``<schema>.<table>``."""
    opts = {"url": url, "dbtable": f"{schema}.{table}" if schema else table}
    for key, value in (("user", user), ("password", password), ("driver", driver), ("fetchsize", fetch_size)):
        if value is not None:
            opts[key] = str(value)
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned read needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return opts


def read_table(spark: SparkSession, table: str, url: str, single_connection: bool = False, **options) -> DataFrame:
    """Read one database table (``public.<table>`` by default).

    Without a ``partition_column`` Spark would pull the whole table through one
    connection into one task; that is done only when ``single_connection`` asks
    for it.  Filters and column choices on the result are pushed into the SQL sent to
    the database.
    """
    if not single_connection and options.get("partition_column") is None:
        raise ValueError("give partition_column with bounds, or ask for single_connection")
    return spark.read.format("jdbc").options(**jdbc_options(url, table, **options)).load()


def transfer_tables(
    spark: SparkSession,
    names: Iterable[str],
    reader: Callable[[SparkSession, str], DataFrame],
    write_to_warehouse: bool = False,
    prefix: str = "",
) -> dict[str, DataFrame]:
    """Register every table as a temp view named ``prefix`` and its own name;
    optionally also overwrite a managed table of its own name in the current
    database (with an empty prefix the view hides it in this session).

    A view is only a catalog entry: nothing is loaded until a query runs.
    """
    frames = {}
    for name in names:
        df = reader(spark, name)
        df.createOrReplaceTempView(f"{prefix}{name}")
        if write_to_warehouse:
            df.write.mode("overwrite").saveAsTable(name)
        frames[name] = df
    return frames
