"""Joining the zone dimension.

The zone table is a dimension of a few hundred rows.  It is broadcast only
after its rows and bytes have been counted against bounds; a larger table
falls back to an ordinary join and Spark picks a shuffle strategy (AQE can
still turn it into a broadcast at run time when the shuffled side turns out
small).

Facts are always aggregated *before* they meet the dimension, so the join sees
one row per group, not one per trip.
"""

from __future__ import annotations

from collections.abc import Sequence
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Largest dimension we broadcast, in rows and in bytes of its columns.
DIMENSION_BROADCAST_MAX_ROWS = 100_000
DIMENSION_BROADCAST_MAX_BYTES = 16 * 1024 * 1024

# DataFrame object -> (rows, bytes).  One object has one file listing, so its
# answer stays true; a table that is read again is a new object and is counted
# again.  Entries go with their objects.
_measured: WeakKeyDictionary[DataFrame, tuple[int, int]] = WeakKeyDictionary()


def _row_bytes(field: T.StructField) -> Column:
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 16
    if isinstance(field.dataType, T.AtomicType):
        return F.lit(16)
    return F.coalesce(F.octet_length(F.to_json(F.struct(f"`{field.name}`"))), F.lit(0)) + 16


def measured_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes of all columns) of ``df``: one aggregate job, one row a task is shuffled.

    Counted once for a DataFrame object.
    """
    if df not in _measured:
        size = sum((_row_bytes(f) for f in df.schema.fields), F.lit(0))
        row = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("bytes")).first()
        _measured[df] = (row["n"], row["bytes"])
    return _measured[df]


def is_bounded(
    df: DataFrame,
    max_rows: int = DIMENSION_BROADCAST_MAX_ROWS,
    max_bytes: int = DIMENSION_BROADCAST_MAX_BYTES,
) -> bool:
    """True when ``df`` is within both bounds.  Runs a small job the first time."""
    rows, size = measured_size(df)
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(df: DataFrame, max_rows: int = DIMENSION_BROADCAST_MAX_ROWS) -> DataFrame:
    """``F.broadcast(df)`` if its size is proven small, else ``df`` unchanged."""
    return F.broadcast(df) if is_bounded(df, max_rows) else df


def attach_zone(
    facts: DataFrame,
    zones: DataFrame,
    key: str,
    keep: Sequence[str] = ("Borough", "Zone"),
    rename: dict[str, str] | None = None,
) -> DataFrame:
    """Inner-join ``facts.key == zones.LocationID`` and append ``keep`` columns.

    Rows whose key is null or unknown drop out, as in an inner join.  Column
    names in ``rename`` are renamed on the zone side first, so the same
    dimension can play the pickup and the drop-off role in one query.
    """
    rename = rename or {}
    dim = zones.select(
        F.col("LocationID").alias("__zone_id"),
        *[F.col(c).alias(rename.get(c, c)) for c in keep],
    )
    if is_bounded(zones):
        dim = F.broadcast(dim)
    joined = facts.join(dim, facts[key] == dim["__zone_id"], "inner")
    return joined.drop("__zone_id")
