"""Time bucketing.

Hours, days, buckets, windows and labels are wall-clock values.  Every function
here first takes the wall clock of its argument (``to_wall_clock``): a no-op on
``timestamp_ntz``, which then does not move with the session zone, and the
session zone's reading of a zoned ``timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the text form of a bucket label.
LABEL_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_wall_clock(ts: Column | str) -> Column:
    """Cast a pickup time to ``timestamp_ntz`` (no-op when it already is).

    A zoned ``timestamp`` is read in the session zone once, at the source;
    everything downstream is then zone-independent.
    """
    return _col(ts).cast(T.TimestampNTZType())


def nearest_bucket(ts: Column | str, seconds: int = 300) -> Column:
    """Index of the nearest ``seconds`` mark: ``round(epoch_seconds / seconds)``.

    Rounds half up, so with 300 s a time 149 s past a mark stays on it and
    150 s goes to the next one.  ``bigint`` so ``bucket * seconds`` cannot
    overflow after 2038.
    """
    return F.round(F.unix_timestamp(to_wall_clock(ts)) / F.lit(seconds)).cast(T.LongType())


def bucket_label(bucket: Column | str, seconds: int = 300) -> Column:
    """Wall-clock text ``yyyy-MM-dd HH:mm:ss`` of ``bucket * seconds``."""
    start = F.timestamp_add("SECOND", _col(bucket) * F.lit(seconds), _epoch_ntz())
    return F.date_format(start, LABEL_FORMAT)


def hour_of_day(ts: Column | str) -> Column:
    return F.hour(to_wall_clock(ts))


def pickup_day(ts: Column | str) -> Column:
    return F.to_date(to_wall_clock(ts))


def tumbling_window(ts: Column | str, duration: str) -> Column:
    """Epoch-aligned tumbling window ``[start, end)`` as a struct.

    Spark turns this into one arithmetic projection (no row expansion).
    """
    return F.window(to_wall_clock(ts), duration)


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())


def wall_clock_to_instant(ts: Column | str) -> Column:
    """The zoned ``timestamp`` whose UTC reading is the wall clock ``ts``.

    Pure micro-second arithmetic, so the session zone plays no part.
    Streaming watermarks need a zoned timestamp; this is how a wall-clock
    pickup time gets one without moving windows.
    """
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", _epoch_ntz(), _col(ts)))


def instant_to_wall_clock(ts: Column | str) -> Column:
    """Inverse of ``wall_clock_to_instant``: back to ``timestamp_ntz``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(ts)), _epoch_ntz())
