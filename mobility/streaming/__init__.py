"""Structured Streaming forms of the windowed operators."""

from mobility.streaming.windows import (
    read_trip_stream,
    stream_peak_demand,
    stream_rideshare_groups,
    stream_rideshare_groups_nearest,
    write_stream,
)

__all__ = [
    "read_trip_stream",
    "stream_peak_demand",
    "stream_rideshare_groups",
    "stream_rideshare_groups_nearest",
    "write_stream",
]
