"""Column-level helpers: pure ``Column -> Column`` expressions, all JVM-side."""

from mobility.functions.length import DEFAULT_LONG_THRESHOLD, is_long, with_length_flag
from mobility.functions.time import (
    bucket_label,
    hour_of_day,
    instant_to_wall_clock,
    nearest_bucket,
    pickup_day,
    to_wall_clock,
    tumbling_window,
    wall_clock_to_instant,
)

__all__ = [
    "DEFAULT_LONG_THRESHOLD",
    "bucket_label",
    "hour_of_day",
    "instant_to_wall_clock",
    "is_long",
    "nearest_bucket",
    "pickup_day",
    "to_wall_clock",
    "tumbling_window",
    "wall_clock_to_instant",
    "with_length_flag",
]
