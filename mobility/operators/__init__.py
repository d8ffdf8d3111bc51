"""Query operators: functions from DataFrames to a DataFrame."""

from mobility.operators.demand import (
    peak_demand,
    peak_per_zone,
    peak_share,
    pickups_by_borough,
    pickups_by_hour,
    pickups_by_zone,
    total_trip_count,
)
from mobility.operators.dimension import attach_zone, bounded_broadcast, is_bounded
from mobility.operators.distance import (
    distance_stats,
    long_trips,
    pickups_by_hour_and_length,
    short_trips,
    top_zones_by_length,
    trips_by_length,
    zone_pair_popularity,
)
from mobility.operators.impact import (
    DEFAULT_PARAMS,
    ImpactParams,
    average_trip_amount,
    impact_total,
    rideshare_impact,
    rideshare_impact_total,
)
from mobility.operators.payment import (
    payment_by_length,
    payment_evolution,
    rate_code_distribution,
    rate_code_evolution,
)
from mobility.operators.rideshare import (
    GROUPABLE_SHARE,
    groupable,
    groupable_trip_count,
    is_groupable,
    rideshare_groups_nearest,
    rideshare_groups_scaled,
    rideshare_groups_window,
)

__all__ = [name for name in dir() if not name.startswith("_")]
