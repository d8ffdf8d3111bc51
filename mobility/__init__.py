"""mobility: trip analytics on the Spark DataFrame API.

Operators live in ``mobility.operators`` (functions from DataFrames to a
DataFrame), column expressions in ``mobility.functions``, readers and writers
in ``mobility.sources``, batch jobs and the named-query registry in
``mobility.plans``, and the streaming forms in ``mobility.streaming``.
"""

from mobility.schema import DAY_TRIPS, HISTORY_TRIPS, ZONE_SCHEMA, TripColumns

__all__ = ["DAY_TRIPS", "HISTORY_TRIPS", "ZONE_SCHEMA", "TripColumns"]
