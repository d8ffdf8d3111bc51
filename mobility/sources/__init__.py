"""Sources and sinks: trip and zone files, JDBC tables, CSV results."""

from mobility.sources.files import read_trips, read_zones
from mobility.sources.jdbc import jdbc_options, read_table, transfer_tables
from mobility.sources.sinks import write_result_csv, write_trips_by_day

__all__ = [
    "jdbc_options",
    "read_table",
    "read_trips",
    "read_zones",
    "transfer_tables",
    "write_result_csv",
    "write_trips_by_day",
]
