"""Sources and sinks: bronze JSON-lines tables, landing writers, rejects,
day-partitioned Parquet tables, and the role mapping of the driver tables."""
