"""Sinks: partitioned Parquet, message transports, JSON dead letter, JDBC."""
