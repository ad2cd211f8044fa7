"""Readers and writers: raw CSV files, the Parquet mart, driver-table adapters, sinks."""
