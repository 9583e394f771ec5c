"""Sources and sinks: parquet, CSV (with and without header), JSON, models."""
