"""Sources and sinks: parquet tables, raw CSV landing, test-data views, warehouse."""
