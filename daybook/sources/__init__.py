"""Sources and sinks: raw CSV, tables (parquet by default), the test-table adapter."""
