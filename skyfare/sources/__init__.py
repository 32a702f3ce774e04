"""Sources and sinks: fixture projections, layered Parquet tables, landed JSON."""
