"""Sources and sinks: CSV/Parquet/tables, SQL text, landed JSON documents."""
