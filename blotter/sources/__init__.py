"""Sources and sinks: landed feed files and the parquet table catalogue."""
