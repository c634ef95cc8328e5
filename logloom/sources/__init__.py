"""Tables and files: the log store on Parquet, raw log files."""
