"""Log analytics on PySpark: ingest, consume, search, index, collect and fleet relations."""
