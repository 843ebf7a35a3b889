"""Raw tables: declared schemas, typed scans, CSV ingestion, external tables."""
