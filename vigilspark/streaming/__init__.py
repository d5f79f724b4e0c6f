"""File-stream ingestion and incremental maintenance of the report tables."""
