"""End-to-end flows: ingest runs and the query catalogue."""
