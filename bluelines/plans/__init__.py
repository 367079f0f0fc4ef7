"""End-to-end jobs, sinks and the query catalogue."""
