"""End-to-end jobs, test views and the query catalogue."""
