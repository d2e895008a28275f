"""Query catalog and end-to-end jobs."""
