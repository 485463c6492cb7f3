"""End-to-end jobs and report tables."""
