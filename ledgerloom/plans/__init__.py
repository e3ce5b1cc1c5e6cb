"""Whole jobs: concept families, profit pipelines, zone ingestion, exports."""
