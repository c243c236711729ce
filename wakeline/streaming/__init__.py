"""Structured Streaming forms of ingestion and voyage segmentation."""
