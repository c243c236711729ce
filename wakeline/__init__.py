"""Vessel-track analytics as composable Spark DataFrame functions."""
