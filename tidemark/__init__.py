"""Keeps warehouse definitions and table extracts in step with their source, on Spark."""
