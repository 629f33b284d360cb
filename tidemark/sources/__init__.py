"""Catalog listings, table scans and the state of the synced copy."""
