"""Scans and sinks: CSV, JSON, SQL dumps and the versioned row store."""
