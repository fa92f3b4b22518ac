"""Scans, sinks and the driver-table role adapters."""
