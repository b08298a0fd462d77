"""Scans, sinks and the adapters that turn the driver's star-schema tables
into the financial shapes the operators consume."""
