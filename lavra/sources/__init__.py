"""Scans, contracts, layer tables, audit logs and event files."""
