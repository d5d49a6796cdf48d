"""Scans: driver-table fixtures and file readers with declared schemas."""
