"""Extraction jobs: landed payloads to normalized rows. One function per payload shape."""
