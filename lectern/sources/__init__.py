"""Readers of landed folders and snapshots."""
