"""Streams over landed folders."""
